"""Customer pools."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions import not_ended
from casework.operators.relational import latest_rows
from casework.settings import PLATFORM_NEW, POOL_TYPES


def latest_pool(
    status: DataFrame,
    customers: DataFrame,
    customer_pools: DataFrame,
    pools: DataFrame,
    as_of: dt.date,
    pool_types: tuple[str, ...] = POOL_TYPES,
) -> DataFrame:
    """Pools of each bill-to account with the newest start date, ties kept.

    Accounts and customers are reduced to distinct keys before the joins, so
    the line fact is aggregated once and never joined.
    """
    accounts = status.filter(F.col("sys_pltfrm") == PLATFORM_NEW).select("acct_or_bill_to", "sys_pltfrm").distinct()
    bill_tos = customers.select(
        F.col("bill_to_cust_e1_num").alias("acct_or_bill_to"),
        F.col("dim_bill_to_cust_curr_id").alias("dim_cust_curr_id"),
    ).distinct()
    current = customer_pools.filter(not_ended(F.col("cust_pool_end_dt"), as_of)).select(
        "dim_cust_curr_id", "dim_pool_id", "cust_pool_start_dt"
    )
    kinds = pools.filter(F.col("pool_type_num").isin(*pool_types)).select("dim_pool_id", "pool_num", "pool_name")
    memberships = (
        current.join(kinds, "dim_pool_id")
        .join(bill_tos, "dim_cust_curr_id")
        .join(accounts, "acct_or_bill_to")
        .select("acct_or_bill_to", "sys_pltfrm", "pool_num", "pool_name", "cust_pool_start_dt")
        .distinct()
    )
    newest = latest_rows(memberships, ["acct_or_bill_to"], "cust_pool_start_dt")
    return newest.select("acct_or_bill_to", "sys_pltfrm", "pool_num", "pool_name")


def with_pool(candidates: DataFrame, pools: DataFrame) -> DataFrame:
    """Candidate lines with the pool of their account; lines without one keep null."""
    numbers = pools.select("acct_or_bill_to", "sys_pltfrm", "pool_num")
    return candidates.join(numbers, ["acct_or_bill_to", "sys_pltfrm"], "left").select(
        "acct_item_key", "pool_num", "highest_cust_name", "vendor_name", "pndg_mmr_opp"
    )
