"""Grouping of candidate lines into numbered cases for the three teams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions import joined_text, year_month_day
from casework.functions.dates import recent_rows
from casework.operators.relational import not_in, numbered_top, without_few_keys
from casework.settings import (
    COST_INCREASE_TYPES,
    PLATFORM_NEW,
    PREFIX_CONTRACT,
    PREFIX_POOL,
    PREFIX_VENDOR,
    TEAM_CONTRACT,
    TEAM_POOL,
    TEAM_VENDOR,
)

CASE_COLUMNS = ["acct_item_key", "case_prefix", "case_cntr", "team_assigned", "pool_num"]


def cost_increase_lines(candidates: DataFrame, types: tuple[str, ...] = COST_INCREASE_TYPES) -> DataFrame:
    """Cost increases caused by a contract change; a null contract is no change."""
    return candidates.filter(
        F.col("mmr_type").isin(*types)
        & (F.col("cost_impact") > 0)
        & (F.col("sys_pltfrm") == PLATFORM_NEW)
        & (F.col("bl_mfg_cont") != F.col("curr_mfg_cont"))
    ).select(
        "acct_item_key", "bus_pltfrm", "bl_mfg_cont", "item_e1_num", "mmr_type", "cost_impact", "pndg_mmr_opp"
    )


def contract_totals(lines: DataFrame, min_impact: dict[str, float] | None = None) -> DataFrame:
    """Summed impact per baseline contract and business platform.

    ``min_impact`` keeps groups above their platform's bound only.
    """
    totals = lines.groupBy("bl_mfg_cont", "bus_pltfrm").agg(F.sum("cost_impact").alias("sum_opp"))
    if min_impact:
        bound = F.lit(None).cast("double")
        for platform, amount in min_impact.items():
            bound = F.when(F.col("bus_pltfrm") == platform, F.lit(float(amount))).otherwise(bound)
        totals = totals.filter(F.col("sum_opp") > bound)
    return totals


def top_contract_cases(lines: DataFrame, n: int = 100, min_impact: dict[str, float] | None = None) -> DataFrame:
    """Lines of the ``n`` contracts with the largest summed impact, one case each."""
    top = numbered_top(
        contract_totals(lines, min_impact), "sum_opp", n, ["bl_mfg_cont", "bus_pltfrm"], "case_cntr"
    ).select("bl_mfg_cont", "bus_pltfrm", "case_cntr")
    return lines.join(top, ["bl_mfg_cont", "bus_pltfrm"]).select(
        "acct_item_key",
        F.lit(PREFIX_CONTRACT).alias("case_prefix"),
        "case_cntr",
        F.lit(TEAM_CONTRACT).alias("team_assigned"),
    )


def pooled_contract_cases(cases: DataFrame, lines: DataFrame) -> DataFrame:
    """Contract case lines with the pool of their account, for information."""
    numbers = lines.select("acct_item_key", "pool_num").distinct()
    return cases.distinct().join(numbers, "acct_item_key", "left").select(*CASE_COLUMNS)


def residual_lines(lines: DataFrame, taken: DataFrame) -> DataFrame:
    """Lines not yet in a case. Few are, so the others are kept where they are."""
    return without_few_keys(lines, "acct_item_key", taken.select("acct_item_key"))


def pool_cases(
    residual: DataFrame,
    history: DataFrame,
    as_of: dt.date,
    days: int = 25,
    ignore_null_keys: bool = False,
) -> DataFrame:
    """One case per pool, unless the pool had a case within the cool-down.

    History rows without a pool make the SQL ``NOT IN`` unknown for every
    pool; ``ignore_null_keys`` leaves them out.
    """
    recent = recent_rows(history, as_of, days).select("pool_num")
    pooled = residual.filter(F.col("pool_num").isNotNull())
    return not_in(pooled, "pool_num", recent, ignore_null_keys).select(
        "acct_item_key",
        F.lit(PREFIX_POOL).alias("case_prefix"),
        F.col("pool_num").alias("case_cntr"),
        F.lit(TEAM_POOL).alias("team_assigned"),
        "pool_num",
    )


def top_customer_vendor_cases(residual: DataFrame, sales: DataFrame, n: int = 10) -> DataFrame:
    """Lines of the ``n`` customer and vendor pairs with the largest sales at a loss.

    Every line counts every sales row of its key. Both sides are summed per
    key before they meet, so repeated keys do not multiply in the join.
    """
    pair = ["highest_cust_name", "vendor_name"]
    without_pool = residual.filter(F.col("pool_num").isNull())
    lines = without_pool.groupBy("acct_item_key", *pair).agg(F.count(F.lit(1)).alias("n_lines"))
    losses = (
        sales.filter(F.col("neg_sls_3_mth") > 0).groupBy("acct_item_key").agg(F.sum("neg_sls_3_mth").alias("loss"))
    )
    totals = (
        lines.join(losses, "acct_item_key")
        .groupBy(*pair)
        .agg(F.sum(F.col("loss") * F.col("n_lines")).alias("neg_sls_3_mth"))
    )
    top = numbered_top(totals, "neg_sls_3_mth", n, pair, "case_cntr").select(*pair, "case_cntr")
    return (
        without_pool.filter(F.col("pndg_mmr_opp") > 0)
        .join(top, pair)
        .select(
            "acct_item_key",
            F.lit(PREFIX_VENDOR).alias("case_prefix"),
            "case_cntr",
            F.lit(TEAM_VENDOR).alias("team_assigned"),
            "pool_num",
        )
    )


def union_cases(*groups: DataFrame) -> DataFrame:
    """Distinct union of the case groups."""
    union = groups[0].select(*CASE_COLUMNS)
    for group in groups[1:]:
        union = union.unionByName(group.select(*CASE_COLUMNS))
    return union.distinct()


def case_number(cases: DataFrame, as_of: dt.date) -> DataFrame:
    """Case id ``yymmdd`` + prefix + counter, and the insert date."""
    day = F.lit(as_of)
    return cases.withColumns(
        {
            "mmr_case": joined_text(year_month_day(day), F.col("case_prefix"), F.col("case_cntr")),
            "insrt_dt": day,
        }
    )


def latest_run_cases(history: DataFrame) -> DataFrame:
    """Distinct cases of the newest run date with their file names."""
    newest = history.agg(F.max("insrt_dt").alias("d")).scalar()
    pool_file = joined_text(F.col("pool_num"), "_", F.col("pool_name"), "_GAP_REPORT_", F.col("mmr_case"))
    team_file = joined_text(F.col("team_assigned"), "-", F.col("mmr_case"))
    return (
        history.filter(F.col("insrt_dt") == newest)
        .select(
            "case_cntr",
            "mmr_case",
            "team_assigned",
            F.when(F.col("team_assigned") == TEAM_POOL, pool_file).otherwise(team_file).alias("file_name"),
        )
        .distinct()
    )
