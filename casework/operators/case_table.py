"""The wide case table: status lines of all cases with every attached fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.operators.relational import null_safe_join
from casework.operators.status import (
    CURRENT_PAIRS,
    MARGIN_PAIRS,
    cost_impact,
    resolved,
    sales_measures,
    variable_cost_gap,
)
from casework.settings import COST_INCREASE_LABEL, Settings
from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS

_LINE_KEY = ["acct_item_key", "acct_or_bill_to", "ship_to", "bus_pltfrm"]


def line_facts(
    status: DataFrame,
    cases: DataFrame,
    sales: DataFrame,
    classes: DataFrame,
    price_lines: DataFrame,
    pools: DataFrame,
    memberships: DataFrame,
    attributes: DataFrame,
    excluded: DataFrame,
    addresses: DataFrame,
    settings: Settings = Settings(),
    stage: Callable[..., DataFrame] = lambda df, name, *keys: df,
) -> DataFrame:
    """Everything attached to a case line, keyed by line, account and platform.

    Only the four key columns of the status fact take part, so the wide rows
    are not moved by any of these joins. Case lines without sales drop out.
    With all sides staged in buckets of the line key, the four joins on it need
    no shuffle; ``stage`` does that for the two that are made here.
    """
    case_keys = cases.select(
        "acct_item_key", *_assignment_columns(cases), F.col("pool_num").alias("__case_pool")
    ).distinct()
    exclusion = ["dim_cust_curr_id", "vrcst_cntrct_tier_id"]
    prices = price_lines.join(excluded, exclusion, "left").select(
        "acct_item_key",
        *["bid_or_prca", "bid_or_prca_name", "lpg_id", "lpg_desc", "price_source_pcca"],
        *["mn_lpg_prca_cost", "var_cst_cont", "var_cst_cont_name", "var_cst_cont_type", "prcnt_cnctd"],
        *["var_mck_cont_id", "pcca_cnctd", "vrcst_cont_excld"],
        *["team_assigned", "pool_num", "mmr_case", "insrt_dt", "case_cntr"],
    ).distinct()
    prices = stage(prices, "line_prices", "acct_item_key")
    tiers = stage(attributes.withColumnsRenamed({"curr_mck_cont": "af_curr_mck_cont"}), "line_tiers", "acct_item_key")
    by_line = (
        status.select(*_LINE_KEY)
        .distinct()
        .join(case_keys, "acct_item_key")
        .join(sales, "acct_item_key")
        .join(prices, "acct_item_key", "left")
        .join(tiers, "acct_item_key", "left")
    )
    pool_names = pools.select(
        F.col("pool_num").alias("__case_pool"), "acct_or_bill_to", "pool_name"
    ).distinct()
    by_account = classes.select(F.col("cust_e1_num").alias("ship_to"), "cot").distinct().join(
        memberships, "ship_to", "full"
    )
    facts = (
        by_line.join(pool_names, ["__case_pool", "acct_or_bill_to"], "left")
        .join(by_account, "ship_to", "left")
        .join(addresses.withColumnRenamed("cust_key", "ship_to").distinct(), ["bus_pltfrm", "ship_to"], "left")
    )
    if settings.assignment_from_cases:
        facts = facts.withColumns(
            {
                "team_assigned": F.col("__team"),
                "mmr_case": F.col("__case"),
                "insrt_dt": F.col("__day"),
                "case_cntr": F.col("__cntr"),
                "pool_num": F.col("__case_pool"),
            }
        )
    return facts.drop("__case_pool", "__team", "__case", "__day", "__cntr")


def _assignment_columns(cases: DataFrame):
    """Assignment columns of numbered cases; plain cases have none to offer."""
    if "mmr_case" not in cases.columns:
        return []
    return [
        F.col("team_assigned").alias("__team"),
        F.col("mmr_case").alias("__case"),
        F.col("insrt_dt").alias("__day"),
        F.col("case_cntr").alias("__cntr"),
    ]


def build_case_table(status: DataFrame, facts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct output rows: the status line resolved to current values plus its facts."""
    wide = null_safe_join(status, facts, _LINE_KEY, strict=["acct_item_key"])
    label = F.when(F.col("mmr_type").isin(*settings.cost_increase_types), COST_INCREASE_LABEL).otherwise(
        F.col("bl_mfg_cont_change")
    )
    on_contract = F.when(F.col("var_mck_cont_id") == resolved("curr_mck_cont"), "Y").otherwise("N")
    computed = variable_cost_gap(sales_measures(wide, settings.annual_factor)).withColumns(
        {
            "cost_impact": cost_impact(settings.annual_factor),
            "st_cnctd": on_contract,
            "bl_mfg_cont_change": label,
        }
    )
    # Resolved in one projection: each expression still sees the original columns.
    current = {name: resolved(name) for name in CURRENT_PAIRS}
    margins = {out: F.coalesce(F.col(cur), F.col(trig)) for out, (cur, trig) in MARGIN_PAIRS.items()}
    final = computed.withColumns({**current, **margins, "curr_mck_cont": F.col("af_curr_mck_cont")})
    columns = dict(HISTORY_COLUMNS)
    if settings.report_extras:
        columns |= {c: t for c, t in HISTORY_EXTRA_COLUMNS.items() if c in final.columns}
    return final.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()]).distinct()
