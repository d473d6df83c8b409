"""Price lines of the case lines: catalog, cheapest contract, share and flags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import joined_text
from casework.operators.catalog import (
    GROUP,
    cheapest_contract,
    connected_share,
    split_contract_id,
    standard_account_connected,
    variable_cost_lines,
)
from casework.operators.relational import first_rows, may_match
from casework.operators.status import resolved
from casework.settings import PLACEHOLDER_CONTRACTS_V2, PLATFORM_NEW, Settings

Stage = Callable[[DataFrame, str], DataFrame]


def _no_stage(df: DataFrame, name: str) -> DataFrame:
    return df


# --- fixed values: output columns in order -----------------------------------
PRICE_LINE_COLUMNS = [
    "ship_to", "bus_pltfrm", "acct_or_bill_to", "price_source_pcca", "bid_or_prca", "bid_or_prca_name",
    "prcnt_cnctd", "pcca_cnctd", "mn_lpg_prca_cost", "lpg_id", "lpg_desc", "var_cst_cont",
    "var_cst_cont_name", "var_cst_cont_type", "team_assigned", "pool_num", "mmr_case", "insrt_dt",
    "case_cntr", "acct_item_key", "var_mck_cont_id", "var_mck_cont_tier", "vrcst_cntrct_tier_id",
    "dim_cust_curr_id",
]
PRICE_LINE_V2_COLUMNS = [
    "ship_to", "sys_pltfrm", "bus_pltfrm", "acct_or_bill_to", "price_source_pcca", "bid_or_prca",
    "bid_or_prca_name", "prcnt_cnctd", "pcca_cnctd", "mn_lpg_prca_cost", "lpg_id", "lpg_desc",
    "var_cst_cont", "var_cst_cont_name", "var_cst_cont_type", "vrcst_gpo_name", "team_assigned",
    "pool_num", "mmr_case", "insrt_dt", "case_cntr", "acct_item_key", "var_mck_cont_id",
    "var_mck_cont_tier", "vrcst_cntrct_tier_id", "dim_cust_curr_id",
]
# -----------------------------------------------------------------------------

_CASE_FIELDS = ["case_cntr", "team_assigned", "pool_num", "mmr_case", "insrt_dt"]


def catalog_key():
    """Line key of a catalog row, built like the key of the status fact."""
    return joined_text(F.col("sys_pltfrm"), F.col("ship_to"), F.col("bus_pltfrm"), F.col("item_e1_num"))


def attach_price_source(cases: DataFrame, status: DataFrame) -> DataFrame:
    """Cases with the resolved price source and the item of their status line."""
    lines = status.select(
        "acct_item_key", resolved("curr_prc_src").alias("price_source"), "item_e1_num"
    )
    return cases.join(may_match(lines, cases, ["acct_item_key"]), "acct_item_key")


def _catalog_rows(ipc: DataFrame, cases: DataFrame) -> DataFrame:
    """Catalog rows that may be lines of ``cases``: few of the catalog, so the others are not moved to be joined."""
    rows = ipc.withColumnsRenamed({"local_pricing_group_id": "lpg_id"}).withColumn("acct_item_key", catalog_key())
    return may_match(rows, cases, ["acct_item_key"])


def _tier_ids(tiers: DataFrame) -> DataFrame:
    return tiers.select(
        F.col("cntrct_num").alias("var_mck_cont_id"),
        F.col("tier_num").alias("var_mck_cont_tier"),
        F.col("dim_cntrct_tier_id").alias("vrcst_cntrct_tier_id"),
    ).distinct()


def _with_tier(contracts: DataFrame, tiers: DataFrame, lenient: bool) -> DataFrame:
    """Contract number, tier and tier id of frames that have one row per contract offer.

    Joined here, before the lines come in: as many rows as groups, and no line
    without a contract meets the dimension on a shared placeholder key.
    """
    split = split_contract_id(contracts, "var_cst_cont", lenient=lenient)
    return split.join(_tier_ids(tiers), ["var_mck_cont_id", "var_mck_cont_tier"], "left")


def _tier_ids_of(tiers: DataFrame, number: int) -> Column:
    """The tier ids that the dimension has under a placeholder number and tier, looked up once."""
    ids = _tier_ids(tiers).filter((F.col("var_mck_cont_id") == number) & (F.col("var_mck_cont_tier") == number))
    return ids.agg(F.collect_set("vrcst_cntrct_tier_id")).scalar()


def _placeholder(lines: DataFrame, condition: Column, number: int, ids: Column) -> DataFrame:
    """Number, tier and tier ids of a placeholder for the lines that meet the condition."""
    fixed = F.lit(number).cast("long")
    tier_ids = F.when(condition, ids).otherwise(F.array("vrcst_cntrct_tier_id"))
    return lines.withColumns(
        {
            "var_mck_cont_id": F.when(condition, fixed).otherwise(F.col("var_mck_cont_id")),
            "var_mck_cont_tier": F.when(condition, fixed).otherwise(F.col("var_mck_cont_tier")),
            "__tier_ids": tier_ids,
        }
    ).withColumn("vrcst_cntrct_tier_id", F.explode_outer("__tier_ids")).drop("__tier_ids")


def price_case_lines(
    ipc: DataFrame,
    case_lines: DataFrame,
    tiers: DataFrame,
    customers: DataFrame,
    settings: Settings = Settings(),
    stage: Stage = _no_stage,
    lenient: bool = False,
) -> DataFrame:
    """Catalog facts of every case line; only customers of the newer platform.

    ``case_lines`` is the result of :func:`attach_price_source` on numbered
    cases. Everything that depends on (price source, item) only - cheapest
    contract, share, reference account flag - is put together per group first,
    so the lines are joined to it once. ``stage`` materialises the two inner
    results that are read several times. A contract id that is no number
    raises, or counts as 0 when ``lenient``.
    """
    groups = case_lines.select(*GROUP).filter(
        F.col("price_source").isNotNull() & F.col("item_e1_num").isNotNull()
    ).distinct()
    # Few groups of the catalog have a case line: the lines of the others are left out before they are moved.
    grouped = may_match(ipc, groups, GROUP)
    cheapest = stage(cheapest_contract(grouped, groups, settings.placeholder_contracts), "cheapest_contract")
    cases = case_lines.select("acct_item_key", *_CASE_FIELDS)
    lines = stage(
        _catalog_rows(ipc, cases)
        .join(cases, "acct_item_key")
        .select(
            "acct_item_key", *_CASE_FIELDS, *GROUP, "ship_to", "bus_pltfrm", "acct_or_bill_to",
            "price_source_pcca", "bid_or_prca", "bid_or_prca_name", "lpg_id", "lpg_desc",
            "comp_cost_list_id", "var_cost",
        )
        .distinct(),
        "case_catalog",
    )
    chosen = cheapest.join(lines.select(*GROUP).distinct(), GROUP, "left_semi")
    share = connected_share(grouped, chosen)
    reference_lines = lines.filter(F.col("price_source_pcca") == F.col("ship_to")).join(chosen, GROUP)
    connected = standard_account_connected(reference_lines, GROUP)
    per_group = chosen.join(share, ["price_source", "var_cst_cont"], "left").join(connected, GROUP, "left")
    with_contract = lines.join(_with_tier(per_group, tiers, lenient), GROUP, "left")
    priced = _placeholder(with_contract, F.col("var_cst_cont").isNull(), 0, _tier_ids_of(tiers, 0))
    accounts = customers.filter(F.col("sys_pltfrm") == PLATFORM_NEW).select(
        F.col("cust_e1_num").alias("ship_to"), "bus_pltfrm", "dim_cust_curr_id"
    ).distinct()
    return (
        priced.join(accounts, ["ship_to", "bus_pltfrm"])
        .select(*PRICE_LINE_COLUMNS)
        .distinct()
    )


def price_case_lines_v2(
    ipc: DataFrame,
    case_lines: DataFrame,
    tiers: DataFrame,
    customers: DataFrame,
    stage: Stage = _no_stage,
    lenient: bool = False,
) -> DataFrame:
    """The alternative price lines.

    The minimum runs over case lines only, found through one text key of
    price source and item; the purchasing group's name is carried along; equal
    costs are decided by the competing list id too; lines of the older
    platform get contract number and tier -1; the reference account flag needs
    a share; customers of every platform stay. The placeholder ``*`` is a
    contract here, so its number needs ``lenient``.
    """
    cases = case_lines.select(
        "acct_item_key", *_CASE_FIELDS,
        joined_text(F.col("price_source"), ",", F.col("item_e1_num")).alias("group_key"),
    )
    lines = stage(
        _catalog_rows(ipc, cases)
        .join(cases, "acct_item_key")
        .select(
            "acct_item_key", *_CASE_FIELDS, "group_key", *GROUP, "sys_pltfrm", "ship_to", "bus_pltfrm",
            "acct_or_bill_to", "price_source_pcca", "bid_or_prca", "bid_or_prca_name", "lpg_id", "lpg_desc",
            F.col("gpo_name").alias("vrcst_gpo_name"), "comp_cost_initial", "pricing_cost_initial",
            "comp_cost_list_id", "pricing_cost_list_id", "comp_cost_cont_name", "pricing_cost_cont_name",
            "comp_cost_cont_type", "pricing_cost_cont_type", "var_cost",
        )
        .distinct(),
        "case_catalog_v2",
    )
    offers = (
        variable_cost_lines(lines, PLACEHOLDER_CONTRACTS_V2)
        .filter(
            F.col("lpg_prca_cost").isNotNull()
            & F.col("price_source").isNotNull()
            & F.col("item_e1_num").isNotNull()
        )
        .select(
            *GROUP, "group_key", "lpg_prca_cost", "var_cst_cont", "var_cst_cont_type", "comp_cost_list_id",
            "var_cst_cont_name", "vrcst_gpo_name",
        )
        .distinct()
    )
    winners = (
        first_rows(
            offers,
            GROUP,
            ["lpg_prca_cost", "var_cst_cont", "var_cst_cont_type", "comp_cost_list_id", "var_cst_cont_name"],
        )
        .select(
            "group_key", F.col("lpg_prca_cost").alias("mn_lpg_prca_cost"), "var_cst_cont", "var_cst_cont_name",
            "var_cst_cont_type", "vrcst_gpo_name",
        )
        .distinct()
    )
    offered = lines.drop("vrcst_gpo_name").join(_with_tier(winners, tiers, lenient), "group_key", "left")
    priced = stage(offered, "priced_v2")
    chosen = priced.select(*GROUP, "var_cst_cont").filter(F.col("var_cst_cont").isNotNull()).distinct()
    share = connected_share(may_match(ipc, chosen, GROUP), chosen, PLATFORM_NEW)
    connected = standard_account_connected(priced, ["price_source_pcca", "var_cst_cont"])
    with_share = priced.join(share.withColumn("has_share", F.lit(True)), ["price_source", "var_cst_cont"], "left")
    # The flag is looked up by contract, but only for lines whose share exists.
    flag_key = F.when(F.col("has_share"), F.col("var_cst_cont"))
    flags = connected.withColumnRenamed("var_cst_cont", "flag_key")
    flagged = with_share.withColumn("flag_key", flag_key).join(flags, ["price_source_pcca", "flag_key"], "left")
    older = ~F.coalesce(F.col("sys_pltfrm") == PLATFORM_NEW, F.lit(False))
    without = ~older & F.col("var_cst_cont").isNull()
    numbered = _placeholder(flagged, without, 0, _tier_ids_of(tiers, 0))
    numbered = _placeholder(numbered, older, -1, _tier_ids_of(tiers, -1))
    accounts = customers.select(
        F.col("cust_e1_num").alias("ship_to"), "bus_pltfrm", "sys_pltfrm", "dim_cust_curr_id"
    ).distinct()
    return (
        numbered.join(accounts, ["ship_to", "bus_pltfrm", "sys_pltfrm"], "left")
        .select(*PRICE_LINE_V2_COLUMNS)
        .distinct()
    )
