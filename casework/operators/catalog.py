"""Price catalog: cheapest contract per price group and who is already on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import (
    joined_text,
    least_strict,
    not_ended,
    number_of,
    ratio,
    text_after_last_hyphen,
    text_before_last_hyphen,
)
from casework.operators.relational import first_per_group, first_rows
from casework.settings import PLACEHOLDER_CONTRACTS, PLATFORM_LEGACY, PLATFORM_NEW

GROUP = ["price_source", "item_e1_num"]


def pricing_is_cheaper() -> Column:
    """The pricing side is strictly cheaper; null on either side is 'no'."""
    return F.coalesce(F.col("pricing_cost_initial") < F.col("comp_cost_initial"), F.lit(False))


def cheaper_side(suffix: str, condition: Column | None = None) -> Column:
    """``pricing_cost_<suffix>`` when the pricing side is cheaper, else ``comp_cost_<suffix>``."""
    cheaper = pricing_is_cheaper() if condition is None else condition
    return F.when(cheaper, F.col(f"pricing_cost_{suffix}")).otherwise(F.col(f"comp_cost_{suffix}"))


def cheaper_branch(ipc: DataFrame) -> DataFrame:
    """Add the contract id, name and type of the cheaper cost side and that cost."""
    return ipc.withColumns(
        {
            "lpg_prca_cost": least_strict(F.col("comp_cost_initial"), F.col("pricing_cost_initial")),
            "var_cst_cont": cheaper_side("list_id"),
            "var_cst_cont_name": cheaper_side("cont_name"),
            "var_cst_cont_type": cheaper_side("cont_type"),
        }
    )


def variable_cost_lines(ipc: DataFrame, placeholders: Sequence[str] = PLACEHOLDER_CONTRACTS) -> DataFrame:
    """Variable-cost catalog lines whose cheaper side names a real contract."""
    priced = cheaper_branch(ipc.filter(F.col("var_cost") == "Y"))
    return priced.filter(F.col("var_cst_cont").isNotNull() & ~F.col("var_cst_cont").isin(*placeholders))


def cheapest_contract(
    ipc: DataFrame,
    groups: DataFrame | None = None,
    placeholders: Sequence[str] = PLACEHOLDER_CONTRACTS,
) -> DataFrame:
    """Smallest cost per (price source, item) and the contract that offers it.

    Equal costs are decided by contract, type and name, nulls last. ``groups``
    (distinct price source and item pairs) limits the catalog first. One
    grouped minimum over a struct gives cost and contract together, so there
    is neither a window nor a join back, and a hot group is combined map-side.
    """
    lines = variable_cost_lines(ipc, placeholders).filter(
        F.col("lpg_prca_cost").isNotNull()
        & F.col("price_source").isNotNull()
        & F.col("item_e1_num").isNotNull()
    )
    if groups is not None:
        lines = lines.join(groups.select(*GROUP).distinct(), GROUP, "left_semi")
    best = first_per_group(
        lines, GROUP, ["lpg_prca_cost", "var_cst_cont", "var_cst_cont_type", "var_cst_cont_name"]
    )
    return best.select(
        *GROUP,
        F.col("lpg_prca_cost").alias("mn_lpg_prca_cost"),
        "var_cst_cont",
        "var_cst_cont_name",
        "var_cst_cont_type",
    )


def connected_share(ipc: DataFrame, chosen: DataFrame, platform: str | None = None) -> DataFrame:
    """Share of accounts already on the cheapest contract, per price source and contract.

    An account counts once per item as "on" (it has a line costed on the
    chosen contract) and once as "off" (it has another line). Both counts are
    summed over the items of a contract and weighted by the number of items on
    the other side; the share is missing when one side has no item. ``chosen``
    holds distinct (price source, item, contract) rows.
    """
    catalog = ipc.filter(F.col("var_cost") == "Y")
    if platform is not None:
        catalog = catalog.filter(F.col("sys_pltfrm") == platform)
    picks = chosen.filter(F.col("var_cst_cont").isNotNull()).select(*GROUP, "var_cst_cont").distinct()
    on_contract = F.coalesce(F.col("comp_cost_list_id") == F.col("var_cst_cont"), F.lit(False))
    per_account = (
        catalog.select(*GROUP, "ship_to", "comp_cost_list_id")
        .join(picks, GROUP)
        .groupBy(*GROUP, "var_cst_cont", "ship_to")
        .agg(F.max(on_contract).alias("on_"), F.max(~on_contract).alias("off_"))
    )
    known = F.col("ship_to").isNotNull()
    per_item = per_account.groupBy(*GROUP, "var_cst_cont").agg(
        F.count_if(F.col("on_") & known).alias("n_on"),
        F.count_if(F.col("off_") & known).alias("n_off"),
        F.max("on_").cast("int").alias("item_on"),
        F.max("off_").cast("int").alias("item_off"),
    )
    totals = per_item.groupBy("price_source", "var_cst_cont").agg(
        F.sum("n_on").alias("n_on"),
        F.sum("n_off").alias("n_off"),
        F.sum("item_on").alias("items_on"),
        F.sum("item_off").alias("items_off"),
    )
    on_side = (F.col("items_off") * F.col("n_on")).cast("decimal(19,0)")
    off_side = (F.col("items_on") * F.col("n_off")).cast("decimal(19,0)")
    return totals.filter((F.col("items_on") > 0) & (F.col("items_off") > 0)).select(
        "price_source",
        "var_cst_cont",
        ratio(on_side, on_side + off_side, 2).cast("decimal(9,4)").alias("prcnt_cnctd"),
    )


def standard_account_connected(lines: DataFrame, keys: Sequence[str] = (*GROUP, "var_cst_cont")) -> DataFrame:
    """'Y'/'N' per key: is the price source's reference account on the cheapest contract?"""
    flag = F.when(F.col("var_cst_cont") == F.col("comp_cost_list_id"), "Y").otherwise("N")
    return (
        lines.filter((F.col("price_source_pcca") == F.col("ship_to")) & (F.col("var_cost") == "Y"))
        .select(*keys, flag.alias("pcca_cnctd"))
        .distinct()
    )


def split_contract_id(
    df: DataFrame,
    column: str,
    number: str = "var_mck_cont_id",
    tier: str = "var_mck_cont_tier",
    lenient: bool = False,
) -> DataFrame:
    """Contract number before and tier after the last hyphen, 0 where missing."""
    c = F.col(column)
    return df.withColumns(
        {
            number: F.coalesce(number_of(text_before_last_hyphen(c), lenient), F.lit(0).cast("long")),
            tier: F.coalesce(number_of(text_after_last_hyphen(c), lenient), F.lit(0).cast("long")),
        }
    )


def _platform_item() -> Column:
    return F.when(F.col("sys_pltfrm") == PLATFORM_LEGACY, F.col("item_as400_num")).otherwise(
        F.col("item_e1_num").cast("string")
    )


OFFER = ["var_cst_cont", "var_cst_cont_id", "var_cst_cont_name", "var_cst_cont_type"]


def catalog_offers(ipc: DataFrame) -> DataFrame:
    """The variable-cost offers of the catalog's lines with the two costs that minima are taken of.

    The one pass over the catalog: everything about the cheapest contract of
    both platforms follows from this frame. Equal offers are not made one here:
    that would move every line once more, and the offers at a minimum are few.
    """
    new_and_cheaper = (F.col("sys_pltfrm") == PLATFORM_NEW) & pricing_is_cheaper()
    strict = least_strict(F.col("comp_cost_initial"), F.col("pricing_cost_initial"))
    cost = F.when(F.col("sys_pltfrm") == PLATFORM_NEW, strict).otherwise(F.col("comp_cost_initial"))
    return (
        ipc.filter(F.col("var_cost") == "Y")
        .select(
            "price_source",
            "item_e1_num",
            "item_as400_num",
            "sys_pltfrm",
            _platform_item().alias("item"),
            cost.alias("mn_lpg_prca_cost"),
            cheaper_side("cont_id", new_and_cheaper).alias("var_cst_cont"),
            cheaper_side("list_id", new_and_cheaper).alias("var_cst_cont_id"),
            cheaper_side("cont_name", new_and_cheaper).alias("var_cst_cont_name"),
            cheaper_side("cont_type", new_and_cheaper).alias("var_cst_cont_type"),
            F.col("comp_cost_initial").alias("least_comp"),
            strict.alias("least_cost"),
        )
    )


def _group_minima(offers: DataFrame) -> DataFrame:
    """Smallest cost per (price source, item text) of both platforms.

    Each minimum runs over every line of the group, whatever its platform; a
    group counts for the platforms that have a line in it.
    """
    legacy = (
        offers.groupBy("price_source", "item_as400_num")
        .agg(
            F.min("least_comp").alias("mn_lpg_prca_cost"),
            F.bool_or(F.col("sys_pltfrm") == PLATFORM_LEGACY).alias("present"),
        )
        .withColumnRenamed("item_as400_num", "item")
    )
    new = (
        offers.groupBy("price_source", "item_e1_num")
        .agg(
            F.min("least_cost").alias("mn_lpg_prca_cost"),
            F.bool_or(F.col("sys_pltfrm") == PLATFORM_NEW).alias("present"),
        )
        .withColumn("item", F.col("item_e1_num").cast("string"))
        .drop("item_e1_num")
    )
    return (
        legacy.unionByName(new)
        .filter("present")
        .select("price_source", "item", "mn_lpg_prca_cost")
        .distinct()
    )


def cheapest_contract_all(
    ipc: DataFrame,
    items: DataFrame,
    tiers: DataFrame,
    gpos: DataFrame,
    as_of: dt.date,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Cheapest contract per (price source, item) of the whole catalog, both platforms.

    The legacy platform uses the competing cost and its own item number. The
    contract's purchasing group is added where contract and group have not
    ended. Rows are distinct. ``stage`` writes the two derived frames that are
    read several times, so that the catalog is scanned once.
    """
    suppliers = items.select("item_e1_num", "parnt_suplr_num").distinct()
    offers = stage(catalog_offers(ipc), "catalog_offers")
    at_minimum = stage(
        offers.select("price_source", "item", "mn_lpg_prca_cost", "item_e1_num", *OFFER)
        .join(_group_minima(offers), ["price_source", "item", "mn_lpg_prca_cost"])
        .distinct(),
        "cheapest_offers",
    )
    winners = first_rows(
        at_minimum,
        ["price_source", "item"],
        ["var_cst_cont", "var_cst_cont_id", "var_cst_cont_type", "var_cst_cont_name"],
    ).join(suppliers, "item_e1_num", "left")
    live_tiers = tiers.filter(not_ended(F.col("cntrct_end_dt"), as_of)).select(
        joined_text(F.col("cntrct_num"), "-", F.col("tier_num")).alias("var_cst_cont_id"),
        F.col("cntrct_type_cd").alias("var_cst_cont_type"),
        "dim_gpo_id",
    )
    live_gpos = gpos.filter(not_ended(F.col("gpo_end_dt"), as_of)).select(
        "dim_gpo_id",
        F.col("gpo_num").alias("var_cst_gpo_num"),
        F.col("gpo_name").alias("var_cst_gpo_name"),
    )
    return (
        winners.join(live_tiers, ["var_cst_cont_id", "var_cst_cont_type"], "left")
        .join(live_gpos, "dim_gpo_id", "left")
        .select(
            joined_text(F.col("price_source"), ",", F.col("item")).alias("prc_src_item_key"),
            "parnt_suplr_num",
            "mn_lpg_prca_cost",
            "var_cst_cont",
            "var_cst_cont_id",
            "var_cst_cont_name",
            "var_cst_cont_type",
            "var_cst_gpo_num",
            "var_cst_gpo_name",
        )
        .distinct()
    )
