"""Variable-cost exceptions: wide base, ordered category rules, totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import joined_text, not_ended, number_of, ratio, text_before_last_hyphen
from casework.settings import PLATFORM_LEGACY, PLATFORM_NEW, ExceptionSettings


def _live_contracts(gpos: DataFrame, tiers: DataFrame, gpo_num: int, as_of: dt.date) -> DataFrame:
    group = gpos.filter((F.col("gpo_num") == gpo_num) & not_ended(F.col("gpo_end_dt"), as_of)).select("dim_gpo_id")
    contracts = tiers.filter(not_ended(F.col("cntrct_end_dt"), as_of) & (F.col("cntrct_type_cd") == "GPO"))
    return contracts.join(group.distinct(), "dim_gpo_id", "left_semi")


def gpo_contracts(gpos: DataFrame, tiers: DataFrame, gpo_num: int, as_of: dt.date) -> DataFrame:
    """Distinct contract-tier ids of one purchasing group's live contracts."""
    return (
        _live_contracts(gpos, tiers, gpo_num, as_of)
        .select(joined_text(F.col("cntrct_num"), "-", F.col("tier_num")).alias("cont_num_tier"))
        .distinct()
    )


def gpo_items(
    gpos: DataFrame,
    tiers: DataFrame,
    contract_items: DataFrame,
    items: DataFrame,
    ipc: DataFrame,
    gpo_num: int,
    as_of: dt.date,
) -> DataFrame:
    """Distinct catalog items on one purchasing group's live contracts."""
    contracts = _live_contracts(gpos, tiers, gpo_num, as_of).select("dim_cntrct_tier_id").distinct()
    live = (
        contract_items.filter(not_ended(F.col("end_dt"), as_of))
        .join(contracts, "dim_cntrct_tier_id", "left_semi")
        .select("dim_item_e1_curr_id")
        .distinct()
    )
    catalog_items = ipc.select("item_e1_num").distinct()
    return (
        items.join(live, "dim_item_e1_curr_id", "left_semi")
        .select("item_e1_num")
        .distinct()
        .join(catalog_items, "item_e1_num", "left_semi")
    )


def _ranks(hierarchy: DataFrame, contract: str, number: str, rank: str) -> DataFrame:
    return hierarchy.select(
        F.col("man_con_id").alias(contract),
        F.col("mck_con_id").alias(number),
        F.col("hierarchy").alias(rank),
    ).distinct()


def exception_base(
    ipc: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    cheapest: DataFrame,
    focus_contracts: DataFrame,
    focus_items: DataFrame,
    hierarchy: DataFrame,
    lenient: bool = False,
) -> DataFrame:
    """Every variable-cost catalog line with the facts the category rules read.

    Facts that depend on the cheapest contract only are attached to
    ``cheapest`` before the lines are joined to it.
    """
    contract_facts = (
        cheapest.drop("var_cst_cont_name")
        .withColumn("var_cst_num", number_of(text_before_last_hyphen(F.col("var_cst_cont_id")), lenient))
        .join(
            focus_contracts.select(F.col("cont_num_tier").alias("var_cst_cont_id"), F.lit("Y").alias("is_focus")),
            "var_cst_cont_id",
            "left",
        )
        .join(
            _ranks(hierarchy, "var_cst_cont", "var_cst_num", "var_cst_cont_hrchy"),
            ["var_cst_cont", "var_cst_num"],
            "left",
        )
        .withColumn("var_cst_hpg_cont", F.coalesce("is_focus", F.lit("N")))
        .withColumnRenamed("parnt_suplr_num", "var_cst_parnt_suplr_num")
        .drop("is_focus", "var_cst_num")
        .distinct()
    )
    item_text = F.when(F.col("sys_pltfrm") == PLATFORM_NEW, F.col("item_e1_num").cast("string")).otherwise(
        F.col("item_as400_num")
    )
    line_key = F.when(
        F.col("sys_pltfrm") == PLATFORM_LEGACY,
        joined_text(F.col("acct_or_bill_to"), "(1)", F.col("item_as400_num")),
    ).when(F.col("sys_pltfrm") == PLATFORM_NEW, joined_text(F.col("ship_to"), "(2)", F.col("item_e1_num")))
    lines = ipc.filter(F.col("var_cost") == "Y").select(
        line_key.alias("acct_item_key"),
        "sys_pltfrm",
        "price_source",
        "ship_to",
        ratio(F.col("unit_price") - F.col("comp_cost"), F.col("unit_price"), 4).alias("loaded_gp_perc"),
        "comp_cost_initial",
        "vendor_name",
        "prvt_brnd_flg",
        "comp_cost_cont_id",
        "comp_cost_cont_type",
        "gpo_number",
        "gpo_name",
        "cust_primary_gpo_number",
        "cust_primary_gpo_name",
        "qty_3_mth",
        "item_e1_num",
        joined_text(F.col("price_source"), ",", item_text).alias("prc_src_item_key"),
        number_of(text_before_last_hyphen(F.col("comp_cost_list_id")), lenient).alias("comp_num"),
    )
    item_facts = items.select("item_e1_num", "parnt_suplr_num", "prod_grp_cd").distinct()
    flagged_items = focus_items.select("item_e1_num", F.lit("Y").alias("on_focus"))
    restrictions = customers.select(
        F.col("cust_e1_num").alias("ship_to"), "prmry_affln_gpo_cost_flg", "singl_gso_rstrctn_flg"
    ).distinct()
    return (
        lines.join(item_facts.join(flagged_items, "item_e1_num", "full"), "item_e1_num", "left")
        .join(restrictions, "ship_to", "left")
        .join(
            _ranks(hierarchy, "comp_cost_cont_id", "comp_num", "comp_cost_cont_hrchy"),
            ["comp_cost_cont_id", "comp_num"],
            "left",
        )
        .join(contract_facts, "prc_src_item_key", "left")
        .withColumns(
            {
                "hpg_item": F.coalesce("on_focus", F.lit("N")),
                "var_cst_hpg_cont": F.coalesce("var_cst_hpg_cont", F.lit("N")),
            }
        )
        .select(*EXCEPTION_BASE_COLUMNS)
    )


# --- fixed values: output columns in order -----------------------------------
EXCEPTION_BASE_COLUMNS = [
    "acct_item_key", "sys_pltfrm", "price_source", "ship_to", "loaded_gp_perc", "comp_cost_initial",
    "vendor_name", "parnt_suplr_num", "prvt_brnd_flg", "prod_grp_cd", "comp_cost_cont_id",
    "comp_cost_cont_type", "comp_cost_cont_hrchy", "gpo_number", "gpo_name", "cust_primary_gpo_number",
    "cust_primary_gpo_name", "qty_3_mth", "prmry_affln_gpo_cost_flg", "singl_gso_rstrctn_flg", "hpg_item",
    "var_cst_hpg_cont", "mn_lpg_prca_cost", "var_cst_cont", "var_cst_cont_id", "var_cst_cont_hrchy",
    "var_cst_cont_type", "var_cst_gpo_num", "var_cst_gpo_name", "var_cst_parnt_suplr_num",
]
MARKET = "Market Contract"
AMR = "AMR"
SINGLE_GPO = "Single GPO Flag"
FOCUS_SINGLE_SOURCE = "HPG - Single Source"
PRIMARY_GPO = "Primary GPO Flag"
BRAND_BELOW = "Mck Brand < 10%"
BRAND_ABOVE = "Mck Brand >= 10%"
LOW_VOLUME = "RX LVC/OS980 LOCAL"
OS980_BOTH = "OS980 GPO-GPO"
OS980 = "OS980"
HIERARCHY = "Contract Hierarchy"
RANKED_HIERARCHY = "BBraun Hierarchy"
SINGLE_SOURCE = "Supplier Single Source"
IDENTIFIER_CATEGORIES = (BRAND_BELOW, LOW_VOLUME, OS980)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One category rule: all conditions must hold. Unset conditions are ignored.

    ``now`` and ``low`` list the allowed types of the current and the cheapest
    contract; ``when`` names further conditions of :func:`_conditions`.
    """

    category: str
    when: tuple[str, ...] = ()
    now: tuple[str, ...] = ()
    low: tuple[str, ...] = ()


def default_rules() -> list[Rule]:
    """The category rules, most specific claim first; the first match wins.

    The market rule comes first, so later rules of the newer platform that ask
    for a market contract only matter when it is taken out of the list.
    """
    loc, gpo, mkt = "LOC", "GPO", "MKT"
    single, primary = ("new", "single_gpo"), ("new", "primary_gpo")
    rules = [
        Rule(MARKET, ("new",), low=(mkt,)),
        Rule(AMR, ("amr_account", "rx_item", "outside_amr_group")),
        Rule(AMR, ("amr_account", "other_item", "low_not_local")),
        Rule(SINGLE_GPO, single, now=(loc,), low=(mkt,)),
        Rule(SINGLE_GPO, (*single, "own_group"), now=(gpo,), low=(mkt,)),
        Rule(SINGLE_GPO, (*single, "other_group"), now=(loc,), low=(gpo,)),
        Rule(SINGLE_GPO, (*single, "own_group", "other_group"), now=(gpo,), low=(gpo,)),
        Rule(FOCUS_SINGLE_SOURCE, ("new", "focus_customer", "focus_item", "low_off_focus"), low=(gpo,)),
        Rule(PRIMARY_GPO, primary, now=(loc,), low=(mkt,)),
        Rule(PRIMARY_GPO, (*primary, "own_group"), now=(gpo,), low=(mkt,)),
        Rule(PRIMARY_GPO, (*primary, "other_group"), now=(mkt,), low=(gpo,)),
        Rule(BRAND_BELOW, ("new", "brand_load", "margin_below")),
        Rule(BRAND_ABOVE, ("new", "brand_load", "margin_reached")),
        Rule(LOW_VOLUME, ("low_volume_contract",)),
        Rule(OS980_BOTH, ("low_os980", "now_os980")),
        Rule(OS980, ("low_os980", "now_not_os980")),
        Rule(HIERARCHY, ("hierarchy_supplier",), now=(loc, gpo), low=(mkt,)),
        Rule(HIERARCHY, ("hierarchy_supplier",), now=(loc,), low=(gpo,)),
        Rule(HIERARCHY, ("reverse_supplier",), now=(gpo,), low=(loc,)),
        Rule(RANKED_HIERARCHY, ("ranked_supplier", "unranked", "low_ranked_supplier"), now=(loc,), low=(gpo, mkt)),
        Rule(RANKED_HIERARCHY, ("ranked_supplier", "unranked", "low_ranked_supplier"), now=(gpo,), low=(mkt,)),
    ]
    for rank in (1, 2):
        rules += [
            Rule(RANKED_HIERARCHY, (f"rank_{rank}", f"low_rank_over_{rank}_or_group_or_market"), now=(loc,)),
            Rule(RANKED_HIERARCHY, (f"rank_{rank}", f"low_rank_over_{rank}_or_market"), now=(gpo,)),
            Rule(RANKED_HIERARCHY, (f"rank_{rank}", f"low_rank_over_{rank}"), now=(mkt,)),
        ]
    rules += [
        Rule(RANKED_HIERARCHY, ("rank_3", "low_ranked_supplier"), now=(loc,), low=(gpo, mkt)),
        Rule(RANKED_HIERARCHY, ("rank_3", "low_ranked_supplier"), now=(gpo,), low=(mkt,)),
        Rule(SINGLE_SOURCE, ("single_source_supplier", "other_group"), low=(gpo,)),
    ]
    return rules


def _conditions(cfg: ExceptionSettings) -> dict[str, Column]:
    """Named conditions on the exception base. An unknown value is not a match."""
    c = F.col
    supplier, low_supplier = c("parnt_suplr_num"), c("var_cst_parnt_suplr_num")
    low, now, rank, low_rank = c("var_cst_cont"), c("comp_cost_cont_id"), c("comp_cost_cont_hrchy"), c("var_cst_cont_hrchy")
    low_type = c("var_cst_cont_type")
    own, other = c("gpo_number"), c("cust_primary_gpo_number")
    named = {
        "new": c("sys_pltfrm") == PLATFORM_NEW,
        "amr_account": c("ship_to").isin(*cfg.amr_ship_tos),
        "rx_item": c("prod_grp_cd") == "RX",
        "other_item": c("prod_grp_cd") != "RX",
        "outside_amr_group": ~c("var_cst_gpo_num").isin(*cfg.amr_gpo_nums)
        | ~c("var_cst_gpo_name").contains(cfg.amr_gpo_name),
        "low_not_local": low_type != "LOC",
        "single_gpo": c("singl_gso_rstrctn_flg") == "Y",
        "primary_gpo": c("prmry_affln_gpo_cost_flg") == "Y",
        "own_group": (own == other) & (own > 0),
        "other_group": other != c("var_cst_gpo_num"),
        "focus_customer": other == cfg.focus_gpo_num,
        "focus_item": c("hpg_item") == "Y",
        "low_off_focus": c("var_cst_hpg_cont") == "N",
        "brand_load": (c("prvt_brnd_flg") == "Y") & (low == cfg.negative_load_contract),
        "margin_below": c("loaded_gp_perc") < cfg.loaded_margin_cut,
        "margin_reached": c("loaded_gp_perc") >= cfg.loaded_margin_cut,
        "low_volume_contract": low.contains("RXLVC") | low.contains("OS980-LOCAL"),
        "low_os980": low.contains("OS980-"),
        "now_os980": now.contains("OS980-"),
        "now_not_os980": ~now.contains("OS980-"),
        "hierarchy_supplier": supplier.isin(*cfg.hierarchy_suppliers),
        "reverse_supplier": supplier == cfg.reverse_hierarchy_supplier,
        "ranked_supplier": supplier == cfg.ranked_supplier,
        "low_ranked_supplier": low_supplier == cfg.ranked_supplier,
        "unranked": rank.isNull(),
        "rank_3": rank == 3,
        "single_source_supplier": supplier.isin(*cfg.single_source_suppliers),
    }
    for n in (1, 2):
        worse = low_rank > n
        named |= {
            f"rank_{n}": rank == n,
            f"low_rank_over_{n}": worse,
            f"low_rank_over_{n}_or_market": worse | (low_type == "MKT"),
            f"low_rank_over_{n}_or_group_or_market": worse | low_type.isin("GPO", "MKT"),
        }
    return named


def rule_condition(rule: Rule, conditions: dict[str, Column]) -> Column:
    """The conjunction a rule stands for."""
    terms = [conditions[name] for name in rule.when]
    if rule.now:
        terms.append(F.col("comp_cost_cont_type").isin(*rule.now))
    if rule.low:
        terms.append(F.col("var_cst_cont_type").isin(*rule.low))
    return reduce(lambda a, b: a & b, terms)


def category(
    rules: Sequence[Rule] | None = None,
    cfg: ExceptionSettings = ExceptionSettings(),
    conditions: Callable[[ExceptionSettings], dict[str, Column]] = _conditions,
) -> Column:
    """First matching rule's category, null without a match."""
    named = conditions(cfg)
    ordered = default_rules() if rules is None else list(rules)
    chain = F.when(rule_condition(ordered[0], named), ordered[0].category)
    for rule in ordered[1:]:
        chain = chain.when(rule_condition(rule, named), rule.category)
    return chain


def matched_rules(
    rules: Sequence[Rule] | None = None, cfg: ExceptionSettings = ExceptionSettings()
) -> Column:
    """All rules a line matches, as one number with a bit per rule; the first rule is the lowest bit."""
    ordered = default_rules() if rules is None else list(rules)
    if len(ordered) > 63:
        raise ValueError("a mask holds at most 63 rules")
    named = _conditions(cfg)
    bits = [F.when(rule_condition(r, named), 1 << i).otherwise(0).cast("long") for i, r in enumerate(ordered)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def first_rule(mask: Column) -> Column:
    """Place of the lowest bit of a mask, null for none: the rule that decides the category."""
    return F.when(mask != 0, F.bit_count(mask.bitwiseAND(-mask) - 1))


def shadow_report(
    base: DataFrame, rules: Sequence[Rule] | None = None, cfg: ExceptionSettings = ExceptionSettings()
) -> DataFrame:
    """Per rule: its lines, those it decides, and those an earlier rule takes from it.

    One pass with two counts per rule; a rule that matches lines but decides none is
    unreachable on these data.
    """
    ordered = default_rules() if rules is None else list(rules)
    masks = base.select(matched_rules(ordered, cfg).alias("__mask")).select("__mask", first_rule(F.col("__mask")).alias("__first"))
    counts = masks.agg(
        *(
            F.struct(
                F.lit(i + 1).cast("long").alias("rule"),
                F.lit(r.category).alias("category"),
                F.count_if(F.col("__mask").bitwiseAND(1 << i) != 0).alias("n_matched"),
                F.count_if(F.col("__first") == i).alias("n_decided"),
            ).alias(f"__{i}")
            for i, r in enumerate(ordered)
        )
    )
    per_rule = counts.select(F.inline(F.array(*(f"__{i}" for i in range(len(ordered))))))
    return per_rule.withColumn("n_shadowed", F.col("n_matched") - F.col("n_decided"))


def categorise(
    base: DataFrame, rules: Sequence[Rule] | None = None, cfg: ExceptionSettings = ExceptionSettings()
) -> DataFrame:
    """Distinct exception lines with their category."""
    return base.select(
        "acct_item_key",
        "comp_cost_initial",
        "mn_lpg_prca_cost",
        "qty_3_mth",
        category(rules, cfg).alias("var_cst_ctgry"),
    ).distinct()


def _annual_gap(factor: int = 4) -> Column:
    return (F.col("comp_cost_initial") - F.col("mn_lpg_prca_cost")) * F.col("qty_3_mth") * factor


def category_opportunity(categorised: DataFrame) -> DataFrame:
    """Categorised lines with their opportunity; only identifier categories keep it."""
    amount = F.when(F.col("var_cst_ctgry").isin(*IDENTIFIER_CATEGORIES), _annual_gap()).otherwise(
        F.lit(0)
    )
    return categorised.filter(F.col("var_cst_ctgry").isNotNull()).select(
        "acct_item_key", "var_cst_ctgry", amount.alias("var_cst_opp")
    )


def category_totals(categorised: DataFrame) -> DataFrame:
    """One row: number of categorised lines and the annual gap over all lines."""
    return categorised.agg(
        F.count("var_cst_ctgry").alias("n_categorised"),
        F.sum(_annual_gap()).alias("total_gap"),
    )
