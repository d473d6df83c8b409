"""The category rules: one row per rule, order, and a plain evaluation on random rows."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casework.operators.exceptions import (
    EXCEPTION_BASE_COLUMNS,
    categorise,
    category_opportunity,
    category_totals,
    default_rules,
)
from casework.settings import ExceptionSettings

CFG = ExceptionSettings()
SUPPLIER, LISTED, SOURCE = CFG.ranked_supplier, CFG.hierarchy_suppliers[0], 487869
FOCUS = CFG.focus_gpo_num
_LONG = (
    "ship_to parnt_suplr_num comp_cost_cont_hrchy gpo_number cust_primary_gpo_number var_cst_cont_hrchy "
    "var_cst_gpo_num var_cst_parnt_suplr_num"
).split()
_DECIMAL = "loaded_gp_perc comp_cost_initial qty_3_mth mn_lpg_prca_cost".split()
SCHEMA = ", ".join(
    f"{c} {'bigint' if c in _LONG else 'double' if c in _DECIMAL else 'string'}" for c in EXCEPTION_BASE_COLUMNS
)


def types(now, low, **more):
    return {"comp_cost_cont_type": now, "var_cst_cont_type": low, **more}


E1 = {"sys_pltfrm": "E1"}
SINGLE = {**E1, "singl_gso_rstrctn_flg": "Y"}
PRIMARY = {**E1, "prmry_affln_gpo_cost_flg": "Y"}
OWN = {"gpo_number": 7, "cust_primary_gpo_number": 7}
OTHER = {"cust_primary_gpo_number": 7, "var_cst_gpo_num": 8}
AMR = {"ship_to": 184722}
BRAND = {**E1, "prvt_brnd_flg": "Y", "var_cst_cont": "MCKB-NEG-LD"}
BOTH_RANKED = {"parnt_suplr_num": SUPPLIER, "var_cst_parnt_suplr_num": SUPPLIER}

# rule number -> (row, category). Rules 4, 5, 9 and 10 ask for a market
# contract of the newer platform, which the first rule has already taken.
RULE_ROWS = [
    (types(None, "MKT", **E1), "Market Contract"),
    ({**AMR, "prod_grp_cd": "RX", "var_cst_gpo_num": 1, "var_cst_gpo_name": "VIZIENT"}, "AMR"),
    (types(None, "GPO", **AMR, prod_grp_cd="MED"), "AMR"),
    (types("LOC", "MKT", **SINGLE), "Market Contract"),
    (types("GPO", "MKT", **SINGLE, **OWN), "Market Contract"),
    (types("LOC", "GPO", **SINGLE, **OTHER), "Single GPO Flag"),
    (types("GPO", "GPO", **SINGLE, **{**OTHER, **OWN}), "Single GPO Flag"),
    (types(None, "GPO", **E1, cust_primary_gpo_number=FOCUS, hpg_item="Y", var_cst_hpg_cont="N"), "HPG - Single Source"),
    (types("LOC", "MKT", **PRIMARY), "Market Contract"),
    (types("GPO", "MKT", **PRIMARY, **OWN), "Market Contract"),
    (types("MKT", "GPO", **PRIMARY, **OTHER), "Primary GPO Flag"),
    ({**BRAND, "loaded_gp_perc": 0.05}, "Mck Brand < 10%"),
    ({**BRAND, "loaded_gp_perc": 0.10}, "Mck Brand >= 10%"),
    ({"var_cst_cont": "xOS980-LOCAL"}, "RX LVC/OS980 LOCAL"),
    ({"var_cst_cont": "OS980-1", "comp_cost_cont_id": "OS980-2"}, "OS980 GPO-GPO"),
    ({"var_cst_cont": "OS980-1", "comp_cost_cont_id": "x"}, "OS980"),
    (types("GPO", "MKT", parnt_suplr_num=LISTED), "Contract Hierarchy"),
    (types("LOC", "GPO", parnt_suplr_num=LISTED), "Contract Hierarchy"),
    (types("GPO", "LOC", parnt_suplr_num=CFG.reverse_hierarchy_supplier), "Contract Hierarchy"),
    (types("LOC", "GPO", **BOTH_RANKED), "BBraun Hierarchy"),
    (types("GPO", "MKT", **BOTH_RANKED), "BBraun Hierarchy"),
    (types("LOC", "LOC", comp_cost_cont_hrchy=1, var_cst_cont_hrchy=2), "BBraun Hierarchy"),
    (types("GPO", "MKT", comp_cost_cont_hrchy=1), "BBraun Hierarchy"),
    (types("MKT", "LOC", comp_cost_cont_hrchy=1, var_cst_cont_hrchy=2), "BBraun Hierarchy"),
    (types("LOC", "GPO", comp_cost_cont_hrchy=2), "BBraun Hierarchy"),
    (types("GPO", "LOC", comp_cost_cont_hrchy=2, var_cst_cont_hrchy=3), "BBraun Hierarchy"),
    (types("MKT", "LOC", comp_cost_cont_hrchy=2, var_cst_cont_hrchy=3), "BBraun Hierarchy"),
    (types("LOC", "MKT", comp_cost_cont_hrchy=3, var_cst_parnt_suplr_num=SUPPLIER), "BBraun Hierarchy"),
    (types("GPO", "MKT", comp_cost_cont_hrchy=3, var_cst_parnt_suplr_num=SUPPLIER), "BBraun Hierarchy"),
    (types(None, "GPO", parnt_suplr_num=SOURCE, **OTHER), "Supplier Single Source"),
    ({"sys_pltfrm": "AS400"}, None),
    (types("MKT", "LOC", comp_cost_cont_hrchy=2, var_cst_cont_hrchy=2), None),
    ({**AMR, "prod_grp_cd": "RX", "var_cst_gpo_num": 4235270, "var_cst_gpo_name": "A VIZIENT GROUP"}, None),
]


def frame(spark, dicts):
    data = [tuple({**d, "acct_item_key": str(i)}.get(c) for c in EXCEPTION_BASE_COLUMNS) for i, d in enumerate(dicts)]
    return spark.createDataFrame(data, SCHEMA)


def test_there_are_thirty_rules():
    assert len(default_rules()) == 30


def test_one_row_per_rule(spark):
    out = {int(r.acct_item_key): r.var_cst_ctgry for r in categorise(frame(spark, [d for d, _ in RULE_ROWS])).collect()}
    assert [out[i] for i in range(len(RULE_ROWS))] == [c for _, c in RULE_ROWS]


@pytest.mark.parametrize("index", range(30))
def test_each_rule_matches_its_own_row(spark, index):
    """Every rule, taken alone, claims the row written for it (also the four shadowed ones)."""
    rule = default_rules()[index]
    out = categorise(frame(spark, [RULE_ROWS[index][0]]), [rule]).first()
    assert out.var_cst_ctgry == rule.category


def plain_category(d):
    """The same rule list evaluated row by row; None is unknown and never matches."""

    def eq(a, b):
        return a is not None and b is not None and a == b

    def ne(a, b):
        return a is not None and b is not None and a != b

    def over(a, b):
        return a is not None and a > b

    g = d.get
    low, now, has = g("var_cst_cont_type"), g("comp_cost_cont_type"), g("var_cst_cont") or ""
    group, name = g("var_cst_gpo_num"), g("var_cst_gpo_name")
    named = {
        "new": g("sys_pltfrm") == "E1",
        "amr_account": g("ship_to") in CFG.amr_ship_tos,
        "rx_item": g("prod_grp_cd") == "RX",
        "other_item": ne(g("prod_grp_cd"), "RX"),
        "outside_amr_group": (group is not None and group not in CFG.amr_gpo_nums)
        or (name is not None and "VIZIENT" not in name),
        "low_not_local": ne(low, "LOC"),
        "single_gpo": g("singl_gso_rstrctn_flg") == "Y",
        "primary_gpo": g("prmry_affln_gpo_cost_flg") == "Y",
        "own_group": eq(g("gpo_number"), g("cust_primary_gpo_number")) and over(g("gpo_number"), 0),
        "other_group": ne(g("cust_primary_gpo_number"), group),
        "focus_customer": g("cust_primary_gpo_number") == FOCUS,
        "focus_item": g("hpg_item") == "Y",
        "low_off_focus": g("var_cst_hpg_cont") == "N",
        "brand_load": g("prvt_brnd_flg") == "Y" and has == "MCKB-NEG-LD",
        "margin_below": g("loaded_gp_perc") is not None and g("loaded_gp_perc") < 0.1,
        "margin_reached": g("loaded_gp_perc") is not None and g("loaded_gp_perc") >= 0.1,
        "low_volume_contract": "RXLVC" in has or "OS980-LOCAL" in has,
        "low_os980": "OS980-" in has,
        "now_os980": "OS980-" in (g("comp_cost_cont_id") or ""),
        "now_not_os980": g("comp_cost_cont_id") is not None and "OS980-" not in g("comp_cost_cont_id"),
        "hierarchy_supplier": g("parnt_suplr_num") in CFG.hierarchy_suppliers,
        "reverse_supplier": g("parnt_suplr_num") == CFG.reverse_hierarchy_supplier,
        "ranked_supplier": g("parnt_suplr_num") == SUPPLIER,
        "low_ranked_supplier": g("var_cst_parnt_suplr_num") == SUPPLIER,
        "unranked": g("comp_cost_cont_hrchy") is None,
        "rank_3": g("comp_cost_cont_hrchy") == 3,
        "single_source_supplier": g("parnt_suplr_num") in CFG.single_source_suppliers,
    }
    for n in (1, 2):
        worse = over(g("var_cst_cont_hrchy"), n)
        named[f"rank_{n}"] = g("comp_cost_cont_hrchy") == n
        named[f"low_rank_over_{n}"] = worse
        named[f"low_rank_over_{n}_or_market"] = worse or low == "MKT"
        named[f"low_rank_over_{n}_or_group_or_market"] = worse or low in ("GPO", "MKT")
    for rule in default_rules():
        if all(named[w] for w in rule.when) and (not rule.now or now in rule.now) and (not rule.low or low in rule.low):
            return rule.category
    return None


def test_random_rows_equal_a_plain_evaluation(spark):
    rng = random.Random(11)
    choices = {
        "sys_pltfrm": ["E1", "AS400"],
        "ship_to": [184722, 5, None],
        "prod_grp_cd": ["RX", "MED", None],
        "comp_cost_cont_type": ["LOC", "GPO", "MKT", None],
        "var_cst_cont_type": ["LOC", "GPO", "MKT", None],
        "singl_gso_rstrctn_flg": ["Y", "N", None],
        "prmry_affln_gpo_cost_flg": ["Y", "N", None],
        "gpo_number": [0, 7, 8, None],
        "cust_primary_gpo_number": [7, 8, FOCUS, 0, None],
        "var_cst_gpo_num": [7, 8, 4235270, None],
        "var_cst_gpo_name": ["VIZIENT", "OTHER", None],
        "hpg_item": ["Y", "N"],
        "var_cst_hpg_cont": ["Y", "N"],
        "prvt_brnd_flg": ["Y", "N"],
        "var_cst_cont": ["MCKB-NEG-LD", "RXLVC1", "OS980-LOCAL", "OS980-GPO", "M1", "M2", None],
        "comp_cost_cont_id": ["OS980-GPO", "M1", None],
        "loaded_gp_perc": [0.05, 0.1, 0.3, None],
        "parnt_suplr_num": [SUPPLIER, LISTED, SOURCE, 4972445, 1, None],
        "var_cst_parnt_suplr_num": [SUPPLIER, 1, None],
        "comp_cost_cont_hrchy": [1, 2, 3, None],
        "var_cst_cont_hrchy": [1, 2, 3, None],
    }
    dicts = [{c: rng.choice(v) for c, v in choices.items()} for _ in range(1500)]
    out = {int(r.acct_item_key): r.var_cst_ctgry for r in categorise(frame(spark, dicts)).collect()}
    expected = {i: plain_category(d) for i, d in enumerate(dicts)}
    assert out == expected
    assert len(set(expected.values())) == 14


def test_opportunity_and_totals(spark):
    df = spark.createDataFrame(
        [("a", 5.0, 3.0, 2.0, "OS980"), ("b", 5.0, 4.0, 1.0, "AMR"), ("c", 2.0, 1.0, 1.0, None)],
        "acct_item_key string, comp_cost_initial double, mn_lpg_prca_cost double, qty_3_mth double, var_cst_ctgry string",
    )
    assert {(r.acct_item_key, float(r.var_cst_opp)) for r in category_opportunity(df).collect()} == {("a", 16.0), ("b", 0.0)}
    assert tuple(category_totals(df).first()) == (2, 24.0)


def test_the_lowest_bit_of_the_mask_decides(spark):
    """The mask's first rule gives the category of the cascade, and the report adds up."""
    from casework.operators.exceptions import categorise, default_rules, first_rule, matched_rules, shadow_report
    from casework_checks.registry import CHECK_RULES, Tables, _exception_base

    base = _exception_base(Tables(spark, "/root/testdata/sf0.001"))
    names = F.array(*(F.lit(r.category) for r in default_rules()))
    masked = base.withColumn("mask", matched_rules(cfg=CHECK_RULES))
    by_mask = masked.select("acct_item_key", "comp_cost_initial", "mn_lpg_prca_cost", "qty_3_mth", F.get(names, first_rule(F.col("mask"))).alias("var_cst_ctgry"))
    assert rows(by_mask.distinct()) == rows(categorise(base, cfg=CHECK_RULES))
    report = shadow_report(base, cfg=CHECK_RULES).collect()
    assert sum(r.n_decided for r in report) == masked.where("mask <> 0").count()
    assert any(r.n_shadowed for r in report) and all(r.n_matched >= r.n_decided for r in report)
