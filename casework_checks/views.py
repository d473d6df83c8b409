"""The driver's tables mapped to the shapes the operators read.

One description serves Spark and the comparing SQL engine: expressions are
plain SQL with the few differing functions supplied by a dialect. Money is
computed in whole cents, so both engines get the same decimals. Nulls are
derived, because the driver's tables have none.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.sources.staging import Staging

AS_OF = dt.date(1998, 6, 30)


class SparkDialect:
    @staticmethod
    def text(x):
        return f"cast({x} as string)"

    @staticmethod
    def div(a, b):
        return f"(({a}) div ({b}))"

    @staticmethod
    def add_days(d, n):
        return f"date_add({d}, cast({n} as int))"

    @staticmethod
    def explode(values):
        return "explode(array(" + ", ".join(f"'{v}'" for v in values) + "))"


class DuckDialect:
    @staticmethod
    def text(x):
        return f"cast({x} as varchar)"

    @staticmethod
    def div(a, b):
        return f"(({a}) // ({b}))"

    @staticmethod
    def add_days(d, n):
        return f"({d} + cast({n} as int))"

    @staticmethod
    def explode(values):
        return "unnest([" + ", ".join(f"'{v}'" for v in values) + "])"


@dataclass
class View:
    base: str
    columns: dict[str, str]
    joins: tuple[str, ...] = ()
    where: str | None = None
    distinct: bool = False
    variants: tuple[str, ...] = ()
    casts: dict[str, str] = field(default_factory=dict)


#: joined table -> (left key, right key)
_JOIN_KEYS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "part": ("l_partkey", "p_partkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}
_LINE_JOINS = ("orders", "customer", "part", "supplier")
_DAY = "date '1998-06-30'"


def _cents(x: str) -> str:
    return f"cast(floor({x} * 100 + 0.5) as bigint)"


def _line_terms(d) -> dict[str, str]:
    """Terms shared by the views over order lines."""
    t = d.text
    sys_ = "case when l_linestatus = 'O' then 'E1' else 'AS400' end"
    bus = "case when l_returnflag = 'R' then 'EC' else 'PC' end"
    retail = _cents("p_retailprice")
    price = _cents("l_extendedprice")
    return {
        "sys": sys_,
        "bus": bus,
        "acct": "(o_custkey - o_custkey % 3)",
        "key": f"({sys_} || {t('o_custkey')} || {bus} || {t('l_partkey')})",
        "retail": retail,
        "price": price,
        "qty": "cast(l_quantity as bigint)",
        "unit": d.div(price, "cast(l_quantity as bigint)"),
        "disc": _cents("l_discount"),
        "tax": _cents("l_tax"),
        "src": f"case when l_partkey % 37 = 0 then null else 'PS' || {t('l_suppkey % 5')} end",
        "trig_src": f"'PS' || {t('(l_suppkey + 1) % 5')}",
        "catalog_src": f"'PS' || {t('l_suppkey % 5')}",
        "bl_date": "cast(o_orderdate as date)",
        "curr_date": (
            "case when l_linenumber = 7 and l_partkey % 5 = 0 then null "
            "when (l_partkey + l_linenumber) % 4 = 0 then cast(o_orderdate as date) "
            "else cast(l_shipdate as date) end"
        ),
        "type": (
            "case l_linenumber when 1 then 'CCI' when 2 then 'VC' when 3 then 'CI/LM' when 4 then 'LM' "
            "when 5 then 'CCI/LM' when 6 then 'CI' else 'VC' end"
        ),
        "team": (
            "case (l_partkey + l_linenumber) % 4 when 0 then 'CCT' when 1 then 'NM' when 2 then 'STRAT' "
            "else 'OTHER' end"
        ),
    }


def _contract_text(d, k: str) -> str:
    return (
        f"case {k} when 3 then 'OS980-GPO3' when 4 then 'OS980-LOCAL4' when 5 then 'RXLVC5' "
        f"when 6 then 'MCKB-NEG-LD' else 'M' || {d.text(k)} end"
    )


def _contract_type(k: str) -> str:
    return f"case (1000 + {k}) % 3 when 0 then 'GPO' when 1 then 'LOC' else 'MKT' end"


def _money(cents: str) -> str:
    return f"cast(({cents}) * 0.01 as decimal(18,4))"


def _whole(x: str) -> str:
    return f"cast({x} as decimal(18,4))"


def _status_columns(d) -> dict[str, str]:
    t, m = d.text, _line_terms(d)
    retail, unit, tax, disc = m["retail"], m["unit"], m["tax"], m["disc"]

    def tier(shift: int, modulus: int) -> str:
        return f"(1000 + (l_suppkey + {shift}) % {modulus}) * 10 + l_linenumber"

    return {
        "acct_item_key": m["key"],
        "sys_pltfrm": m["sys"],
        "bus_pltfrm": m["bus"],
        "highest_cust_name": "c_mktsegment",
        "acct_or_bill_to": m["acct"],
        "acct_or_bill_to_name": f"'Account ' || {t(m['acct'])}",
        "ship_to": "o_custkey",
        "st_name": "c_name",
        "item_as400_num": t("l_partkey - l_partkey % 2"),
        "item_e1_num": "l_partkey",
        "bl_qty": _whole("l_quantity + l_linenumber"),
        "curr_qty": _whole("l_quantity"),
        "ctlg_num": f"'C' || {t('l_partkey % 500')}",
        "sell_uom": "case when l_linenumber % 2 = 0 then 'EA' else 'CS' end",
        "buy_uom": "case when l_linenumber % 3 = 0 then 'EA' else 'CS' end",
        "vendor_num": "l_suppkey",
        "vendor_name": "s_name",
        "prvt_brnd_flg": "case when l_partkey % 6 = 0 then 'Y' else 'N' end",
        "item_dsc": "p_name",
        "item_product_fam_dsc": "p_type",
        "bl_date": m["bl_date"],
        "curr_date": m["curr_date"],
        "mmr_type": m["type"],
        "mmr_status": "case when l_linenumber > 3 then 'OPEN' else 'NEW' end",
        "bl_mfg_cont_change": "case when l_linenumber % 2 = 0 then 'SAME CONTRACT' else null end",
        "sig_cost_inc": f"case when {disc} > 5 then 'Y' else 'N' end",
        "bl_reason_cd": f"'R' || {t('l_linenumber')}",
        "bl_explanation": f"'Reason ' || {t('l_linenumber')}",
        "curr_change_summary": "o_orderpriority",
        "cost_status": "o_orderstatus",
        "price_status": "l_returnflag",
        "margin_status": "l_linestatus",
        "margin_prec_status": "case when l_linenumber = 4 then null else 'P' end",
        "bl_change_summary": "o_orderpriority",
        "mmr_status_reason_code": f"'S' || {t('l_partkey % 9')}",
        "bl_cost": _money(retail),
        "bl_trig_cost": _money(f"{retail} + l_linenumber * 100 - 300"),
        "curr_cost": f"case when l_partkey % 43 = 0 then null else {_money(unit)} end",
        "bl_comp_cost": _money(f"{retail} + 100"),
        "bl_trig_comp_cost": _money(f"{retail} + 150"),
        "curr_comp_cost": _money(f"{retail} + (l_suppkey % 7) * 100 - 300"),
        "bl_pricing_cost": _money(f"{retail} + 200"),
        "bl_trig_pricing_cost": _money(f"{retail} + 250"),
        "curr_pricing_cost": _money(f"{retail} + {tax} * 10"),
        "bl_cost_change": _money(f"{tax} * 100"),
        "curr_cost_change": _money(f"{disc} * 100"),
        "curr_var_cost": "case when l_returnflag = 'N' then 'N' else 'Y' end",
        "curr_min_var_cst": f"case when l_returnflag = 'N' then null else {_money(f'{retail} - l_linenumber * 50')} end",
        "bl_sell_price": _money(f"{retail} * 2"),
        "bl_trig_sell_price": _money(f"{retail} * 2 + 10"),
        "curr_sell_price": _money(f"{retail} * 2 + 20"),
        "bl_prc_rule": f"'B' || {t('l_linenumber')}",
        "bl_trig_prc_rule": f"'T' || {t('l_linenumber')}",
        "curr_prc_rule": f"'C' || {t('l_linenumber')}",
        "bl_prc_src": m["catalog_src"],
        "bl_trig_prc_src": m["trig_src"],
        "curr_prc_src": m["src"],
        "bl_prc_src_name": "'Baseline source'",
        "bl_trig_prc_src_name": "'Trigger source'",
        "curr_prc_src_name": "'Current source'",
        "bl_price_change": _money(tax),
        "curr_price_change": _money(disc),
        "bl_margin": _money(retail),
        "bl_trig_margin": _money(f"{retail} + 10"),
        "curr_margin": f"case when l_linenumber = 2 then null else {_money(f'{retail} + 20')} end",
        "bl_margin_perc": _money(f"{disc} + 10"),
        "bl_trig_margin_perc": _money(f"{disc} + 11"),
        "curr_margin_perc": f"case when l_linenumber = 3 then null else {_money(f'{disc} + 12')} end",
        "bl_mfg_cont": (
            "case when l_partkey % 29 = 0 then null when l_partkey % 31 = 0 then 'MCKB-NEG-LD' "
            f"when l_partkey % 8 = 0 then p_brand else p_brand || '/' || {t('l_partkey % 8')} end"
        ),
        "bl_trig_mfg_cont": f"'Brand#' || {t('(l_suppkey + 1) % 25 + 1')}",
        "curr_mfg_cont": f"case when l_suppkey % 41 = 0 then null else 'Brand#' || {t('l_suppkey % 25 + 1')} end",
        "bl_mfg_cont_name": "'Contract of ' || p_brand",
        "bl_trig_mfg_cont_name": "'Trigger contract'",
        "curr_mfg_cont_name": f"'Current contract ' || {t('l_suppkey % 25 + 1')}",
        "bl_cont_type": _contract_type("l_suppkey"),
        "bl_trig_cont_type": _contract_type("(l_suppkey + 1)"),
        "curr_cont_type": _contract_type("(l_suppkey + 2)"),
        "bl_trig_mck_cont": "1000 + l_suppkey % 37",
        "curr_mck_cont": "1000 + l_suppkey % 41",
        "bl_cntrct_tier_id": tier(0, 37),
        "bl_trig_cntrct_tier_id": tier(1, 41),
        "curr_cntrct_tier_id": tier(2, 43),
        "bl_item_end_dt": d.add_days(m["bl_date"], "l_linenumber * 30"),
        "bl_cntrct_end_dt": d.add_days(m["bl_date"], 365),
        "bl_cust_elig_end_dt_mck": d.add_days(m["bl_date"], 700),
        "bl_cust_prim_gpo_num": "4000 + o_custkey % 5",
        "bl_trig_cust_prim_gpo_num": "4000 + (o_custkey + 1) % 5",
        "curr_cust_prim_gpo_num": "4000 + (o_custkey + 2) % 5",
        "mstr_grp_num": "o_custkey % 100",
        "mstr_grp_name": f"'Group ' || {t('o_custkey % 100')}",
        "acct_mgr_name": f"'Manager ' || {t('c_nationkey')}",
        "decision_maker": f"'Owner ' || {t('l_suppkey % 10')}",
        "lm_perc_cap": _money(f"{tax} + 5"),
        "lm_opp_mrgn_perc": _money(f"{tax} + 6"),
        "pndg_mmr_opp": _whole(f"{disc} - 3"),
        "res_mmr_opp": _whole(tax),
    }


def _history_columns(d) -> dict[str, str]:
    """A wide history as earlier runs would have left it (weekly runs)."""
    t, m = d.text, _line_terms(d)
    s = _status_columns(d)
    pool = f"case when {m['team']} = 'NM' then null else o_custkey % 25 + 100 end"
    number = f"case when {m['team']} = 'STRAT' then o_custkey % 25 + 100 else l_suppkey % 90 + 1 end"
    prefix = f"case {m['team']} when 'CCT' then '1' when 'STRAT' then '3' else '4' end"
    neg = f"case when {m['disc']} > 5 then {m['price']} else 0 end"
    neg_cost = f"case when {m['disc']} > 5 then {m['price']} - {m['price']} % 1000 else 0 end"
    cost = f"({m['price']} - {m['price']} % 700)"
    extra = {
        "bid_or_prca": f"'B' || {t('l_suppkey % 8')}",
        "bid_or_prca_name": f"'Bid ' || {t('l_suppkey % 8')}",
        "lpg_id": m["catalog_src"],
        "lpg_desc": "'Local group'",
        "price_source_pcca": "o_custkey - o_custkey % 4",
        "cot": "c_mktsegment",
        "address": "c_name || ', City'",
        "addrss_line1": "c_name",
        "addrss_line2": "case when o_custkey % 2 = 0 then 'Suite' else null end",
        "addrss_line3": t("null"),
        "addrss_line4": "'Dock'",
        "city": f"'City ' || {t('c_nationkey')}",
        "state": f"'S' || {t('c_nationkey % 5')}",
        "zip": t("10000 + c_nationkey"),
        "cost_impact": "cast((" + m["unit"] + " - " + m["retail"] + ") * 0.01 * " + m["qty"] + " * 4 as decimal(26,6))",
        "var_cst_opp": f"cast(({m['retail']} % 977) * 0.01 as decimal(26,6))",
        "mn_lpg_prca_cost": f"case when l_suppkey % 6 = 0 then null else {_money(m['retail'])} end",
        "vrcst_mfg_cont": _contract_text(d, "(l_suppkey % 37)"),
        "vrcst_mck_cont": "1000 + l_suppkey % 37",
        "var_cst_cont": f"{t('1000 + l_suppkey % 37')} || '-' || {t('l_linenumber')}",
        "var_cst_cont_name": f"'Contract ' || {t('l_suppkey % 37')}",
        "var_cst_cont_type": _contract_type("(l_suppkey % 37)"),
        "prcnt_cnctd": "cast(case when l_suppkey % 9 = 0 then null else (l_partkey % 101) * 0.01 end as decimal(9,4))",
        "st_cnctd": "case when l_suppkey % 2 = 0 then 'Y' else 'N' end",
        "pcca_cnctd": "case when l_suppkey % 3 = 0 then null when l_suppkey % 3 = 1 then 'Y' else 'N' end",
        "vrcst_cont_excld": "case when l_suppkey % 10 = 0 then 'Y' else null end",
        "vrcst_cont_atr_elig_flg": "case when l_linenumber % 2 = 0 then 'Y' else 'N' end",
        "vrcst_cont_tier_base_flg": "case when l_linenumber = 1 then 'Y' else 'N' end",
        "vrcst_orgn_scr": "case when l_suppkey % 2 = 0 then 'CAMS' else 'E1C' end",
        "vrcst_gpo_name": f"'Group ' || {t('l_suppkey % 5')}",
        "actl_neg_m": _money(f"{neg} - {neg_cost}"),
        "proj_neg_m": _money(f"({neg} - {neg_cost}) * 4"),
        "actl_sls": _money(m["price"]),
        "proj_sls": _money(f"{m['price']} * 4"),
        "actl_gp": _money(f"{m['price']} - {cost}"),
        "proj_gp": _money(f"({m['price']} - {cost}) * 4"),
        "bl_mck_cont": "1000 + l_suppkey % 37",
        "bl_cont_atr_elig_flg": "case when l_linenumber % 2 = 0 then 'Y' else 'N' end",
        "bl_cont_tier_base_flg": "case when l_linenumber = 1 then 'Y' else 'N' end",
        "curr_cont_atr_elig_flg": "case when l_linenumber % 3 = 0 then 'Y' else 'N' end",
        "curr_cont_tier_base_flg": "case when l_linenumber = 2 then 'Y' else 'N' end",
        "curr_orgn_scr": "case when l_suppkey % 3 = 0 then 'CAMS' else 'E1C' end",
        "hin": f"case when o_custkey % 7 = 0 then null else 'H' || {t('o_custkey')} end",
        "dea": f"'D' || {t('o_custkey')}",
        "dea_exp_date": d.add_days(_DAY, "c_nationkey"),
        "prmry_gpo_flag": "case when o_custkey % 5 = 4 then null else 'Y' end",
        "prmry_gpo_num": "4000 + o_custkey % 5",
        "prmry_gpo_name": f"'Group ' || {t('o_custkey % 5')}",
        "prmry_gpo_id": f"'P' || {t('o_custkey')}",
        "gpo_mmbrshp_st": "'01/01/1997'",
        "prmry_aff_st": "'02/01/1997'",
        "rx_gpo_num": "4000 + o_custkey % 3",
        "rx_gpo_name": f"'Group ' || {t('o_custkey % 3')}",
        "rx_gpo_id": f"'X' || {t('o_custkey')}",
        "gpo_cot": "o_custkey % 6",
        "gpo_cot_name": f"'Class ' || {t('o_custkey % 6')}",
        "trig_cont_atr_elig_flg": "'N'",
        "trig_cont_tier_base_flg": "'Y'",
        "team_assigned": m["team"],
        "pool_num": pool,
        "case_cntr": number,
        "mmr_case": f"'9806' || {prefix} || {t(number)}",
        "insrt_dt": d.add_days(_DAY, "-7 * (" + d.div("l_partkey", "4") + " % 20)"),
        "pool_name": f"case when {m['team']} = 'NM' then null else 'Pool ' || {t('o_custkey % 25')} end",
    }
    return {**s, **extra}


def build_views(d) -> dict[str, View]:
    t, m = d.text, _line_terms(d)
    retail, price, disc, tax = m["retail"], m["price"], m["disc"], m["tax"]
    comp = f"({retail} + (l_suppkey % 7) * 100 - 300)"
    loss = f"{disc} > 5"
    comp_k, price_k = "(l_suppkey % 37)", "(l_suppkey % 41)"
    variant = {"E1PC": 1, "E1EC": 2, "ASPC": 3}
    tier_k = "(l_suppkey % 41)"
    null_text = t("null")
    return {
        "status": View("lineitem", _status_columns(d), _LINE_JOINS),
        "history_wide": View("lineitem", _history_columns(d), _LINE_JOINS),
        # One key per item, so a key has rows of many run dates.
        "history_runs": View(
            "lineitem",
            _history_columns(d)
            | {"acct_item_key": f"'I' || {t('l_partkey')}", "insrt_dt": "cast(l_shipdate as date)"},
            _LINE_JOINS,
        ),
        "history": View(
            "lineitem",
            {
                "acct_item_key": m["key"],
                "insrt_dt": "cast(l_shipdate as date)",
                "team_assigned": m["team"],
                "pool_num": f"case when {m['team']} = 'NM' then null else o_custkey % 25 + 100 end",
            },
            ("orders",),
            where="cast(l_shipdate as date) <= date '1998-06-30'",
        ),
        "exclusions": View(
            "lineitem",
            {
                "ship_to": f"case when l_partkey % 50 = 0 or {disc} <> 10 then -1 else o_custkey end",
                "item_e1_num": "case when l_partkey % 47 = 0 then null else l_partkey end",
            },
            ("orders",),
        ),
        "weekly_txn": View(
            "lineitem",
            {
                "acct_item_key": m["key"],
                "sls_3_mth": _money(price),
                "neg_sls_3_mth": f"case when {loss} then {_money(price)} else {_money('cast(0 as bigint)')} end",
                "qty_3_mth": _whole("l_quantity"),
                "cst_3_mth": _money(d.div(f"{price} * (100 - {disc})", "100")),
                "neg_cst_3_mth": (
                    f"case when {loss} then {_money(d.div(f'{price} * (100 - {disc})', '100'))} "
                    f"else {_money('cast(0 as bigint)')} end"
                ),
            },
            ("orders",),
        ),
        "ipc": View(
            "lineitem",
            {
                "sys_pltfrm": m["sys"],
                "bus_pltfrm": m["bus"],
                "var_cost": "case when l_returnflag = 'N' then 'N' else 'Y' end",
                "prvt_brnd_flg": "case when l_partkey % 6 = 0 then 'Y' else 'N' end",
                "vendor_name": f"'Supplier ' || {t('l_suppkey')}",
                "item_as400_num": t("l_partkey - l_partkey % 2"),
                "price_source": m["catalog_src"],
                "bid_or_prca": f"'B' || {t('l_suppkey % 8')}",
                "bid_or_prca_name": f"'Bid ' || {t('l_suppkey % 8')}",
                "local_pricing_group_id": m["catalog_src"],
                "lpg_desc": f"case when l_suppkey % 5 = 4 then null else 'Group ' || {t('l_suppkey % 5')} end",
                "pricing_cost_list_id": (
                    f"case when l_suppkey % 31 = 0 then '/*' else {t('1000 + l_suppkey % 41')} || '-' || "
                    f"{t('l_linenumber')} end"
                ),
                "comp_cost_list_id": (
                    "case when l_suppkey % 19 = 0 then '*' when l_suppkey % 23 = 0 then null "
                    f"when l_suppkey % 29 = 0 then '0' else {t('1000 + l_suppkey % 37')} || '-' || "
                    f"{t('l_linenumber')} end"
                ),
                "pricing_cost_cont_id": _contract_text(d, price_k),
                "pricing_cost_cont_name": f"'Contract ' || {t(price_k)}",
                "pricing_cost_cont_type": _contract_type(price_k),
                "comp_cost_cont_id": _contract_text(d, comp_k),
                "comp_cost_cont_name": f"case when l_suppkey % 13 = 0 then null else 'Contract ' || {t(comp_k)} end",
                "comp_cost_cont_type": _contract_type(comp_k),
                "gpo_name": f"'Group ' || {t('l_suppkey % 5')}",
                "cust_primary_gpo_name": f"'Group ' || {t('o_custkey % 5')}",
                "ship_to": "o_custkey",
                "acct_or_bill_to": m["acct"],
                "price_source_pcca": "o_custkey - o_custkey % 4",
                "item_e1_num": "l_partkey",
                "gpo_number": "case when l_suppkey % 11 = 0 then 0 else 4000 + l_suppkey % 5 end",
                "cust_primary_gpo_number": "4000 + o_custkey % 5",
                "comp_cost_initial": f"case when l_partkey % 53 = 0 and l_linenumber = 5 then null else {_money(comp)} end",
                "pricing_cost_initial": (
                    f"case when l_linenumber = 6 and l_partkey % 3 = 0 then null else {_money(f'{comp} + ({tax} - 4) * 50')} end"
                ),
                "comp_cost": _money(comp),
                "unit_price": f"case when l_partkey % 61 = 0 then {_money('cast(0 as bigint)')} else {_money(m['unit'])} end",
                "qty_3_mth": _whole("l_quantity"),
            },
            ("orders", "part"),
        ),
        "customer": View(
            "customer",
            {
                "dim_cust_curr_id": "c_custkey * 10 + case v "
                + " ".join(f"when '{k}' then {n}" for k, n in variant.items())
                + " end",
                "cust_num": "c_custkey",
                "cust_e1_num": "c_custkey",
                "bus_pltfrm": "substr(v, 3, 2)",
                "sys_pltfrm": "case when substr(v, 1, 2) = 'E1' then 'E1' else 'AS400' end",
                "cust_type_cd": "substr('SXBZ', cast(c_custkey % 4 as int) + 1, 1)",
                "actv_flg": "case when c_nationkey = 7 then 'N' else 'Y' end",
                "hlth_indstry_num": f"case when c_custkey % 7 = 0 then null else 'H' || {t('c_custkey')} end",
                "dea_lic_num": f"'D' || {t('c_custkey')}",
                "dea_lic_expr_dt": d.add_days(_DAY, "c_nationkey"),
            },
            variants=tuple(variant),
        ),
        "customer_restriction": View(
            "customer",
            {
                "cust_e1_num": "c_custkey",
                "prmry_affln_gpo_cost_flg": "case when c_nationkey % 2 = 0 then 'Y' else 'N' end",
                "singl_gso_rstrctn_flg": "case when c_nationkey % 5 = 1 then 'Y' else 'N' end",
            },
        ),
        "customer_blend": View(
            "customer",
            {
                "bill_to_cust_e1_num": "c_custkey - c_custkey % 3",
                "dim_bill_to_cust_curr_id": "(c_custkey - c_custkey % 3) * 10 + 1",
                "cust_e1_num": "c_custkey",
                "cust_lgcy_num": "c_custkey",
                "bus_pltfrm": "v",
                "sys_pltfrm": "case when c_custkey % 5 = 0 then 'EC' else 'E1' end",
                "hc_dlvry_cd": "case when c_mktsegment = 'MACHINERY' then 'PHD' when c_mktsegment = 'BUILDING' then null else 'STD' end",
                "cnvrsn_type_cd": "case when c_nationkey % 2 = 0 then 'E' else 'N' end",
                "mms_sub_class_dsc": "c_mktsegment",
                "addrss_line1": "c_name",
                "addrss_line2": "case when c_custkey % 2 = 0 then 'Suite' else null end",
                "addrss_line3": null_text,
                "addrss_line4": "'Dock'",
                "city": f"'City ' || {t('c_nationkey')}",
                "state": f"'S' || {t('c_nationkey % 5')}",
                "zip": t("10000 + c_nationkey"),
            },
            variants=("PC", "EC"),
        ),
        "customer_pool": View(
            "orders",
            {
                "dim_cust_curr_id": "(o_custkey - o_custkey % 3) * 10 + 1",
                "dim_pool_id": "o_orderkey % 25",
                "cust_pool_start_dt": "case when o_orderkey % 41 = 0 then null else cast(o_orderdate as date) end",
                "cust_pool_end_dt": (
                    "case when o_orderstatus = 'P' and cast(o_orderdate as date) <= date '1998-06-30' "
                    f"then {d.add_days('cast(o_orderdate as date)', 365)} else date '1998-06-01' end"
                ),
            },
        ),
        "pool": View(
            "nation",
            {
                "dim_pool_id": "n_nationkey",
                "pool_num": "n_nationkey + 100",
                "pool_name": "n_name",
                "pool_type_num": t("n_nationkey % 9"),
            },
        ),
        "contract_tier": View(
            "lineitem",
            {
                "dim_cntrct_tier_id": f"(1000 + {tier_k}) * 10 + l_linenumber",
                "cntrct_num": f"1000 + {tier_k}",
                "tier_num": "l_linenumber",
                "dim_gpo_id": f"{tier_k} % 6",
                "cntrct_type_cd": _contract_type(tier_k),
                "cntrct_src_cd": f"case when {tier_k} % 2 = 0 then 'CAMS' else 'E1C' end",
                "tier_attrbt_elgblty_flg": "case when l_linenumber % 2 = 0 then 'Y' else 'N' end",
                "tier_base_flg": "case when l_linenumber = 1 then 'Y' else 'N' end",
                "mfg_cntrct_num": _contract_text(d, tier_k),
                "mfg_cntrct_dsc": f"'Contract ' || {t(tier_k)}",
                "cntrct_end_dt": d.add_days(_DAY, f"{tier_k} * 20 - 100"),
            },
            distinct=True,
        ),
        "eligibility": View(
            "orders",
            {
                "dim_cntrct_tier_id": "(1000 + o_orderkey % 41) * 10 + o_orderkey % 7 + 1",
                "dim_cust_curr_id": "o_custkey * 10 + 1 + o_orderkey % 2",
                "elgblty_start_dt": "cast(o_orderdate as date)",
                "elgblty_end_dt": d.add_days("cast(o_orderdate as date)", 365),
                "cust_incl_excl_cd": "case when o_orderpriority = '1-URGENT' then 'I' else 'E' end",
            },
        ),
        "contract_item": View(
            "lineitem",
            {
                "dim_cntrct_tier_id": f"(1000 + {tier_k}) * 10 + l_linenumber",
                "dim_item_e1_curr_id": "l_partkey + 1000000",
                "end_dt": "cast(l_shipdate as date)",
            },
        ),
        "item": View(
            "part",
            {
                "dim_item_e1_curr_id": "p_partkey + 1000000",
                "item_e1_num": "p_partkey",
                "parnt_suplr_num": "case when p_partkey % 25 = 24 then null else p_partkey % 25 end",
                "prod_grp_cd": "case when p_size % 4 = 0 then 'RX' when p_size % 4 = 1 then null else p_type end",
            },
        ),
        "gpo": View(
            "region",
            {
                "dim_gpo_id": "r_regionkey",
                "gpo_num": "4000 + r_regionkey",
                "gpo_name": "r_name",
                "gpo_end_dt": d.add_days(_DAY, "r_regionkey * 100 - 50"),
            },
        ),
        "customer_gpo": View(
            "events",
            {
                "dim_cust_curr_id": "user_id * 10 + 1",
                "dim_gpo_id": "event_id % 5",
                "dim_gpo_prgrm_id": "event_id % 26",
                "dim_gpo_class_of_trade_id": "event_id % 6",
                "prmry_affltn_flg": "case when event_id % 5 = 0 then 'N' else 'Y' end",
                "gpo_mmbrship_type_dsc": (
                    "case event_type when 'purchase' then 'GPO' when 'signup' then 'RX' else 'OTHER' end"
                ),
                "gpo_cust_acct_num": f"case when event_id % 3 = 0 then null else 'A' || {t('event_id % 1000')} end",
                "mmbrship_start_dt": d.add_days("cast(ts as date)", "-365 * (event_id % 3)"),
                "prmry_affltn_start_dt": d.add_days("cast(ts as date)", "-365 * (event_id % 4)"),
                "prmry_affltn_end_dt": "case when value < 10 then date '1998-01-01' else cast(ts as date) end",
                "rx_mmbrship_end_dt": "case when value < 20 then date '1998-01-01' else cast(ts as date) end",
            },
        ),
        "gpo_program": View(
            "nation",
            {
                "dim_gpo_prgrm_id": "n_nationkey",
                "prgrm_num": "n_nationkey + 500",
                "sub_prgrm_num": "n_regionkey",
                "prgrm_dsc": "n_name",
                "sub_prgrm_dsc": "'Sub ' || n_name",
            },
        ),
        "gpo_class": View(
            "region",
            {
                "dim_gpo_class_of_trade_id": "r_regionkey",
                "class_of_trade_num": "r_regionkey * 10",
                "class_of_trade_dsc": "r_name",
            },
        ),
        "address_dated": View(
            "orders",
            {
                "alan8": "o_custkey",
                "aleftb": "case when o_orderkey % 97 = 0 then null else cast(o_orderdate as date) end",
                "aladd1": f"'Street ' || {t('o_orderkey % 1000')}",
                "aladd2": f"case when o_orderkey % 3 = 0 then null else 'Floor ' || {t('o_orderkey % 9')} end",
                "aladd3": null_text,
                "aladd4": null_text,
                "alcty1": f"'Town ' || {t('o_custkey % 30')}",
                "aladds": f"'S' || {t('o_custkey % 5')}",
                "aladdz": t("20000 + o_custkey % 500"),
            },
        ),
        "address_alternate": View(
            "customer",
            {
                "atan8": (
                    "case when c_mktsegment = 'MACHINERY' or c_mktsegment = 'FURNITURE' then c_custkey "
                    "else -c_custkey end"
                ),
                "atadd1": "c_name",
                "atadd2": "'Gate'",
                "atadd3": null_text,
                "atadd4": null_text,
                "atcty1": f"'Harbour ' || {t('c_nationkey')}",
                "atadds": f"'S' || {t('c_nationkey % 5')}",
                "ataddz": t("30000 + c_nationkey"),
            },
        ),
        "hierarchy": View(
            "supplier",
            {
                "man_con_id": (
                    f"case when (s_suppkey % 37) % 4 > 0 then {_contract_text(d, '(s_suppkey % 37)')} end"
                ),
                "mck_con_id": "1000 + s_suppkey % 37",
                "hierarchy": "(s_suppkey % 37) % 3 + 1",
            },
            distinct=True,
        ),
    }


_PREFIX_TABLE = {"o_": "orders", "c_": "customer", "p_": "part", "s_": "supplier"}


def _typed(name: str, expr: str, integer: set[str]) -> str:
    return f"cast({expr} as bigint)" if name in integer else expr


def _integer_columns() -> set[str]:
    from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS, INPUTS

    tables = [*INPUTS.values(), HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS]
    return {c for table in tables for c, kind in table.items() if kind == "bigint"}


def _needed_joins(view: View, exprs: list[str]) -> list[str]:
    """Joined tables whose columns are used; an order line has exactly one of each."""
    text = " ".join(exprs) + " " + (view.where or "")
    used = {table for prefix, table in _PREFIX_TABLE.items() if re.search(rf"\b{prefix}\w+", text)}
    if "customer" in used:
        used.add("orders")
    return [j for j in view.joins if j in used]


def _picked(view: View, columns: list[str] | None) -> dict[str, str]:
    return {c: e for c, e in view.columns.items() if columns is None or c in columns}


def _words(*exprs: str) -> set[str]:
    return {word for expr in exprs for word in re.findall(r"\w+", expr)}


def _words(*exprs: str) -> set[str]:
    return {word for expr in exprs for word in re.findall(r"\w+", expr)}


#: Rounds in which :func:`joined_tables` joins a table where it may stage: a round's shuffle files are a part of the join's.
ROUNDS = 4


def _joined(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    return df.join(other, df[left] == other[right])


def _joined_in_rounds(df: DataFrame, other: DataFrame, left: str, right: str, used: set[str], stage, name: str) -> DataFrame:
    """An equal join of which one hash class of the keys after the other is written, so that not all is shuffled at once."""
    parts = []
    for k in range(ROUNDS):
        mine, theirs = (F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(ROUNDS)) == k for c in (left, right))
        part = _joined(df.filter(mine), other.filter(theirs), left, right)
        parts.append(stage(part.select(*[c for c in part.columns if c in used]), f"{name}_{k}"))
    return reduce(DataFrame.unionByName, parts)


def joined_tables(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    columns: list[str] | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """The tables that a view reads, joined and filtered, with the columns its expressions use.

    With ``staging`` lines meet orders and parts in rounds, each written: the shuffle files of a round
    go before the next makes its own, and staged lines take a quarter of the disk that they take shuffled.
    """
    view = build_views(SparkDialect)[name]
    exprs = list(_picked(view, columns).values())
    df = spark.read.parquet(f"{sf_dir}/{view.base}.parquet")
    needed = _needed_joins(view, exprs)
    # Suppliers add the least to a line, so the other joins hardly move more for it.
    joins = sorted((j for j in needed if j != "customer"), key=lambda j: j != "supplier")
    done: list[str] = []
    for i, table in enumerate(joins):
        left, right = _JOIN_KEYS[table]
        other = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        # Customers meet the orders, of which there are fewer than lines, so the lines move once less.
        if table == "orders" and "customer" in needed:
            customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
            other = other.join(customer, other["o_custkey"] == customer["c_custkey"])
        if staging is None or table == "supplier":
            df = _joined(df, other, left, right)
            continue
        used = _words(*exprs, view.where or "", *(_JOIN_KEYS[j][0] for j in joins[i + 1 :]))
        df = _joined_in_rounds(df, other, left, right, used, staging.stage, f"{name}_{table}")
        if done:
            for k in range(ROUNDS):
                staging.drop(f"{name}_{done[-1]}_{k}")
        done.append(table)
    if view.where:
        df = df.where(view.where)
    used = _words(*exprs)
    return df.select(*[c for c in df.columns if c in used])


def shown_as(joined: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """A view's columns made of what :func:`joined_tables` gave for it."""
    view = build_views(SparkDialect)[name]
    integer = _integer_columns()
    if view.variants:
        joined = joined.selectExpr("*", f"{SparkDialect.explode(view.variants)} as v")
    out = joined.selectExpr(*[f"{_typed(c, e, integer)} as {c}" for c, e in _picked(view, columns).items()])
    return out.distinct() if view.distinct else out


def spark_view(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A view as a DataFrame; ``columns`` limits it to what a query reads."""
    return shown_as(joined_tables(spark, sf_dir, name, columns), name, columns)


def duck_view(name: str) -> str:
    """The same view as a SELECT for the comparing engine, with all columns and joins."""
    view = build_views(DuckDialect)[name]
    integer = _integer_columns()
    source = view.base
    for table in view.joins:
        left, right = _JOIN_KEYS[table]
        source += f" join {table} on {left} = {right}"
    if view.variants:
        source = f"(select *, {DuckDialect.explode(view.variants)} as v from {source})"
    items = ", ".join(f"{_typed(c, e, integer)} as {c}" for c, e in view.columns.items())
    where = f" where {view.where}" if view.where else ""
    return f"select {'distinct ' if view.distinct else ''}{items} from {source}{where}"
