"""Report extracts over the history of case lines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions.dates import recent_rows
from casework.operators.relational import may_match
from casework.operators.status import increase_type
from casework.settings import (
    ACQUISITION_TYPES,
    COST_INCREASE_TYPES,
    LOW_MARGIN_TYPES,
    TEAM_CONTRACT,
    TEAM_POOL,
    TEAM_VENDOR,
    VARIABLE_COST_TYPES,
)
from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS

# --- fixed values: report columns in order ------------------------------------
STRAT_COST_INCREASE = """
    acct_item_key sys_pltfrm bus_pltfrm highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to
    st_name cot item_as400_num item_e1_num cost_impact bl_date bl_reason_cd bl_explanation bl_cost
    curr_cost bl_mck_cont bl_mfg_cont bl_mfg_cont_name bl_cont_type curr_mck_cont curr_mfg_cont
    curr_mfg_cont_name curr_cont_type bl_cntrct_end_dt bl_cust_elig_end_dt_mck bl_item_end_dt
    prmry_gpo_name bl_sell_price curr_sell_price bl_margin_perc curr_margin_perc bl_prc_rule
    curr_prc_rule decision_maker bl_qty sell_uom vendor_name vendor_num prvt_brnd_flg ctlg_num item_dsc
    item_product_fam_dsc actl_neg_m proj_neg_m pndg_mmr_opp actl_gp proj_gp incrs_type
    curr_change_summary mmr_case case_cntr
""".split()
STRAT_ACQUISITION = """
    mmr_case acct_item_key sys_pltfrm bus_pltfrm bid_or_prca bid_or_prca_name lpg_id lpg_desc
    highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to st_name cot item_as400_num
    item_e1_num item_dsc vendor_name bl_qty bl_date bl_cost curr_cost bl_comp_cost curr_comp_cost
    bl_sell_price curr_sell_price bl_prc_rule curr_prc_rule bl_margin_perc curr_margin_perc
    prmry_gpo_name pndg_mmr_opp
""".split()
STRAT_LOW_MARGIN = """
    acct_item_key mmr_case sys_pltfrm bus_pltfrm bid_or_prca bid_or_prca_name lpg_id lpg_desc
    highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to st_name cot item_as400_num
    item_e1_num item_dsc vendor_name bl_qty bl_date bl_cost curr_cost bl_comp_cost curr_comp_cost
    bl_sell_price curr_sell_price bl_margin_perc curr_margin_perc bl_prc_rule curr_prc_rule
    prmry_gpo_name pndg_mmr_opp
""".split()
NM_COST_INCREASE = """
    acct_item_key sys_pltfrm bus_pltfrm highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to
    st_name addrss_line2 addrss_line1 addrss_line3 addrss_line4 city state zip item_as400_num
    item_e1_num cost_impact bl_date bl_reason_cd bl_explanation bl_cost curr_cost bl_mck_cont
    bl_mfg_cont bl_mfg_cont_name bl_cont_type bl_cntrct_end_dt bl_cust_elig_end_dt_mck bl_item_end_dt
    curr_mck_cont curr_mfg_cont curr_mfg_cont_name curr_cont_type bl_cust_prim_gpo_num
    curr_cust_prim_gpo_num bl_sell_price curr_sell_price bl_margin_perc curr_margin_perc bl_prc_rule
    curr_prc_rule decision_maker bl_qty sell_uom vendor_name vendor_num prvt_brnd_flg ctlg_num item_dsc
    item_product_fam_dsc prmry_gpo_name prmry_gpo_id actl_neg_m proj_neg_m pndg_mmr_opp actl_gp proj_gp
    curr_change_summary mmr_case case_cntr acct_mgr_name
""".split()
NM_ACQUISITION = """
    acct_item_key sys_pltfrm bus_pltfrm bid_or_prca bid_or_prca_name lpg_id lpg_desc highest_cust_name
    acct_or_bill_to acct_or_bill_to_name ship_to st_name addrss_line2 addrss_line1 addrss_line3
    addrss_line4 city state zip item_as400_num item_e1_num item_dsc vendor_name prmry_gpo_name
    prmry_gpo_id bl_qty pndg_mmr_opp bl_date bl_cost curr_cost bl_comp_cost curr_comp_cost
    bl_sell_price curr_sell_price bl_margin_perc curr_margin_perc bl_prc_rule curr_prc_rule mmr_case
    decision_maker acct_mgr_name
""".split()
CCT_LINES = """
    sys_pltfrm bus_pltfrm highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to st_name
    bid_or_prca price_source_pcca cot addrss_line1 addrss_line2 addrss_line3 addrss_line4 city state zip
    item_as400_num item_e1_num bl_qty curr_qty ctlg_num sell_uom buy_uom vendor_num vendor_name
    prvt_brnd_flg item_dsc item_product_fam_dsc bl_date curr_date bl_reason_cd bl_explanation
    bl_change_summary curr_change_summary bl_cost curr_cost bl_comp_cost curr_comp_cost bl_pricing_cost
    curr_pricing_cost cost_impact bl_sell_price curr_sell_price bl_prc_rule curr_prc_rule bl_margin_perc
    curr_margin_perc actl_neg_m proj_neg_m actl_gp proj_gp bl_mck_cont bl_mfg_cont bl_mfg_cont_name
    bl_cont_type curr_mck_cont curr_mfg_cont curr_mfg_cont_name curr_cont_type bl_cont_atr_elig_flg
    bl_cont_tier_base_flg curr_cont_atr_elig_flg curr_cont_tier_base_flg bl_item_end_dt bl_cntrct_end_dt
    bl_cust_elig_end_dt_mck curr_orgn_scr hin dea dea_exp_date prmry_gpo_name prmry_gpo_id rx_gpo_name
    rx_gpo_id decision_maker pndg_mmr_opp pool_num mmr_case case_cntr pool_name incrs_type
""".split()
STRAT_VARIABLE_COST_DETAIL = """
    case_cntr mmr_case sys_pltfrm bus_pltfrm bid_or_prca bid_or_prca_name lpg_id lpg_desc
    highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to st_name price_source_pcca
    item_as400_num item_e1_num bl_date vendor_name item_dsc curr_cost curr_comp_cost curr_pricing_cost
    curr_var_cost curr_min_var_cst mn_lpg_prca_cost var_cst_cont var_cst_cont_name var_cst_cont_type
    prcnt_cnctd pcca_cnctd curr_prc_src curr_prc_src_name actl_neg_m proj_neg_m actl_gp proj_gp
    bl_cont_atr_elig_flg bl_cont_tier_base_flg trig_cont_atr_elig_flg trig_cont_tier_base_flg
    curr_cont_atr_elig_flg curr_cont_tier_base_flg curr_mck_cont curr_mfg_cont curr_mfg_cont_name
    curr_cont_type bl_item_end_dt bl_cntrct_end_dt bl_cust_elig_end_dt_mck curr_cust_prim_gpo_num hin dea
    dea_exp_date gpo_cot gpo_cot_name prmry_gpo_flag prmry_gpo_num prmry_gpo_name prmry_gpo_id
    gpo_mmbrshp_st prmry_aff_st rx_gpo_num rx_gpo_name rx_gpo_id decision_maker pndg_mmr_opp res_mmr_opp
    team_assigned pool_num
""".split()
VARIABLE_COST_DIMENSIONS = """
    mmr_case sys_pltfrm bus_pltfrm pool_num pool_name vendor_name curr_mck_cont curr_mfg_cont
    curr_mfg_cont_name curr_cont_type vrcst_orgn_scr vrcst_mck_cont vrcst_mfg_cont var_cst_cont_name
    var_cst_cont_type vrcst_cont_atr_elig_flg vrcst_cont_tier_base_flg vrcst_gpo_name gpo_cot
    gpo_cot_name prmry_gpo_flag prmry_gpo_name prmry_gpo_id gpo_mmbrshp_st prmry_aff_st rx_gpo_name
    rx_gpo_id acct_or_bill_to acct_or_bill_to_name ship_to st_name cot addrss_line2 addrss_line1
    addrss_line3 addrss_line4 city state zip hin dea dea_exp_date price_source_pcca bid_or_prca
    bid_or_prca_name lpg_id lpg_desc curr_prc_src curr_prc_src_name bl_cntrct_end_dt pcca_cnctd
    vrcst_cont_excld decision_maker acct_mgr_name
""".split()
VARIABLE_COST_SUMS = "actl_neg_m proj_neg_m actl_gp proj_gp pndg_mmr_opp res_mmr_opp".split()
SNAPSHOT_COLUMNS = """
    acct_item_key price_source_pcca cot var_cst_opp mn_lpg_prca_cost vrcst_mfg_cont vrcst_mck_cont
    var_cst_cont_name var_cst_cont_type prcnt_cnctd st_cnctd pcca_cnctd vrcst_cont_excld
    vrcst_cont_atr_elig_flg vrcst_cont_tier_base_flg vrcst_orgn_scr vrcst_gpo_name bl_cont_atr_elig_flg
    bl_cont_tier_base_flg curr_cont_atr_elig_flg curr_cont_tier_base_flg hin dea curr_cust_prim_gpo_num
    bl_cust_prim_gpo_num curr_orgn_scr dea_exp_date gpo_cot_name prmry_gpo_flag prmry_gpo_num
    prmry_gpo_name prmry_gpo_id gpo_mmbrshp_st prmry_aff_st rx_gpo_num rx_gpo_name rx_gpo_id
    team_assigned mmr_case insrt_dt pool_name cost_impact actl_neg_m proj_neg_m actl_gp proj_gp
    pndg_mmr_opp new_sgstd_prc res_mmr_opp case_cntr
""".split()
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Report:
    """Filter and columns of one extract; unset conditions are ignored."""

    columns: Sequence[str]
    team: str | None = None
    cases: Sequence[int] | None = None
    cases_below: int | None = None
    types: Sequence[str] | None = None
    positive_opportunity: bool = False
    need_variable_cost: bool = False
    days: int | None = 14
    increase_cut: int = 70

    def with_(self, **changes) -> Report:
        return replace(self, **changes)

    def rows(self, history: DataFrame, as_of: dt.date) -> DataFrame:
        """The history rows that the extract is about."""
        recent = history if self.days is None else recent_rows(history, as_of, self.days)
        return recent.filter(self.condition())

    def condition(self) -> Column:
        terms: list[Column] = []
        if self.team is not None:
            terms.append(F.col("team_assigned") == self.team)
        if self.cases is not None:
            terms.append(F.col("case_cntr").isin(*[int(c) for c in self.cases]))
        if self.cases_below is not None:
            terms.append(F.col("case_cntr") < self.cases_below)
        if self.types is not None:
            terms.append(F.col("mmr_type").isin(*self.types))
        if self.positive_opportunity:
            terms.append(F.col("pndg_mmr_opp") > 0)
        if self.need_variable_cost:
            terms.append(F.col("mn_lpg_prca_cost").isNotNull())
        condition = F.lit(True)
        for term in terms:
            condition = condition & term
        return condition


REPORTS: dict[str, Report] = {
    "strat_cost_increase": Report(STRAT_COST_INCREASE, TEAM_POOL, types=COST_INCREASE_TYPES),
    "strat_acquisition": Report(STRAT_ACQUISITION, TEAM_POOL, types=ACQUISITION_TYPES, positive_opportunity=True),
    "strat_low_margin": Report(STRAT_LOW_MARGIN, TEAM_POOL, types=LOW_MARGIN_TYPES, positive_opportunity=True),
    "strat_variable_cost_detail": Report(STRAT_VARIABLE_COST_DETAIL, TEAM_POOL, types=VARIABLE_COST_TYPES),
    "nm_cost_increase": Report(NM_COST_INCREASE, TEAM_VENDOR, types=COST_INCREASE_TYPES),
    "nm_cost_increase_multi": Report(NM_COST_INCREASE, TEAM_VENDOR, types=COST_INCREASE_TYPES, cases_below=10),
    "nm_acquisition": Report(NM_ACQUISITION, TEAM_VENDOR, types=ACQUISITION_TYPES, positive_opportunity=True),
    "nm_low_margin": Report(NM_ACQUISITION, TEAM_VENDOR, types=LOW_MARGIN_TYPES, positive_opportunity=True),
    "cct": Report(CCT_LINES, TEAM_CONTRACT),
    "full_dump": Report(list(HISTORY_COLUMNS), days=None),
}


def _with_optional(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add columns some reports read but an older history may lack, as nulls."""
    have = {c.lower() for c in history.columns}
    missing = {
        c: F.lit(None).cast(HISTORY_EXTRA_COLUMNS[c])
        for c in columns
        if c not in have and c in HISTORY_EXTRA_COLUMNS
    }
    return history.withColumns(missing) if missing else history


def report(history: DataFrame, preset: Report | str, as_of: dt.date, **changes) -> DataFrame:
    """Distinct rows of one extract; ``changes`` override the preset (e.g. ``cases=[3]``)."""
    spec = REPORTS[preset] if isinstance(preset, str) else preset
    spec = spec.with_(**changes) if changes else spec
    rows = spec.rows(_with_optional(history, spec.columns), as_of)
    if "incrs_type" in spec.columns:
        rows = increase_type(rows, spec.increase_cut)
    selected = rows.select(*spec.columns)
    return selected if preset == "full_dump" else selected.distinct()


def sorted_report(extract: DataFrame) -> DataFrame:
    """Final order of an extract that is written out: by case."""
    column = "case_cntr" if "case_cntr" in extract.columns else "mmr_case"
    return extract.orderBy(F.col(column).asc_nulls_last())


def variable_cost_summary(
    history: DataFrame,
    team: str,
    as_of: dt.date,
    cases: Sequence[int] | None = None,
    days: int = 14,
) -> DataFrame:
    """Average share and summed measures over 54 dimensions of variable-cost lines."""
    spec = Report(
        VARIABLE_COST_DIMENSIONS, team, cases=cases, types=VARIABLE_COST_TYPES, need_variable_cost=True, days=days
    )
    rows = spec.rows(_with_optional(history, VARIABLE_COST_DIMENSIONS), as_of)
    return rows.groupBy(*VARIABLE_COST_DIMENSIONS).agg(
        F.avg("prcnt_cnctd").alias("avg_prcnt_cnctd"),
        *[F.sum(c).alias(f"sum_{c}") for c in VARIABLE_COST_SUMS],
    )


#: what the snapshot reads of the history
SNAPSHOT_SOURCE = list(
    dict.fromkeys([*(c for c in SNAPSHOT_COLUMNS if c != "new_sgstd_prc"), "insrt_dt", "curr_comp_cost", "bl_margin_perc"])
)


def newest_days(rows: DataFrame) -> DataFrame:
    """Each line's newest insert date."""
    return (
        rows.filter(F.col("acct_item_key").isNotNull() & F.col("insrt_dt").isNotNull())
        .groupBy("acct_item_key")
        .agg(F.max("insrt_dt").alias("insrt_dt"))
    )


def newest_rows(rows: DataFrame) -> DataFrame:
    """Rows of each line's newest insert date, ties kept.

    The newest date is a grouped maximum joined back on key and date, so a key
    with many rows is never gathered in one window.
    """
    return rows.join(newest_days(rows), ["acct_item_key", "insrt_dt"])


def with_suggested_price(rows: DataFrame) -> DataFrame:
    suggested = F.col("curr_comp_cost") * (F.lit(1) + F.col("bl_margin_perc"))
    return rows.withColumn("new_sgstd_prc", suggested).select(*SNAPSHOT_COLUMNS)


def latest_snapshot(history: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Rows of each line's newest insert date, with a suggested price.

    With ``stage`` the newest dates are written first, from two columns. A key filter of them then leaves
    out the other rows where they are read, so only those that may be newest are joined and shuffled wide.
    """
    rows = _with_optional(history, ["gpo_cot_name"])
    if stage is None:
        return with_suggested_price(newest_rows(rows))
    days = stage(newest_days(rows), "newest_days")
    on = ["acct_item_key", "insrt_dt"]
    return with_suggested_price(may_match(rows, days, on).join(days, on))
