"""Explicit schemas. Keys are long, money is decimal(18,4), codes are text."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = "decimal(18,4)"
_AMOUNT = "decimal(26,6)"
_SHARE = "decimal(9,4)"


def _columns(**groups: str) -> dict[str, str]:
    """Type -> names, as name -> type. Keyword names are the type aliases below."""
    types = {
        "text": "string", "key": "bigint", "money": _MONEY, "amount": _AMOUNT, "share": _SHARE,
        "date": "date", "time": "timestamp", "days": "double",
    }
    return {name: types[kind] for kind, names in groups.items() for name in names.split()}


# --- fixed values: input tables ------------------------------------------------
STATUS = _columns(
    text="""acct_item_key sys_pltfrm bus_pltfrm highest_cust_name acct_or_bill_to_name st_name item_as400_num
        ctlg_num sell_uom buy_uom vendor_name prvt_brnd_flg item_dsc item_product_fam_dsc mmr_type mmr_status
        bl_mfg_cont_change sig_cost_inc bl_reason_cd bl_explanation curr_change_summary cost_status price_status
        margin_status margin_prec_status bl_change_summary mmr_status_reason_code curr_var_cost bl_prc_rule
        bl_trig_prc_rule curr_prc_rule bl_prc_src bl_trig_prc_src curr_prc_src bl_prc_src_name
        bl_trig_prc_src_name curr_prc_src_name bl_mfg_cont bl_trig_mfg_cont curr_mfg_cont bl_mfg_cont_name
        bl_trig_mfg_cont_name curr_mfg_cont_name bl_cont_type bl_trig_cont_type curr_cont_type mstr_grp_name
        acct_mgr_name decision_maker""",
    key="""acct_or_bill_to ship_to item_e1_num vendor_num bl_trig_mck_cont curr_mck_cont bl_cntrct_tier_id
        bl_trig_cntrct_tier_id curr_cntrct_tier_id bl_cust_prim_gpo_num bl_trig_cust_prim_gpo_num
        curr_cust_prim_gpo_num mstr_grp_num""",
    money="""bl_qty curr_qty bl_cost bl_trig_cost curr_cost bl_comp_cost bl_trig_comp_cost curr_comp_cost
        bl_pricing_cost bl_trig_pricing_cost curr_pricing_cost bl_cost_change curr_cost_change curr_min_var_cst
        bl_sell_price bl_trig_sell_price curr_sell_price bl_price_change curr_price_change bl_margin
        bl_trig_margin curr_margin bl_margin_perc bl_trig_margin_perc curr_margin_perc lm_perc_cap
        lm_opp_mrgn_perc pndg_mmr_opp res_mmr_opp""",
    date="bl_date curr_date bl_item_end_dt bl_cntrct_end_dt bl_cust_elig_end_dt_mck",
)
IPC = _columns(
    text="""sys_pltfrm bus_pltfrm var_cost prvt_brnd_flg vendor_name item_as400_num price_source bid_or_prca
        bid_or_prca_name local_pricing_group_id lpg_desc pricing_cost_list_id comp_cost_list_id
        pricing_cost_cont_id pricing_cost_cont_name pricing_cost_cont_type comp_cost_cont_id comp_cost_cont_name
        comp_cost_cont_type gpo_name cust_primary_gpo_name""",
    key="ship_to acct_or_bill_to price_source_pcca item_e1_num gpo_number cust_primary_gpo_number",
    money="comp_cost_initial pricing_cost_initial comp_cost unit_price qty_3_mth",
)
WEEKLY_TXN = _columns(text="acct_item_key", money="sls_3_mth neg_sls_3_mth qty_3_mth cst_3_mth neg_cst_3_mth")
EXCLUSIONS = _columns(key="ship_to item_e1_num")
CUSTOMER = _columns(
    key="dim_cust_curr_id cust_num cust_e1_num",
    text="bus_pltfrm sys_pltfrm cust_type_cd actv_flg hlth_indstry_num dea_lic_num",
    date="dea_lic_expr_dt",
)
CUSTOMER_RESTRICTION = _columns(key="cust_e1_num", text="prmry_affln_gpo_cost_flg singl_gso_rstrctn_flg")
CUSTOMER_BLEND = _columns(
    key="bill_to_cust_e1_num dim_bill_to_cust_curr_id cust_e1_num cust_lgcy_num",
    text="""bus_pltfrm sys_pltfrm hc_dlvry_cd cnvrsn_type_cd mms_sub_class_dsc addrss_line1 addrss_line2
        addrss_line3 addrss_line4 city state zip""",
)
CUSTOMER_POOL = _columns(key="dim_cust_curr_id dim_pool_id", date="cust_pool_start_dt cust_pool_end_dt")
POOL = _columns(key="dim_pool_id pool_num", text="pool_name pool_type_num")
CONTRACT_TIER = _columns(
    key="dim_cntrct_tier_id cntrct_num tier_num dim_gpo_id",
    text="""cntrct_type_cd cntrct_src_cd tier_attrbt_elgblty_flg tier_base_flg mfg_cntrct_num
        mfg_cntrct_dsc""",
    date="cntrct_end_dt",
)
ELIGIBILITY = _columns(
    key="dim_cntrct_tier_id dim_cust_curr_id", date="elgblty_start_dt elgblty_end_dt", text="cust_incl_excl_cd"
)
CONTRACT_ITEM = _columns(key="dim_cntrct_tier_id dim_item_e1_curr_id", date="end_dt")
ITEM = _columns(key="dim_item_e1_curr_id item_e1_num parnt_suplr_num", text="prod_grp_cd")
GPO = _columns(key="dim_gpo_id gpo_num", text="gpo_name", date="gpo_end_dt")
CUSTOMER_GPO = _columns(
    key="dim_cust_curr_id dim_gpo_id dim_gpo_prgrm_id dim_gpo_class_of_trade_id",
    text="prmry_affltn_flg gpo_mmbrship_type_dsc gpo_cust_acct_num",
    date="mmbrship_start_dt prmry_affltn_start_dt prmry_affltn_end_dt rx_mmbrship_end_dt",
)
GPO_PROGRAM = _columns(key="dim_gpo_prgrm_id prgrm_num sub_prgrm_num", text="prgrm_dsc sub_prgrm_dsc")
GPO_CLASS = _columns(key="dim_gpo_class_of_trade_id class_of_trade_num", text="class_of_trade_dsc")
ADDRESS_DATED = _columns(key="alan8", date="aleftb", text="aladd1 aladd2 aladd3 aladd4 alcty1 aladds aladdz")
ADDRESS_ALTERNATE = _columns(key="atan8", text="atadd1 atadd2 atadd3 atadd4 atcty1 atadds ataddz")
HIERARCHY = _columns(text="man_con_id", key="mck_con_id hierarchy")

INPUTS: dict[str, dict[str, str]] = {
    "status": STATUS,
    "ipc": IPC,
    "weekly_txn": WEEKLY_TXN,
    "exclusions": EXCLUSIONS,
    "customer": CUSTOMER,
    "customer_restriction": CUSTOMER_RESTRICTION,
    "customer_blend": CUSTOMER_BLEND,
    "customer_pool": CUSTOMER_POOL,
    "pool": POOL,
    "contract_tier": CONTRACT_TIER,
    "eligibility": ELIGIBILITY,
    "contract_item": CONTRACT_ITEM,
    "item": ITEM,
    "gpo": GPO,
    "customer_gpo": CUSTOMER_GPO,
    "gpo_program": GPO_PROGRAM,
    "gpo_class": GPO_CLASS,
    "address_dated": ADDRESS_DATED,
    "address_alternate": ADDRESS_ALTERNATE,
    "hierarchy": HIERARCHY,
}
#: source column names that are quoted there -> names used here
RENAMED_COLUMNS = {
    "Ship To": "ship_to",
    "Item Number (E1)": "item_e1_num",
    "McK_CON_ID": "mck_con_id",
    "Hierarchy": "hierarchy",
}

# --- fixed values: output table, columns in order --------------------------------
_HISTORY_ORDER = """
    acct_item_key sys_pltfrm bus_pltfrm highest_cust_name acct_or_bill_to acct_or_bill_to_name ship_to st_name
    bid_or_prca bid_or_prca_name lpg_id lpg_desc price_source_pcca cot address addrss_line1 addrss_line2
    addrss_line3 addrss_line4 city state zip item_as400_num item_e1_num bl_qty curr_qty ctlg_num sell_uom
    buy_uom vendor_num vendor_name prvt_brnd_flg item_dsc item_product_fam_dsc bl_date curr_date mmr_type
    mmr_status bl_mfg_cont_change sig_cost_inc bl_reason_cd bl_explanation curr_change_summary cost_status
    price_status margin_status margin_prec_status bl_change_summary mmr_status_reason_code bl_cost curr_cost
    bl_comp_cost curr_comp_cost bl_pricing_cost curr_pricing_cost bl_cost_change curr_cost_change cost_impact
    curr_var_cost var_cst_opp curr_min_var_cst mn_lpg_prca_cost vrcst_mfg_cont vrcst_mck_cont
    var_cst_cont_name var_cst_cont_type prcnt_cnctd st_cnctd pcca_cnctd vrcst_cont_excld
    vrcst_cont_atr_elig_flg vrcst_cont_tier_base_flg vrcst_orgn_scr vrcst_gpo_name bl_sell_price
    curr_sell_price bl_prc_rule curr_prc_rule bl_prc_src curr_prc_src bl_prc_src_name curr_prc_src_name
    bl_price_change curr_price_change bl_margin curr_margin bl_margin_perc curr_margin_perc actl_neg_m
    proj_neg_m actl_sls proj_sls actl_gp proj_gp bl_mck_cont bl_mfg_cont bl_mfg_cont_name bl_cont_type
    curr_mck_cont curr_mfg_cont curr_mfg_cont_name curr_cont_type bl_cont_atr_elig_flg bl_cont_tier_base_flg
    curr_cont_atr_elig_flg curr_cont_tier_base_flg bl_item_end_dt bl_cntrct_end_dt bl_cust_elig_end_dt_mck
    curr_orgn_scr bl_cust_prim_gpo_num curr_cust_prim_gpo_num hin dea dea_exp_date prmry_gpo_flag
    prmry_gpo_num prmry_gpo_name prmry_gpo_id gpo_mmbrshp_st prmry_aff_st rx_gpo_num rx_gpo_name rx_gpo_id
    mstr_grp_num mstr_grp_name acct_mgr_name decision_maker lm_perc_cap lm_opp_mrgn_perc pndg_mmr_opp
    res_mmr_opp team_assigned pool_num mmr_case insrt_dt case_cntr pool_name
""".split()
_HISTORY_ONLY = _columns(
    key="price_source_pcca vrcst_mck_cont bl_mck_cont prmry_gpo_num rx_gpo_num pool_num case_cntr",
    money="mn_lpg_prca_cost actl_neg_m proj_neg_m actl_sls proj_sls actl_gp proj_gp",
    amount="cost_impact var_cst_opp",
    share="prcnt_cnctd",
    date="dea_exp_date insrt_dt",
)
HISTORY_COLUMNS: dict[str, str] = {
    c: _HISTORY_ONLY.get(c, STATUS.get(c, "string")) for c in _HISTORY_ORDER
}
#: read by some reports, written only on request
HISTORY_EXTRA_COLUMNS = _columns(
    text="gpo_cot_name trig_cont_atr_elig_flg trig_cont_tier_base_flg var_cst_cont", key="gpo_cot"
)
#: partition column of the history: the day of the run, never null
RUN_DATE = "run_date"
EVENT_LOG_COLUMNS = {
    "start_": "timestamp",
    "now": "timestamp",
    "duration_string": "double",
    "application_name": "string",
    "process_name": "string",
    "process_type": "string",
    "event_action": "string",
    "action_description": "string",
    "metric_name": "string",
    "metric_value": "bigint",
}
# ----------------------------------------------------------------------------------

#: allowed codes of the enumerated columns
ALLOWED_VALUES = {
    "sys_pltfrm": ("E1", "AS400"),
    "bus_pltfrm": ("PC", "EC"),
    "team_assigned": ("CCT", "NM", "STRAT"),
    "mmr_type": ("CCI", "CCI/LM", "VC", "CI", "CI/LM", "LM"),
}


_SPARK_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "double": T.DoubleType(), _MONEY: T.DecimalType(18, 4), _AMOUNT: T.DecimalType(26, 6), _SHARE: T.DecimalType(9, 4),
}


def struct(columns: dict[str, str]) -> T.StructType:
    """Spark schema of a column -> type mapping."""
    return T.StructType([T.StructField(c, _SPARK_TYPES[t], True) for c, t in columns.items()])
