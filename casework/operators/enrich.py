"""Facts attached to case lines: sales, contracts, memberships, addresses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.functions import joined_text, month_day_year, not_ended, valid_on
from casework.operators.relational import latest_rows
from casework.operators.status import resolved
from casework.settings import (
    ELIGIBLE_CUSTOMER_TYPES,
    EXCLUDED_CODE,
    PLATFORM_LEGACY_ADDRESS,
    PLATFORM_NEW,
)

SALES_COLUMNS = ["sls_3_mth", "neg_sls_3_mth", "qty_3_mth", "cst_3_mth", "neg_cst_3_mth"]


def attach_sales(candidates: DataFrame, sales: DataFrame) -> DataFrame:
    """Distinct 3-month sales, quantity and cost of the candidate keys.

    The distinct comes after the semi join: it then works on the candidates'
    rows only and reuses the join's partitioning by key.
    """
    mine = sales.select("acct_item_key", *SALES_COLUMNS).join(
        candidates.select("acct_item_key"), "acct_item_key", "left_semi"
    )
    return mine.distinct()


def exclusion_flag(lines: DataFrame, customers: DataFrame, eligibility: DataFrame, as_of: dt.date) -> DataFrame:
    """'Y' for customer and tier pairs with a current exclusion; only hits are kept."""
    pairs = (
        lines.select("vrcst_cntrct_tier_id", "dim_cust_curr_id")
        .filter(F.col("vrcst_cntrct_tier_id").isNotNull() & F.col("dim_cust_curr_id").isNotNull())
        .distinct()
    )
    active = customers.filter(
        F.col("cust_type_cd").isin(*ELIGIBLE_CUSTOMER_TYPES)
        & (F.col("sys_pltfrm") == PLATFORM_NEW)
        & (F.col("actv_flg") == "Y")
    ).select("dim_cust_curr_id")
    excluded = eligibility.filter(
        valid_on(F.col("elgblty_start_dt"), F.col("elgblty_end_dt"), as_of)
        & (F.col("cust_incl_excl_cd") == EXCLUDED_CODE)
    ).select(F.col("dim_cntrct_tier_id").alias("vrcst_cntrct_tier_id"), "dim_cust_curr_id")
    return (
        pairs.join(excluded.distinct(), ["vrcst_cntrct_tier_id", "dim_cust_curr_id"], "left_semi")
        .join(active.distinct(), "dim_cust_curr_id", "left_semi")
        .select("vrcst_cntrct_tier_id", "dim_cust_curr_id", F.lit("Y").alias("vrcst_cont_excld"))
    )


# --- fixed values: output columns in order -----------------------------------
CONTRACT_ATTRIBUTE_COLUMNS = [
    "bl_cont_atr_elig_flg", "bl_cont_tier_base_flg", "bl_mck_cont",
    "curr_cont_atr_elig_flg", "curr_cont_tier_base_flg", "curr_mck_cont",
    "vrcst_cont_atr_elig_flg", "vrcst_cont_tier_base_flg", "vrcst_mck_cont",
    "vrcst_mfg_cont", "vrcst_cont_name", "curr_orgn_scr", "vrcst_orgn_scr", "vrcst_gpo_name",
    "acct_item_key",
]
TRIGGER_ATTRIBUTE_COLUMNS = ["trig_cont_atr_elig_flg", "trig_cont_tier_base_flg"]
# -----------------------------------------------------------------------------


def contract_attributes(
    status: DataFrame,
    cases: DataFrame,
    price_lines: DataFrame,
    tiers: DataFrame,
    gpos: DataFrame,
    with_trigger: bool = False,
) -> DataFrame:
    """Tier facts of the baseline, current and cheapest contract of each case line.

    One tier dimension in three roles (four ``with_trigger``); keys are made
    distinct before the lookups.
    """
    keys = cases.select("acct_item_key").distinct()
    own = status.filter(F.col("sys_pltfrm") == PLATFORM_NEW).select(
        "acct_item_key",
        "bl_cntrct_tier_id",
        resolved("curr_cntrct_tier_id").alias("curr_cntrct_tier_id"),
        "bl_trig_cntrct_tier_id",
    )
    if not with_trigger:
        own = own.drop("bl_trig_cntrct_tier_id")
    cheapest = price_lines.select("acct_item_key", "vrcst_cntrct_tier_id").distinct()
    ids = own.join(keys, "acct_item_key").join(cheapest, "acct_item_key", "left").distinct()
    attributes = {"atr_elig_flg": "tier_attrbt_elgblty_flg", "tier_base_flg": "tier_base_flg"}

    def role(id_column: str, prefix: str, **extra: str) -> DataFrame:
        return tiers.select(
            F.col("dim_cntrct_tier_id").alias(id_column),
            *[F.col(source).alias(f"{prefix}_cont_{out}") for out, source in attributes.items()],
            *[F.col(source).alias(out) for out, source in extra.items()],
        )

    baseline = role("bl_cntrct_tier_id", "bl", bl_mck_cont="cntrct_num")
    current = role("curr_cntrct_tier_id", "curr", curr_mck_cont="cntrct_num", curr_orgn_scr="cntrct_src_cd")
    lowest = role(
        "vrcst_cntrct_tier_id",
        "vrcst",
        vrcst_mck_cont="cntrct_num",
        vrcst_mfg_cont="mfg_cntrct_num",
        vrcst_cont_name="mfg_cntrct_dsc",
        vrcst_orgn_scr="cntrct_src_cd",
        dim_gpo_id="dim_gpo_id",
    ).join(gpos.select("dim_gpo_id", F.col("gpo_name").alias("vrcst_gpo_name")), "dim_gpo_id", "left")
    out = (
        ids.join(baseline, "bl_cntrct_tier_id", "left")
        .join(current, "curr_cntrct_tier_id", "left")
        .join(lowest, "vrcst_cntrct_tier_id", "left")
    )
    columns = list(CONTRACT_ATTRIBUTE_COLUMNS)
    if with_trigger:
        out = out.join(role("bl_trig_cntrct_tier_id", "trig"), "bl_trig_cntrct_tier_id", "left")
        columns += TRIGGER_ATTRIBUTE_COLUMNS
    return out.select(*columns).distinct()


def case_accounts(cases: DataFrame, status: DataFrame) -> DataFrame:
    """Distinct ship-to accounts of the case lines."""
    return (
        status.select("acct_item_key", "ship_to")
        .join(cases.select("acct_item_key").distinct(), "acct_item_key", "left_semi")
        .select("ship_to")
        .filter(F.col("ship_to").isNotNull())
        .distinct()
    )


# --- fixed values: output columns in order -----------------------------------
MEMBERSHIP_COLUMNS = [
    "ship_to", "hin", "dea", "dea_exp_date", "gpo_cot", "gpo_cot_name", "prmry_gpo_flag",
    "prmry_gpo_num", "prmry_gpo_name", "prmry_gpo_id", "gpo_mmbrshp_st", "prmry_aff_st",
    "rx_gpo_num", "rx_gpo_name", "rx_gpo_id",
]
# -----------------------------------------------------------------------------


def membership_summary(
    customer_gpos: DataFrame,
    gpos: DataFrame,
    programs: DataFrame,
    classes: DataFrame,
    as_of: dt.date,
    true_dates: bool = False,
) -> DataFrame:
    """One row per customer: primary group membership and pharmacy membership.

    Both kinds are read in one pass and folded by a maximum. A number missing
    on one side of a customer who has the other side comes out as 0, a text as
    null. Dates are compared as MM/DD/YYYY text unless ``true_dates``.
    """
    primary = (F.col("gpo_mmbrship_type_dsc") == "GPO") & not_ended(F.col("prmry_affltn_end_dt"), as_of)
    pharmacy = (F.col("gpo_mmbrship_type_dsc") == "RX") & not_ended(F.col("rx_mmbrship_end_dt"), as_of)
    live = (
        customer_gpos.filter((F.col("prmry_affltn_flg") == "Y") & (primary | pharmacy))
        .join(gpos.select("dim_gpo_id", "gpo_num", "gpo_name"), "dim_gpo_id")
        .join(programs.select("dim_gpo_prgrm_id").distinct().withColumn("has_program", F.lit(True)),
              "dim_gpo_prgrm_id", "left")
        .join(classes.select("dim_gpo_class_of_trade_id", "class_of_trade_num", "class_of_trade_dsc",
                             F.lit(True).alias("has_class")),
              "dim_gpo_class_of_trade_id", "left")
        .withColumn("is_primary", F.col("gpo_mmbrship_type_dsc") == "GPO")
        .filter(~F.col("is_primary") | (F.col("has_program") & F.col("has_class")))
    )
    is_primary = F.col("is_primary")

    def number(own: bool, column: str):
        return F.max(F.when(is_primary if own else ~is_primary, F.col(column)).otherwise(0))

    def text(own: bool, column: str):
        return F.max(F.when(is_primary if own else ~is_primary, F.col(column)))

    def date(column: str):
        if true_dates:
            return month_day_year(F.max(F.when(is_primary, F.col(column))))
        return F.max(F.when(is_primary, month_day_year(F.col(column))))

    return live.groupBy("dim_cust_curr_id").agg(
        number(True, "class_of_trade_num").alias("gpo_cot"),
        text(True, "class_of_trade_dsc").alias("gpo_cot_name"),
        text(True, "prmry_affltn_flg").alias("prmry_gpo_flag"),
        number(True, "gpo_num").alias("prmry_gpo_num"),
        text(True, "gpo_name").alias("prmry_gpo_name"),
        text(True, "gpo_cust_acct_num").alias("prmry_gpo_id"),
        date("mmbrship_start_dt").alias("gpo_mmbrshp_st"),
        date("prmry_affltn_start_dt").alias("prmry_aff_st"),
        number(False, "gpo_num").alias("rx_gpo_num"),
        text(False, "gpo_name").alias("rx_gpo_name"),
        text(False, "gpo_cust_acct_num").alias("rx_gpo_id"),
    )


def gpo_membership(
    customers: DataFrame,
    accounts: DataFrame,
    customer_gpos: DataFrame,
    gpos: DataFrame,
    programs: DataFrame,
    classes: DataFrame,
    as_of: dt.date,
    true_dates: bool = False,
) -> DataFrame:
    """Licence and membership facts of the active case accounts."""
    mine = customers.join(
        accounts.select(F.col("ship_to").alias("cust_num")).distinct(), "cust_num", "left_semi"
    ).filter((F.col("sys_pltfrm") == PLATFORM_NEW) & (F.col("actv_flg") == "Y"))
    ids = mine.select("dim_cust_curr_id").distinct()
    memberships = customer_gpos.join(ids, "dim_cust_curr_id", "left_semi")
    summary = membership_summary(memberships, gpos, programs, classes, as_of, true_dates)
    return (
        mine.select(
            F.col("cust_e1_num").alias("ship_to"),
            F.col("hlth_indstry_num").alias("hin"),
            F.col("dea_lic_num").alias("dea"),
            F.col("dea_lic_expr_dt").alias("dea_exp_date"),
            "dim_cust_curr_id",
        )
        .join(summary, "dim_cust_curr_id", "left")
        .select(*MEMBERSHIP_COLUMNS)
        .distinct()
    )


# --- fixed values: source column -> output column ------------------------------
ALTERNATE_ADDRESS = {
    "atadd1": "addrss_line1", "atadd2": "addrss_line2", "atadd3": "addrss_line3", "atadd4": "addrss_line4",
    "atcty1": "city", "atadds": "state", "ataddz": "zip",
}
DATED_ADDRESS = {
    "aladd1": "addrss_line1", "aladd2": "addrss_line2", "aladd3": "addrss_line3", "aladd4": "addrss_line4",
    "alcty1": "city", "aladds": "state", "aladdz": "zip",
}
ADDRESS_PARTS = ["addrss_line1", "addrss_line2", "addrss_line3", "addrss_line4", "city", "state", "zip"]
# -----------------------------------------------------------------------------


def resolve_address(
    lines: DataFrame,
    customers: DataFrame,
    alternate: DataFrame,
    dated: DataFrame,
    legacy_platform: str = PLATFORM_LEGACY_ADDRESS,
) -> DataFrame:
    """Address per (business platform, customer key) of the price lines.

    Legacy customers use the bill-to address on file. Customers of the newer
    platform use the alternate address when they are home deliveries of
    conversion type E, else their newest dated address (ties kept).
    """
    accounts = lines.select("bus_pltfrm", "acct_or_bill_to", "ship_to").distinct()
    legacy = (
        accounts.select("bus_pltfrm", F.col("acct_or_bill_to").alias("cust_key"))
        .distinct()
        .join(
            customers.filter(F.col("sys_pltfrm") == legacy_platform).select(
                F.col("cust_lgcy_num").alias("cust_key"), "bus_pltfrm", *ADDRESS_PARTS
            ),
            ["cust_key", "bus_pltfrm"],
        )
        .select("bus_pltfrm", "cust_key", *ADDRESS_PARTS, F.lit(False).alias("from_dated"))
        .distinct()
    )
    ship_tos = accounts.select(F.col("ship_to").alias("cust_key")).distinct()
    newest = latest_rows(
        dated.withColumnsRenamed({"alan8": "cust_key"})
        .select("cust_key", "aleftb", *DATED_ADDRESS)
        .join(ship_tos, "cust_key", "left_semi")
        .distinct(),
        ["cust_key"],
        "aleftb",
    ).drop("aleftb")
    use_alternate = F.coalesce(
        (F.col("hc_dlvry_cd") == "PHD") & (F.col("cnvrsn_type_cd") == "E"), F.lit(False)
    )
    kinds = customers.filter(F.col("sys_pltfrm") == PLATFORM_NEW).select(
        F.col("cust_e1_num").alias("cust_key"), "bus_pltfrm", use_alternate.alias("use_alternate")
    ).distinct()
    parts = [
        F.when(F.col("use_alternate"), F.col(alt)).otherwise(F.col(dat)).alias(out)
        for (alt, out), dat in zip(ALTERNATE_ADDRESS.items(), DATED_ADDRESS)
    ]
    shipped = (
        accounts.withColumnRenamed("ship_to", "cust_key")
        .join(kinds, ["cust_key", "bus_pltfrm"])
        .join(
            alternate.select(F.col("atan8").alias("acct_or_bill_to"), *ALTERNATE_ADDRESS),
            "acct_or_bill_to",
            "left",
        )
        .join(newest, "cust_key", "left")
        .select("bus_pltfrm", "cust_key", *parts, (~F.col("use_alternate")).alias("from_dated"))
        .distinct()
    )
    one_line = joined_text(
        F.col("addrss_line1"), " ", F.col("addrss_line2"), " ", F.col("addrss_line3"), " ",
        F.col("addrss_line4"), ", ", F.col("city"), ", ", F.col("state"), " ", F.col("zip"),
    )
    return legacy.unionByName(shipped).select(
        "bus_pltfrm", "cust_key", one_line.alias("address"), *ADDRESS_PARTS
    )


def class_of_trade(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct customer sub-class of the case accounts."""
    mine = accounts.select(F.col("ship_to").alias("cust_e1_num")).distinct()
    return (
        customers.select(F.col("mms_sub_class_dsc").alias("cot"), "cust_e1_num")
        .join(mine, "cust_e1_num", "left_semi")
        .distinct()
    )
