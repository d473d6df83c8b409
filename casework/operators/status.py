"""Column rules on the status fact: baseline, trigger and current values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: resolved output column -> (trigger column, current column); fixed values
CURRENT_PAIRS: dict[str, tuple[str, str]] = {
    "curr_cost": ("bl_trig_cost", "curr_cost"),
    "curr_comp_cost": ("bl_trig_comp_cost", "curr_comp_cost"),
    "curr_pricing_cost": ("bl_trig_pricing_cost", "curr_pricing_cost"),
    "curr_sell_price": ("bl_trig_sell_price", "curr_sell_price"),
    "curr_prc_rule": ("bl_trig_prc_rule", "curr_prc_rule"),
    "curr_prc_src": ("bl_trig_prc_src", "curr_prc_src"),
    "curr_prc_src_name": ("bl_trig_prc_src_name", "curr_prc_src_name"),
    "curr_mfg_cont": ("bl_trig_mfg_cont", "curr_mfg_cont"),
    "curr_mfg_cont_name": ("bl_trig_mfg_cont_name", "curr_mfg_cont_name"),
    "curr_cont_type": ("bl_trig_cont_type", "curr_cont_type"),
    "curr_mck_cont": ("bl_trig_mck_cont", "curr_mck_cont"),
    "curr_cntrct_tier_id": ("bl_trig_cntrct_tier_id", "curr_cntrct_tier_id"),
    "curr_cust_prim_gpo_num": ("bl_trig_cust_prim_gpo_num", "curr_cust_prim_gpo_num"),
}

#: resolved output column -> (current column, trigger column); fixed values
MARGIN_PAIRS: dict[str, tuple[str, str]] = {
    "curr_margin": ("curr_margin", "bl_trig_margin"),
    "curr_margin_perc": ("curr_margin_perc", "bl_trig_margin_perc"),
}


def resolved(name: str) -> Column:
    """Trigger value when the current date is the baseline date, else current."""
    trigger, current = CURRENT_PAIRS[name]
    same_day = F.col("curr_date") == F.col("bl_date")
    return F.when(same_day, F.col(trigger)).otherwise(F.col(current))


def resolve_current(status: DataFrame, pairs: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Replace each current column by its resolved value (null dates -> current)."""
    chosen = CURRENT_PAIRS if pairs is None else pairs
    present = {
        out: F.when(F.col("curr_date") == F.col("bl_date"), F.col(trigger)).otherwise(F.col(current))
        for out, (trigger, current) in chosen.items()
        if trigger in status.columns and current in status.columns
    }
    return status.withColumns(present)


def resolve_margin(status: DataFrame) -> DataFrame:
    """Margin columns: the trigger value only where the current one is null."""
    return status.withColumns(
        {out: F.coalesce(F.col(cur), F.col(trig)) for out, (cur, trig) in MARGIN_PAIRS.items()}
    )


def cost_impact(annual_factor: int = 4) -> Column:
    """Annualised impact: (resolved cost - baseline cost) x current quantity x factor."""
    increase = resolved("curr_cost") - F.col("bl_cost")
    return increase * F.col("curr_qty") * F.lit(annual_factor)


def annualised_impact(status: DataFrame, annual_factor: int = 4) -> DataFrame:
    return status.withColumn("cost_impact", cost_impact(annual_factor))


def sales_measures(df: DataFrame, annual_factor: int = 4) -> DataFrame:
    """Actual and projected loss, sales and gross profit of the 3-month totals."""
    loss = F.col("neg_sls_3_mth") - F.col("neg_cst_3_mth")
    profit = F.col("sls_3_mth") - F.col("cst_3_mth")
    return df.withColumns(
        {
            "actl_neg_m": loss,
            "proj_neg_m": loss * annual_factor,
            "actl_sls": F.col("sls_3_mth"),
            "proj_sls": F.col("sls_3_mth") * annual_factor,
            "actl_gp": profit,
            "proj_gp": profit * annual_factor,
        }
    )


def variable_cost_gap(df: DataFrame) -> DataFrame:
    """Current competing cost above the smallest variable cost."""
    return df.withColumn("var_cst_opp", F.col("curr_comp_cost") - F.col("curr_min_var_cst"))


def increase_type(df: DataFrame, cut: int = 70) -> DataFrame:
    """'ITEM' above the case number cut, else 'CONTRACT' (also for a null number)."""
    return df.withColumn("incrs_type", F.when(F.col("case_cntr") > cut, "ITEM").otherwise("CONTRACT"))
