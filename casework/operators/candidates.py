"""Selection of the lines that may go into a case."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.functions import joined_text
from casework.functions.dates import recent_rows
from casework.operators.relational import (
    hashed_alike,
    may_be_listed,
    passes_nulls,
    set_facts,
    without_values,
)
from casework.operators.status import cost_impact, resolved
from casework.settings import PLATFORM_LEGACY, PLATFORM_NEW, Settings


def recently_assigned(history: DataFrame, as_of: dt.date, days_by_team: dict[str, int]) -> DataFrame:
    """Line keys assigned within their team's cool-down; unknown teams never count.

    Written as one literal date bound per team plus the widest bound, so the
    widest bound prunes the date partitions of the history table.
    """
    def since(days: int) -> Column:
        return F.col("insrt_dt") > F.lit(as_of - dt.timedelta(days=days))

    if not days_by_team:
        return history.select("acct_item_key").limit(0)
    per_team = [(F.col("team_assigned") == team) & since(days) for team, days in days_by_team.items()]
    any_team = reduce(lambda a, b: a | b, per_team)
    widest = max(days_by_team.values())
    return recent_rows(history, as_of, widest).filter(any_team).select("acct_item_key")


def _exclusion_keys(exclusions: DataFrame) -> DataFrame:
    return exclusions.filter(F.col("ship_to") != -1).select(
        joined_text(F.col("ship_to"), F.col("item_e1_num")).alias("exclusion_key")
    )


def excluded_keys(exclusions: DataFrame) -> DataFrame:
    """Distinct ship-to and item keys of the exclusion list; ship-to -1 is a placeholder."""
    return _exclusion_keys(exclusions).distinct()


def trace_key() -> Column:
    """Readable key of a line for tracing exclusions; other platforms have none."""
    legacy = joined_text(F.col("acct_or_bill_to"), F.col("sys_pltfrm"), F.col("item_as400_num"), "-", F.col("bl_date"))
    new = joined_text(F.col("ship_to"), F.col("sys_pltfrm"), F.col("item_e1_num"), "-", F.col("bl_date"))
    return F.when(F.col("sys_pltfrm") == PLATFORM_LEGACY, legacy).when(F.col("sys_pltfrm") == PLATFORM_NEW, new)


#: Columns of the status fact that a candidate line and its trace key are made of.
_LINE_COLUMNS = (
    "acct_item_key", "bl_mfg_cont", "item_e1_num", "item_as400_num", "pndg_mmr_opp", "mmr_type", "acct_or_bill_to",
    "ship_to", "bl_date", "highest_cust_name", "vendor_name", "bus_pltfrm", "sys_pltfrm", "mstr_grp_num",
)
CANDIDATE_COLUMNS = [
    "acct_item_key", "bl_mfg_cont", "curr_mfg_cont", "item_e1_num", "cost_impact", "pndg_mmr_opp", "mmr_type",
    "acct_or_bill_to", "highest_cust_name", "vendor_name", "bus_pltfrm", "sys_pltfrm", "mstr_grp_num", "trace_key",
]


def select_candidates(
    status: DataFrame,
    history: DataFrame,
    exclusions: DataFrame,
    as_of: dt.date,
    settings: Settings = Settings(),
    stage: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Lines with an open opportunity that are neither excluded nor cooling down.

    By default the exclusion list is matched by joined text; with
    ``composite_exclusion_keys`` by ship-to and item, where a null matches nothing.
    With ``stage`` the open lines are written once, and only those that a key filter of the
    two lists cannot rule out are shuffled for the exact tests.
    """
    baseline = F.col("bl_mfg_cont")
    open_lines = (
        status.filter(F.col("pndg_mmr_opp") > 0)
        .filter((baseline != settings.negative_load_contract) | baseline.isNull())
        .select(
            *_LINE_COLUMNS,
            resolved("curr_mfg_cont").alias("curr_mfg_cont"),
            cost_impact(settings.annual_factor).alias("cost_impact"),
        )
    )
    recent = recently_assigned(history, as_of, settings.cool_down_days)
    if settings.composite_exclusion_keys:
        listed = exclusions.filter(F.col("ship_to") != -1).select(
            F.col("ship_to").alias("__ship_to"), F.col("item_e1_num").alias("__item")
        )
        excluded_by = ["ship_to", "item_e1_num"]
    else:
        listed = _exclusion_keys(exclusions)
        excluded_by = ["__exclusion_key"]
    if stage is not None:
        open_lines = stage(open_lines, "open_lines")
        listed, recent = stage(listed.distinct(), "listed_keys"), stage(recent.distinct(), "recent_keys")
    keyed = open_lines.withColumn("__exclusion_key", joined_text(F.col("ship_to"), F.col("item_e1_num")))

    def exact(lines: DataFrame) -> DataFrame:
        """Lines with no key of either list; whether a list is empty or has a null is asked below."""
        if settings.composite_exclusion_keys:
            same = (F.col("ship_to") == F.col("__ship_to")) & (F.col("item_e1_num") == F.col("__item"))
            kept = lines.join(listed.distinct(), same, "left_anti")
        else:
            kept = without_values(lines, "__exclusion_key", listed.distinct())
        return without_values(kept, "acct_item_key", recent.distinct())

    lists = [(excluded_by, listed), (["acct_item_key"], recent)]
    alike = all(hashed_alike(keyed, values, list(zip(by, values.columns))) for by, values in lists)
    if stage is not None and alike:
        marked = may_be_listed(keyed, lists, "__hit")
        kept = exact(marked.filter("__hit")).unionByName(marked.filter("not __hit")).drop("__hit")
    else:
        kept = exact(keyed)
    if not settings.composite_exclusion_keys:
        kept = kept.filter(passes_nulls("__exclusion_key", set_facts(listed.distinct())))
    kept = kept.filter(passes_nulls("acct_item_key", set_facts(recent.distinct())))
    return kept.withColumn("trace_key", trace_key()).select(*CANDIDATE_COLUMNS)
