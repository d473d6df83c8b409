"""The report job: the newest run's cases, each extract as one file set, and the dashboard's snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from casework.operators.cases import latest_run_cases
from casework.operators.reports import REPORTS, report, variable_cost_summary
from casework.plans.snapshot import refresh_snapshot
from casework.session import tune
from casework.settings import TEAM_POOL, TEAM_VENDOR
from casework.sources.history import read_history, read_newest_day
from casework.sources.sinks import export_case_files, export_sorted, save_table


#: summary extracts and their teams
SUMMARIES = {"strat_variable_cost_summary": TEAM_POOL, "nm_variable_cost_summary": TEAM_VENDOR}


def run_reports(
    spark: SparkSession,
    history_path: str,
    path: str,
    as_of: dt.date,
    presets: Sequence[str] = (*REPORTS, *SUMMARIES),
    sorted_parts: Sequence[str] = (),
) -> DataFrame:
    """Write the extracts under ``path/<preset>`` and return the newest run's case list.

    All cases of an extract are written by one job: under ``file_name=...``, sorted by
    case, or for those in ``sorted_parts`` as numbered parts in one order. The case list
    reads the newest run date only.
    """
    tune(spark)
    history = read_history(spark, history_path)
    cases = latest_run_cases(read_newest_day(spark, history_path))
    for preset in presets:
        if preset in SUMMARIES:
            extract = variable_cost_summary(history, SUMMARIES[preset], as_of)
        else:
            extract = report(history, preset, as_of)
        (export_sorted if preset in sorted_parts else export_case_files)(extract, cases, f"{path}/{preset}")
    return cases


def run_dashboard(spark: SparkSession, history_path: str, state_path: str, path: str, table: str | None = None) -> DataFrame:
    """Bring the snapshot up to date and write it for the dashboard; ``table`` also names a catalog table."""
    refresh_snapshot(spark, history_path, state_path).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    if table:
        save_table(written, table)
    return written
