"""Sinks: event log, catalog tables and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.sources.schemas import EVENT_LOG_COLUMNS


def append_table(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append the named columns in the given order, never by position."""
    df.select(*columns).write.mode("append").parquet(path)


def append_log(entry: DataFrame, path: str) -> None:
    append_table(entry.coalesce(1), path, list(EVENT_LOG_COLUMNS))


def save_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table from a result."""
    df.write.mode("overwrite").saveAsTable(name)


def export_case_files(extract: DataFrame, cases: DataFrame, path: str) -> None:
    """Write every case's rows under its file name, all cases in one job.

    ``cases`` is the case list with file names; the extract carries
    ``mmr_case``. Rows are spread within a file name, so one huge case is
    written by several tasks, and sorted by case within a file.
    """
    named = extract.join(cases.select("mmr_case", "file_name").distinct(), "mmr_case")
    order = "case_cntr" if "case_cntr" in extract.columns else "mmr_case"
    dealt = named.hint("rebalance", F.col("file_name")).sortWithinPartitions("file_name", F.col(order).asc_nulls_last())
    dealt.write.mode("overwrite").partitionBy("file_name").parquet(path)


def export_sorted(extract: DataFrame, cases: DataFrame, path: str) -> None:
    """Write all cases' rows as numbered parts that are sorted by file name and case when read in name order.

    The range is cut between rows of a case, too: the other columns break its ties, so a case with
    very many rows fills several parts. A task sorts its range only.
    """
    named = extract.join(cases.select("mmr_case", "file_name").distinct(), "mmr_case")
    case = "case_cntr" if "case_cntr" in extract.columns else "mmr_case"
    ties = F.xxhash64(*extract.columns)
    order = [F.col("file_name").asc_nulls_first(), F.col(case).asc_nulls_last(), F.col("__ties")]
    dealt = named.withColumn("__ties", ties).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.drop("__ties").write.mode("overwrite").parquet(path)
