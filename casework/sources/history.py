"""The history: versioned partitions of run dates, and a commit per version.

A run's rows are written to a folder of their own, ``rows/run_date=/version=``,
and count once a one-row file in ``commits`` names them. Readers take the newest
commit of every run date, so a run that ends half way leaves what was there, and
a reader never sees a partition that is being replaced. A commit carries the
number of rows and the range of insert dates, taken while the rows were written:
what asks for the newest day reads commits, not rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.sources import files
from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS, RUN_DATE, struct
from casework.sources.staging import observed

_COMMIT_COLUMNS = "run_date date, version string, sequence bigint, n_rows bigint, first_day date, last_day date"


@dataclass(frozen=True)
class Commit:
    """One version of a run date; ``first_day`` and ``last_day`` bound its insert dates."""

    run_date: dt.date
    version: str
    sequence: int
    n_rows: int
    first_day: dt.date | None
    last_day: dt.date | None

    def folder(self, path: str) -> str:
        return f"{path}/rows/{RUN_DATE}={self.run_date.isoformat()}/version={self.version}"


def _all_commits(spark: SparkSession, path: str) -> list[Commit]:
    if not files.children(spark, f"{path}/commits"):
        return []
    rows = spark.read.schema(_COMMIT_COLUMNS).parquet(f"{path}/commits").collect()
    return sorted((Commit(*r) for r in rows), key=lambda c: (c.sequence, c.version))


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The newest commit of every run date, by date: one small row per run."""
    newest = {c.run_date: c for c in _all_commits(spark, path)}
    return [newest[d] for d in sorted(newest)]


def append_history(rows: DataFrame, path: str, run_date: dt.date) -> Commit:
    """Write a run's rows, dated or not, as the history's newest version of its run date.

    A rerun leaves what a single run leaves, and an empty rerun empties the date. The
    insert date stays a column of the rows; lines without a price line have none.
    """
    spark = rows.sparkSession
    earlier = _all_commits(spark, path)
    sequence = earlier[-1].sequence + 1 if earlier else 1
    version = f"{sequence:08d}-{uuid.uuid4().hex}"
    columns = [c for c in (HISTORY_COLUMNS | HISTORY_EXTRA_COLUMNS) if c in rows.columns]
    target = Commit(run_date, version, sequence, 0, None, None).folder(path)
    # The rows are written where they are: spreading them would move every wide row once more.
    counted, result = observed(rows.select(*columns), first_day=F.min("insrt_dt"), last_day=F.max("insrt_dt"))
    counted.write.option("compression", "zstd").parquet(target)
    days, n_rows = result()
    commit = Commit(run_date, version, sequence, n_rows, days["first_day"], days["last_day"])
    _publish(spark, path, commit)
    return commit


def _publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """Make a written version the one that is read; its file appears as a whole or not at all."""
    row = [F.lit(getattr(commit, c)).cast(t).alias(c) for c, t in (x.split() for x in _COMMIT_COLUMNS.split(", "))]
    spark.range(1).coalesce(1).select(*row).write.mode("append").parquet(f"{path}/commits")


def read_versions(spark: SparkSession, path: str, chosen: Iterable[Commit]) -> DataFrame:
    """The rows of some versions, with their run date; only their folders are listed."""
    columns = HISTORY_COLUMNS | HISTORY_EXTRA_COLUMNS | {RUN_DATE: "date"}
    folders = [c.folder(path) for c in chosen if c.n_rows]
    if not folders:
        return empty_history(spark)
    read = spark.read.schema(struct(columns)).option("basePath", f"{path}/rows").parquet(*folders)
    return read.select(*columns)


def read_history(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The history with its run date; ``since`` leaves older run dates unlisted."""
    found = commits(spark, path)
    if since is None:
        return read_versions(spark, path, found)
    rows = read_versions(spark, path, [c for c in found if c.run_date > since])
    return rows.filter((F.col("insrt_dt") > F.lit(since)) & (F.col(RUN_DATE) > F.lit(since)))


def read_newest_day(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest insert date, from the versions that have it; the others aren't read."""
    found = [c for c in commits(spark, path) if c.last_day is not None]
    newest = max((c.last_day for c in found), default=None)
    rows = read_versions(spark, path, [c for c in found if c.last_day == newest])
    return rows.filter(F.col("insrt_dt") == F.lit(newest)) if newest else rows


def empty_history(spark: SparkSession) -> DataFrame:
    """History of a first run."""
    return spark.createDataFrame([], struct(HISTORY_COLUMNS | HISTORY_EXTRA_COLUMNS | {RUN_DATE: "date"}))


def sweep_history(spark: SparkSession, path: str) -> list[str]:
    """Remove replaced and abandoned versions. To be run while nobody writes or reads old versions."""
    kept = {c.folder("") for c in commits(spark, path)}
    gone = []
    for day in files.children(spark, f"{path}/rows"):
        for version in files.children(spark, f"{path}/rows/{day}"):
            if f"/rows/{day}/{version}" not in kept:
                files.delete(spark, f"{path}/rows/{day}/{version}")
                gone.append(f"{day}/{version}")
    return gone
