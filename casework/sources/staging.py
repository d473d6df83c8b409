"""Run-scoped staging tables.

A result that several later steps read is written once and read back. The
folder is shared by all executors, so a lost executor loses nothing, and the
lineage of the later steps starts at the files. A run's folder goes with
``clear``, those of a session with ``release``, and what is left when the
driver ends: a lazy result may need its tables until then.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casework.sources import files

#: folders by application until they are cleared, with the names of their bucketed tables by staged name; never
#: frames, whose plans and file lists would stay in the driver's memory
_OPEN: dict[str, dict[str, dict[str, str]]] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a folder of this machine is used, which is only right
    for a local master; a cluster without the setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="casework-")


class Staging:
    """Staging tables of one run. ``rows`` has the number of rows of each, counted as it was written."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{root or staging_root(spark)}/casework-{uuid.uuid4().hex}"
        self.written: dict[str, DataFrame] = {}
        self.rows: dict[str, int] = {}
        self._tables: dict[str, str] = {}
        files.make(spark, self.folder)
        _OPEN.setdefault(spark.sparkContext.applicationId, {})[self.folder] = self._tables

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def stage(self, df: DataFrame, name: str, *keys: str) -> DataFrame:
        """Write a staging table and return it as read back; with keys, in buckets of them."""
        if keys:
            return self.stage_bucketed(df, name, int(self.spark.conf.get("spark.sql.shuffle.partitions")), *keys)
        return self.stage_observed(df, name)[0]

    def stage_observed(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write a staging table; return it as read back, and aggregates taken as it was written."""
        schema = df.schema
        counted, result = observed(df, **metrics)
        counted.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        found, self.rows[name] = result()
        self.written[name] = self.spark.read.schema(schema).parquet(self.path(name))
        return self.written[name], found

    def stage_bucketed(self, df: DataFrame, name: str, buckets: int, *columns: str) -> DataFrame:
        """Write a staging table in buckets of ``columns`` and return it as read back.

        Joins and groups on these columns then read it without another shuffle. A task
        writes a file for each bucket that it has rows of.
        """
        table = f"{os.path.basename(self.folder)}_{name}".replace("-", "_")
        counted, result = observed(df)
        writer = counted.write.format("parquet").mode("overwrite").option("path", self.path(name))
        writer = writer.option("compression", "zstd")
        writer.bucketBy(buckets, *columns).saveAsTable(table)
        _, self.rows[name] = result()
        self._tables[name] = table
        self.written[name] = self.spark.table(table)
        return self.written[name]

    def drop(self, name: str) -> None:
        """Remove one staging table that no later step reads."""
        if name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(name)}")
        files.delete(self.spark, self.path(name))
        self.written.pop(name, None)

    def clear(self) -> None:
        """Remove the run's tables and their folder."""
        _remove(self.spark, self.folder, self._tables)
        self.written = {}
        _OPEN.get(self.spark.sparkContext.applicationId, {}).pop(self.folder, None)


def _remove(spark: SparkSession, folder: str, tables: dict[str, str]) -> None:
    for table in tables.values():
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    files.delete(spark, folder)
    tables.clear()


def release(spark: SparkSession) -> int:
    """Remove all staging tables of the session, once the results that read them are written."""
    held = _OPEN.pop(spark.sparkContext.applicationId, {})
    for folder, tables in held.items():
        _remove(spark, folder, tables)
    return len(held)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Callable[[], tuple[dict, int]]]:
    """A frame that is counted on its way to a sink, and what gives the metrics and the number of rows then."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *(m.alias(n) for n, m in metrics.items()))

    def result() -> tuple[dict, int]:
        found = seen.get
        return {n: found.get(n) for n in metrics}, found.get("__rows") or 0

    return counted, result
