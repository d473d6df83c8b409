"""Helpers shared by the corpus operators.

Row keys, running totals over hot groups, and staged tables. None of them
brings a group whole into one task.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casework.sources.staging import Staging

FIRST_ROW = Window.unboundedPreceding


def new_staging(spark: SparkSession) -> Staging:
    return Staging(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result once to the shared folder and read it back, which cuts its lineage."""
    return Staging(df.sparkSession).stage(df, name)


def key_columns(*columns: str) -> list[Column]:
    """Two 64-bit hashes that together name a row by its values; null is a value of its own.

    A flag per column keeps null and a value apart, since the hash skips nulls.
    """
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return [
        F.xxhash64(*parts).alias("_k1"),
        F.xxhash64(F.lit("second"), *parts).alias("_k2"),
    ]


def running_totals(
    rows: DataFrame, group: list[str], bucket: str, order: list[str], totals: list[str]
) -> DataFrame:
    """Add ``<total>_before`` for each total: its sum over the earlier rows of the group.

    Rows of a group are ordered by ``bucket``, then ``order``. The bucket spreads a
    group over many tasks: each (group, bucket) is summed in its own window, and the
    sums of the buckets, a bounded number per group, are added up in a second one.
    """
    sums = rows.groupBy(*group, bucket).agg(*(F.sum(t).alias(f"_sum_{t}") for t in totals))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(FIRST_ROW, -1)
    offsets = sums.select(
        *group,
        bucket,
        *(F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals),
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(FIRST_ROW, -1)
    windowed = rows.withColumns(
        {f"_in_{t}": F.coalesce(F.sum(t).over(inside), F.lit(0)) for t in totals}
    )
    joined = windowed.join(offsets, [*group, bucket])
    return joined.select(
        *(joined[c] for c in rows.columns),
        *((F.col(f"_off_{t}") + F.col(f"_in_{t}")).alias(f"{t}_before") for t in totals),
    )


def range_totals(rows: DataFrame, order: list[str], totals: list[str], name: str) -> DataFrame:
    """Add ``<total>_before`` over the whole table in the order of ``order``.

    The table is cut into key ranges, one per shuffle partition, and staged so that the
    cuts are fixed. The broadcast side has one row per partition.
    """
    parted = stage(
        rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    sums = parted.groupBy("_part").agg(*(F.sum(t).alias(f"_sum_{t}") for t in totals))
    earlier = Window.orderBy("_part").rowsBetween(FIRST_ROW, -1)
    offsets = sums.select(
        "_part",
        *(F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals),
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(FIRST_ROW, -1)
    windowed = parted.withColumns(
        {f"_in_{t}": F.coalesce(F.sum(t).over(inside), F.lit(0)) for t in totals}
    )
    return windowed.join(F.broadcast(offsets), "_part").select(
        *rows.columns,
        *((F.col(f"_off_{t}") + F.col(f"_in_{t}")).alias(f"{t}_before") for t in totals),
    )


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per context.

    Where the session has no batch size of its own it gets one of a thousand rows: Spark's
    ten thousand texts and their copies are too much for a Python worker.
    """
    context = spark.sparkContext
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch, None) is None:
        spark.conf.set(batch, "1000")
    if any(os.path.basename(f) == "casework_code.zip" for f in context._python_includes):
        return
    top = Path(__file__).resolve().parents[2]
    archive = os.path.join(tempfile.mkdtemp(prefix="casework-code-"), "casework_code.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted((top / "casework").rglob("*.py")):
            file.write(path, path.relative_to(top))
    context.addPyFile(archive)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
