"""Readers with declared schemas, and the rows that don't fit them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.sources.schemas import (
    ALLOWED_VALUES,
    INPUTS,
    RENAMED_COLUMNS,
)


def snake_case(name: str) -> str:
    """'Item Number (E1)' -> 'item_number_e1'."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def normalised(df: DataFrame) -> DataFrame:
    """Known quoted names mapped to their plain name, all others to snake case."""
    return df.withColumnsRenamed(
        {c: RENAMED_COLUMNS.get(c, snake_case(c)) for c in df.columns if RENAMED_COLUMNS.get(c, snake_case(c)) != c}
    )


@dataclass(frozen=True)
class Folder:
    """Files of a format with its reader options, e.g. ``Folder("s3a://b/ipc", "csv", {"header": "true"})``."""

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    """A catalog table, ``db.table``."""

    name: str


Location = Folder | Table | str


def located(spark: SparkSession, location: Location) -> Folder | Table:
    """Plain text names a catalog table if there is one of that name, else a Parquet folder."""
    if not isinstance(location, str):
        return location
    is_name = re.fullmatch(r"[\w`]+(\.[\w`]+)*", location) is not None
    return Table(location) if is_name and spark.catalog.tableExists(location) else Folder(location)


def _source(spark: SparkSession, location: Location, with_file: bool = False) -> DataFrame:
    """The rows with normalised names; ``with_file``, and the file or table each is from."""
    place = located(spark, location)
    if isinstance(place, Table):
        rows = spark.table(place.name)
        return normalised(rows.withColumn(_FILE, F.lit(place.name)) if with_file else rows)
    rows = spark.read.format(place.format).options(**place.options).load(place.path)
    return normalised(rows.select("*", F.col("_metadata.file_path").alias(_FILE)) if with_file else rows)


_FILE = "source_file"


def _faults(df: DataFrame, name: str, columns: Mapping[str, str]) -> dict[str, Column]:
    """Reason -> condition, for every declared column whose values may not fit its type.

    A column that already has its type can't fail, so it isn't looked at and may be pruned.
    """
    have = dict(df.dtypes)
    missing = [c for c in columns if c not in have]
    if missing:
        raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
    return {
        f"{c}: no {t}": F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        for c, t in columns.items()
        if have[c] != t and t != "string"
    }


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def read_input(spark: SparkSession, name: str, location: Location) -> DataFrame:
    """One input table in its declared schema, without the rows that don't fit it.

    Names are matched in plain or quoted form, other columns are dropped. Rows left
    out are those that :func:`rejected_rows` returns. Casts sit above the scan, so
    only columns that a query uses, or that might not fit, are read.
    """
    columns = INPUTS[name]
    rows = _source(spark, location)
    faults = _faults(rows, name, columns)
    fitting = rows.filter(~_any(faults.values())) if faults else rows
    return fitting.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()])


def rejected_rows(spark: SparkSession, name: str, location: Location) -> DataFrame:
    """Rows that don't fit the declared schema: input, source file, reasons, and the row as JSON text."""
    rows = _source(spark, location, with_file=True)
    faults = _faults(rows, name, INPUTS[name])
    reasons = F.filter(F.array(*(F.when(c, r) for r, c in faults.items())), F.isnotnull) if faults else F.array()
    kept = [c for c in rows.columns if c != _FILE]
    found = rows.filter(_any(faults.values())) if faults else rows.limit(0)
    return found.select(
        F.lit(name).alias("input"),
        _FILE,
        reasons.cast("array<string>").alias("reasons"),
        F.to_json(F.struct(*kept)).alias("row"),
    )


def read_inputs(
    spark: SparkSession, locations: Mapping[str, Location], quarantine: str | None = None
) -> dict[str, DataFrame]:
    """All inputs; with ``quarantine``, rows that don't fit go there first, replacing an earlier set."""
    if quarantine is not None:
        sets = [rejected_rows(spark, name, location) for name, location in locations.items()]
        reduce(DataFrame.unionByName, sets).write.mode("overwrite").partitionBy("input").parquet(quarantine)
    return {name: read_input(spark, name, location) for name, location in locations.items()}


def unexpected_counts(columns: Iterable[str]) -> dict[str, Column]:
    """Per enumerated column among ``columns``, the aggregate that counts codes outside its known list."""
    return {c: F.count_if(~F.col(c).isin(*values)) for c, values in ALLOWED_VALUES.items() if c in columns}


def unexpected_codes(df: DataFrame) -> DataFrame:
    """Counts of codes outside the known lists, per enumerated column."""
    return df.agg(*(n.alias(c) for c, n in unexpected_counts(df.columns).items()))
