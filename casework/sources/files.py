"""Folders, through the file system that Spark itself uses for their path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _opened(spark, path)
    return system.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    system, folder = _opened(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def make(spark: SparkSession, path: str) -> None:
    """Create a folder that goes when the driver ends, however it ends short of a kill."""
    system, folder = _opened(spark, path)
    system.mkdirs(folder)
    system.deleteOnExit(folder)


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _opened(spark, path)
    system.delete(folder, True)
