"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings, applied only where the session does not name a value.
_RUNTIME = {
    # A join on a hot key is split into several tasks even if the aggregate
    # after it then needs one more shuffle. Without a hot key nothing changes.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A shuffle starts with many parts, which adaptive execution joins up to its target size. With
    # a fixed small number a task's part grows with the input until its sorts and groups spill.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
    # Java compiles no method above this size: the code of a wide row's stage would be interpreted.
    # Above it Spark evaluates the row by expression, in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A broadcast of few rows may have to wait for tasks of large stages that began before it.
    "spark.sql.broadcastTimeout": "3600",
    # A query's shuffle files go when it ends. Otherwise those of all steps of a run stay on disk until
    # the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators are written for, unless the session has a value of its own."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark
