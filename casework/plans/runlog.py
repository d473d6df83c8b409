"""Event log of a run: one row per step with its duration and row count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.functions import days_between
from casework.sources.schemas import EVENT_LOG_COLUMNS, struct

APPLICATION = "casework"
PROCESS = "batch"
START_TEXT = "start of a run"


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], struct(EVENT_LOG_COLUMNS))


def start_entry(spark: SparkSession) -> DataFrame:
    """The row that starts the timer."""
    now = F.current_timestamp()
    return spark.range(1).select(
        now.alias("start_"),
        now.alias("now"),
        F.lit(None).cast("double").alias("duration_string"),
        F.lit(APPLICATION).alias("application_name"),
        F.lit(PROCESS).alias("process_name"),
        F.lit("TIMER").alias("process_type"),
        F.lit("START").alias("event_action"),
        F.lit(START_TEXT).alias("action_description"),
        F.lit(None).cast("string").alias("metric_name"),
        F.lit(None).cast("bigint").alias("metric_value"),
    )


def run_log(
    log: DataFrame,
    count: int,
    action: str,
    description: str,
    process_type: str = "CREATE",
    metric: str = "ROW_COUNT",
    process: str = PROCESS,
) -> DataFrame:
    """The next log row of a process: time since its latest row, and the step's count.

    The count comes with the step, as a rule observed while its rows were written,
    so that logging reads none of them. No row comes out when the process has not been started. The latest time is
    one value, so equal times cannot multiply the new row.
    """
    latest = log.filter(F.col("process_name") == process).agg(F.max("now").alias("start_"))
    now = F.current_timestamp()
    return latest.filter(F.col("start_").isNotNull()).select(
        "start_",
        now.alias("now"),
        days_between(now, F.col("start_")).alias("duration_string"),
        F.lit(APPLICATION).alias("application_name"),
        F.lit(process).alias("process_name"),
        F.lit(process_type).alias("process_type"),
        F.lit(action).alias("event_action"),
        F.lit(description).alias("action_description"),
        F.lit(metric).alias("metric_name"),
        F.lit(count).cast("bigint").alias("metric_value"),
    )
