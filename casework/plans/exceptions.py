"""The exception job: every catalog line with its variable-cost category, in one call."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from casework.operators.catalog import cheapest_contract_all
from casework.operators.exceptions import (
    categorise,
    category_opportunity,
    category_totals,
    exception_base,
    gpo_contracts,
    gpo_items,
)
from casework.session import tune
from casework.settings import ExceptionSettings
from casework.sources.sinks import save_table
from casework.sources.staging import Staging


def exception_lines(
    inputs: Mapping[str, DataFrame],
    as_of: dt.date,
    cfg: ExceptionSettings = ExceptionSettings(),
    stage=lambda df, name, *keys: df,
    lenient: bool = False,
) -> DataFrame:
    """Categorised lines from ``ipc item contract_tier contract_item gpo customer_restriction hierarchy``."""
    tiers, gpos, items = inputs["contract_tier"], inputs["gpo"], inputs["item"]
    cheapest = stage(cheapest_contract_all(inputs["ipc"], items, tiers, gpos, as_of, stage), "cheapest_all")
    base = exception_base(
        inputs["ipc"],
        items,
        inputs["customer_restriction"],
        cheapest,
        gpo_contracts(gpos, tiers, cfg.focus_gpo_num, as_of),
        gpo_items(gpos, tiers, inputs["contract_item"], items, inputs["ipc"], cfg.focus_gpo_num, as_of),
        inputs["hierarchy"],
        lenient,
    )
    return categorise(base, cfg=cfg)


def run_exceptions(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    path: str,
    as_of: dt.date,
    cfg: ExceptionSettings = ExceptionSettings(),
    lenient: bool = False,
    table: str | None = None,
) -> DataFrame:
    """Write a day's categorised lines, their opportunities and the totals; return the lines.

    They go to ``path/lines``, ``path/opportunity`` and ``path/totals`` and replace an
    earlier result; ``table`` also keeps the lines as a catalog table.
    """
    tune(spark)
    staging = Staging(spark)
    try:
        exception_lines(inputs, as_of, cfg, staging.stage, lenient).write.mode("overwrite").parquet(f"{path}/lines")
    finally:
        staging.clear()
    lines = spark.read.parquet(f"{path}/lines")
    category_opportunity(lines).write.mode("overwrite").parquet(f"{path}/opportunity")
    category_totals(lines).write.mode("overwrite").parquet(f"{path}/totals")
    if table:
        save_table(lines, table)
    return lines
