"""The case batch: candidates, cases, price lines, enrichment, history row set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.operators.candidates import select_candidates
from casework.operators.case_table import build_case_table, line_facts
from casework.operators.cases import (
    case_number,
    cost_increase_lines,
    pool_cases,
    pooled_contract_cases,
    residual_lines,
    top_contract_cases,
    top_customer_vendor_cases,
    union_cases,
)
from casework.operators.enrich import (
    attach_sales,
    case_accounts,
    class_of_trade,
    contract_attributes,
    exclusion_flag,
    gpo_membership,
    resolve_address,
)
from casework.operators.pools import latest_pool, with_pool
from casework.operators.relational import may_match
from casework.operators.price_lines import (
    PRICE_LINE_COLUMNS,
    attach_price_source,
    price_case_lines,
    price_case_lines_v2,
)
from casework.plans.runlog import empty_log, run_log, start_entry
from casework.settings import Settings
from casework.session import tune
from casework.sources.schemas import RUN_DATE
from casework.sources.history import append_history, commits, empty_history, read_history, read_versions
from casework.sources.sinks import append_log, save_table
from casework.sources.staging import Staging
from casework.sources.tables import unexpected_codes, unexpected_counts

Stage = Callable[..., DataFrame]
Inputs = Mapping[str, DataFrame]

#: staged results that get a log row: name -> description
LOGGED_STEPS = {
    "candidates": "open lines without exclusions and cooling-down lines",
    "contract_cases": "lines of the largest contract cases",
    "sales": "3-month sales of the candidate lines",
    "cases": "cases of all teams",
    "price_lines": "catalog facts of the case lines",
    "excluded": "exclusion flags of the cheapest contracts",
}


def _keep(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return df


def assign_cases(
    inputs: Inputs, history: DataFrame, as_of: dt.date, settings: Settings = Settings(), stage: Stage = _keep
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cases of all teams, with the pools and the sales they were built from."""
    status = inputs["status"]
    candidates = stage(
        select_candidates(status, history, inputs["exclusions"], as_of, settings, None if stage is _keep else stage),
        "candidates",
    )
    pools = stage(
        latest_pool(
            status, inputs["customer_blend"], inputs["customer_pool"], inputs["pool"], as_of, settings.pool_types
        ),
        "pools",
    )
    increases = cost_increase_lines(candidates, settings.cost_increase_types)
    contract_cases = stage(
        top_contract_cases(increases, settings.top_contracts, settings.min_case_impact), "contract_cases"
    )
    sales = stage(attach_sales(candidates, inputs["weekly_txn"]), "sales", "acct_item_key")
    lines = with_pool(candidates, pools)
    residual = stage(residual_lines(lines, contract_cases), "residual")
    # Few lines are in a contract case: the others are left out before the pools are looked up for these.
    in_contract = may_match(candidates, contract_cases.select("acct_item_key"), ["acct_item_key"])
    cases = union_cases(
        pooled_contract_cases(contract_cases, with_pool(in_contract, pools)),
        pool_cases(residual, history, as_of, settings.pool_cool_down_days, settings.ignore_null_pools),
        top_customer_vendor_cases(residual, sales, settings.top_customer_vendors),
    )
    return stage(cases, "cases", "acct_item_key"), pools, sales


def case_rows(
    inputs: Inputs,
    history: DataFrame,
    as_of: dt.date,
    settings: Settings = Settings(),
    stage: Stage = _keep,
    assigned: tuple[DataFrame, DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The rows one run adds to the history.

    ``stage`` is called on every result that more than one later step reads;
    pass ``Staging.stage`` to write these once. Without it everything is one
    plan and shared parts are computed again where they are used. ``assigned``
    is what :func:`assign_cases` returned, where it has run already.
    """
    plain_cases, pools, sales = assigned or assign_cases(inputs, history, as_of, settings, stage)
    # All later steps need the status of the case lines only: the wide rows are read once and
    # few of them kept. Frames on the line key are staged in buckets of it, so their joins
    # move nothing.
    case_keys = plain_cases.select("acct_item_key").distinct()
    may_be_case = may_match(inputs["status"], case_keys, ["acct_item_key"])
    status = stage(may_be_case.join(case_keys, "acct_item_key", "left_semi"), "case_lines", "acct_item_key")
    cases = case_number(plain_cases, as_of)
    priced = attach_price_source(cases, status)
    catalog = inputs["ipc"], priced, inputs["contract_tier"], inputs["customer"]
    if settings.alternative_price_lines:
        lines = price_case_lines_v2(*catalog, stage, settings.lenient).select(*PRICE_LINE_COLUMNS)
    else:
        lines = price_case_lines(*catalog, settings, stage, settings.lenient)
    prices = stage(lines, "price_lines")
    accounts = stage(case_accounts(cases, status), "accounts")
    facts = line_facts(
        status,
        cases,
        sales,
        class_of_trade(inputs["customer_blend"], accounts),
        prices,
        pools,
        gpo_membership(
            inputs["customer"],
            accounts,
            inputs["customer_gpo"],
            inputs["gpo"],
            inputs["gpo_program"],
            inputs["gpo_class"],
            as_of,
            settings.true_dates,
        ),
        contract_attributes(
            status, cases, prices, inputs["contract_tier"], inputs["gpo"], with_trigger=settings.report_extras
        ),
        stage(exclusion_flag(prices, inputs["customer"], inputs["eligibility"], as_of), "excluded"),
        resolve_address(
            prices,
            inputs["customer_blend"],
            inputs["address_alternate"],
            inputs["address_dated"],
            settings.legacy_address_platform,
        ),
        settings,
        stage,
    )
    return build_case_table(status, facts, settings)


def run_batch(
    spark: SparkSession,
    inputs: Inputs,
    history_path: str,
    log_path: str,
    as_of: dt.date,
    settings: Settings = Settings(),
    first_run: bool = False,
    table: str | None = None,
) -> DataFrame:
    """One run: build the case rows, commit them to the history, log every step.

    Returns the history rows of the run date, read back; ``table`` also keeps them
    as a catalog table. Counts in the log are observed while the rows are written.
    """
    tune(spark)
    staging = Staging(spark)
    append_log(start_entry(spark), log_path)

    def log(count: int, step: str, text: str, metric: str = "ROW_COUNT") -> None:
        seen = spark.read.schema(empty_log(spark).schema).parquet(log_path)
        append_log(run_log(seen, count, step, text, metric=metric), log_path)

    def stage(df: DataFrame, name: str, *keys: str) -> DataFrame:
        staged = staging.stage(df, name, *keys)
        if name in LOGGED_STEPS:
            log(staging.rows[name], name, LOGGED_STEPS[name])
        return staged

    try:
        # Rows of the run date are left out, so a rerun sees what the first attempt
        # saw and replaces its rows. Undated rows never count as recent.
        history = empty_history(spark) if first_run else read_history(spark, history_path)
        history = history.filter(F.col(RUN_DATE) < F.lit(as_of))
        built = case_rows(inputs, history, as_of, settings, stage)
        rows, odd = staging.stage_observed(built, "case_rows", **unexpected_counts(built.columns))
        commit = append_history(rows, history_path, as_of)
        log(commit.n_rows, "history", "rows added to the history", metric="ROWS_INSERTED")
        for source, counts in (("status", unexpected_codes(inputs["status"]).first().asDict()), ("history", odd)):
            for column, n in counts.items():
                log(n, f"{source}_codes", f"codes outside the known list of {column}", metric="UNKNOWN_CODES")
        today = read_versions(spark, history_path, [c for c in commits(spark, history_path) if c.run_date == as_of])
        if table:
            save_table(today, table)
        return today
    finally:
        staging.clear()
