"""Named queries: the Spark side and the SQL side of each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casework.functions import (
    joined_text,
    least_strict,
    ratio,
    text_after_last_hyphen,
    text_before_last_hyphen,
)
from casework.functions.dates import newer_than
from casework.operators import catalog, exceptions, price_lines, reports
from casework.operators.candidates import excluded_keys, recently_assigned, select_candidates
from casework.operators.cases import (
    CASE_COLUMNS,
    case_number,
    contract_totals,
    cost_increase_lines,
    latest_run_cases,
    pool_cases,
    residual_lines,
    top_contract_cases,
    top_customer_vendor_cases,
)
from casework.operators.enrich import (
    CONTRACT_ATTRIBUTE_COLUMNS,
    MEMBERSHIP_COLUMNS,
    TRIGGER_ATTRIBUTE_COLUMNS,
    attach_sales,
    class_of_trade,
    contract_attributes,
    exclusion_flag,
    gpo_membership,
    resolve_address,
)
from casework.operators.pools import latest_pool, with_pool
from casework.operators.relational import not_in, not_in_filtered
from casework.operators.status import (
    CURRENT_PAIRS,
    MARGIN_PAIRS,
    annualised_impact,
    resolve_current,
    resolve_margin,
    sales_measures,
    variable_cost_gap,
)
from casework.plans.batch import assign_cases, case_rows
from casework.plans.runlog import run_log, start_entry
from casework.session import tune
from casework.settings import COOL_DOWN_DAYS, ExceptionSettings, Settings
from casework.plans.snapshot import refresh_snapshot
from casework.sources import files
from casework.sources.history import append_history, read_history, read_newest_day
from casework.sources.schemas import HISTORY_COLUMNS, HISTORY_EXTRA_COLUMNS, INPUTS, RENAMED_COLUMNS
from casework.sources.sinks import export_sorted, save_table
from casework.sources.staging import Staging
from casework.sources.tables import read_input, rejected_rows
from casework_checks import oracle
from casework_checks.views import AS_OF, SparkDialect, build_views, joined_tables, shown_as, spark_view

Query = Callable[[SparkSession, str], DataFrame]

#: the rule numbers of the driver's data
CHECK_RULES = ExceptionSettings(
    amr_ship_tos=(0, 4, 8, 12, 16, 20, 24, 28),
    amr_gpo_nums=(4001, 4003),
    amr_gpo_name="ASIA",
    focus_gpo_num=4002,
    hierarchy_suppliers=(1, 2, 3),
    reverse_hierarchy_supplier=4,
    ranked_supplier=5,
    single_source_suppliers=tuple(range(6, 18)),
)
#: all teams get cases, every case line keeps its assignment, all columns
ALL_TEAMS = Settings(
    ignore_null_pools=True,
    pool_cool_down_days=2,
    assignment_from_cases=True,
    true_dates=True,
    report_extras=True,
)


class Tables:
    """The mapped views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self._written: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name)

    def inputs(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in build_views(SparkDialect) if not name.startswith("history")}

    def written(self, name: str) -> DataFrame:
        """A view read several times by one query, written once."""
        if name not in self._written:
            self._written[name] = Staging(self.spark).stage(self[name], name)
        return self._written[name]

    def joined_once(self, name: str, staging: Staging) -> DataFrame:
        """A wide view of all joined tables: they are joined once, its many columns are made at each reading.

        What a join shuffles is gone before the wide rows are written.
        """
        return shown_as(joined_tables(self.spark, self.sf_dir, name, staging=staging), name)

    def narrow(self, name: str, *columns: str) -> DataFrame:
        return spark_view(self.spark, self.sf_dir, name, list(columns))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, whole numbers as bigint, so both engines compare alike."""

    def cast(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return c.cast("bigint").alias(field.name)
        return c

    return df.select(*[cast(f) for f in df.schema])


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None = None


def _fragment(name: str, columns: str | list[str], **kwargs) -> str:
    return oracle.statement(name, columns.split() if isinstance(columns, str) else columns, **kwargs)


CANDIDATE_COLUMNS = (
    "acct_item_key bl_mfg_cont curr_mfg_cont item_e1_num cost_impact pndg_mmr_opp mmr_type acct_or_bill_to "
    "highest_cust_name vendor_name bus_pltfrm sys_pltfrm mstr_grp_num trace_key"
)
SALES = "acct_item_key sls_3_mth neg_sls_3_mth qty_3_mth cst_3_mth neg_cst_3_mth"
POOLED = "acct_item_key pool_num highest_cust_name vendor_name pndg_mmr_opp"


# The view of a table carries every column; the optimizer prunes joined tables'
# columns but not the joins, so status queries name what they read.
CANDIDATE_SOURCE = (
    "acct_item_key bl_mfg_cont bl_trig_mfg_cont curr_mfg_cont item_e1_num item_as400_num bl_cost bl_trig_cost "
    "curr_cost curr_qty bl_date curr_date pndg_mmr_opp mmr_type acct_or_bill_to ship_to highest_cust_name "
    "vendor_name bus_pltfrm sys_pltfrm mstr_grp_num"
).split()


# What the price lines read of the catalog.
CATALOG_SOURCE = (
    "sys_pltfrm bus_pltfrm var_cost item_e1_num price_source price_source_pcca bid_or_prca bid_or_prca_name "
    "local_pricing_group_id lpg_desc ship_to acct_or_bill_to gpo_name comp_cost_initial pricing_cost_initial "
    "comp_cost_list_id pricing_cost_list_id comp_cost_cont_name pricing_cost_cont_name comp_cost_cont_type "
    "pricing_cost_cont_type"
).split()


def _candidate_status(t: Tables) -> DataFrame:
    return t.narrow("status", *CANDIDATE_SOURCE)


def _candidates(t: Tables, settings: Settings = Settings()) -> DataFrame:
    stage = Staging(t.spark).stage
    return select_candidates(_candidate_status(t), t["history"], t["exclusions"], AS_OF, settings, stage)


def _pools(t: Tables) -> DataFrame:
    accounts = t.narrow("status", "acct_or_bill_to", "sys_pltfrm")
    return latest_pool(accounts, t["customer_blend"], t["customer_pool"], t["pool"], AS_OF)


def _staged_residual(t: Tables, staging: Staging) -> tuple[DataFrame, DataFrame]:
    candidates = staging.stage(_candidates(t), "candidates")
    lines = with_pool(candidates, staging.stage(_pools(t), "pools"))
    taken = staging.stage(top_contract_cases(cost_increase_lines(candidates)), "contract_cases")
    return candidates, residual_lines(lines, taken)


def _residual(t: Tables) -> DataFrame:
    return _staged_residual(t, Staging(t.spark))[1]


def _vendor_cases(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    candidates, residual = _staged_residual(t, staging)
    return top_customer_vendor_cases(staging.stage(residual, "residual"), attach_sales(candidates, t["weekly_txn"]))


def _pool_cases(days: int, ignore: bool) -> Callable[[Tables], DataFrame]:
    return lambda t: pool_cases(_residual(t), t["history"], AS_OF, days, ignore)


def _case_inputs(t: Tables, staging: Staging, *columns: str) -> dict[str, DataFrame]:
    """Inputs of the case steps; the two line tables, read many times, are written once."""
    status = t.narrow("status", *columns) if columns else t["status"]
    return t.inputs() | {
        "status": staging.stage(status, "status"),
        "ipc": staging.stage(t.narrow("ipc", *CATALOG_SOURCE), "ipc"),
    }


def _cases(settings: Settings) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        inputs = t.inputs() | {"status": _candidate_status(t)}
        return assign_cases(inputs, t["history"], AS_OF, settings, Staging(t.spark).stage)[0]

    return build


def _priced_cases(t: Tables, staging: Staging) -> tuple[dict[str, DataFrame], DataFrame]:
    inputs = _case_inputs(t, staging, *CANDIDATE_SOURCE, "bl_trig_prc_src", "curr_prc_src")
    cases = assign_cases(inputs, t["history"], AS_OF, ALL_TEAMS, staging.stage)[0]
    priced = price_lines.attach_price_source(case_number(cases, AS_OF), inputs["status"])
    return inputs, staging.stage(priced, "priced_cases")


def _price_lines(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    inputs, cases = _priced_cases(t, staging)
    return price_lines.price_case_lines(
        inputs["ipc"], cases, t["contract_tier"], t["customer"], stage=staging.stage
    )


def _price_lines_v2(t: Tables) -> DataFrame:
    staging = Staging(t.spark)
    inputs, cases = _priced_cases(t, staging)
    return price_lines.price_case_lines_v2(
        inputs["ipc"], cases, t["contract_tier"], t["customer"], staging.stage, lenient=True
    )


def _case_table(settings: Settings) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        staging = Staging(t.spark)
        inputs = t.inputs()
        narrow = inputs | {"status": _candidate_status(t)}
        assigned = assign_cases(narrow, t["history"], AS_OF, settings, staging.stage)
        inputs |= {"ipc": staging.stage(t.narrow("ipc", *CATALOG_SOURCE), "ipc")}
        return case_rows(inputs, t["history"], AS_OF, settings, staging.stage, assigned)

    return build


def _maybe_taken(t: Tables) -> DataFrame:
    recent = t["history"].filter(newer_than(F.col("insrt_dt"), AS_OF, 25))
    return recent.select(F.when(F.col("pool_num").isNotNull(), F.col("acct_item_key")).alias("k"))


def _catalog_pairs(t: Tables) -> DataFrame:
    list_id = F.when(F.col("comp_cost_list_id") != "*", F.col("comp_cost_list_id"))
    before, after = text_before_last_hyphen(list_id).cast("long"), text_after_last_hyphen(list_id).cast("long")
    return t["ipc"].select(
        price_lines.catalog_key().alias("acct_item_key"),
        (F.col("ship_to") * 10 + 1).alias("dim_cust_curr_id"),
        (before * 10 + after).alias("vrcst_cntrct_tier_id"),
    )


def _attributes(t: Tables) -> DataFrame:
    status = t.narrow(
        "status", "acct_item_key", "sys_pltfrm", "bl_cntrct_tier_id", "bl_trig_cntrct_tier_id",
        "curr_cntrct_tier_id", "curr_date", "bl_date",
    )
    return contract_attributes(
        status, status, _catalog_pairs(t), t["contract_tier"], t["gpo"], with_trigger=True
    )


def _membership(true_dates: bool) -> Callable[[Tables], DataFrame]:
    return lambda t: gpo_membership(
        t["customer"], t.narrow("status", "ship_to").distinct(), t["customer_gpo"], t["gpo"], t["gpo_program"],
        t["gpo_class"], AS_OF, true_dates,
    )


def _scalar_functions(t: Tables) -> DataFrame:
    return t["ipc"].select(
        "ship_to",
        "item_e1_num",
        joined_text(F.col("local_pricing_group_id"), "/", F.col("lpg_desc"), F.col("comp_cost_list_id")).alias("joined"),
        least_strict(F.col("comp_cost_initial"), F.col("pricing_cost_initial")).alias("strict_least"),
        text_before_last_hyphen(F.col("pricing_cost_list_id")).alias("before_hyphen"),
        text_after_last_hyphen(F.col("pricing_cost_list_id")).alias("after_hyphen"),
        ratio(F.col("unit_price") - F.col("comp_cost"), F.col("unit_price"), 4).alias("loaded"),
    )


def _cheapest(t: Tables) -> DataFrame:
    return catalog.cheapest_contract(t["ipc"])


def _standard_account(t: Tables) -> DataFrame:
    return catalog.standard_account_connected(t["ipc"].join(_cheapest(t), catalog.GROUP))


def _split(t: Tables) -> DataFrame:
    return catalog.split_contract_id(t["ipc"].select("comp_cost_list_id"), "comp_cost_list_id", lenient=True)


def _cheapest_all(t: Tables) -> DataFrame:
    return catalog.cheapest_contract_all(
        t["ipc"], t["item"], t["contract_tier"], t["gpo"], AS_OF, Staging(t.spark).stage
    )


def _gpo_contracts(t: Tables) -> DataFrame:
    return exceptions.gpo_contracts(t["gpo"], t["contract_tier"], CHECK_RULES.focus_gpo_num, AS_OF)


def _gpo_items(t: Tables) -> DataFrame:
    return exceptions.gpo_items(
        t["gpo"], t["contract_tier"], t["contract_item"], t["item"], t["ipc"], CHECK_RULES.focus_gpo_num, AS_OF
    )


def _exception_base(t: Tables) -> DataFrame:
    return exceptions.exception_base(
        t["ipc"], t["item"], t["customer_restriction"],
        Staging(t.spark).stage(_cheapest_all(t), "cheapest_all"), _gpo_contracts(t), _gpo_items(t),
        t["hierarchy"],
    )


def _categorised(t: Tables) -> DataFrame:
    return exceptions.categorise(_exception_base(t), cfg=CHECK_RULES)


def _report(name: str, **changes) -> Callable[[Tables], DataFrame]:
    return lambda t: reports.report(t["history_wide"], name, AS_OF, **changes)


def _full_dump(t: Tables) -> DataFrame:
    return reports.report(t.joined_once("history_wide", Staging(t.spark)), "full_dump", AS_OF)


def _report_sql(name: str, condition: str, distinct: bool = True) -> str:
    return oracle.statement("report_rows", list(reports.REPORTS[name].columns), condition, distinct)


_RECENT = "insrt_dt > date '1998-06-30' - 14"


def _summary(team: str, **kwargs) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        out = reports.variable_cost_summary(t["history_wide"], team, AS_OF, **kwargs)
        return out.withColumn("avg_prcnt_cnctd", F.round(F.col("avg_prcnt_cnctd").cast("double"), 6))

    return build


def _run_log(t: Tables) -> DataFrame:
    """A step's row after an older and a newer process, two rows sharing the latest time."""
    start = start_entry(t.spark)
    log = start.union(start).union(start.withColumn("process_name", F.lit("reports")))
    staging = Staging(t.spark)
    staging.stage(t.narrow("status", "acct_item_key"), "status")
    entry = run_log(log, staging.rows["status"], "status", "rows of the status fact")
    return entry.select(
        "application_name", "process_name", "process_type", "event_action", "action_description", "metric_name",
        "metric_value", (F.col("duration_string") >= 0).cast("bigint").alias("runs_forward"),
    )


def _history_rerun(t: Tables) -> DataFrame:
    """A day's rows, dated and undated, written twice and read back; another day is empty at last."""
    staging = Staging(t.spark)
    path = staging.path("history")
    rows = t.joined_once("history_wide", staging).withColumn(
        "insrt_dt", F.when(F.col("ship_to") % 4 != 3, F.lit(AS_OF))
    )
    other = AS_OF - dt.timedelta(days=7)
    for day, part in ((AS_OF, rows), (other, rows), (AS_OF, rows), (other, rows.limit(0))):
        append_history(part, path, day)
    return read_history(t.spark, path).select("acct_item_key", "insrt_dt", "case_cntr", "pndg_mmr_opp", "run_date")


def _history_failed_rerun(t: Tables) -> DataFrame:
    """A rerun that fails after part of its rows leaves the day as it was."""
    staging = Staging(t.spark)
    path = staging.path("history")
    rows = t.joined_once("history_wide", staging)
    append_history(rows, path, AS_OF)
    broken = F.when(F.col("ship_to") % 5 == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("mmr_case"))
    try:
        append_history(rows.withColumn("mmr_case", broken.cast("string")), path, AS_OF)
    except Exception as error:
        if "lost" not in str(error):
            raise
    return read_history(t.spark, path).select("acct_item_key", "insrt_dt", "case_cntr", "pndg_mmr_opp", "run_date")


#: years of insert dates in each of the snapshot's runs, and the year that the run is dated: a run with rows
#: that are not its own, runs in order, two late ones, and the first one again without the other rows
_RUNS = (
    ((1998, 2100), 1998), ((1999, 2000), 1999), ((1997, 1998), 1997), ((2000, 2100), 2001), ((0, 1997), 1996),
    ((1998, 1999), 1998),
)


def _snapshot_runs(t: Tables) -> DataFrame:
    """The snapshot after six runs, each taken in by a refresh."""
    staging = Staging(t.spark)
    history, state = staging.path("history"), staging.path("state")
    rows = staging.stage(t.narrow("history_runs", *reports.SNAPSHOT_SOURCE), "runs")
    for (first, end), year in _RUNS:
        part = rows.filter((F.year("insrt_dt") >= first) & (F.year("insrt_dt") < end))
        append_history(part, history, dt.date(year, 12, 31))
        snapshot = refresh_snapshot(t.spark, history, state)
    return snapshot


def _committed_runs(t: Tables, staging: Staging) -> str:
    """The wide history as runs of four days, of which the last holds the newest insert date."""
    path = staging.path("history")
    rows = t["history_wide"]
    for days, part in ((90, F.col("insrt_dt") < F.lit(AS_OF - dt.timedelta(days=20))), (0, F.col("insrt_dt") >= F.lit(AS_OF - dt.timedelta(days=20)))):
        append_history(rows.filter(part), path, AS_OF - dt.timedelta(days=days))
    return path


def _newest_cases(t: Tables) -> DataFrame:
    return latest_run_cases(read_newest_day(t.spark, _committed_runs(t, Staging(t.spark))))


def _sorted_parts(t: Tables) -> DataFrame:
    """The newest run's cases as numbered parts: rows, parts that begin before the last one's end, files."""
    staging = Staging(t.spark)
    cases = staging.stage(latest_run_cases(t["history_wide"]), "cases")
    export_sorted(t["history_wide"].select("acct_item_key", "mmr_case", "case_cntr"), cases, staging.path("parts"))
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    order = F.struct("file_name", "case_cntr")
    parts = (
        t.spark.read.parquet(staging.path("parts"))
        .select(part.alias("part"), order.alias("place"), "file_name")
        .groupBy("part")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.count("*").alias("n"), F.collect_set("file_name").alias("files"))
    )
    earlier = parts.select(F.col("part").alias("before"), F.col("high").alias("end"))
    # One row per written part on either side.
    wrong = parts.join(earlier, F.col("before") == F.col("part") - 1).filter("low < end")
    return parts.agg(
        F.sum("n").alias("n_rows"),
        F.lit(wrong.count()).cast("long").alias("n_out_of_order"),
        F.size(F.array_distinct(F.flatten(F.collect_list("files")))).cast("long").alias("n_files"),
    )


def _read_back(name: str) -> Callable[[Tables], DataFrame]:
    """An input written under quoted names and read in its declared schema."""
    quoted = {plain: quote for quote, plain in RENAMED_COLUMNS.items()}

    def build(t: Tables) -> DataFrame:
        staging = Staging(t.spark)
        path = staging.path(name)
        # Lines of all tables: the joins' shuffle files go before the wide rows are written.
        rows = t.joined_once(name, staging) if len(build_views(SparkDialect)[name].joins) > 2 else t[name]
        named = rows.withColumnsRenamed({c: quoted.get(c, c.replace("_", " ").title()) for c in rows.columns})
        named.write.option("compression", "zstd").parquet(path)
        return read_input(t.spark, name, path)

    return build


def _quarantine(t: Tables) -> DataFrame:
    """Transactions as text, every seventh amount of which is none: rows kept, and rows rejected with their reason."""
    path = Staging(t.spark).path("weekly_txn")
    amount = F.when(F.col("sls_3_mth") % 7 == 0, "n/a").otherwise(F.col("sls_3_mth").cast("string"))
    t["weekly_txn"].withColumn("sls_3_mth", amount).write.parquet(path)
    kept = read_input(t.spark, "weekly_txn", path).select(
        F.lit("kept").alias("outcome"), "acct_item_key", F.lit(None).cast("string").alias("reason")
    )
    rejected = rejected_rows(t.spark, "weekly_txn", path).select(
        F.lit("rejected"), F.get_json_object("row", "$.acct_item_key"), F.array_join("reasons", "; ")
    )
    return kept.union(rejected)


def _saved_table(t: Tables) -> DataFrame:
    """A result kept as a catalog table, written twice."""
    staging = Staging(t.spark)
    name = f"saved_{staging.folder.rsplit('-', 1)[-1]}"
    t.spark.sql(f"create database if not exists {name} location '{staging.path('tables')}'")
    for _ in range(2):
        save_table(excluded_keys(t["exclusions"]), f"{name}.result")
    return t.spark.table(f"{name}.result")


def _staging_life(t: Tables) -> DataFrame:
    """Rows counted as they were staged, and folders left after the run's tables were cleared."""
    staging = Staging(t.spark)
    staging.stage(t.narrow("status", "acct_item_key"), "lines")
    n = staging.rows["lines"]
    staging.clear()
    left = int(files.exists(t.spark, staging.folder))
    return t.spark.range(1).select(F.lit(n).cast("long").alias("n_rows"), F.lit(left).cast("long").alias("n_left"))


_SUMMARY = (reports.VARIABLE_COST_DIMENSIONS, reports.VARIABLE_COST_SUMS)

ENTRIES: dict[str, Entry] = {
    # status
    "resolve_current": Entry(
        lambda t: resolve_current(t["status"]).select("acct_item_key", *CURRENT_PAIRS),
        _fragment("resolve_current", ["acct_item_key", *CURRENT_PAIRS]),
    ),
    "resolve_margin": Entry(
        lambda t: resolve_margin(
            t.narrow("status", "acct_item_key", *[c for pair in MARGIN_PAIRS.values() for c in pair])
        ).select("acct_item_key", *MARGIN_PAIRS),
        _fragment("resolve_margin", ["acct_item_key", *MARGIN_PAIRS]),
    ),
    "annualised_impact": Entry(
        lambda t: annualised_impact(_candidate_status(t)).select("acct_item_key", "cost_impact"),
        _fragment("annualised_impact", "acct_item_key cost_impact"),
    ),
    "sales_measures": Entry(
        lambda t: sales_measures(t["weekly_txn"]).select(
            "acct_item_key", "actl_neg_m", "proj_neg_m", "actl_sls", "proj_sls", "actl_gp", "proj_gp"
        ),
        _fragment("sales_measures", "acct_item_key actl_neg_m proj_neg_m actl_sls proj_sls actl_gp proj_gp"),
    ),
    "variable_cost_gap": Entry(
        lambda t: variable_cost_gap(
            t.narrow("status", "acct_item_key", "curr_comp_cost", "curr_min_var_cst")
        ).select("acct_item_key", "var_cst_opp"),
        _fragment("variable_cost_gap", "acct_item_key var_cst_opp"),
    ),
    "scalar_functions": Entry(
        _scalar_functions,
        _fragment("scalar_functions", "ship_to item_e1_num joined strict_least before_hyphen after_hyphen loaded"),
    ),
    # candidates
    "recently_assigned": Entry(
        lambda t: recently_assigned(t["history"], AS_OF, COOL_DOWN_DAYS), _fragment("recent", "acct_item_key")
    ),
    "excluded_keys": Entry(lambda t: excluded_keys(t["exclusions"]), _fragment("excluded_keys", "exclusion_key")),
    "candidates": Entry(_candidates, _fragment("candidates", CANDIDATE_COLUMNS)),
    "candidates_composite_keys": Entry(
        lambda t: _candidates(t, Settings(composite_exclusion_keys=True)),
        _fragment("candidates_composite", CANDIDATE_COLUMNS),
    ),
    "not_in_with_nulls": Entry(
        lambda t: not_in(t.narrow("status", "acct_item_key"), "acct_item_key", _maybe_taken(t)),
        _fragment("not_in_with_nulls", "acct_item_key"),
    ),
    "not_in_ignoring_nulls": Entry(
        lambda t: not_in(t.narrow("status", "acct_item_key"), "acct_item_key", _maybe_taken(t), True),
        _fragment("not_in_ignoring_nulls", "acct_item_key"),
    ),
    "not_in_filtered": Entry(
        lambda t: not_in_filtered(t.narrow("status", "acct_item_key"), "acct_item_key", _maybe_taken(t), True),
        _fragment("not_in_ignoring_nulls", "acct_item_key"),
    ),
    # pools and cases
    "latest_pool": Entry(_pools, _fragment("pools", "acct_or_bill_to sys_pltfrm pool_num pool_name")),
    "with_pool": Entry(lambda t: with_pool(_candidates(t), _pools(t)), _fragment("pooled", POOLED)),
    "cost_increase_lines": Entry(
        lambda t: cost_increase_lines(_candidates(t)),
        _fragment("increases", "acct_item_key bus_pltfrm bl_mfg_cont item_e1_num mmr_type cost_impact pndg_mmr_opp"),
    ),
    "contract_totals": Entry(
        lambda t: contract_totals(cost_increase_lines(_candidates(t)), {"PC": 25000, "EC": 10000}),
        _fragment("contract_totals", "bl_mfg_cont bus_pltfrm sum_opp"),
    ),
    "top_contract_cases": Entry(
        lambda t: top_contract_cases(cost_increase_lines(_candidates(t))),
        _fragment("contract_cases", "acct_item_key case_prefix case_cntr team_assigned"),
    ),
    "attach_sales": Entry(lambda t: attach_sales(_candidates(t), t["weekly_txn"]), _fragment("sales", SALES)),
    "residual_lines": Entry(_residual, _fragment("residual", POOLED)),
    "pool_cases": Entry(_pool_cases(25, False), _fragment("pool_cases", CASE_COLUMNS)),
    "pool_cases_ignoring_nulls": Entry(
        _pool_cases(2, True), _fragment("pool_cases_ignoring_nulls", CASE_COLUMNS)
    ),
    "top_customer_vendor_cases": Entry(_vendor_cases, _fragment("vendor_cases", CASE_COLUMNS)),
    "union_cases": Entry(_cases(Settings()), _fragment("cases", CASE_COLUMNS)),
    "union_cases_all_teams": Entry(_cases(ALL_TEAMS), _fragment("cases_all", CASE_COLUMNS)),
    "case_number": Entry(
        lambda t: case_number(_cases(ALL_TEAMS)(t), AS_OF).select("acct_item_key", "mmr_case", "insrt_dt").distinct(),
        _fragment("numbered_cases_all", "acct_item_key mmr_case insrt_dt", distinct=True),
    ),
    # price catalog
    "cheaper_branch": Entry(
        lambda t: catalog.cheaper_branch(t["ipc"]).select(
            *catalog.GROUP, "ship_to", "lpg_prca_cost", "var_cst_cont", "var_cst_cont_name", "var_cst_cont_type"
        ),
        _fragment(
            "cheaper_branch",
            [*catalog.GROUP, "ship_to", "lpg_prca_cost", "var_cst_cont", "var_cst_cont_name", "var_cst_cont_type"],
        ),
    ),
    "cheapest_contract": Entry(
        _cheapest,
        _fragment(
            "cheapest", [*catalog.GROUP, "mn_lpg_prca_cost", "var_cst_cont", "var_cst_cont_name", "var_cst_cont_type"]
        ),
    ),
    "cheapest_contract_all": Entry(
        _cheapest_all,
        _fragment(
            "cheapest_all",
            "prc_src_item_key parnt_suplr_num mn_lpg_prca_cost var_cst_cont var_cst_cont_id var_cst_cont_name "
            "var_cst_cont_type var_cst_gpo_num var_cst_gpo_name",
        ),
    ),
    "connected_share": Entry(
        lambda t: catalog.connected_share(t["ipc"], _cheapest(t)),
        _fragment("connected_share", "price_source var_cst_cont prcnt_cnctd"),
    ),
    "standard_account_connected": Entry(
        _standard_account, _fragment("standard_account_connected", [*catalog.GROUP, "var_cst_cont", "pcca_cnctd"])
    ),
    "split_contract_id": Entry(
        _split, _fragment("split_contract_id", "comp_cost_list_id var_mck_cont_id var_mck_cont_tier")
    ),
    "price_case_lines": Entry(
        _price_lines, _fragment("price_lines_cases_all", price_lines.PRICE_LINE_COLUMNS)
    ),
    "price_case_lines_v2": Entry(
        _price_lines_v2, _fragment("price_lines_v2", price_lines.PRICE_LINE_V2_COLUMNS)
    ),
    # enrichment
    "exclusion_flag": Entry(
        lambda t: exclusion_flag(_catalog_pairs(t), t["customer"], t["eligibility"], AS_OF),
        _fragment("exclusion_flag", "vrcst_cntrct_tier_id dim_cust_curr_id vrcst_cont_excld"),
    ),
    "contract_attributes": Entry(
        _attributes, _fragment("contract_attributes", CONTRACT_ATTRIBUTE_COLUMNS + TRIGGER_ATTRIBUTE_COLUMNS)
    ),
    "gpo_membership": Entry(_membership(False), _fragment("gpo_membership", MEMBERSHIP_COLUMNS)),
    "gpo_membership_true_dates": Entry(
        _membership(True), _fragment("gpo_membership_true_dates", MEMBERSHIP_COLUMNS)
    ),
    "resolve_address": Entry(
        lambda t: resolve_address(
            t.narrow("ipc", "bus_pltfrm", "acct_or_bill_to", "ship_to"), t["customer_blend"],
            t["address_alternate"], t["address_dated"],
        ),
        _fragment(
            "resolve_address",
            "bus_pltfrm cust_key address addrss_line1 addrss_line2 addrss_line3 addrss_line4 city state zip",
        ),
    ),
    "class_of_trade": Entry(
        lambda t: class_of_trade(t["customer_blend"], t.narrow("status", "ship_to").distinct()),
        _fragment("class_of_trade", "cot cust_e1_num"),
    ),
    # the wide table
    "case_table": Entry(_case_table(Settings()), _fragment("case_table_cases", list(HISTORY_COLUMNS))),
    "case_table_all_teams": Entry(
        _case_table(ALL_TEAMS), _fragment("case_table_cases_all", [*HISTORY_COLUMNS, *HISTORY_EXTRA_COLUMNS])
    ),
    # reports
    "latest_run_cases": Entry(
        lambda t: latest_run_cases(t["history_wide"]),
        _fragment("latest_run_cases", "case_cntr mmr_case team_assigned file_name"),
    ),
    "report_strat_cost_increase": Entry(
        _report("strat_cost_increase", cases=[101, 107, 113, 119]),
        _report_sql("strat_cost_increase", f"team_assigned = 'STRAT' and case_cntr in (101, 107, 113, 119) and mmr_type in ('CCI', 'CCI/LM') and {_RECENT}"),
    ),
    "report_strat_acquisition": Entry(
        _report("strat_acquisition"),
        _report_sql("strat_acquisition", f"team_assigned = 'STRAT' and mmr_type in ('CI', 'CI/LM') and pndg_mmr_opp > 0 and {_RECENT}"),
    ),
    "report_strat_low_margin": Entry(
        _report("strat_low_margin"),
        _report_sql("strat_low_margin", f"team_assigned = 'STRAT' and mmr_type = 'LM' and pndg_mmr_opp > 0 and {_RECENT}"),
    ),
    "report_strat_variable_cost_detail": Entry(
        _report("strat_variable_cost_detail"),
        _report_sql("strat_variable_cost_detail", f"team_assigned = 'STRAT' and mmr_type = 'VC' and {_RECENT}"),
    ),
    "report_nm_cost_increase": Entry(
        _report("nm_cost_increase", cases=[1, 2, 3, 5, 8, 13, 21, 34]),
        _report_sql("nm_cost_increase", f"team_assigned = 'NM' and case_cntr in (1, 2, 3, 5, 8, 13, 21, 34) and mmr_type in ('CCI', 'CCI/LM') and {_RECENT}"),
    ),
    "report_nm_cost_increase_multi": Entry(
        _report("nm_cost_increase_multi"),
        _report_sql("nm_cost_increase_multi", f"team_assigned = 'NM' and case_cntr < 10 and mmr_type in ('CCI', 'CCI/LM') and {_RECENT}"),
    ),
    "report_nm_acquisition": Entry(
        _report("nm_acquisition"),
        _report_sql("nm_acquisition", f"team_assigned = 'NM' and mmr_type in ('CI', 'CI/LM') and pndg_mmr_opp > 0 and {_RECENT}"),
    ),
    "report_nm_low_margin": Entry(
        _report("nm_low_margin"),
        _report_sql("nm_low_margin", f"team_assigned = 'NM' and mmr_type = 'LM' and pndg_mmr_opp > 0 and {_RECENT}"),
    ),
    "report_cct": Entry(_report("cct"), _report_sql("cct", f"team_assigned = 'CCT' and {_RECENT}")),
    "report_full_dump": Entry(_full_dump, _report_sql("full_dump", "true", distinct=False)),
    "variable_cost_summary_strat": Entry(
        _summary("STRAT"), oracle.summary_statement(*_SUMMARY, "STRAT", "true")
    ),
    "variable_cost_summary_nm": Entry(
        _summary("NM", cases=list(range(1, 60))),
        oracle.summary_statement(*_SUMMARY, "NM", "case_cntr between 1 and 59"),
    ),
    "latest_snapshot": Entry(
        lambda t: reports.latest_snapshot(t["history_runs"], Staging(t.spark).stage),
        _fragment("latest_snapshot", reports.SNAPSHOT_COLUMNS),
    ),
    # exceptions
    "gpo_contracts": Entry(_gpo_contracts, _fragment("gpo_contracts", "cont_num_tier")),
    "gpo_items": Entry(_gpo_items, _fragment("gpo_items", "item_e1_num")),
    "exception_base": Entry(_exception_base, _fragment("exception_base", exceptions.EXCEPTION_BASE_COLUMNS)),
    "categorise": Entry(
        _categorised,
        _fragment("categorise", "acct_item_key comp_cost_initial mn_lpg_prca_cost qty_3_mth var_cst_ctgry"),
    ),
    "category_opportunity": Entry(
        lambda t: exceptions.category_opportunity(_categorised(t)),
        _fragment("category_opportunity", "acct_item_key var_cst_ctgry var_cst_opp"),
    ),
    "category_totals": Entry(
        lambda t: exceptions.category_totals(_categorised(t)), _fragment("category_totals", "n_categorised total_gap")
    ),
    # the log's times differ from run to run: only the sign of the duration is compared
    "run_log": Entry(
        _run_log,
        _fragment(
            "run_log",
            "application_name process_name process_type event_action action_description metric_name metric_value "
            "runs_forward",
        ),
    ),
    "history_rerun": Entry(
        _history_rerun, _fragment("history_rerun", "acct_item_key insrt_dt case_cntr pndg_mmr_opp run_date")
    ),
    "history_failed_rerun": Entry(
        _history_failed_rerun,
        _fragment("history_failed_rerun", "acct_item_key insrt_dt case_cntr pndg_mmr_opp run_date"),
    ),
    "snapshot_runs": Entry(_snapshot_runs, _fragment("latest_snapshot", reports.SNAPSHOT_COLUMNS)),
    "latest_run_cases_committed": Entry(
        _newest_cases, _fragment("latest_run_cases", "case_cntr mmr_case team_assigned file_name")
    ),
    "sorted_parts": Entry(_sorted_parts, _fragment("sorted_parts", "n_rows n_out_of_order n_files")),
    "saved_table": Entry(_saved_table, _fragment("excluded_keys", "exclusion_key")),
    "staging_life": Entry(_staging_life, _fragment("staging_life", "n_rows n_left")),
    "rule_shadows": Entry(
        lambda t: exceptions.shadow_report(_exception_base(t), cfg=CHECK_RULES),
        _fragment("rule_shadows", "rule category n_matched n_decided n_shadowed"),
    ),
    # sources, read through the readers
    **{
        f"read_{name}": Entry(_read_back(name), _fragment(f"v_{name}", list(INPUTS[name])))
        for name in (
            "status ipc weekly_txn customer customer_pool pool contract_tier eligibility contract_item item gpo "
            "address_alternate address_dated exclusions hierarchy"
        ).split()
    },
    "read_quarantined": Entry(_quarantine, _fragment("quarantine", "outcome acct_item_key reason")),
}


def queries() -> dict[str, Query]:
    def runner(entry: Entry) -> Query:
        return lambda spark, sf_dir: plain(entry.build(Tables(spark, sf_dir)))

    return {name: runner(entry) for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql is not None}
