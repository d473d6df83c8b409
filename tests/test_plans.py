"""Plans without broadcasts, as they would be on inputs too large for one."""

from __future__ import annotations

import re

import pytest
from conftest import rows

from casework.operators.catalog import catalog_offers, cheapest_contract, cheapest_contract_all, connected_share
from casework.operators.enrich import attach_sales
from casework.operators.pools import with_pool
from casework.operators.reports import latest_snapshot
from casework.plans import batch
from casework.settings import Settings
from casework.sources import files
from casework.sources.staging import Staging
from casework_checks.registry import Tables
from casework_checks.views import AS_OF, ROUNDS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Tables(spark, SF)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", physical(df)))


def test_cheapest_contract_shuffles_once(tables):
    assert exchanges(cheapest_contract(tables.written("ipc"))) == 1


def test_connected_share_shuffles(tables):
    """Catalog twice (cheapest contract, accounts) and the small totals once."""
    ipc = tables.written("ipc")
    assert exchanges(connected_share(ipc, cheapest_contract(ipc))) == 3


def test_attach_sales_reuses_the_partitioning_of_its_join(tables):
    txn, status = tables.written("weekly_txn"), tables.written("status")
    assert exchanges(attach_sales(status, txn)) == 2


def test_latest_snapshot_has_no_window(tables):
    plan = physical(latest_snapshot(tables.written("history_runs")))
    assert "Window" not in plan and plan.count("SortMergeJoin") == 1


def test_history_filters_reach_the_scan(spark, tmp_path):
    """Cool-down and report filters prune date partitions."""
    from casework.operators.candidates import recently_assigned
    from casework.operators.reports import report
    from casework.settings import COOL_DOWN_DAYS
    from casework.sources.history import append_history, read_history

    path = f"{tmp_path}/history"
    append_history(Tables(spark, SF)["history_wide"], path, AS_OF)
    history = read_history(spark, path)
    cooling = physical(recently_assigned(history, AS_OF, COOL_DOWN_DAYS))
    for plan in (cooling, physical(report(history, "cct", AS_OF))):
        assert re.search(r"PartitionFilters: \[[^]]*run_date", plan)
    assert "ReadSchema: struct<acct_item_key:string,team_assigned:string,insrt_dt:date>" in cooling


def test_line_key_joins_of_the_case_table_move_nothing(spark, tables):
    """All sides of the joins on the line key are bucketed, so no frame is dealt out by that key alone."""
    from casework.plans.batch import case_rows
    from casework.sources.staging import Staging
    from casework_checks.registry import ALL_TEAMS

    staging = Staging(spark)
    plan = physical(case_rows(tables.inputs(), tables["history"], AS_OF, ALL_TEAMS, staging.stage))
    assert not re.search(r"Exchange hashpartitioning\(acct_item_key#\d+, \d+\)", plan)
    bucketed = [name for name in staging.written if re.search(rf"spark_catalog\.default\.\w+_{name}\[", plan)]
    assert {"case_lines", "cases", "sales", "line_prices", "line_tiers"} <= set(bucketed)
    staging.clear()


def test_shuffles_start_with_many_parts(spark, tables):
    """A task's share of a join doesn't grow with the input while the session's few parts stay."""
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4
    assert re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, 256\)", physical(tables["history"]))


def test_customers_meet_the_orders_before_the_lines(tables):
    """The lines are dealt out by order, part and supplier, not once more by customer."""
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", physical(tables["status"]))
    assert sorted(moved) == sorted(["o_custkey", "c_custkey", "o_orderkey", "l_orderkey", "l_partkey", "p_partkey", "l_suppkey", "s_suppkey"])
    lines = [m for m in re.findall(r"Exchange hashpartitioning\(o_custkey.*\n(?:.*\n){4}", physical(tables["status"]))]
    assert all("l_orderkey" not in text for text in lines)


def test_wide_projections_are_compiled_by_expression(spark, tables):
    """Java doesn't compile methods of over 8,000 bytes, so Spark must not make them."""
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_catalog_offers_are_taken_in_one_pass_without_a_shuffle(tables):
    """Lines move for the minima and for their join alone; equal lines give one row all the same."""
    ipc = tables.written("ipc")
    assert exchanges(catalog_offers(ipc)) == 0
    others = tables["item"], tables["contract_tier"], tables["gpo"], AS_OF
    once = cheapest_contract_all(ipc, *others)
    assert sorted(map(repr, cheapest_contract_all(ipc.union(ipc), *others).collect())) == sorted(map(repr, once.collect()))


def test_pools_of_contract_cases_are_looked_up_for_few_lines(spark, tables, monkeypatch):
    """Lines that a key filter of the contract cases rules out don't meet the pools a second time."""
    met = []
    monkeypatch.setattr(batch, "with_pool", lambda lines, pools: met.append(lines.count()) or with_pool(lines, pools))
    staging = Staging(spark)
    batch.assign_cases(tables.inputs(), tables["history"], AS_OF, Settings(top_contracts=5), staging.stage)
    assert len(met) == 2 and staging.rows["contract_cases"] <= met[1] < met[0] / 2
    staging.clear()


@pytest.fixture
def own_tables(spark, tmp_path):
    """Order lines with repeated keys, null keys and keys that meet nothing."""
    rows = [
        (o, p, s, n, float(q), 10.5 * n, 0.06, 0.02, "N" if n % 2 else "R", "O", f"1998-0{n}-01 00:00:00")
        for n, (o, p, s, q) in enumerate(
            [(1, 1, 1, 3), (1, 1, 1, 3), (2, 1, 2, 5), (None, 1, 1, 1), (2, None, 1, 1), (2, 2, 9, 1), (3, 2, 2, 4)], 1
        )
    ]
    frames = {
        "lineitem": (
            rows + rows[:1],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string",
        ),
        "orders": (
            [(1, 7, "O", 1.0, "1998-01-01 00:00:00", "5-LOW"), (2, 8, "P", 1.0, "1998-02-01 00:00:00", "1-URGENT"), (2, 7, "F", 1.0, None, None)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string",
        ),
        "customer": (
            [(7, "c7", 1, 1.0, "BUILDING"), (8, None, 2, 1.0, None)],
            "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "part": (
            [(1, "ring", "Brand#1", "LARGE", 1, 900.0), (2, "bolt", None, "SMALL", 2, 900.1)],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "supplier": ([(1, "s1", 1, 1.0), (2, None, 2, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    for name, (data, schema) in frames.items():
        df = spark.createDataFrame(data, schema)
        days = {c: df[c].cast("timestamp") for c in ("l_shipdate", "o_orderdate") if c in df.columns}
        df.withColumns(days).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Tables(spark, str(tmp_path))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["history_wide", "status"])
def test_a_wide_view_joins_its_tables_once(spark, own_tables, name):
    staging = Staging(spark)
    once, plain = own_tables.joined_once(name, staging), own_tables[name]
    assert once.dtypes == plain.dtypes
    assert rows(once) == rows(plain) != []
    assert "Join" not in physical(once) and physical(plain).count("SortMergeJoin") >= 4
    assert files.children(spark, staging.folder) == [f"{name}_part_{k}" for k in range(ROUNDS)]
    staging.clear()


def test_latest_snapshot_with_staged_days_moves_only_what_may_be_newest(spark, own_tables):
    """The key filter stands below the joins, where the lines are read."""
    staging = Staging(spark)
    history = own_tables["history_runs"]
    staged = latest_snapshot(history, staging.stage)
    scans = [line for line in physical(staged).splitlines() if "Filter" in line and "l_shipdate" in line]
    assert scans and all("xxhash64" in line for line in scans)
    assert rows(staged) == rows(latest_snapshot(history)) != []
    staging.clear()


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """Of a run of many steps not all shuffles stay on disk."""

    def on_disk():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before = on_disk()
    Staging(spark, str(tmp_path)).stage(spark.range(1000).repartition(3, "id").groupBy("id").count(), "counted")
    assert on_disk() <= before
