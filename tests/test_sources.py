"""Versioned history, snapshot state, staging life cycle, readers and their rejects, sorted parts."""

from __future__ import annotations

import datetime as dt
import gc
import random
import re
import weakref

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casework.operators.cases import latest_run_cases
from casework.operators.reports import latest_snapshot
from casework.plans import snapshot
from casework.plans.reports import run_dashboard
from casework.plans.snapshot import read_snapshot, refresh_snapshot
from casework.sources import files, history
from casework.sources.history import append_history, commits, read_history, read_newest_day, sweep_history
from casework.sources.schemas import HISTORY_COLUMNS, struct
from casework.sources.sinks import export_sorted
from casework.sources.staging import Staging, release
from casework.sources.tables import Folder, Table, read_input, read_inputs, rejected_rows

DAY = dt.date(2021, 3, 15)


def lines(spark, keyed):
    """History rows of (key, insert date, price); the other columns are null."""
    data = [(k, d, p) for k, d, p in keyed]
    df = spark.createDataFrame(data, "k string, d date, p double")
    return df.select(
        *[
            (
                F.col("k") if c == "acct_item_key" else F.col("d") if c == "insrt_dt" else F.col("p") if c == "curr_comp_cost" else F.lit(None)
            ).cast(t).alias(c)
            for c, t in HISTORY_COLUMNS.items()
        ]
    )


def shown(df):
    return rows(df.select("acct_item_key", "insrt_dt", F.col("curr_comp_cost").cast("double")))


def day(n):
    return DAY + dt.timedelta(days=n)


def test_a_write_that_fails_half_way_leaves_the_day(spark, tmp_path):
    path = f"{tmp_path}/h"
    append_history(lines(spark, [("a", DAY, 1.0), ("b", None, 2.0)]), path, DAY)
    before = shown(read_history(spark, path))
    broken = lines(spark, [("c", DAY, 1.0), ("d", DAY, 2.0)]).withColumn(
        "mmr_case", F.when(F.col("acct_item_key") == "d", F.raise_error(F.lit("lost")).cast("string"))
    )
    with pytest.raises(Exception, match="lost"):
        append_history(broken, path, DAY)
    assert shown(read_history(spark, path)) == before


def test_rows_without_a_commit_are_not_read(spark, tmp_path, monkeypatch):
    """A driver that dies between the rows and the commit."""
    path = f"{tmp_path}/h"
    append_history(lines(spark, [("a", DAY, 1.0)]), path, DAY)

    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(history, "_publish", dies)
        with pytest.raises(RuntimeError):
            append_history(lines(spark, [("z", DAY, 9.0)]), path, DAY)
    assert shown(read_history(spark, path)) == [("a", DAY, 1.0)]
    append_history(lines(spark, [("a", DAY, 3.0)]), path, DAY)
    assert shown(read_history(spark, path)) == [("a", DAY, 3.0)]
    assert len(sweep_history(spark, path)) == 2
    assert shown(read_history(spark, path)) == [("a", DAY, 3.0)]


def test_commits_carry_counts_and_days(spark, tmp_path):
    path = f"{tmp_path}/h"
    assert commits(spark, path) == [] and read_history(spark, path).count() == 0
    append_history(lines(spark, [("a", day(-1), 1.0), ("b", day(-3), 2.0), ("c", None, 1.0)]), path, DAY)
    append_history(lines(spark, []), path, day(7))
    first, empty = commits(spark, path)
    assert (first.n_rows, first.first_day, first.last_day) == (3, day(-3), day(-1))
    assert (empty.n_rows, empty.last_day) == (0, None)


def test_newest_day_reads_its_partition_only(spark, tmp_path):
    path = f"{tmp_path}/h"
    for n in (0, 7, 14):
        append_history(lines(spark, [("a", day(n), 1.0), ("b", None, 2.0)]), path, day(n))
    append_history(lines(spark, [("u", None, 1.0)]), path, day(21))
    newest = read_newest_day(spark, path)
    assert {re.search(r"run_date=([\d-]+)", f)[1] for f in newest.inputFiles()} == {day(14).isoformat()}
    assert shown(newest) == [("a", day(14), 1.0)]
    assert rows(latest_run_cases(newest)) == rows(latest_run_cases(read_history(spark, path)))
    since = read_history(spark, path, day(7))
    assert all(f"run_date={day(n).isoformat()}" not in f for f in since.inputFiles() for n in (0, 7))


def test_snapshot_equals_the_full_form_after_every_run(spark, tmp_path, monkeypatch):
    """Ordinary, late, repeated, shrunk and emptied days; ties across days, null keys and dates."""
    path, state = f"{tmp_path}/h", f"{tmp_path}/s"
    rng = random.Random(5)
    keys = [*"abcdefgh", None]

    def some(n, days):
        return [(rng.choice(keys), rng.choice([*days, None]), float(rng.randint(1, 9))) for _ in range(n)]

    runs = [(0, some(20, [day(0)])), (7, some(12, [day(7), day(6)])), (3, some(10, [day(3), day(7)]))]
    runs += [(7, some(3, [day(7)])), (14, some(4, [day(14)])), (14, []), (7, [])]
    for n, data in runs:
        append_history(lines(spark, data), path, day(n))
        got = refresh_snapshot(spark, path, state)
        assert rows(got) == rows(latest_snapshot(read_history(spark, path)))
    read = []
    monkeypatch.setattr(snapshot, "read_versions", lambda s, p, chosen: read.append(list(chosen)) or history.read_versions(s, p, chosen))
    assert rows(refresh_snapshot(spark, path, state)) == rows(got) and read == []
    append_history(lines(spark, some(6, [day(21)])), path, day(21))
    refresh_snapshot(spark, path, state)
    assert [[c.run_date for c in chosen] for chosen in read] == [[day(21)]]
    assert len(files.children(spark, f"{state}/rows")) == 2


def test_a_refresh_that_fails_leaves_the_state(spark, tmp_path, monkeypatch):
    path, state = f"{tmp_path}/h", f"{tmp_path}/s"
    with pytest.raises(ValueError, match="refresh"):
        read_snapshot(spark, state)
    append_history(lines(spark, [("a", DAY, 1.0)]), path, DAY)
    before = rows(refresh_snapshot(spark, path, state))
    append_history(lines(spark, [("a", day(1), 2.0)]), path, day(1))

    def dies(rows):
        return rows.withColumn("curr_comp_cost", F.raise_error(F.lit("lost")).cast("decimal(18,4)"))

    with monkeypatch.context() as patch:
        patch.setattr(snapshot, "newest_rows", dies)
        with pytest.raises(Exception, match="lost"):
            refresh_snapshot(spark, path, state)
    assert rows(read_snapshot(spark, state)) == before
    assert rows(run_dashboard(spark, path, state, f"{tmp_path}/out")) == rows(latest_snapshot(read_history(spark, path)))


def test_staging_counts_and_leaves_nothing(spark):
    staging = Staging(spark)
    staging.stage(spark.range(5).toDF("a"), "t")
    staging.stage(spark.range(0).toDF("a"), "none")
    staging.stage(spark.createDataFrame([], "a int").where("a > 1"), "empty")
    assert staging.rows == {"t": 5, "none": 0, "empty": 0}
    bucketed = staging.stage(spark.range(50).selectExpr("id % 7 as a", "id as b"), "b", "a")
    assert bucketed.count() == staging.rows["b"] == 50
    staging.clear()
    assert not files.exists(spark, staging.folder)
    held = Staging(spark)
    held.stage(spark.range(5).toDF("a"), "t")
    assert release(spark) >= 1 and not files.exists(spark, held.folder)
    assert release(spark) == 0


def test_frames_of_staged_tables_are_let_go_but_their_folders_are_cleared(spark):
    release(spark)
    staging = Staging(spark)
    bucketed = staging.stage(spark.range(9).toDF("a"), "b", "a")
    folder, table = staging.folder, staging._tables["b"]
    frame = weakref.ref(bucketed)
    assert bucketed.count() == 9 and spark.catalog.tableExists(table)
    del staging, bucketed
    gc.collect()
    assert frame() is None and files.exists(spark, folder)
    assert release(spark) == 1 and not files.exists(spark, folder) and not spark.catalog.tableExists(table)


def test_joins_of_bucketed_tables_need_no_shuffle(spark):
    staging = Staging(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = [staging.stage(spark.range(100).selectExpr("cast(id % 9 as string) as k", f"id as v{i}"), f"b{i}", "k") for i in range(3)]
        joined = sides[0].join(sides[1], "k").join(sides[2].groupBy("k").max("v2"), "k", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == sum(len(range(k, 100, 9)) ** 2 for k in range(9))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        staging.clear()


def test_readers_reject_what_does_not_fit(spark, tmp_path):
    path = f"{tmp_path}/txn"
    spark.createDataFrame(
        [("k1", "1.5", "2"), ("k2", "bad", "3"), ("k3", None, "4"), ("k4", "x", "y")], "acct_item_key string, sls string, qty string"
    ).selectExpr(
        "acct_item_key as `Acct Item Key`", "sls as `Sls 3 Mth`", "qty as qty_3_mth", "cast(0 as decimal(18,4)) as neg_sls_3_mth",
        "1L as cst_3_mth", "1.0d as neg_cst_3_mth", "'more' as other",
    ).coalesce(1).write.option("header", "true").csv(path)
    place = Folder(path, "csv", {"header": "true"})
    kept = read_inputs(spark, {"weekly_txn": place}, f"{tmp_path}/bad")["weekly_txn"]
    assert [tuple(r)[:2] for r in kept.orderBy("acct_item_key").collect()] == [("k1", 1.5), ("k3", None)]
    bad = spark.read.parquet(f"{tmp_path}/bad").orderBy("row").collect()
    assert [r.reasons for r in bad] == [["sls_3_mth: no decimal(18,4)"], ["sls_3_mth: no decimal(18,4)", "qty_3_mth: no decimal(18,4)"]]
    assert all(path in r.source_file and '"other":"more"' in r.row for r in bad)
    with pytest.raises(ValueError, match="lacks the columns ship_to"):
        read_input(spark, "exclusions", place)


def test_readers_prune_columns_that_fit(spark, tmp_path):
    path = f"{tmp_path}/exclusions"
    spark.range(5).selectExpr("id as `Ship To`", "id as `Item Number (E1)`", "id as more").write.parquet(path)
    read = read_input(spark, "exclusions", path)
    plan = read.select("ship_to")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Ship To:bigint>" in plan
    assert rejected_rows(spark, "exclusions", path).count() == 0
    spark.sql(f"create database if not exists casework_read location '{tmp_path}/db'")
    read.write.mode("overwrite").saveAsTable("casework_read.excluded")
    for place in ("casework_read.excluded", Table("casework_read.excluded")):
        assert rows(read_input(spark, "exclusions", place)) == rows(read)
    spark.sql("drop database casework_read cascade")


def test_sorted_parts_split_a_huge_case(spark, tmp_path):
    extract = spark.range(6000).selectExpr(
        "concat('k', id) as acct_item_key", "if(id % 6 < 5, 'huge', concat('m', id % 5)) as mmr_case", "cast(id % 6 as bigint) as case_cntr"
    )
    cases = extract.selectExpr("mmr_case", "concat('F-', mmr_case) as file_name").distinct()
    path = f"{tmp_path}/parts"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_sorted(extract, cases, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = []
    for name in sorted(f for f in files.children(spark, path) if f.startswith("part-")):
        part = [(r.file_name, r.case_cntr) for r in spark.read.schema("file_name string, case_cntr long").parquet(f"{path}/{name}").collect()]
        assert len(part) < 3000
        read += part
    assert read == sorted(read) and len(read) == 6000


def test_struct_has_all_history_columns():
    assert struct(HISTORY_COLUMNS).names == list(HISTORY_COLUMNS)


def test_a_history_is_written_where_its_rows_are(spark, tmp_path):
    """No shuffle of the wide rows before the write: every part of the frame leaves its own file."""
    data = lines(spark, [(f"k{i}", DAY, float(i)) for i in range(40)]).repartition(5)
    commit = append_history(data, f"{tmp_path}/h", DAY)
    written = [f for f in files.children(spark, commit.folder(f"{tmp_path}/h")) if f.endswith(".parquet")]
    assert len(written) == 5 and all(f.endswith(".zstd.parquet") for f in written)
    assert shown(read_history(spark, f"{tmp_path}/h")) == shown(data)


def test_committed_runs_write_the_wide_rows_once(spark):
    from casework_checks.registry import Tables, _committed_runs

    staging = Staging(spark)
    path = _committed_runs(Tables(spark, "/root/testdata/sf0.001"), staging)
    assert staging.written == {} and read_history(spark, path).count() > 0
    staging.clear()
