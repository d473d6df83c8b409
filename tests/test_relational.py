"""Null and tie rules of the relational helpers."""

from __future__ import annotations

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casework.operators.relational import (
    first_per_group,
    first_rows,
    key_filter,
    latest_rows,
    may_match,
    not_in,
    not_in_filtered,
    null_safe_join,
    numbered_top,
    with_filter_hit,
    without_few_keys,
    without_keys,
)

KEYS = ["a", "b", "b", None]


@pytest.mark.parametrize("excluded", [[], ["a"], ["a", None], [None], ["z"], ["a", "a", "b"]])
def test_not_in_equals_sql_not_in(spark, excluded):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "k string, i int")
    sub = spark.createDataFrame([(k,) for k in excluded], "x string")
    df.createOrReplaceTempView("t_keys")
    sub.createOrReplaceTempView("t_excluded")
    expected = spark.sql("select * from t_keys where k not in (select x from t_excluded)")
    assert rows(not_in(df, "k", sub)) == rows(expected)
    ignoring = spark.sql("select * from t_keys where k not in (select x from t_excluded where x is not null)")
    assert rows(not_in(df, "k", sub, ignore_null_keys=True)) == rows(ignoring)
    assert rows(not_in_filtered(df, "k", sub, blocks=2)) == rows(expected)
    assert rows(not_in_filtered(df, "k", sub, ignore_null_keys=True)) == rows(ignoring)


def test_filter_has_no_wrong_misses_and_few_wrong_hits(spark):
    lines = spark.range(40_000).select(F.when(F.col("id") % 50 > 0, F.concat(F.lit("k"), "id")).alias("k"), "id")
    keys = spark.range(0, 60_000, 8).select(F.concat(F.lit("k"), "id").alias("x"))
    bits = key_filter(keys, "x", 8)
    assert bits.count() <= 8
    probed = with_filter_hit(lines, "k", bits, 8)
    assert probed.columns == ["k", "id", "__hit"] and probed.count() == 40_000
    there = (F.col("id") % 8 == 0) & F.col("k").isNotNull()
    assert probed.filter(there & ~F.col("__hit")).count() == 0
    assert probed.filter(F.col("k").isNull() & F.col("__hit")).count() == 0
    assert probed.filter(~there & F.col("__hit")).count() < 0.02 * 40_000
    # A filter that is far too small lets more rows through to the anti join; the rows stay right.
    assert rows(not_in_filtered(lines, "k", keys, blocks=1)) == rows(not_in(lines, "k", keys))


def test_only_rows_the_filter_lets_through_are_shuffled(spark, tmp_path):
    spark.range(40_000).select("id").write.parquet(str(tmp_path / "lines"))
    spark.range(0, 40_000, 100).select(F.col("id").alias("x")).write.parquet(str(tmp_path / "taken"))
    lines, taken = spark.read.parquet(str(tmp_path / "lines")), spark.read.parquet(str(tmp_path / "taken"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = {}
        for f in (not_in, not_in_filtered):
            df = f(lines, "id", taken)
            assert df.count() == 39_600
            plan = df._jdf.queryExecution().executedPlan()
            df.collect()
            shuffled[f.__name__] = _shuffled_rows(plan)
        assert shuffled["not_in"] > 40_000 > 4_000 > shuffled["not_in_filtered"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shuffled_rows(plan) -> int:
    """Rows written by all exchanges of a plan that has run."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _shuffled_rows(plan.executedPlan())
    total = 0
    while plan.getClass().getSimpleName().endswith("QueryStageExec"):
        plan = plan.plan()
    written = plan.metrics().get("shuffleRecordsWritten")
    if written.isDefined():
        total += written.get().value()
    children = plan.children()
    return total + sum(_shuffled_rows(children.apply(i)) for i in range(children.length()))


def test_filtered_keys_of_other_types_are_refused(spark):
    lines = spark.range(3)
    with pytest.raises(TypeError):
        not_in_filtered(lines, "id", spark.createDataFrame([("1",)], "x string"))
    with pytest.raises(TypeError):
        not_in_filtered(lines.select(F.col("id").cast("double").alias("d")), "d", spark.createDataFrame([(1.0,)], "x double"))


def test_not_in_has_no_cross_join_and_no_forced_broadcast(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    sub = spark.range(5).select(F.col("id").alias("x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = not_in(df, "k", sub)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan.split("== Physical Plan ==")[1]
    assert "NestedLoop" not in physical and "Cartesian" not in physical and "BroadcastExchange" not in physical


def test_without_keys_keeps_duplicates_and_drops_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    taken = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(without_keys(df, "k", taken)) == [("b",), ("b",)]


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None, "l"), (None, None, "m")], "a int, b int, v string")
    right = spark.createDataFrame([(1, None, "r"), (None, None, "s")], "a int, b int, w string")
    assert rows(null_safe_join(left, right, ["a", "b"]).select("v", "w")) == [("l", "r"), ("m", "s")]
    assert rows(null_safe_join(left, right, ["a", "b"], strict=["a"]).select("v", "w")) == [("l", "r")]


def _random_frame(spark, n=400):
    rng = random.Random(7)
    data = [
        (rng.choice(["x", "y", "z", None]), rng.choice([1, 2, 3, None]), rng.choice(["p", "q", None]), i % 50)
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "k string, a int, b string, v int")
    df.createOrReplaceTempView("t_random")
    return df


def test_latest_rows_is_rank_one_descending_nulls_first(spark):
    df = _random_frame(spark)
    expected = spark.sql(
        "select k, a, b, v from (select *, rank() over (partition by k order by a desc nulls first) r from t_random) where r = 1"
    )
    assert rows(latest_rows(df, ["k"], "a").select("k", "a", "b", "v")) == rows(expected)


def test_latest_rows_without_null_days_keeps_ties(spark):
    df = _random_frame(spark).filter("a is not null")
    expected = spark.sql(
        "select k, a, b, v from (select *, rank() over (partition by k order by a desc) r from t_random "
        "where a is not null) where r = 1"
    )
    assert rows(latest_rows(df, ["k"], "a").select("k", "a", "b", "v")) == rows(expected)


def test_first_rows_is_rank_one_ascending_nulls_last(spark):
    df = _random_frame(spark)
    expected = spark.sql(
        "select k, a, b, v from (select *, rank() over (partition by k order by a asc nulls last, b asc nulls last) r "
        "from t_random) where r = 1"
    )
    assert rows(first_rows(df, ["k"], ["a", "b"]).select("k", "a", "b", "v")) == rows(expected)


def test_first_rows_with_null_in_every_order_column(spark):
    df = spark.createDataFrame(
        [("g", None, "b", 1), ("g", None, None, 2), ("g", None, "b", 3), ("h", None, None, 4)],
        "k string, a int, b string, v int",
    )
    assert [r[3] for r in rows(first_rows(df, ["k"], ["a", "b"]).select("k", "a", "b", "v"))] == [1, 3, 4]


def test_first_per_group_equals_distinct_first_rows(spark):
    df = _random_frame(spark).select("k", "a", "b")
    assert rows(first_per_group(df, ["k"], ["a", "b"])) == rows(first_rows(df, ["k"], ["a", "b"]).distinct())


def test_numbered_top_is_dense_and_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 5), ("a", 5), ("b", 9), ("d", 1)], "k string, s int")
    out = numbered_top(df, "s", 3, ["k"], "n")
    assert rows(out.select("n", "k")) == [(1, "b"), (2, "a"), (3, "c")]


def test_wide_rows_that_cannot_match_are_left_out_before_a_join(spark):
    df = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("k"), F.expr("date '2021-01-01' + cast(id div 500 as int)").alias("d"), "id")
    days = df.groupBy("k").agg(F.max("d").alias("d"))
    kept = may_match(df, days, ["k", "d"], blocks=8)
    assert kept.columns == df.columns and kept.count() < 2_000
    assert rows(kept.join(days, ["k", "d"])) == rows(df.join(days, ["k", "d"]))
    nulls = df.select(F.lit(None).cast("string").alias("k"), "d").limit(5)
    assert nulls.join(may_match(days, nulls, ["k", "d"]), ["k", "d"]).count() == 0
    with pytest.raises(TypeError, match="hashed alike"):
        may_match(df.withColumn("k", F.col("id")), days, ["k", "d"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_cannot_match_are_left_out_below_wide_projections_and_joins(spark):
    """The condition reaches the first join that has its columns, so the later join meets few rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = spark.range(2_000).select(F.col("id").alias("o"), (F.col("id") % 50).alias("p"), F.col("id").alias("x"))
    orders = spark.range(2_000).select(F.col("id").alias("o"), (F.col("id") * 3).alias("c"))
    parts = spark.range(50).select(F.col("id").alias("p"), F.col("id").cast("string").alias("name"))
    wide = lines.join(orders, "o").join(parts, "p").select(F.concat("c", F.lit("-"), "p").alias("k"), "x", "name")
    values = wide.filter(F.col("x") < 20).select("k")
    found = may_match(wide, values, ["k"], blocks=8)
    text = plan(found)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at_part = re.search(r"SortMergeJoin \[p#\d+L\].*", text).group()
    at_order = re.search(r"SortMergeJoin \[o#\d+L\].*", text).group()
    assert "Subquery" in at_order and "Subquery" not in at_part
    assert 20 <= found.count() < 100
    assert rows(found.join(values, "k")) == rows(wide.join(values, "k"))


@pytest.mark.parametrize("taken", [[], ["a"], ["a", None], [None], ["z", "b"]])
def test_without_few_keys_equals_without_keys(spark, taken):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "k string, i int")
    keys = spark.createDataFrame([(k,) for k in taken], "t string")
    assert rows(without_few_keys(df, "k", keys, blocks=2)) == rows(without_keys(df, "k", keys))


def test_without_few_keys_moves_only_rows_that_may_be_taken(spark):
    df = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    taken = df.filter("id % 1000 = 0").select("k")
    kept = without_few_keys(df, "k", taken, blocks=64)
    assert kept.count() == 19_980
    assert may_match(df, taken, ["k"], blocks=64).count() < 100
