"""Column helpers on hand-made rows: null, empty, tie and no-match cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casework.functions import (
    days_between,
    joined_text,
    least_strict,
    month_day_year,
    number_of,
    ratio,
    text_after_last_hyphen,
    text_before_last_hyphen,
    valid_on,
    year_month_day,
)
from casework.operators.catalog import cheaper_branch, split_contract_id


def test_least_strict_is_null_when_either_side_is(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None), (None, None), (3, 3)], "a int, b int")
    assert [r[0] for r in df.select(least_strict(F.col("a"), F.col("b"))).collect()] == [1, 1, None, None, None, 3]


def test_joined_text_treats_null_as_empty_and_empty_as_null(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None), ("", None)], "a string, b long")
    assert [r[0] for r in df.select(joined_text(F.col("a"), F.col("b"))).collect()] == ["a1", "2", "b", None, None]
    assert [r[0] for r in df.select(joined_text(F.col("a"), "-")).collect()] == ["a-", "-", "b-", "-", "-"]


CONTRACT_IDS = [
    ("123-4", 123, 4),
    ("123", 0, 123),
    ("-4", 0, 4),
    ("123-", 123, 0),
    ("", 0, 0),
    (None, 0, 0),
    ("7- 5 ", 7, 5),
]


def test_split_contract_id(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CONTRACT_IDS], "c string")
    out = split_contract_id(df, "c", "n", "t").collect()
    assert [(r.c, r.n, r.t) for r in out] == CONTRACT_IDS


def test_last_hyphen_decides(spark):
    df = spark.createDataFrame([("12-3-4",)], "c string")
    row = df.select(text_before_last_hyphen(F.col("c")), text_after_last_hyphen(F.col("c"))).first()
    assert tuple(row) == ("12-3", "4")


def test_junk_numbers_raise_unless_lenient(spark):
    df = spark.createDataFrame([("x1",)], "c string")
    assert df.select(number_of(F.col("c"), lenient=True)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(number_of(F.col("c"))).collect()


def test_ratio_rounds_half_away_from_zero_and_survives_zero(spark):
    df = spark.sql(
        "select cast(a as decimal(18,4)) a, cast(b as decimal(18,4)) b from values (29, 200), (-29, 200), (1, 0) t(a, b)"
    )
    out = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert out == [Decimal("0.15"), Decimal("-0.15"), None]


def test_dates(spark):
    day = dt.date(2021, 3, 5)
    df = spark.createDataFrame(
        [(day, dt.datetime(2021, 3, 5, 12), dt.datetime(2021, 3, 4, 0))], "d date, later timestamp, earlier timestamp"
    )
    row = df.select(
        year_month_day(F.col("d")), month_day_year(F.col("d")), days_between(F.col("later"), F.col("earlier"))
    ).first()
    assert tuple(row) == ("210305", "03/05/2021", 1.5)


def test_valid_on_includes_the_first_day_and_excludes_the_last(spark):
    day = dt.date(2021, 3, 5)
    one = dt.timedelta(days=1)
    df = spark.createDataFrame(
        [(1, day, day + one), (2, day - one, day), (3, day + one, day + one), (4, None, day + one)],
        "i int, s date, e date",
    )
    assert [r.i for r in df.filter(valid_on(F.col("s"), F.col("e"), day)).collect()] == [1]


def test_cheaper_branch(spark):
    cases = [(1, 2, "P"), (2, 1, "C"), (2, 2, "C"), (None, 2, "C"), (2, None, "C")]
    df = spark.createDataFrame(
        [(p, c, "P", "C", "P", "C", "P", "C") for p, c, _ in cases],
        "pricing_cost_initial int, comp_cost_initial int, pricing_cost_list_id string, comp_cost_list_id string, "
        "pricing_cost_cont_name string, comp_cost_cont_name string, pricing_cost_cont_type string, "
        "comp_cost_cont_type string",
    )
    out = cheaper_branch(df).collect()
    assert [r.var_cst_cont for r in out] == [side for _, _, side in cases]
    assert [r.lpg_prca_cost for r in out] == [1, 1, 2, None, None]
