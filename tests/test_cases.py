"""Candidates, pools and cases on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import AS_OF, rows
from pyspark.sql import functions as F

from casework.operators.candidates import recently_assigned, select_candidates
from casework.operators.cases import (
    case_number,
    contract_totals,
    latest_run_cases,
    pool_cases,
    residual_lines,
    top_contract_cases,
    top_customer_vendor_cases,
)
from casework.operators.pools import latest_pool
from casework.settings import COOL_DOWN_DAYS, Settings
from casework.sources.schemas import EXCLUSIONS, STATUS, struct
from casework.sources.staging import Staging, release
from test_relational import _shuffled_rows

DAY = dt.timedelta(days=1)
HISTORY = "acct_item_key string, insrt_dt date, team_assigned string, pool_num long"


def status(spark, lines):
    data = []
    for line in lines:
        full = {"pndg_mmr_opp": Decimal(1), "sys_pltfrm": "E1", "ship_to": 1, "item_e1_num": 1, **line}
        data.append(tuple(Decimal(v) if STATUS[c].startswith("decimal") and v is not None else v
                          for c, v in ((c, full.get(c)) for c in STATUS)))
    return spark.createDataFrame(data, struct(STATUS))


def test_cool_down_days_per_team(spark):
    entries = [
        ("cct", 24, "CCT"), ("cct-old", 25, "CCT"), ("nm", 89, "NM"), ("nm-old", 90, "NM"),
        ("strat", 24, "STRAT"), ("strat-old", 30, "STRAT"), ("other", 1, "OTHER"), ("none", 1, None),
    ]
    history = spark.createDataFrame([(k, AS_OF - d * DAY, t, None) for k, d, t in entries], HISTORY)
    assert rows(recently_assigned(history, AS_OF, COOL_DOWN_DAYS)) == [("cct",), ("nm",), ("strat",)]


def test_select_candidates(spark):
    lines = status(
        spark,
        [
            {"acct_item_key": "keep", "bl_mfg_cont": None, "bl_date": AS_OF, "curr_date": AS_OF, "bl_cost": 2,
             "bl_trig_cost": 5, "curr_cost": 9, "curr_qty": 3, "bl_trig_mfg_cont": "T", "curr_mfg_cont": "C"},
            {"acct_item_key": "current", "bl_date": AS_OF, "curr_date": None, "bl_cost": 2, "bl_trig_cost": 5,
             "curr_cost": 9, "curr_qty": 1, "bl_trig_mfg_cont": "T", "curr_mfg_cont": "C"},
            {"acct_item_key": "no-opportunity", "pndg_mmr_opp": 0},
            {"acct_item_key": "negative-load", "bl_mfg_cont": "MCKB-NEG-LD"},
            {"acct_item_key": "excluded", "ship_to": 12, "item_e1_num": 3},
            {"acct_item_key": "cooling"},
        ],
    )
    history = spark.createDataFrame([("cooling", AS_OF - DAY, "NM", None)], HISTORY)
    exclusions = spark.createDataFrame([(12, 3), (-1, 1)], struct(EXCLUSIONS))
    out = {r.acct_item_key: r for r in select_candidates(lines, history, exclusions, AS_OF).collect()}
    assert set(out) == {"keep", "current"}
    assert (out["keep"].curr_mfg_cont, out["keep"].cost_impact) == ("T", 36)
    assert (out["current"].curr_mfg_cont, out["current"].cost_impact) == ("C", 28)
    assert out["keep"].trace_key == f"1E11-{AS_OF}"


def test_latest_pool_keeps_ties_and_checks_type_and_end(spark):
    lines = spark.createDataFrame([(10, "E1"), (10, "E1"), (20, "AS400"), (30, "E1")], "acct_or_bill_to long, sys_pltfrm string")
    customers = spark.createDataFrame(
        [(10, 1), (10, 1), (20, 2), (30, 3)], "bill_to_cust_e1_num long, dim_bill_to_cust_curr_id long"
    )
    old, new, end = AS_OF - 50 * DAY, AS_OF - 5 * DAY, AS_OF + DAY
    members = spark.createDataFrame(
        [(1, 100, old, end), (1, 101, new, end), (1, 102, new, end), (1, 103, new, AS_OF), (1, 104, end, end),
         (2, 101, new, end), (3, 104, new, end)],
        "dim_cust_curr_id long, dim_pool_id long, cust_pool_start_dt date, cust_pool_end_dt date",
    )
    pools = spark.createDataFrame(
        [(100, 1, "a", "3"), (101, 2, "b", "4"), (102, 3, "c", "7"), (103, 4, "d", "5"), (104, 5, "e", "8")],
        "dim_pool_id long, pool_num long, pool_name string, pool_type_num string",
    )
    assert rows(latest_pool(lines, customers, members, pools, AS_OF)) == [(10, "E1", 2, "b"), (10, "E1", 3, "c")]


LINES = "acct_item_key string, bl_mfg_cont string, bus_pltfrm string, cost_impact double"


def test_top_contract_cases_number_by_sum(spark):
    lines = spark.createDataFrame(
        [("1", "A", "PC", 5.0), ("2", "A", "PC", 6.0), ("3", "B", "PC", 11.0), ("4", "A", "EC", 20.0), ("5", "C", "PC", 1.0),
         ("6", None, "PC", 99.0)],
        LINES,
    )
    out = rows(top_contract_cases(lines, 4).select("acct_item_key", "case_cntr"))
    # The group without a contract takes number 1 and joins no line.
    assert out == [("1", 3), ("2", 3), ("3", 4), ("4", 2)]


def test_contract_totals_minimum_per_platform(spark):
    lines = spark.createDataFrame(
        [("1", "A", "PC", 30.0), ("2", "B", "PC", 20.0), ("3", "A", "EC", 20.0), ("4", "A", "XX", 99.0)], LINES
    )
    assert rows(contract_totals(lines, {"PC": 25, "EC": 10}).select("bl_mfg_cont", "bus_pltfrm")) == [("A", "EC"), ("A", "PC")]


RESIDUAL = "acct_item_key string, pool_num long, highest_cust_name string, vendor_name string, pndg_mmr_opp double"


def test_pool_cases_and_null_pools_in_the_history(spark):
    residual = spark.createDataFrame(
        [("1", 7, "c", "v", 1.0), ("2", 8, "c", "v", 1.0), ("3", None, "c", "v", 1.0)], RESIDUAL
    )
    recent = spark.createDataFrame([("x", AS_OF - DAY, "STRAT", 7)], HISTORY)
    assert [r[0] for r in rows(pool_cases(residual, recent, AS_OF))] == ["2"]
    with_null = recent.union(spark.createDataFrame([("y", AS_OF - DAY, "NM", None)], HISTORY))
    assert rows(pool_cases(residual, with_null, AS_OF)) == []
    assert [r[0] for r in rows(pool_cases(residual, with_null, AS_OF, ignore_null_keys=True))] == ["2"]
    old_null = recent.union(spark.createDataFrame([("y", AS_OF - 25 * DAY, "NM", None)], HISTORY))
    assert [r[0] for r in rows(pool_cases(residual, old_null, AS_OF))] == ["2"]


def test_top_customer_vendor_cases(spark):
    residual = spark.createDataFrame(
        [("1", None, "c", "v", 1.0), ("2", None, "c", "v", 0.0), ("3", None, "c", "w", 1.0), ("4", 9, "c", "w", 1.0),
         ("5", None, "d", "v", 1.0), ("6", None, "e", "v", 1.0)],
        RESIDUAL,
    )
    sales = spark.createDataFrame(
        [("1", 5.0), ("2", 5.0), ("3", 7.0), ("4", 99.0), ("5", 0.0), ("6", 1.0)], "acct_item_key string, neg_sls_3_mth double"
    )
    out = rows(top_customer_vendor_cases(residual, sales, 2).select("acct_item_key", "case_cntr", "team_assigned"))
    assert out == [("1", 1, "NM"), ("3", 2, "NM")]


def test_residual_and_case_number(spark):
    lines = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "acct_item_key string")
    taken = spark.createDataFrame([("1",), (None,)], "acct_item_key string")
    assert rows(residual_lines(lines, taken)) == [("2",), ("2",)]
    cases = spark.createDataFrame([("3", 41)], "case_prefix string, case_cntr long")
    row = case_number(cases, AS_OF).first()
    assert (row.mmr_case, row.insrt_dt) == ("210315341", AS_OF)


def test_latest_run_cases(spark):
    history = spark.createDataFrame(
        [(1, "c1", "CCT", 5, "p", AS_OF), (1, "c1", "CCT", 5, "p", AS_OF), (2, "c2", "STRAT", 5, "p", AS_OF),
         (3, "c3", "STRAT", None, None, AS_OF), (4, "c4", "NM", None, None, AS_OF - DAY)],
        "case_cntr long, mmr_case string, team_assigned string, pool_num long, pool_name string, insrt_dt date",
    )
    assert rows(latest_run_cases(history)) == [
        (1, "c1", "CCT", "CCT-c1"),
        (2, "c2", "STRAT", "5_p_GAP_REPORT_c2"),
        (3, "c3", "STRAT", "__GAP_REPORT_c3"),
    ]


def test_unknown_codes_are_counted(spark):
    from casework.sources.tables import unexpected_codes

    df = spark.createDataFrame([("E1", "CCI"), ("X", "CCI"), (None, "??")], "sys_pltfrm string, mmr_type string")
    assert unexpected_codes(df).first().asDict() == {"sys_pltfrm": 1, "mmr_type": 1}


def test_normalised_names(spark):
    from casework.sources.tables import normalised

    df = spark.createDataFrame([(1, 2, 3)], ["Ship To", "Item Number (E1)", "Some Other Name"])
    assert normalised(df).columns == ["ship_to", "item_e1_num", "some_other_name"]
    assert normalised(df).select(F.col("item_e1_num")).first()[0] == 2


def test_composite_exclusion_keys_do_not_collide(spark):
    """Ship-to 12 with item 345 and ship-to 123 with item 45 have the same joined text."""
    from casework.operators.candidates import excluded_keys
    from casework_checks.registry import Tables, _candidate_status

    tables = Tables(spark, "/root/testdata/sf0.001")
    line = _candidate_status(tables).filter("pndg_mmr_opp > 0 and ship_to > 9").limit(1).collect()[0]
    ship_to, item = str(line.ship_to), str(line.item_e1_num)
    other = spark.createDataFrame([(int(ship_to[:-1]), int(ship_to[-1] + item))], "ship_to long, item_e1_num long")
    assert excluded_keys(other).first()[0] == ship_to + item
    none = tables["history"].limit(0)
    plain = select_candidates(_candidate_status(tables), none, other, AS_OF)
    exact = select_candidates(_candidate_status(tables), none, other, AS_OF, Settings(composite_exclusion_keys=True))
    key = line.acct_item_key
    assert plain.filter(F.col("acct_item_key") == key).count() == 0
    assert exact.filter(F.col("acct_item_key") == key).count() > 0


def _listed(spark):
    """Lines, a history and an exclusion list with nulls in their keys; 1 line in 40 is on a list."""
    def key(n):
        return F.when(F.col("id") % 997 > 0, F.concat(F.lit("k"), n.cast("string")))

    lines = spark.range(8_000).select(
        *[
            {
                "acct_item_key": key(F.col("id")),
                "ship_to": F.when(F.col("id") % 53 > 0, F.col("id") % 400),
                "item_e1_num": F.when(F.col("id") % 59 > 0, F.col("id")),
                "pndg_mmr_opp": F.lit(1),
            }.get(c, F.lit(None)).cast(kind).alias(c)
            for c, kind in STATUS.items()
        ]
    )
    history = spark.range(0, 8_000, 80).select(
        F.concat(F.lit("k"), "id").alias("acct_item_key"), F.lit(AS_OF).alias("insrt_dt"),
        F.lit("CCT").alias("team_assigned"), F.lit(None).cast("long").alias("pool_num"),
    )
    exclusions = spark.range(7, 8_000, 80).select(
        F.when(F.col("id") % 400 == 7, -1).otherwise(F.col("id") % 400).cast("long").alias("ship_to"),
        F.col("id").alias("item_e1_num"),
    )
    return lines, history, exclusions


def test_staged_open_lines_give_the_same_candidates(spark):
    lines, history, exclusions = _listed(spark)
    undated = history.withColumn("acct_item_key", F.when(F.col("acct_item_key") != "k80", F.col("acct_item_key")))
    blank = exclusions.select(F.lit(None).cast("long").alias("ship_to"), F.lit(None).cast("long").alias("item_e1_num"))
    for past in (history, undated, history.limit(0)):
        for listed in (exclusions, exclusions.union(blank), exclusions.limit(0)):
            for composite in (False, True):
                args = past, listed, AS_OF, Settings(composite_exclusion_keys=composite)
                plain = select_candidates(lines, *args)
                assert rows(select_candidates(lines, *args, Staging(spark).stage)) == rows(plain)
    assert 7_000 < select_candidates(lines, history, exclusions, AS_OF).count() < 7_900
    release(spark)


def test_candidates_shuffle_only_lines_that_may_be_listed(spark):
    lines, history, exclusions = _listed(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = []
        for stage in (None, Staging(spark).stage):
            df = select_candidates(lines, history, exclusions, AS_OF, stage=stage)
            plan = df._jdf.queryExecution().executedPlan()
            df.collect()
            shuffled.append(_shuffled_rows(plan))
        assert shuffled[0] > 8_000 > 1_500 > shuffled[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        release(spark)
