"""Cheapest contract, connected share and reference account flag."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from casework.operators.catalog import cheapest_contract, connected_share, standard_account_connected
from casework.sources.schemas import IPC, struct

SCHEMA = struct(IPC)


def ipc(spark, lines):
    """Catalog lines from partial dicts; a variable-cost line unless said otherwise."""
    data = []
    for line in lines:
        full = {"var_cost": "Y", "price_source": "P", "item_e1_num": 1, **line}
        for c in ("comp_cost_initial", "pricing_cost_initial"):
            if full.get(c) is not None:
                full[c] = Decimal(full[c])
        data.append(tuple(full.get(c) for c in IPC))
    return spark.createDataFrame(data, SCHEMA)


def line(comp, pricing, comp_list, pricing_list="P-1", **more):
    return {
        "comp_cost_initial": comp,
        "pricing_cost_initial": pricing,
        "comp_cost_list_id": comp_list,
        "pricing_cost_list_id": pricing_list,
        **more,
    }


def test_cheapest_contract_skips_placeholders_and_null_costs(spark):
    df = ipc(
        spark,
        [
            line(1, 2, "0"),
            line(1, 2, "*"),
            line(1, 2, "/*"),
            line(1, 2, None),
            line(2, None, "null-cost"),
            line(5, 6, "B-2"),
            line(5, 6, "A-2", comp_cost_cont_type="Z"),
            line(5, 6, "A-2", comp_cost_cont_type="Y", comp_cost_cont_name=None),
            line(5, 6, "A-2", comp_cost_cont_type="Y", comp_cost_cont_name="n"),
            line(1, 1, "cheap", var_cost="N"),
        ],
    )
    out = cheapest_contract(df).collect()
    assert len(out) == 1
    row = out[0]
    assert (row.mn_lpg_prca_cost, row.var_cst_cont, row.var_cst_cont_type, row.var_cst_cont_name) == (5, "A-2", "Y", "n")


def test_cheapest_contract_is_limited_to_the_groups(spark):
    df = ipc(spark, [line(1, 2, "A-1"), line(1, 2, "A-1", item_e1_num=2)])
    groups = spark.createDataFrame([("P", 2), ("P", 2)], "price_source string, item_e1_num long")
    assert [r.item_e1_num for r in cheapest_contract(df, groups).collect()] == [2]


def share_by_join(ipc_df, chosen):
    """The share as a many-to-many join of the two count tables."""
    detail = (
        ipc_df.filter("var_cost = 'Y'")
        .join(chosen.filter("var_cst_cont is not null"), ["price_source", "item_e1_num"])
        .select(
            "price_source", "item_e1_num", "var_cst_cont", "ship_to",
            F.when(F.col("comp_cost_list_id") == F.col("var_cst_cont"), "N").otherwise("Y").alias("gap"),
        )
        .distinct()
    )
    keys = ["price_source", "item_e1_num", "var_cst_cont"]
    on = detail.filter("gap = 'N'").groupBy(*keys).agg(F.count("ship_to").alias("n")).drop("item_e1_num")
    off = detail.filter("gap = 'Y'").groupBy(*keys).agg(F.count("ship_to").alias("m")).drop("item_e1_num")
    return (
        on.join(off, ["price_source", "var_cst_cont"])
        .groupBy("price_source", "var_cst_cont")
        .agg((F.sum("n") / (F.sum("m") + F.sum("n"))).alias("share"))
        .collect()
    )


def test_connected_share_equals_the_join_form(spark):
    rng = random.Random(3)
    lines = [
        line(
            1, 2, rng.choice(["A-1", "B-1", "C-1", None]), price_source=rng.choice(["P", "Q"]),
            item_e1_num=rng.randrange(4), ship_to=rng.choice([None, *range(12)]),
            var_cost=rng.choice(["Y", "Y", "N"]),
        )
        for _ in range(600)
    ]
    df = ipc(spark, lines)
    chosen = spark.createDataFrame(
        [(p, i, c) for p in "PQ" for i, c in enumerate(["A-1", "A-1", "B-1", None])],
        "price_source string, item_e1_num long, var_cst_cont string",
    )
    expected = {(r.price_source, r.var_cst_cont): r.share for r in share_by_join(df, chosen)}
    actual = {(r.price_source, r.var_cst_cont): float(r.prcnt_cnctd) for r in connected_share(df, chosen).collect()}
    assert set(actual) == set(expected) and len(actual) == 4
    assert all(abs(actual[k] - expected[k]) <= 0.005 + 1e-9 for k in actual)


def test_connected_share_edge_groups(spark):
    chosen = spark.createDataFrame(
        [("on", 1, "A"), ("off", 1, "A"), ("both", 1, "A"), ("same", 1, "A"), ("nulls", 1, "A")],
        "price_source string, item_e1_num long, var_cst_cont string",
    )
    df = ipc(
        spark,
        [
            line(1, 2, "A", price_source="on", ship_to=1),
            line(1, 2, "B", price_source="off", ship_to=1),
            line(1, 2, "A", price_source="both", ship_to=1),
            line(1, 2, "B", price_source="both", ship_to=2),
            line(1, 2, "B", price_source="both", ship_to=3),
            line(1, 2, "A", price_source="same", ship_to=1),
            line(1, 2, "B", price_source="same", ship_to=1),
            line(1, 2, "A", price_source="nulls", ship_to=None),
            line(1, 2, None, price_source="nulls", ship_to=None),
        ],
    )
    out = {r.price_source: r.prcnt_cnctd for r in connected_share(df, chosen).collect()}
    assert out == {"both": Decimal("0.3300"), "same": Decimal("0.5000"), "nulls": None}


def test_standard_account_can_be_both(spark):
    df = ipc(
        spark,
        [
            line(1, 2, "A", ship_to=5, price_source_pcca=5),
            line(1, 2, "B", ship_to=5, price_source_pcca=5),
            line(1, 2, "A", ship_to=6, price_source_pcca=5),
            line(1, 2, "A", ship_to=5, price_source_pcca=5, var_cost="N"),
        ],
    ).withColumn("var_cst_cont", F.lit("A"))
    assert rows(standard_account_connected(df)) == [("P", 1, "A", "N"), ("P", 1, "A", "Y")]


def test_strict_contract_id_raises(spark):
    from casework.operators.catalog import split_contract_id

    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        split_contract_id(spark.createDataFrame([("x-1",)], "id string"), "id").collect()
    lenient = split_contract_id(spark.createDataFrame([("x-1",), (None,)], "id string"), "id", lenient=True)
    assert {(r.var_mck_cont_id, r.var_mck_cont_tier) for r in lenient.collect()} == {(0, 1), (0, 0)}


def test_lines_without_contract_take_the_placeholder_tiers(spark):
    """Nine of ten lines have no contract: their tier ids come from one lookup, not from a join on one key."""
    from casework.operators.price_lines import price_case_lines

    day = "cast('2021-03-15' as date)"
    lines = [
        {"sys_pltfrm": "E1", "ship_to": i, "bus_pltfrm": "PC", "item_e1_num": 1, "price_source": "A" if i % 10 else "B",
         "comp_cost_list_id": "5-1" if i % 10 == 0 else "*", "pricing_cost_list_id": "5-1" if i % 10 == 0 else "*",
         "comp_cost_initial": Decimal(i + 1), "pricing_cost_initial": Decimal(i + 1), "acct_or_bill_to": i}
        for i in range(50)
    ]
    catalog = ipc(spark, lines)
    cases = catalog.selectExpr(
        "concat(sys_pltfrm, ship_to, bus_pltfrm, item_e1_num) acct_item_key", "price_source", "item_e1_num",
        "1L case_cntr", "'CCT' team_assigned", "cast(null as bigint) pool_num", "'x' mmr_case", f"{day} insrt_dt",
    )
    tiers = spark.createDataFrame(
        [(0, 0, 7), (0, 0, 8), (5, 1, 51)], "cntrct_num long, tier_num long, dim_cntrct_tier_id long"
    )
    accounts = spark.createDataFrame(
        [("E1", i, "PC", 100 + i) for i in range(50)],
        "sys_pltfrm string, cust_e1_num long, bus_pltfrm string, dim_cust_curr_id long",
    )
    out = price_case_lines(catalog, cases, tiers, accounts)
    found = sorted((r.ship_to, r.var_mck_cont_id, r.vrcst_cntrct_tier_id) for r in out.collect())
    want = sorted((i, 5, 51) for i in range(0, 50, 10))
    want += sorted((i, 0, t) for i in range(50) if i % 10 for t in (7, 8))
    assert found == sorted(want)
