"""Every query against its SQL counterpart on the smallest data, and plan shapes."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
import check
from casework_checks.registry import ENTRIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return check.engine(SF)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they would be on inputs too large for a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_plan(df):
    """No cross join, no Python, and no group gathered in a window.

    Numbering a top-n is the one window allowed: it runs after the limit.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[-+] Window \[", line) or line.strip().startswith("Window ["):
            assert any("TakeOrderedAndProject" in later or "Limit" in later for later in lines[i : i + 6])


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_equals_sql(spark, engine, no_broadcast, name):
    agreed, text = check.compare(spark, engine, name, SF, check_plan)
    assert agreed, text


def test_entry(spark):
    out = driver.entry(spark)
    assert out.columns == ["acct_item_key", "case_prefix", "case_cntr", "team_assigned"]
    assert out.limit(1).count() == 1


def test_every_query_has_sql():
    assert all(entry.sql for entry in ENTRIES.values())
    assert set(ENTRIES) <= set(driver.queries()) & set(driver.oracle_sql())
