"""Registered queries against DuckDB on the smallest tables, and what their plans must not do."""

import os
import re
from collections import Counter

import pytest

import __spark_entry__ as entry_points
from oracle import connect, difference
from tierkit.workload import ORACLES, QUERIES

FOLDER = os.environ.get("TIERKIT_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
TYPES |= {"date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(18,2)": "DECIMAL(18,2)"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    """Same columns, types and rows, without a cross join or Python rows in the plan."""
    df = QUERIES[name](spark, FOLDER)
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {c: TYPES[kind] for c, kind in df.dtypes} == {row[0]: row[1] for row in described}
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonUDF"):
        assert forbidden not in plan
    assert difference(df, duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["chk_recency"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    plan = QUERIES["order_totals"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_union_filters_inside_the_branches(spark):
    plan = QUERIES["union_superset"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThan(c_acctbal,1000.0)" in plan and "GreaterThan(s_acctbal,1000.0)" in plan


FOLDED_FIRST = [
    *("chk_unique", "chk_unique_combo", "chk_accepted_values", "chk_equal_rowcount", "chk_fewer_rows"),
    *("chk_equality", "chk_equality_multiset", "chk_cardinality", "chk_at_least_one", "chk_null_proportion"),
    *("dedup_latest", "dedup_lines", "unpivot_measures", "column_values", "histogram", "url_host"),
]


@pytest.mark.parametrize("name", FOLDED_FIRST)
def test_rows_fold_before_every_shuffle(spark, name):
    """A key with a third of all rows must not travel row by row."""
    lines = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [after for line, after in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert below and all("Aggregate(" in line or "WindowGroupLimit" in line for line in below)


def test_checks_scan_a_table_twice_at_most(spark):
    """Once for all tallies, once for all keys; the fact is never read per check."""
    plan = QUERIES["star_suite"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    scans = Counter(re.findall(r"SubqueryAlias \S+\.(\w+)|Relation \S+?\.(\w+?)\[", plan))
    scans = Counter(a or b for a, b in scans.elements())
    assert len(scans) >= 7 and max(scans.values()) <= 2, scans


def test_repeated_queries_add_no_databases(spark):
    QUERIES["promote_table"](spark, FOLDER).count()
    before = {d.name for d in spark.catalog.listDatabases()}
    QUERIES["promote_table"](spark, FOLDER).count()
    QUERIES["replace_table"](spark, FOLDER).count()
    assert {d.name for d in spark.catalog.listDatabases()} == before
