"""Every registered query against its SQL, and what its plan must not hold."""

import duckdb
import pytest

from __spark_entry__ import entry
from compare import canonical
from oracle import ORACLE
from tallyframe.plans.commerce import NAMES, QUERIES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(name, spark, base):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    found = [tuple(row) for row in result.collect()]
    if name not in ORACLE:
        assert name == "storage_report" and len(found) == len(NAMES)
        return
    cursor = base.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert canonical(found, result.columns) == canonical(cursor.fetchall(), names)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def _plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_period_filter_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "period_revenue")
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in plan
    assert "FileScan parquet [l_orderkey" in plan and "l_comment" not in plan and "l_tax" not in plan


def test_top_k_keeps_k_rows_per_task(spark):
    for name in ("top_count", "top_labelled", "last_location_revenue"):
        assert "TakeOrderedAndProject" in _plan(spark, name)


def test_unknown_period_reads_nothing(spark):
    plan = QUERIES["period_revenue_unknown"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan


def test_large_plans_have_no_forbidden_operator(spark, no_broadcast):
    for name in ("no_sales", "anti_or", "nested_semi", "row_policy"):
        assert not [word for word in FORBIDDEN if word in _plan(spark, name)], name
