"""Every registered query against its SQL, on the smallest test tables."""

import math
import os

import pytest

import __spark_entry__ as entry_points
from spendloom.plans.registry import PLANS, QUERIES
from spendloom.plans.star_billing import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    df = entry_points.queries()[name](spark, FOLDER)
    got = table_of(df.columns, df.collect())
    ran = sql.execute(entry_points.oracle_sql()[name])
    want = table_of([column[0] for column in ran.description], ran.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(PLANS) - {"csv_ingest", "period_replacement"}))
def test_plans_scale(spark, name):
    """No cross products and no Python in any plan."""
    plan = PLANS[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan


def test_flagship(spark):
    assert entry_points.entry(spark).columns == ["service", "cost"]
