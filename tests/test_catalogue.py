"""Every registered query against its oracle SQL on the smallest tables."""

import collections
import math

import duckdb
import pytest

import __spark_entry__ as entry
from optiontide.plans.derived import TABLES

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else 0.0 if value == 0 else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, db, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    mine, theirs = _rows(df.columns, rows), _rows(columns, cursor.fetchall())
    assert mine == theirs, (list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])


def test_entry(spark):
    df = entry.entry(spark)
    assert {"putCall", "expiry_month", "contracts", "solved", "avg_iv"} == set(df.columns)
    assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
