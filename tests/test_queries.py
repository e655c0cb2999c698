"""Every registered query against its SQL on the same files."""

from __future__ import annotations

import math
import os
from pathlib import Path

import pytest

from strata.workload import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("STRATA_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")

# Rows in Python, all pairs of rows, and numbering of all rows in one task.
NOT_WANTED = ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin", "RDDScan")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    return repr(round(value, 6) if isinstance(value, float) else value)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = bag(columns, cursor.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in NOT_WANTED), plan
    got = bag(df.columns, [tuple(row) for row in df.collect()])
    assert len(got) == len(expected)
    assert got[:5] == expected[:5]
    assert got == expected
    assert got, "a query without rows checks nothing"
