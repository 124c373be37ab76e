"""Every query against its SQL counterpart on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import entry, oracle_sql, queries as all_queries  # noqa: E402
from compare import rows_of  # noqa: E402
from tidemark.registry.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(all_queries())


def test_entry(spark):
    assert entry(spark).columns == [
        "year_month", "category", "monthly_spend", "running_total", "month_over_month_pct_change"
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = all_queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(slow in plan for slow in ("Python", "Cartesian", "NestedLoop"))
    result = db.execute(oracle_sql()[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == theirs
