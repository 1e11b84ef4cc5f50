"""Every registered plan against its SQL on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from pulsekit.plans.registry import PLANS, SQL
from tools.check_oracle import TABLES, other_type, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plan(spark, sql, name):
    df = PLANS[name](spark, SF_DIR)
    cursor = sql.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: other_type(t) for c, t in df.dtypes} == types
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_every_plan_has_sql():
    assert set(PLANS) == set(SQL)
    assert set(PLANS) <= set(entry.queries())
