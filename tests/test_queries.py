"""Every query with SQL against DuckDB on the smallest tables; all others run."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from chatloom.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows(names, values):
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted([tuple(fix(x[n]) for n in sorted(names)) for x in values], key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [r.asDict() for r in df.collect()]) == rows(want.columns, [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, DATA).limit(5).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
