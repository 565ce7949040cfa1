"""Every query with SQL against DuckDB, over whole tables of the smallest size."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.partition('.')[0]} as select * from '{DATA}/{f}'")
    return c


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda x: None if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)
    return Counter(tuple(show(r[i]) for i in order) for r in rows)


CORE = [n for n, f in entry.queries().items() if not f.__module__.startswith("barloom.llm")]


@pytest.mark.parametrize("name", [n for n in CORE if n in entry.oracle_sql()])
def test_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert cells(df.columns, df.collect()) == cells(want.columns, want.fetchall())


@pytest.mark.parametrize("name", [n for n in CORE if n not in entry.oracle_sql()])
def test_runs(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {f"p{n}_found" for n in (1, 2, 4, 5, 6)} <= set(entry.queries())
