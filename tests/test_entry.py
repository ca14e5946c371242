"""Every query with SQL against DuckDB on the smallest tables; the registry's contract."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = Counter(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    rel = duck.execute(ORACLES[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    want = Counter(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in rel.fetchall())
    assert got == want


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
