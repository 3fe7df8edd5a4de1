"""Every query with SQL against DuckDB on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    found = entry.queries()[name](spark, str(DATA))
    want = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(found.columns)
    got = Counter(tuple(plain(r[c]) for c in sorted(names)) for r in found.collect())
    at = [names.index(c) for c in sorted(names)]
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
