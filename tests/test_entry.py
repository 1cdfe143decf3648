"""Driver contract and oracle parity on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SMALL

TABLES = ["events", "documents", "embeddings", "pages", "benchmark"]
# keys without an oracle: none
ROWS_ONLY: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 9


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if isinstance(v, list | tuple):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("key", sorted(set(E.QUERIES) - ROWS_ONLY))
def test_oracle_parity_small(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in res.description]
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
