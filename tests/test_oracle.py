"""Every SQL-backed registered query equals its DuckDB oracle at sf0.01."""
import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF01)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, res.fetchall())


def test_every_oracle_key_is_registered():
    assert set(oracle_sql()) <= set(queries())
