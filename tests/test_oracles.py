"""Every registered query against its DuckDB oracle on the smallest tables (sf0.001)."""

import hashlib
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.queries import QUERIES

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip(f"no test data at {SF}")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "icw_exp_ts" in df.columns
