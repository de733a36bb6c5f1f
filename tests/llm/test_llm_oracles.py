"""Queries that SQL can express against their DuckDB oracles on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.llm.decontam import find_leaks
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    r = con.execute(ORACLES[name])
    columns = [d[0] for d in r.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, r.fetchall()))


def test_decontamination_of_altered_copies_matches_oracle(spark):
    """Altered, re-parameterised and re-cased copies, items that are nearly all names, and short items, on both sides."""
    import pandas as pd

    words = "worker carries heavy boxes from old house near river with great care".split()
    item = " and ".join(f"number {k} " + " ".join(w + c for w in words) for k, c in zip((3, 5, 8, 13, 5), "abcde"))
    names = "Who met Anna Berg and Carl Dorn near Ulm or Bonn before Emil Frank saw Gerda Haas and Ida Jung?"
    texts = [item, item.replace("number 13", "number 3"), item.replace("5", "17"), item.upper(), names, names.lower(), f"so: {names.upper()} yes", "A line\nWho won?\nanother", "who won the race", "Who won?",
             "nothing of this kind is here", None, "", item]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    bench = pd.DataFrame({"item_id": [10, 11, 12, 13, 14], "text": [item, names, "Who won?", None, "?!"]})
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("benchmark", bench)
    want = con.execute(ORACLES["op5_decontaminate"]).fetchall()
    sides = [spark.createDataFrame([tuple(r) for r in df.itertuples(index=False)], schema) for df, schema in ((docs, "doc_id long, text string"), (bench, "item_id long, text string"))]
    got = find_leaks(*sides).select("doc_id", "item_id", "n_windows", "item_windows", "n_slots", "reparameterised").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r[0] for r in got} == {0, 1, 2, 3, 4, 5, 6, 7, 9, 13} and {r[0] for r in got if r[5]} == {2}
