"""Hard negatives against brute force: copies, ties, short and empty vectors, rows that take no part."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.hard_negatives import Query, encode, mine_hard_negatives, rotate, signs

SCHEMA = "vec_id long, label string, embedding array<double>, anchor int, band int, q string"


def brute(rows, every=5, n_pos=5, n_neg=10):
    clean = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v, *_ in rows
             if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = []
    for a in (r for r in clean if r[0] % every == 0):
        other = [(-score(a, b), b[0], b[1] == a[1]) for b in clean if b[0] != a[0]]
        for s, p, _ in sorted(x for x in other if x[2])[:n_pos]:
            fits = sorted(x for x in other if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s)[:n_neg]
            out += [(a[0], p, k, i, -s, -t) for k, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(240):
        c = rng.choice(middle)
        v = [x + rng.gauss(0, rng.choice([0, 0.2, 1.5])) for x in c][:rng.choice([20, 20, 20, 7, 0])]
        rows.append((i, rng.choice("abc"), v, 1, 2, "x"))
    rows += [rows[k] for k in (5, 10, 10)] + [(5, "b", rows[7][2], 1, 2, "x"), (None, "a", middle[0], 1, 2, "x"), (400, None, middle[0], 1, 2, "x"),
             (405, "a", None, 1, 2, "x"), (410, "a", [1.0, None], 1, 2, "x"), (415, "a", [float("nan")] * 20, 1, 2, "x"), (420, "a", [float("-inf")], 1, 2, "x"), (425, "z", middle[1], 1, 2, "x")]
    rows += [(500 + i, "b", middle[0], 1, 2, "x") for i in range(30)] + [(600 + i, "a", middle[0], 1, 2, "x") for i in range(30)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mine_hard_negatives(df, F.col("vec_id") % 5 == 0, block=25 if seed else 2048, levels=1 + seed, planes=8 - 3 * seed)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mine_hard_negatives(none, F.col("vec_id") % 5 == 0).collect() == []
    alone = spark.createDataFrame([(0, "a", [1.0], 1, 1, ""), (1, "b", [1.0], 1, 1, ""), (2, "a", [1e30], 1, 1, "")], SCHEMA)
    assert mine_hard_negatives(alone, F.col("vec_id") % 5 == 0).collect() == []


def test_intervals_hold():
    """Every level's interval holds the inner product, and narrows."""
    rng = np.random.default_rng(1)
    x, q, s = rng.integers(-90, 90, (500, 48)), rng.integers(-90, 90, (20, 48)), signs(64, 3)
    assert np.allclose(rotate(x.astype(float), s) @ rotate(q.astype(float), s).T, x @ q.T)
    part = type("P", (), dict(zip(("codes", "align", "rest"), encode(x, s, 4))))
    for a, r in zip(q, rotate(q.astype(float), s)):
        true, widths = x @ a, []

        def keep(lo, hi):
            assert (lo <= true).all() and (true <= hi).all()
            widths.append((hi - lo).mean())
            return np.ones(len(lo), dtype=bool)

        assert len(Query(a, r, 8).narrow(part, np.arange(500), keep)) == 500
        assert widths == sorted(widths, reverse=True) and widths[-1] < widths[0] / 3
