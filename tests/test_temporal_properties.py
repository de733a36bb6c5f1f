"""Property checks of the bitemporal merge over many random keys in one Spark run.

Each key is an independent random case: a non-overlapping current timeline in the
target and non-overlapping source periods.  After the merge (no deletes, no key
master) the current timeline must equal "source where the source covers the
instant, else the old target"; current periods must not overlap; closed history
is untouched; a second run with the same input and as_of changes nothing.
"""

import random

import pytest

from tidemark import Roles, temporal_merge

from conftest import as_of, day, undo
from test_temporal import OPEN_SYS, TGT

ROLES = Roles(key=("k",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"))
N_KEYS = 300
HORIZON = 30


def timeline(rng, n_max):
    cuts = sorted(rng.sample(range(HORIZON), rng.randint(0, n_max) * 2))
    return [(cuts[i], cuts[i + 1]) for i in range(0, len(cuts), 2)]


def cases(seed=7):
    rng = random.Random(seed)
    tgt, src, hist = [], [], []
    for n in range(N_KEYS):
        k = f"k{n}"
        for s, e in timeline(rng, 3):
            tgt.append((k, rng.choice("ab"), day(s), day(e), day(1), OPEN_SYS))
        for s, e in timeline(rng, 2):
            src.append((k, rng.choice("ab"), day(s), day(e)))
        if rng.random() < 0.3:
            hist.append((k, "old", day(0), day(5), day(0), day(1)))
    return tgt + hist, src, hist


def value_at(rows, t):
    for his, s, e in rows:
        if s <= t < e:
            return his
    return None


@pytest.mark.parametrize("slice_rows", [None, 1], ids=["window", "sliced"])
def test_timeline_properties(spark, slice_rows):
    tgt_rows, src_rows, hist = cases()
    tgt = spark.createDataFrame(tgt_rows, TGT)
    src = spark.createDataFrame(src_rows, "k string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz")
    out = temporal_merge(src, tgt, ROLES, as_of(), slice_rows=slice_rows)
    rows = out.collect()

    cur, closed = {}, []
    for r in rows:
        if r.icw_exp_ts > day(100):
            cur.setdefault(r.k, []).append((r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)))
        else:
            closed.append((r.k, r.his, r.bus_eff_ts, r.bus_exp_ts, r.icw_eff_ts, r.icw_exp_ts))
    src_by, tgt_by = {}, {}
    for k, h, s, e in src_rows:
        src_by.setdefault(k, []).append((h, undo(s), undo(e)))
    for k, h, s, e, _, x in tgt_rows:
        if x == OPEN_SYS:
            tgt_by.setdefault(k, []).append((h, undo(s), undo(e)))

    for n in range(N_KEYS):
        k = f"k{n}"
        got = sorted(cur.get(k, []), key=lambda x: x[1])
        for a, b in zip(got, got[1:]):
            assert a[2] <= b[1], (k, got)  # no overlapping current versions
        for t in range(HORIZON):
            want = value_at(src_by.get(k, []), t) or value_at(tgt_by.get(k, []), t)
            assert value_at(got, t) == want, (k, t, got, src_by.get(k), tgt_by.get(k))

    for h in hist:  # closed history is never altered
        assert h in closed

    again = temporal_merge(src, out, ROLES, as_of(), keep_action=True)
    assert {r["__action"] for r in again.select("__action").distinct().collect()} <= {"history", "current"}
