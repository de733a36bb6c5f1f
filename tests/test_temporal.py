"""Bitemporal hand cases of FIXTURES.md section 2 (decisions D4, D5, D17-D19, D23)."""

from datetime import datetime

import pytest

from tidemark import OverlapError, Roles, normalise_periods, temporal_merge, temporal_merge_set
from tidemark.operators.periods import coalesce_periods

from conftest import INF, as_of, day, undo

OPEN_SYS = datetime(9999, 12, 31, 23, 59, 59, 999000)
TGT = "k string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz, " \
      "icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz"
ROLES = Roles(key=("k",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"))


def tgt_frame(spark, rows):
    """rows: (k, his, s, e) or (k, his, s, e, sys_end)."""
    out = []
    for r in rows:
        sys_end = r[4] if len(r) > 4 else OPEN_SYS
        out.append((r[0], r[1], day(r[2]), day(r[3]), day(1), sys_end))
    return spark.createDataFrame(out, TGT)


def src_frame(spark, rows, opr=False):
    schema = "k string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz"
    if opr:
        schema += ", opr string"
    return spark.createDataFrame(
        [(r[0], r[1], day(r[2]), day(r[3]), *(r[4:] if opr else ())) for r in rows], schema
    )


def split(ms):
    closed = sorted((r.k, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in ms if r.icw_exp_ts == day(100))
    inserted = sorted((r.k, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in ms if r.icw_eff_ts == day(100))
    refreshed = sorted((r.k, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts))
                       for r in ms if r.icw_exp_ts == OPEN_SYS and r.icw_eff_ts != day(100))
    return closed, inserted, refreshed


def run(spark, tgt_rows, src_rows, opr=False, roles=ROLES):
    if opr:
        roles = Roles(key=roles.key, his=roles.his, bus=roles.bus, opr="opr")
    ms = temporal_merge_set(src_frame(spark, src_rows, opr), tgt_frame(spark, tgt_rows), roles, as_of()).collect()
    return split(ms)


@pytest.mark.parametrize("above", [None, 1])
def test_overlaps_are_refused_in_every_layout(spark, above):
    apart, src = [("k", "z", 1, 9), ("k", "y", 10, 12)], [("k", "a", 30, 40)]
    for tgt_rows, src_rows in (([("k", "z", 1, 50), ("k", "y", 10, 12)], src), (apart, [("k", "a", 5, 20), ("k", "b", 10, 30)])):
        with pytest.raises(OverlapError):
            temporal_merge(src_frame(spark, src_rows), tgt_frame(spark, tgt_rows), ROLES, as_of(), slice_rows=above)
    assert temporal_merge(src_frame(spark, src + src), tgt_frame(spark, apart), ROLES, as_of(), slice_rows=above).count() == 3


def test_new_key(spark):
    assert run(spark, [("x", "q", 1, 2)], [("k", "a", 1, 5)]) == ([], [("k", "a", 1, 5)], [])


def test_inside(spark):
    c, i, _ = run(spark, [("k", "z", 1, 10)], [("k", "a", 3, 5)])
    assert c == [("k", "z", 1, 10)]
    assert i == [("k", "a", 3, 5), ("k", "z", 1, 3), ("k", "z", 5, 10)]


def test_identical(spark):
    assert run(spark, [("k", "z", 1, 10)], [("k", "z", 1, 10)]) == ([], [], [])


def test_refresh(spark):
    r = run(spark, [("k", "z", 1, 10, datetime(9998, 1, 1))], [("k", "z", 1, 10)])
    assert r == ([], [], [("k", "z", 1, 10)])


def test_same_value_inside(spark):
    assert run(spark, [("k", "z", 1, 10)], [("k", "z", 3, 5)]) == ([], [], [])


def test_adjacent_not_fused(spark):
    assert run(spark, [("k", "a", 5, 9)], [("k", "a", 1, 5)]) == ([], [("k", "a", 1, 5)], [])


def test_island_not_closed(spark):
    assert run(spark, [("k", "z", 5, 6)], [("k", "a", 1, 2), ("k", "a", 8, 9)]) == (
        [], [("k", "a", 1, 2), ("k", "a", 8, 9)], [])


def test_delete(spark):
    assert run(spark, [("k", "z", 1, 10)], [("k", "d", 4, 5, "E")], opr=True) == ([("k", "z", 1, 10)], [], [])


def test_delete_and_replace(spark):
    c, i, _ = run(spark, [("k", "z", 1, 10)], [("k", "d", 1, 2, "E"), ("k", "a", 3, 5, None)], opr=True)
    assert c == [("k", "z", 1, 10)] and i == [("k", "a", 3, 5)]


def test_delete_between(spark):
    c, i, _ = run(spark, [("k", "z", 1, 2), ("k", "z", 2, 3), ("k", "z", 3, 4)],
                  [("k", "d", 2, 3, "E"), ("k", "z", 1, 2, None), ("k", "z", 3, 4, None)], opr=True)
    assert c == [("k", "z", 2, 3)] and i == []


def test_null_first_key(spark):
    assert run(spark, [(None, "a", 1, 10)], [(None, "a", 1, 10)]) == ([], [], [])


KEM = Roles(key=("d",), kem=("m",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"))
KTGT = "m string, d string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz, " \
       "icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz"


def kem_run(spark, tgt_rows, src_rows):
    tgt = spark.createDataFrame([(m, d, h, day(s), day(e), day(1), OPEN_SYS) for m, d, h, s, e in tgt_rows], KTGT)
    src = spark.createDataFrame([(m, d, h, day(s), day(e)) for m, d, h, s, e in src_rows],
                                "m string, d string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz")
    ms = temporal_merge_set(src, tgt, KEM, as_of()).collect()
    closed = sorted((r.d, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in ms if r.icw_exp_ts == day(100))
    ins = sorted((r.d, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in ms if r.icw_eff_ts == day(100))
    return closed, ins


def test_key_master_missing_detail(spark):
    c, i = kem_run(spark, [("m", "d1", "z", 1, 10)], [("m", "d2", "q", 3, 5)])
    assert c == [("d1", "z", 1, 10)]
    assert i == [("d1", "z", 1, 3), ("d2", "q", 3, 5)]


def test_key_master_ordinary_input_drops_tail(spark):
    c, i = kem_run(spark, [("m", "d1", "z", 1, 10)], [("m", "d1", "a", 3, 5)])
    assert c == [("d1", "z", 1, 10)]
    assert i == [("d1", "a", 3, 5), ("d1", "z", 1, 3)]


def test_key_master_two_driver_periods(spark):
    c, i = kem_run(spark, [("m", "d1", "z", 1, 10)], [("m", "d2", "q", 2, 3), ("m", "d3", "q", 5, 6)])
    assert c == [("d1", "z", 1, 10)]
    assert [x for x in i if x[0] == "d1"] == [("d1", "z", 1, 2), ("d1", "z", 3, 5)]


def test_normalise(spark):
    df = spark.createDataFrame(
        [("a", day(1), day(10)), ("a", day(2), day(3)), ("a", day(5), day(6)),
         ("b", day(1), day(2)), ("b", day(2), day(3)), ("c", day(1), day(2)), ("c", day(3), day(4))],
        "k string, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.k, undo(r.s), undo(r.e)) for r in normalise_periods(df, ["k"], "s", "e").collect())
    assert got == [("a", 1, 10), ("b", 1, 3), ("c", 1, 2), ("c", 3, 4)]


def test_normalise_keeps_flags_apart(spark):
    df = spark.createDataFrame([("a", 1, day(1), day(2)), ("a", 0, day(2), day(3)), ("a", 1, day(3), day(4))],
                               "k string, f int, s timestamp_ntz, e timestamp_ntz")
    got = coalesce_periods(df, ["k", "f"], [], "s", "e").collect()
    assert len(got) == 3


def test_apply_is_idempotent(spark):
    tgt = tgt_frame(spark, [("k", "z", 1, 10), ("j", "y", 1, INF)])
    src = src_frame(spark, [("k", "a", 3, 5), ("j", "y", 1, INF)])
    out = temporal_merge(src, tgt, ROLES, as_of())
    again = temporal_merge(src, out, ROLES, as_of(), keep_action=True)
    acts = {r["__action"] for r in again.collect()}
    assert acts <= {"history", "current"}


def test_normalise_null_equals_default(spark):
    df = spark.createDataFrame([("k", None, day(1), day(2)), ("k", "", day(2), day(3))],
                               "k string, h string, s timestamp_ntz, e timestamp_ntz")
    got = [(r.k, r.h, undo(r.s), undo(r.e)) for r in normalise_periods(df, ["k", "h"], "s", "e").collect()]
    assert got == [("k", "", 1, 3)]


def test_check_overlaps_both_paths(spark):
    from tidemark import check_overlaps
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 4), ("a", 5, 6), ("a", 4, 9), ("b", 1, 2)],
                               "k string, s int, e int")
    plain = sorted((r.k, r.s, r.overlap_end) for r in check_overlaps(df, ["k"], "s", "e", slice_rows=None).collect())
    sliced = sorted((r.k, r.s, r.overlap_end) for r in check_overlaps(df, ["k"], "s", "e", slice_rows=1).collect())
    assert plain == sliced == [("a", 3, 5), ("a", 4, 5), ("a", 5, 9)]


def test_two_table_layout(spark):
    from tidemark.operators.apply import write_split
    from tidemark.session import scratch_path
    base = scratch_path(spark, "test-split")
    cur = tgt_frame(spark, [("k", "z", 1, 10), ("j", "y", 1, 20)])
    src = src_frame(spark, [("k", "a", 3, 5)])
    applied = temporal_merge(src, cur, ROLES, as_of(), keep_action=True)
    new_cur, metrics = write_split(applied, ("icw_eff_ts", "icw_exp_ts"), as_of(), f"{base}/history", f"{base}/run1")
    assert metrics == {"rows_inserted": 3, "rows_updated": 1}
    current = sorted((r.k, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in spark.read.parquet(new_cur).collect())
    assert current == [("j", "y", 1, 20), ("k", "a", 3, 5), ("k", "z", 1, 3), ("k", "z", 5, 10)]
    hist = [(r.k, r.his, undo(r.bus_eff_ts), undo(r.bus_exp_ts)) for r in spark.read.parquet(f"{base}/history").collect()]
    assert hist == [("k", "z", 1, 10)]
    # the next run reads only the current table; nothing changes for the same input
    again = temporal_merge(src, spark.read.parquet(new_cur), ROLES, as_of(), keep_action=True)
    assert {r["__action"] for r in again.select("__action").distinct().collect()} == {"current"}


def test_split_overlapping(spark):
    from tidemark import split_overlapping
    df = spark.createDataFrame([("a", "x", 1, 5), ("a", "x", 1, 5), ("a", "y", 3, 8), ("a", "z", 8, 9), ("b", "x", 1, 2)],
                               "k string, his string, s int, e int")
    for slice_rows in (None, 1):
        clean, rejected = split_overlapping(df, ["k"], "s", "e", slice_rows=slice_rows)
        assert sorted(tuple(r) for r in clean.collect()) == [("a", "x", 1, 5), ("a", "z", 8, 9), ("b", "x", 1, 2)]
        assert [tuple(r) for r in rejected.collect()] == [("a", "y", 3, 8)]
