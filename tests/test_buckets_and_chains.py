"""Partial rewrite of a bucketed table, audit rows by run, and the largest set of periods without overlap."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import Roles, audit_run, create_buckets, merge_buckets, read_buckets, resolve_overlapping, temporal_merge, write_merged
from tidemark.session import scratch_path

from conftest import as_of, day
from test_temporal import ROLES, src_frame, tgt_frame

END = "icw_exp_ts"


def files(spark, path, state="current"):
    t = spark.read.parquet(path).where(F.col("state") == state)
    return {(r.bucket, r.f) for r in t.select("bucket", F.col("_metadata.file_name").alias("f")).distinct().collect()}


def test_only_touched_buckets_are_rewritten(spark):
    rows = [(f"k{i}", "z", 1, 10) for i in range(60)]
    tgt, path, log = tgt_frame(spark, rows), scratch_path(spark, "b"), scratch_path(spark, "log")
    src = src_frame(spark, [("k3", "a", 3, 5), ("new", "b", 1, 2)])
    create_buckets(tgt, path, ["k"], buckets=16)
    before = files(spark, path)
    got = merge_buckets(spark, path, src, ROLES, as_of(), "r1", buckets=16, audit_path=log)
    assert got == {"rows_inserted": 4, "rows_updated": 1, "buckets": 2}
    after = files(spark, path)
    touched = {b for b, _ in after - before}
    assert len(touched) == 2 and {x for x in before if x[0] not in touched} == {x for x in after if x[0] not in touched} and not {x for x in before if x[0] in touched} & after
    want = sorted(map(str, temporal_merge(src, tgt, ROLES, as_of()).collect()))
    assert sorted(map(str, read_buckets(spark, path, END).collect())) == want
    assert read_buckets(spark, path, END, "closed-r1").count() == 1
    again = merge_buckets(spark, path, src, ROLES, as_of(), "r1", buckets=16, audit_path=log)
    assert again["rows_inserted"] == again["rows_updated"] == 0 and sorted(map(str, read_buckets(spark, path, END).collect())) == want
    assert spark.read.parquet(log).count() == 1


def test_emptied_bucket_and_no_rows(spark):
    path = scratch_path(spark, "b")
    create_buckets(tgt_frame(spark, [("k", "z", 1, 10)]), path, ["k"], buckets=4)
    gone = src_frame(spark, [("k", "d", 2, 3, "E")], opr=True)
    roles = Roles(key=("k",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"), opr="opr")
    assert merge_buckets(spark, path, gone, roles, as_of(), "r1", buckets=4)["rows_updated"] == 1
    assert read_buckets(spark, path, END, "current").count() == 0 and read_buckets(spark, path, END).count() == 1
    assert merge_buckets(spark, path, gone.limit(0), roles, as_of(), "r2", buckets=4)["buckets"] == 0


def test_type_2_buckets(spark):
    path, open_ = scratch_path(spark, "b"), datetime(9999, 12, 31, 23, 59, 59, 999000)
    tgt = spark.createDataFrame([(f"k{i}", "x", day(1), open_) for i in range(20)], "k string, v string, icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz")
    create_buckets(tgt, path, ["k"], buckets=8, files=2)
    got = merge_buckets(spark, path, spark.createDataFrame([("k1", "y"), ("n", "z")], "k string, v string"), Roles(key=("k",)), as_of(), "r1", kind="scd2", buckets=8, files=2)
    assert (got["rows_inserted"], got["rows_updated"]) == (2, 1)
    cur = read_buckets(spark, path, END, "current")
    assert cur.count() == 21 and cur.where("k = 'k1'").first().v == "y"


def test_write_counts_and_audit(spark):
    path, log = scratch_path(spark, "w"), scratch_path(spark, "log")
    m = write_merged(temporal_merge(src_frame(spark, [("k", "a", 3, 5)]), tgt_frame(spark, [("k", "z", 1, 10)]), ROLES, as_of(), keep_action=True), path)
    assert m == {"rows_inserted": 3, "rows_updated": 1} and spark.read.parquet(path).count() == 4
    for run in ("a", "b", "a"):
        rows = audit_run(spark, log, run, "temporal_merge", [("Versions written", str(m)), ("done", None)])
    assert rows.count() == 4


def greedy(rows):
    kept, ends = set(), {}
    for r in sorted(set(rows), key=lambda r: (r[2], r[1], r[3])):
        if r[1] < r[2] and ends.get(r[0], -1) <= r[1]:
            kept.add(r)
            ends[r[0]] = r[2]
    return kept


@pytest.mark.parametrize("slice_rows", [None, 20])
def test_resolve_overlapping_equals_greedy(spark, slice_rows):
    rng = random.Random(4)
    rows = [(rng.choice("aaaab"), s, s + rng.choice([0, 1, 3, 9, 60]), i) for i in range(400) for s in [rng.randrange(300)]]
    rows += rows[:20] + [("c", 1, 10, 0), ("c", 5, 30, 1), ("c", 20, 25, 2), ("d", 4, 9, 1), ("d", 4, 9, 0)]
    df = spark.createDataFrame(rows, "k string, s int, e int, id int")
    clean, rejected = resolve_overlapping(df, ["k"], "s", "e", slice_rows)
    want = greedy(rows)
    assert {("c", 1, 10, 0), ("c", 20, 25, 2), ("d", 4, 9, 0)} <= want
    got = set(map(tuple, clean.collect()))
    assert got == want and set(map(tuple, rejected.collect())) == set(rows) - want
    assert resolve_overlapping(df.limit(0), ["k"], "s", "e")[0].count() == 0
