"""Scans of a timeline equal plain windows in every layout; a key with most rows is spread before staging."""

import random
from functools import reduce

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import Roles, envelope_versions
from tidemark.operators.periods import coalesce_periods, containing, neighbour_bounds
from tidemark.operators.temporal import plan_temporal
from tidemark.operators.timeline import SLICE, carried, measure

from conftest import as_of, day
from test_temporal import OPEN_SYS, TGT


def skewed(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(4000):  # one hot key with most rows, plus a tail of small keys
        k = "hot" if i < 3000 else f"k{rng.randint(0, 200)}"
        s = rng.randint(0, 5000)
        rows.append((k, s, s + rng.randint(1, 30), i))
    return spark.createDataFrame(rows, "k string, s int, e int, id int")


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("rows", [None, 300, 7])
def test_carried_equals_windows(spark, rows):
    df, order = skewed(spark), ["s", "e", "id"]
    lay = measure([(df, "s")], ["k"], rows)
    assert (lay.cuts is None) == (rows is None)
    odd = F.when(F.col("id") % 7 == 0, F.col("e"))
    got = carried(lay.deal(df, "s"), lay, order, [("a", "last", odd), ("b", "next", odd), ("c", "max", F.col("e")), ("d", "min_after", F.col("e"))])
    up = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("k").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.last(odd, True).over(up).alias("a"), F.last(odd, True).over(down).alias("b"), F.max("e").over(up).alias("c"), F.min("e").over(down).alias("d"))
    same(got.select(*want.columns), want)


@pytest.mark.parametrize("rows", [None, 50])
def test_neighbours_and_islands(spark, rows):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("s", "e", "id")
    dated = df.select("k", *[(F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col(c))).alias(c) for c in "se"], "id")
    nb = neighbour_bounds(dated, ["k"], "s", "e", ["id"], rows)
    nxt = F.lead("s").over(w)
    want = dated.select("*", F.lag("e").over(w).alias("prev_end"), F.when(nxt < F.col("e"), F.col("e")).otherwise(nxt).alias("next_start"))
    same(nb, want)
    run = F.max("e").over(Window.partitionBy("k").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("o", F.when(run.isNull() | (F.col("s") > run), 1).otherwise(0))
    numbered = opened.withColumn("i", F.sum("o").over(Window.partitionBy("k").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)))
    same(coalesce_periods(df, ["k"], [], "s", "e", rows), numbered.groupBy("k", "i").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("i"))


def test_hot_key_is_spread(spark):
    """90 % of the rows under one key: the staged timeline and the versions stay within twice the mean partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        key = F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 499).cast("string")))
        start = F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))
        tgt = spark.range(20_000).select(key.alias("k"), F.lit("a").alias("his"), start.alias("bus_eff_ts"), (start + F.expr("INTERVAL 1 DAY")).alias("bus_exp_ts"),
                                         F.lit(day(1)).cast("timestamp_ntz").alias("icw_eff_ts"), F.lit(OPEN_SYS).cast("timestamp_ntz").alias("icw_exp_ts"))
        src = tgt.where("day(bus_eff_ts) % 3 = 0").select("k", F.lit("b").alias("his"), (F.col("bus_eff_ts") + F.expr("INTERVAL 1 HOUR")).alias("bus_eff_ts"), "bus_exp_ts")
        roles = Roles(key=("k",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"))
        p = plan_temporal(src, tgt, roles, as_of(), slice_rows=20_000 // (8 * 8))
        for name, df in (("hot", p.hot), ("timeline", p.timeline), ("norm", p.norm)):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) <= 2 * sum(sizes) / 8, (name, sizes)
        assert p.timeline.where("k = 'hot'").select(SLICE).distinct().count() >= 32
        whole = plan_temporal(src, tgt, roles, as_of(), slice_rows=10**9)
        same(p.merge_set, whole.merge_set)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.mark.parametrize("seed", range(2))
def test_containing_equals_pair_join(spark, seed):
    rng = random.Random(seed)
    span = lambda n: (lambda s: (s, s + rng.choice([0, 1, 5, 40, 900])))(rng.randrange(1000))
    v = spark.createDataFrame([(rng.choice("aaaab"), i, *span(i)) for i in range(500)], "m string, d int, s int, e int")
    p = spark.createDataFrame([(rng.choice("aaaab"), *span(i)) for i in range(300)], "m string, a int, b int").distinct()
    want = v.join(p, "m").where("a BETWEEN s AND e AND b BETWEEN s AND e").select("m", "d", "s", "e", "a", "b")
    for rows in (None, 10):
        same(containing(v, p, ["m"], "s", "e", "a", "b", rows).select("m", "d", "s", "e", "a", "b"), want)


def test_containing_does_not_pair_a_hot_group(spark):
    """20,000 details and 20,000 periods of one master key, each detail holding one: far fewer candidates than pairs."""
    v = spark.range(20_000).select(F.lit("m").alias("m"), F.col("id").alias("d"), (F.col("id") * 10).alias("s"), (F.col("id") * 10 + 9).alias("e"))
    p = spark.range(20_000).select(F.lit("m").alias("m"), (F.col("id") * 10 + 2).alias("a"), (F.col("id") * 10 + F.when(F.col("id") % 2 == 0, 5).otherwise(50)).alias("b"))
    got = containing(v, p, ["m"], "s", "e", "a", "b", 512)
    assert got.count() == 10_000
    lay = measure([(v, "s"), (p, "a")], ["m"], 512)
    tiles = reduce(lambda x, y: x.unionByName(y), [lay.slice_of(v, "s").groupBy(SLICE).count(), lay.slice_of(p, "a").groupBy(SLICE).count()])
    assert tiles.agg(F.max("count")).first()[0] < 2000


def test_envelope_versions(spark):
    inp = spark.createDataFrame([("k", 10, 20), ("k", 30, 40), (None, 5, 6)], "k string, s int, e int")
    v = spark.createDataFrame([("k", 1, 9), ("k", 9, 12), ("k", 12, 40), ("k", 40, 50), ("x", 10, 20), ("", 5, 7)], "k string, s int, e int")
    got = sorted((r.s, r.inside, r.holds_start, r.holds_end) for r in envelope_versions(inp, v, ["k"], "s", "e").collect())
    assert got == [(5, False, True, True), (9, False, True, False), (12, True, False, False)]


def test_instants_are_looked_up_by_heads(spark):
    rows = spark.range(3000).selectExpr("'a' AS k", "cast(id * 7 % 3000 AS int) AS s").unionByName(spark.createDataFrame([("a", None), ("b", 5), (None, 1)], "k string, s int"))
    lay = measure([(rows, "s")], ["k"], 5)
    cuts = lay.cuts.first()
    assert len(cuts["__cuts"]) > 500 and cuts["__heads"] == cuts["__cuts"][::32]  # a row meets some 50 of them
    for k, s, n, cut in lay.slice_of(rows, "s").select("k", "s", SLICE, "__cut").collect():
        assert n == (sum(c <= s for c in cuts["__cuts"]) if k == "a" and s is not None else 0) and cut == (k == "a")


def test_keys_are_counted_by_bucket_first(spark, monkeypatch):
    many = spark.range(20000).selectExpr("id AS k", "cast(id % 9 AS int) AS s")
    seen, real = [], type(many).groupBy
    monkeypatch.setattr(type(many), "groupBy", lambda df, *by: seen.append([str(b) for b in by]) or real(df, *by))
    assert measure([(many, "s")], ["k"]).cuts is None
    assert seen and ["k"] not in seen


@pytest.mark.parametrize("rows", [None, 2])
def test_versions_with_several_system_ends_are_settled_as_one(spark, rows):
    roles = Roles(key=("k",), his=("his",), bus=("bus_eff_ts", "bus_exp_ts"))
    src = spark.createDataFrame([("a", "x", day(1), day(5)), ("a", "y", day(5), day(9))], "k string, his string, bus_eff_ts timestamp_ntz, bus_exp_ts timestamp_ntz")
    ends = [day(200), day(300), OPEN_SYS]
    tgt = spark.createDataFrame([("a", h, day(s), day(e), day(0), x) for h, s, e in (("x", 1, 5), ("z", 5, 9)) for x in ends], TGT)
    got = plan_temporal(src, tgt, roles, as_of(), slice_rows=rows).merge_set
    assert sorted((r.his, r.icw_eff_ts, r.icw_exp_ts) for r in got.collect()) == [("x", day(0), OPEN_SYS), ("y", day(100), OPEN_SYS), ("z", day(0), day(100))]
    assert "Deduplicate" not in got._jdf.queryExecution().analyzed().toString()  # the merge set is not dealt once more


def test_stages_free_their_shuffles_and_the_timeline_lies_in_columns(spark, tmp_path):
    import time
    from pathlib import Path

    from tidemark.operators._stage import stage
    from tidemark.operators.roles import Roles
    from tidemark.operators.temporal import plan_temporal

    def shuffled():
        dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    before, name = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(name, None)
    for mode in ("checkpoint", "table"):
        df = spark.range(5000).repartition(3, F.col("id") % 7)
        assert len(stage(df, mode).collect()) == 5000
    for _ in range(100):  # the files go in the background
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(name, None) == held

    ts = "timestamp'2020-01-0{} 00:00:00'"
    tgt = spark.sql(f"select 1 as k, 'a' as v, {ts.format(1)} as bus_eff_ts, {ts.format(9)} as bus_exp_ts, {ts.format(1)} as icw_eff_ts, timestamp'9999-12-31 00:00:00' as icw_exp_ts")
    src = spark.sql(f"select 1 as k, 'b' as v, {ts.format(3)} as bus_eff_ts, {ts.format(4)} as bus_exp_ts")
    plan = plan_temporal(src, tgt, Roles(key=("k",), his=("v",), bus=("bus_eff_ts", "bus_exp_ts")), "2024-06-01 00:00:00")
    assert plan.timeline.inputFiles() and all(f.endswith(".parquet") for f in plan.timeline.inputFiles())
    assert sorted((r.v, r.bus_eff_ts.day, r.bus_exp_ts.day) for r in plan.merge_set.collect()) == [("a", 1, 3), ("a", 1, 9), ("a", 4, 9), ("b", 3, 4)]
