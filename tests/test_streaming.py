"""A landed stream merged batch by batch into a type-2 target (foreachBatch adapter)."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark import Roles, scd2_merge
from tidemark.session import scratch_path
from tidemark.streaming.landing import merge_each_batch

ROLES = Roles(key=("k",), his=("his",))
OPEN = datetime(9999, 12, 31, 23, 59, 59, 999000)


def test_merge_each_batch(spark, tmp_path):
    base = scratch_path(spark, "test-stream-merge")
    tgt0 = f"{base}/t0"
    spark.createDataFrame(
        [("a", "x", datetime(2020, 1, 1), OPEN), ("b", "y", datetime(2020, 1, 1), OPEN)],
        "k string, his string, icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz",
    ).write.parquet(tgt0)
    src = tmp_path / "src"
    src.mkdir()
    spark.createDataFrame([("a", "x2"), ("c", "z")], "k string, his string").write.parquet(str(src / "f1"))

    state = {"path": tgt0}

    def apply(batch, batch_id):
        tgt = batch.sparkSession.read.parquet(state["path"])
        out = scd2_merge(batch.select("k", "his"), tgt, ROLES, "2024-06-01 00:00:00")
        path = f"{base}/t{batch_id + 1}"
        out.write.parquet(path)  # a new path per batch; the one being read is never overwritten
        state["path"] = path

    stream = spark.readStream.schema("k string, his string").option("recursiveFileLookup", "true").parquet(str(src))
    merge_each_batch(stream, f"{base}/ckpt", apply)
    cur = spark.read.parquet(state["path"]).filter(F.col("icw_exp_ts") > F.lit("2024-06-01").cast("timestamp_ntz"))
    assert sorted((r.k, r.his) for r in cur.collect()) == [("a", "x2"), ("b", "y"), ("c", "z")]


def test_land_stream_service_mode(spark, tmp_path):
    from tidemark import land_stream
    src = tmp_path / "svc"
    src.mkdir()
    spark.range(5).write.parquet(str(src / "f1"))
    base = scratch_path(spark, "test-stream-service")
    q = land_stream(spark, str(src), f"{base}/sink", f"{base}/ckpt", trigger="1 second",
                    options={"recursiveFileLookup": "true"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{base}/sink").count() == 5
