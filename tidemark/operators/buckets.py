"""Merging into a bucketed table that is rewritten in part only (U22, S6), with metrics and audit from the one write.

The table is a folder of parquet files partitioned by ``state`` and ``bucket``: ``state=current`` holds the current
versions by a hash of their key, ``state=closed-<run>`` the versions a run has closed.  A run reads and
overwrites only the current buckets that its keys fall into (dynamic partition overwrite), and adds its closed
versions as partitions of its own, all in one job; other files are neither read nor written.  A run that is
repeated finds its work done: it closes nothing more, and its partitions and audit row are the same ones.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import with_canonical
from ..functions.periods import ts_lit
from .apply import ACTION, observed
from .audit import audit_run
from .roles import Roles, resolve_roles
from .scd2 import scd2_merge
from .temporal import temporal_merge

STATE, BUCKET = "state", "bucket"


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def _bucketed(df: DataFrame, key: list[str], buckets: int) -> DataFrame:
    K = [f"__b{i}" for i in range(len(key))]
    c = with_canonical(df, key, "__b", _types(df))
    return c.withColumn(BUCKET, F.pmod(F.xxhash64(*K), F.lit(buckets)).cast("int")).drop(*K)


def _write(df: DataFrame, path: str, files: int, spread: Column) -> None:
    # a bucket goes to several tasks, so a hot key does not end in one
    dealt = df.repartition(STATE, BUCKET, F.pmod(F.xxhash64(spread), F.lit(files)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(STATE, BUCKET).parquet(path)


def create_buckets(df: DataFrame, path: str, key: list[str], buckets: int = 256, files: int = 1) -> None:
    """Write current versions as a new bucketed table; ``key``: the columns that every run's keys share (master keys, if any)."""
    _write(_bucketed(df, key, buckets).withColumn(STATE, F.lit("current")), path, files, F.struct(*df.columns))


def read_buckets(spark: SparkSession, path: str, end: str, state: str | None = None) -> DataFrame:
    """Versions of the table, all or of one ``state``; ``end``: its system end column (marker rows have none)."""
    t = spark.read.parquet(path).where(F.col(end).isNotNull())
    return (t if state is None else t.where(F.col(STATE) == state)).drop(STATE, BUCKET)


def merge_buckets(
    spark: SparkSession,
    path: str,
    src: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    run_id: str,
    kind: str = "temporal",
    buckets: int = 256,
    files: int = 1,
    driver: DataFrame | None = None,
    audit_path: str | None = None,
) -> dict:
    """One type-2 (``kind="scd2"``) or bitemporal merge into the table at ``path``; returns rows inserted and updated, and buckets written.

    A bucket whose versions were all closed keeps a marker row without values, so that its old file is replaced.
    """
    whole = spark.read.parquet(path).drop(STATE, BUCKET)
    r = resolve_roles(src.schema, whole.schema, roles, "temporal" if kind == "temporal" else "scd2")
    key = r.key[: len(r.kem)] if kind == "temporal" and r.kem else r.key
    runs = _bucketed(src.select(*key), key, buckets).select(BUCKET)
    if driver is not None:
        runs = runs.unionByName(_bucketed(driver.select(*key), key, buckets).select(BUCKET))
    touched = [b[0] for b in runs.distinct().collect()]  # at most ``buckets`` numbers
    eff, exp = r.sys
    if not touched:
        return {"rows_inserted": 0, "rows_updated": 0, "buckets": 0}
    cur = spark.read.parquet(path).where((F.col(STATE) == "current") & F.col(BUCKET).isin(touched) & F.col(exp).isNotNull()).drop(STATE, BUCKET)
    if kind == "temporal":
        merged = temporal_merge(src, cur, roles, as_of, driver, keep_action=True)
    else:
        merged = scd2_merge(src, cur, roles, as_of, keep_action=True)
    still = F.coalesce(F.col(exp) > ts_lit(as_of, _types(cur)[exp]), F.lit(False))
    obs = Observation()
    rows = _bucketed(observed(merged, obs), key, buckets).where(F.col(ACTION) != "history").drop(ACTION)
    rows = rows.withColumn(STATE, F.when(still, "current").otherwise(F.lit(f"closed-{run_id}")))
    marks = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int").select(
        *[F.lit(None).cast(t).alias(c) for c, t in _types(cur).items()], BUCKET, F.lit("current").alias(STATE))
    _write(rows.unionByName(marks), path, files, F.struct(*cur.columns))
    metrics = {**obs.get, "buckets": len(touched)}
    if audit_path:
        audit_run(spark, audit_path, run_id, f"{kind}_merge", [("Rows written", ", ".join(f"{k}: {v}" for k, v in metrics.items()))])
    return metrics
