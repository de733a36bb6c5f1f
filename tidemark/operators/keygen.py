"""Surrogate-key assignment against a hub table.

The reference numbers new keys with ``max + row_number() over (order by null)``,
a window without partitioning that Spark would run in one task.  Here numbering
is two-pass and distributed: range-partition the distinct new keys, cut lineage
with a reliable checkpoint so partitions cannot move, count rows per partition,
turn the (partition-count sized) counts into offsets, and add the in-partition
position.  Keys are numbered in key order, so the result is deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.nulls import with_canonical
from ..functions.periods import ts_lit
from ..session import ensure_checkpoint_dir
from ._joins import join_on
from ._stage import stage
from .roles import Resolved, Roles, resolve_roles

# Layout of monotonically_increasing_id(): partition index above bit 33.
_PART_SHIFT = 33
_ROW_MASK = (1 << _PART_SHIFT) - 1


def dense_number(df: DataFrame, order: list[str], out: str = "row_no", partitions: int | None = None) -> DataFrame:
    """Append ``out`` = 1..n in ``order`` over the whole frame, without a global window.

    Two passes over a checkpointed, range-partitioned copy; the only data that
    gathers anywhere is one count per partition.  Ties in ``order`` are numbered
    in an arbitrary but fixed order.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("__mid"), _PART_SHIFT)
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    return (
        ranged.join(F.broadcast(offsets), part == offsets["__part"])
        .withColumn(out, F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_ROW_MASK)) + F.lit(1))
        .drop("__mid", "__part", "__off")
    )


def _resolve(src: DataFrame, key: list[str], sys_key: str, tgt: DataFrame | None = None) -> Resolved:
    return resolve_roles(src.schema, (src if tgt is None else tgt).schema, Roles(key=tuple(key), sys=(sys_key,)), "keygen")


def lookup_keys(
    src: DataFrame,
    hub: DataFrame,
    key: list[str],
    sys_key: str,
    as_of: str | _dt.datetime,
    hub_exp: str = "icw_exp_ts",
) -> DataFrame:
    """Distinct source keys with the surrogate of their current hub row, or NULL.

    Keys compare NULL-or-default (D9); several current hub rows of one key give
    the smallest surrogate (D10).  Columns: key columns, ``sys_key``.
    """
    types = {f.name: f.dataType for f in hub.schema.fields}
    K = [f"__k{i}" for i in range(len(key))]
    s = with_canonical(src.select(*key), key, "__k", types)
    s = s.groupBy(*K).agg(*[F.max(k).alias(k) for k in key])
    h = with_canonical(hub.filter(F.col(hub_exp) > ts_lit(as_of, types[hub_exp])), key, "__k", types)
    h = h.groupBy(*K).agg(F.min(sys_key).alias(sys_key))
    return join_on(s, h, K, "left").select(*key, sys_key)


def hub_duplicates(hub: DataFrame, key: list[str], as_of: str | _dt.datetime, hub_exp: str = "icw_exp_ts") -> DataFrame:
    """Keys with more than one current hub row (D10 report)."""
    types = {f.name: f.dataType for f in hub.schema.fields}
    K = [f"__k{i}" for i in range(len(key))]
    h = with_canonical(hub.filter(F.col(hub_exp) > ts_lit(as_of, types[hub_exp])), key, "__k", types)
    return h.groupBy(*K).agg(*[F.max(k).alias(k) for k in key], F.count(F.lit(1)).alias("n_current")).filter(
        "n_current > 1"
    ).drop(*K)


def assign_keys(
    cache: DataFrame, hub: DataFrame, key: list[str], sys_key: str, stage_mode: str = "checkpoint"
) -> DataFrame:
    """Fill NULL surrogates: ``coalesce(max over all hub rows, 0) + rank in key order`` (U8).

    The maximum counts expired hub rows too; the hub is not written.  Adds
    ``is_new`` (true for generated keys).  The filled cache (one row per distinct
    key) is materialised once: the key output, the write-back and the metrics
    all read it.
    """
    max_key = hub.select(F.coalesce(F.max(sys_key), F.lit(0)).alias("m")).scalar()
    known = cache.filter(F.col(sys_key).isNotNull()).withColumn("is_new", F.lit(False))
    missing = cache.filter(F.col(sys_key).isNull()).drop(sys_key)
    types = {f.name: f.dataType for f in cache.schema.fields}
    K = [f"__k{i}" for i in range(len(key))]
    numbered = dense_number(with_canonical(missing, key, "__k", types), K, "__rn")
    new = numbered.select(
        *key, (max_key + F.col("__rn")).cast(types[sys_key]).alias(sys_key), F.lit(True).alias("is_new")
    )
    K2 = [f"__k{i}" for i in range(len(key))]
    filled = known.unionByName(new)
    return stage(with_canonical(filled, key, "__k", types).repartition(*K2), stage_mode).drop(*K2)


def keygen(
    src: DataFrame,
    hub: DataFrame,
    key: list[str],
    sys_key: str,
    as_of: str | _dt.datetime,
    mode: str = "target",
    hub_exp: str = "icw_exp_ts",
    cache: DataFrame | None = None,
    tgt: DataFrame | None = None,
) -> DataFrame:
    """Source rows with their surrogate key.

    ``tgt``: the table to be written; its columns are reconciled with the source's
    (a source column it lacks raises, a column it alone has is warned about).

    ``mode='target'``: key columns, the other source columns, then ``sys_key``
    (inner join with the key cache; what gets written to a new target).
    ``mode='source'``: the source's own columns with ``sys_key`` set where a key
    was found (left join + ``coalesce``, the write-back form).
    """
    r = _resolve(src, key, sys_key, tgt)
    if cache is None:
        cache = assign_keys(lookup_keys(src, hub, r.key, sys_key, as_of, hub_exp), hub, r.key, sys_key)
    types = {f.name: f.dataType for f in src.schema.fields}
    K = [f"__k{i}" for i in range(len(r.key))]
    c = with_canonical(cache.select(*r.key, F.col(sys_key).alias("__sk")), r.key, "__k", types).drop(*r.key)
    s = with_canonical(src, r.key, "__k", types)
    if mode == "target":
        j = join_on(s, c, K, "inner")
        return j.select(*r.key, *r.other, F.col("__sk").alias(sys_key))
    if mode == "source":
        j = join_on(s, c, K, "left")
        if sys_key in src.columns:
            return j.select(*[F.coalesce("__sk", sys_key).alias(x) if x == sys_key else F.col(x) for x in src.columns])
        return j.select(*src.columns, F.col("__sk").alias(sys_key))
    raise ValueError(f"mode must be 'target' or 'source', not {mode!r}")


def keygen_summary(cache: DataFrame, written: DataFrame) -> DataFrame:
    """Keys needed, keys generated, rows written: one row."""
    spark = SparkSession.getActiveSession() or cache.sparkSession
    needed = cache.select(F.count(F.lit(1))).scalar()
    generated = cache.select(F.count_if(F.col("is_new"))).scalar()
    rows = written.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        needed.alias("keys_needed"), generated.alias("keys_generated"), rows.alias("rows_written")
    )
