"""Ordered scans per key over one timeline, with hot keys cut into time slices before any shuffle.

Rows of a key are events with an instant. A :class:`Layout` holds, for the few keys that own more rows
than a fair share of a task, quantiles of their instants; a row's slice is the number of them at or before
its instant. Rows are dealt by (key, slice) in one shuffle, so a key with most of the rows is spread
like many small ones, and every window, group and de-duplication per (key, slice) runs where the rows lie.

:func:`carried` looks along a key's events in order: the last value before a row, the next one after
it, running maximum or minimum, all in two window passes (forward and backward). Where a key is cut,
a summary of one row per slice carries each value over the slice borders; keys that are not cut need none. The
result is the same for every layout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ._joins import join_on

SLICE = "__slice"
_CUTS = "__cuts"
_HEADS = "__heads"
#: Every so many cuts one is a head: an instant is looked up among the heads, then among the cuts after its head.
_STRIDE = 32
#: Keys are counted by bucket of their hash first: no key has more rows than its bucket.
_BUCKETS = 1 << 16
#: Keys of up to this many rows are never cut: a task sorts them at once.
WHOLE_ROWS = 20_000
#: Slices a key is cut into at most.
MOST_SLICES = 1024


@dataclass
class Layout:
    """How the rows of ``part`` are dealt; ``cuts``: instants per hot key, None when there is no hot key."""

    part: list[str]
    cuts: DataFrame | None = None

    @property
    def keys(self) -> list[str]:
        """Columns that a group of rows in one task shares."""
        return self.part + ([SLICE] if self.cuts is not None else [])

    def slice_of(self, df: DataFrame, *instants: str) -> DataFrame:
        """``df`` with ``__slice`` (and ``__slice1``, ..) of its instants; 0 where the key is whole."""
        names = [SLICE if i == 0 else f"{SLICE}{i}" for i in range(len(instants))]
        if self.cuts is None:
            return df
        # at most 8 rows and cuts for every task of the cluster (see measure), so they go to all of them
        j = join_on(df, F.broadcast(self.cuts), self.part, "left")
        upto = lambda cuts, instant: F.size(F.filter(cuts, lambda c: c <= F.col(instant)))
        heads = [f"__head{i}" for i in range(len(instants))]
        j = j.withColumns({h: F.greatest(upto(F.col(_HEADS), i) - 1, F.lit(0)) * _STRIDE for h, i in zip(heads, instants)})
        at = [F.coalesce(F.col(h) + upto(F.slice(_CUTS, F.col(h) + 1, _STRIDE), i), F.lit(0)) for h, i in zip(heads, instants)]
        at = [F.when(F.col(_CUTS).isNotNull(), a).otherwise(0).alias(n) for a, n in zip(at, names)]
        return j.select(*df.columns, *at, *([F.col(_CUTS).isNotNull().alias("__cut")] if len(instants) == 1 else []))

    def deal(self, df: DataFrame, instant: str) -> DataFrame:
        """Rows dealt by key and slice; cut rows are staged, since two branches read them."""
        if self.cuts is None:
            return df.repartition(*self.part)
        ensure_checkpoint_dir(df.sparkSession)
        return self.slice_of(df, instant).repartition(*self.keys).checkpoint(eager=True)


def measure(frames: list[tuple[DataFrame, str]], part: list[str], rows: int | None = None) -> Layout:
    """Layout of the rows of all ``frames`` (frame, column of its instant) by ``part``.

    A key is hot when it owns more than ``rows`` rows; by default an eighth of a task's fair share, and
    ``WHOLE_ROWS`` at least. So there are at most eight hot keys, and eight cuts, for every task.
    """
    spark = frames[0][0].sparkSession
    every = None
    for df, at in frames:
        one = df.select(*part, F.col(at).alias("__at"))
        every = one if every is None else every.unionByName(one)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*part), F.lit(_BUCKETS if rows is None else 16 * _BUCKETS))
    total, largest = every.groupBy(bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n")).agg(F.sum("__n"), F.max("__n")).first()
    most = rows if rows is not None else max(WHOLE_ROWS, (total or 0) // (8 * tasks))
    if (largest or 0) <= most:
        return Layout(part)
    sizes = every.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    if (sizes.agg(F.max("__n")).first()[0] or 0) <= most:
        return Layout(part)
    hot = sizes.where(F.col("__n") > most).withColumn("__n", F.least(F.lit(MOST_SLICES), F.ceil(F.col("__n") / most)))
    shares = [k / MOST_SLICES for k in range(1, MOST_SLICES)]
    marks = join_on(every, hot, part).groupBy(*part).agg(F.percentile_approx("__at", shares, 4 * MOST_SLICES).alias("__q"), F.max("__n").alias("__n"))
    picked = F.transform(F.sequence(F.lit(1), F.col("__n") - 1), lambda i: F.get("__q", (F.floor(i * MOST_SLICES / F.col("__n")) - 1).cast("int")))
    ensure_checkpoint_dir(spark)
    cuts = marks.select(*part, F.array_sort(F.array_distinct(picked)).alias(_CUTS))
    return Layout(part, cuts.withColumn(_HEADS, F.filter(_CUTS, lambda _, i: i % _STRIDE == 0)).checkpoint(eager=True))


def carried(df: DataFrame, layout: Layout, order: list[str], wanted: list[tuple[str, str, Column]], within: list[str] | None = None) -> DataFrame:
    """``df`` (dealt by ``layout``) with columns that look along the rows of each key in ``order``.

    ``wanted``: (name, kind, value) with kind ``last`` (the last non-NULL value before the row), ``next`` (the first after
    it), ``max`` (the greatest before it) or ``min_after``. Rows of a key (and ``within``) that tie in ``order`` are in any order.
    """
    group = layout.part + (within or [])
    keys = layout.keys + (within or [])
    ahead = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    local = {
        "last": lambda v: F.last(v, ignorenulls=True).over(ahead), "next": lambda v: F.last(v, ignorenulls=True).over(behind),
        "max": lambda v: F.max(v).over(ahead), "min_after": lambda v: F.min(v).over(behind),
    }
    seen = df.select("*", *[local[kind](value).alias(name) for name, kind, value in wanted])
    if layout.cuts is None:
        return seen
    place = F.struct(*[F.col(c) for c in order])
    whole = {"last": lambda v: F.max_by(v, F.when(v.isNotNull(), place)), "next": lambda v: F.min_by(v, F.when(v.isNotNull(), place)), "max": F.max, "min_after": F.min}
    up = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*group).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    over = {
        "last": lambda c: F.last(c, ignorenulls=True).over(up), "next": lambda c: F.last(c, ignorenulls=True).over(down),
        "max": lambda c: F.max(c).over(up), "min_after": lambda c: F.min(c).over(down),
    }
    each = df.where("__cut").groupBy(*keys).agg(*[whole[kind](value).alias(f"__w_{name}") for name, kind, value in wanted])
    each = each.select(*keys, *[over[kind](f"__w_{name}").alias(f"__c_{name}") for name, kind, _ in wanted])
    both = join_on(seen, each, keys, "left")
    pick = {"last": F.coalesce, "next": F.coalesce, "max": F.greatest, "min_after": F.least}
    return both.select(*df.columns, *[pick[kind](name, f"__c_{name}").alias(name) for name, kind, _ in wanted])


def undealt(df: DataFrame) -> DataFrame:
    """Without the columns that :meth:`Layout.deal` added."""
    return df.drop(SLICE, "__cut")
