"""Period operators on half-open business periods.

All ordered work per key (neighbours, remainders, islands, overlaps, holding versions) is a scan of the
key's events in time order (:mod:`.timeline`), linear in its rows; no version of a key is compared with
every input of it, and keys with many rows are cut into time slices before they are dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import with_canonical
from ..functions.periods import BUS_OPEN_FROM, contains_between, ts_lit, within
from ..session import ensure_checkpoint_dir
from ._joins import join_on
from .timeline import SLICE, Layout, carried, measure, undealt


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def neighbour_bounds(
    df: DataFrame,
    key: list[str],
    start: str,
    end: str,
    order_extra: list[str] | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Append ``prev_end`` and ``next_start`` of each row's neighbours within its key.

    Rules (the reference's): ``prev_end`` is the previous row's end, but the row's
    own start when that end is open (``>= 9999-12-31``); ``next_start`` is the next
    row's start, but the row's own end when the next row starts inside this row
    and this row's end is not open.  Order: start, end, then ``order_extra`` as a
    tie-break so the result is deterministic.  ``key`` columns are used as given;
    pass canonical columns for NULL-or-default keys.
    """
    open_from = ts_lit(BUS_OPEN_FROM, _types(df)[end])
    lay = measure([(df, start)], key, slice_rows)
    nb = carried(lay.deal(df, start), lay, [start, end, *(order_extra or [])],
                 [("__prev", "last", F.struct(F.col(end).alias("x"))), ("__next", "next", F.struct(F.col(start).alias("x")))])
    prev, nxt = F.col("__prev.x"), F.col("__next.x")
    return nb.select(
        *df.columns,
        F.when(prev >= open_from, F.col(start)).otherwise(prev).alias("prev_end"),
        F.when((nxt < F.col(end)) & (F.col(end) < open_from), F.col(end)).otherwise(nxt).alias("next_start"),
    )


def period_neighbours(df: DataFrame, key: list[str], start: str, end: str, slice_rows: int | None = None) -> DataFrame:
    """Public U14 on raw columns: NULL-or-default keys, ``prev_end``/``next_start`` added.

    ``slice_rows``: rows above which a key is cut into time slices (default: its fair share of a task).
    """
    K = [f"__k{i}" for i in range(len(key))]
    c = with_canonical(df, key, "__k", _types(df))
    rest = [x for x in df.columns if x not in key + [start, end]]
    return neighbour_bounds(c, K, start, end, rest, slice_rows).drop(*K)


def islands(df: DataFrame, layout: Layout, within_key: list[str], carry: list[str], start: str, end: str) -> DataFrame:
    """Gaps-and-islands (U20 core) on rows dealt by ``layout``.

    Rows equal on the layout's key and ``within_key`` whose periods overlap or meet become one row
    ``[min start, max end)``.  A row opens a new island when it starts after the running maximum end of
    all earlier rows, so nested periods fuse too (D5); an island is named by its first start.
    ``carry`` columns take ``max`` per island (raw values whose canonical form is
    equal: NULL and the default give the default).
    """
    group = layout.part + within_key
    marked = carried(df, layout, [start, end], [("__reach", "max", F.col(end))], within_key)
    first = F.when(F.col("__reach").isNull() | (F.col(start) > F.col("__reach")), F.col(start))
    marked = marked.withColumn("__first", first)
    named = carried(marked, layout, [start, end], [("__isl", "last", F.col("__first"))], within_key)
    return named.withColumn("__isl", F.coalesce("__first", "__isl")).groupBy(*group, "__isl").agg(
        *[F.max(c).alias(c) for c in carry], F.min(start).alias(start), F.max(end).alias(end)).drop("__isl")


def coalesce_periods(df: DataFrame, part: list[str], carry: list[str], start: str, end: str, slice_rows: int | None = None) -> DataFrame:
    """:func:`islands` of undealt rows; columns ``part``, ``carry``, ``start``, ``end``."""
    lay = measure([(df, start)], part, slice_rows)
    return islands(lay.deal(df, start), lay, [], carry, start, end).select(*part, *carry, start, end)


def normalise_periods(df: DataFrame, by: list[str], start: str, end: str, slice_rows: int | None = None) -> DataFrame:
    """Public U20: coalesce overlapping or meeting periods of rows equal on ``by``.

    Equality is NULL-or-default per column type.  Output: ``by`` columns, start, end.
    """
    P = [f"__p{i}" for i in range(len(by))]
    c = with_canonical(df.select(*by, start, end), by, "__p", _types(df))
    return coalesce_periods(c, P, by, start, end, slice_rows).select(*by, start, end)


def period_envelope(df: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Per key: ``env_start = min(start)``, ``env_end = max(end)`` (A3)."""
    K = [f"__k{i}" for i in range(len(key))]
    c = with_canonical(df, key, "__k", _types(df))
    return c.groupBy(*K).agg(
        *[F.max(k).alias(k) for k in key],
        F.min(start).alias("env_start"),
        F.max(end).alias("env_end"),
    ).drop(*K)


def envelope_versions(inp: DataFrame, versions: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Versions touched by their key's envelope of input periods, and how.

    ``versions`` (all columns) of the keys of ``inp`` that lie inside the envelope ``[env_start, env_end)`` (``inside``),
    hold its first instant (``holds_start``) or hold an instant just before its end but reach beyond it (``holds_end``).
    The envelope is one row per key, so each version meets one row, whatever the size of its key; the current
    remainder before or after the envelope is ``[start, env_start)`` or ``[env_end, end)`` of the versions that hold them.
    """
    K = [f"__k{i}" for i in range(len(key))]
    env = with_canonical(period_envelope(inp, key, start, end), key, "__k", _types(inp)).select(*K, "env_start", "env_end")
    j = join_on(with_canonical(versions, key, "__k", _types(versions)), env, K)
    s, e, a, b = (F.col(c) for c in (start, end, "env_start", "env_end"))
    out = j.withColumns({
        "inside": within(s, e, a, b),
        "holds_start": (a >= s) & (a < e),
        "holds_end": (b > s) & (b < e),
    })
    return out.where("inside OR holds_start OR holds_end").drop(*K)


def check_overlaps(df: DataFrame, key: list[str], start: str, end: str, slice_rows: int | None = None) -> DataFrame:
    """Rows whose period overlaps an earlier row of the same key (precondition D6).

    An earlier row is one ordered before it by (start, end); overlap is tested
    against the running maximum end, so every violator is reported once, with
    ``overlap_end`` the end it collides with.  Returns the offending rows only.
    """
    K = [f"__k{i}" for i in range(len(key))]
    c = with_canonical(df, key, "__k", _types(df))
    lay = measure([(c, start)], K, slice_rows)
    marked = carried(lay.deal(c, start), lay, [start, end], [("overlap_end", "max", F.col(end))])
    return marked.filter(F.col("overlap_end") > F.col(start)).select(*df.columns, "overlap_end")


def split_overlapping(df: DataFrame, key: list[str], start: str, end: str, slice_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)`` for the D6 precondition: the caller fails on or quarantines ``rejected``.

    Exact duplicate rows collapse first (a merge treats them as one).  A row is
    rejected when its period overlaps any row of its key ordered before it (by
    start, end, then every other column, so the split is deterministic); the clean
    rows then hold no overlapping periods per key.  :func:`resolve_overlapping` keeps more rows.
    """
    K = [f"__k{i}" for i in range(len(key))]
    d = with_canonical(df.dropDuplicates(), key, "__k", _types(df))
    rest = [c for c in df.columns if c not in key + [start, end]]
    lay = measure([(d, start)], K, slice_rows)
    marked = carried(lay.deal(d, start), lay, [start, end, *rest], [("__before", "max", F.col(end))])
    bad = F.coalesce(F.col("__before") > F.col(start), F.lit(False))
    return marked.filter(~bad).select(*df.columns), marked.filter(bad).select(*df.columns)


def resolve_overlapping(df: DataFrame, key: list[str], start: str, end: str, slice_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)`` with as many clean rows per key as there can be: always the earliest end goes on.

    From a row that is kept, the next one kept is the first by (end, start, other columns) of those that start at or after its
    end.  One scan gives every row that successor; the rows on the chain from a key's first row are found by
    doubling: after k rounds of one join each a pointer spans 2^k rows, so a chain of a million rows takes
    twenty rounds and no key is walked in one task.  Exact duplicates collapse first; rows that do not end after they
    start, or have no start or end, are rejected.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    K = [f"__k{i}" for i in range(len(key))]
    rest = [c for c in df.columns if c not in key + [start, end]]
    d = with_canonical(df.dropDuplicates(), key, "__k", _types(df)).withColumn("__id", F.monotonically_increasing_id()).checkpoint(eager=True)
    sound = d.where(F.col(start) < F.col(end))
    rank = F.struct(end, start, *rest, *key, "__id")
    rows = sound.select(*K, F.col(start).alias("__at"), F.lit(1).alias("__o"), rank.alias("__rank"), F.lit(None).cast("long").alias("__asks"))
    asks = sound.select(*K, F.col(end).alias("__at"), F.lit(0).alias("__o"), F.lit(None).cast(rows.schema["__rank"].dataType).alias("__rank"), F.col("__id").alias("__asks"))
    events = rows.unionByName(asks)
    lay = measure([(events, "__at")], K, slice_rows)
    hop = carried(lay.deal(events, "__at"), lay, ["__at", "__o"], [("__next", "min_after", F.col("__rank"))])
    hop = hop.where("__asks IS NOT NULL AND __next IS NOT NULL").select(F.col("__asks").alias("id"), F.col("__next.__id").alias("to")).checkpoint(eager=True)
    kept = sound.groupBy(*K).agg(F.min(rank).alias("r")).select(F.col("r.__id").alias("id")).checkpoint(eager=True)
    while True:
        more = kept.join(hop, "id").select(F.col("to").alias("id"))
        grown = kept.union(more).distinct().checkpoint(eager=True)
        far = hop.select("id", F.col("to").alias("via")).join(hop.select(F.col("id").alias("via"), "to"), "via").select("id", "to").checkpoint(eager=True)
        kept, hop = grown, far
        if not hop.limit(1).count():
            break
    named = kept.withColumnRenamed("id", "__id")
    return d.join(named, "__id", "left_semi").select(*df.columns), d.join(named, "__id", "left_anti").select(*df.columns)


def containing(versions: DataFrame, inner: DataFrame, part: list[str], start: str, end: str, inner_start: str, inner_end: str,
               slice_rows: int | None = None) -> DataFrame:
    """``versions`` joined with the ``inner`` periods of their ``part`` that they contain, both ends inclusive.

    Groups of more than ``slice_rows`` rows (1,024) are not compared pair by pair.  A sweep over the starts first drops
    versions that contain no period (the least end of the periods that start in or after them is beyond
    theirs) and periods that no version contains (no version that starts before them reaches their end).  The rest
    meets in time tiles: a period in the tile of its start, a version in every tile it spans.
    """
    most = 1024 if slice_rows is None else slice_rows
    lay = measure([(versions, start), (inner, inner_start)], part, most)
    fits = contains_between(F.col(start), F.col(end), F.col(inner_start), F.col(inner_end))
    if lay.cuts is None:
        return join_on(versions, inner, part, "inner", fits)
    v, p = F.struct(*versions.columns), F.struct(*inner.columns)
    none = lambda df, x: F.lit(None).cast(df.select(x.alias("x")).schema["x"].dataType)
    events = versions.select(*part, F.col(start).alias("__at"), F.lit(0).alias("__o"), F.col(end).alias("__end"), v.alias("__v"), none(inner, p).alias("__p")).unionByName(
        inner.select(*part, F.col(inner_start).alias("__at"), F.lit(1).alias("__o"), F.col(inner_end).alias("__end"), none(versions, v).alias("__v"), p.alias("__p")))
    swept = carried(lay.deal(events, "__at"), lay, ["__at", "__o"], [
        ("__reach", "max", F.when(F.col("__o") == 0, F.col("__end"))), ("__least", "min_after", F.when(F.col("__o") == 1, F.col("__end")))])
    left = swept.where("__o = 0 AND __least <= __end").select("__v.*")
    right = swept.where("__o = 1 AND __reach >= __end").select("__p.*")
    tiled = lay.slice_of(left, start, end)
    tiled = tiled.withColumn(SLICE, F.explode(F.sequence(SLICE, F.greatest(SLICE, f"{SLICE}1")))).drop(f"{SLICE}1")
    return undealt(join_on(tiled, lay.slice_of(right, inner_start).drop("__cut"), [*part, SLICE], "inner", fits))
