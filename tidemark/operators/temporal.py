"""Bitemporal merge: business period x system period.

One run has a fixed ``as_of`` and works on one timeline of events per key:

    V   a current version at its start (target rows of the run's keys)
    L   an input at its start, R the same input at its end (source rows; key-master rows)
    D   a delete instant

One scan of that timeline (:mod:`.timeline`) gives every event the version that holds it, the inputs on both
sides, and the running ends of versions and inputs.  From those alone follow the deleted versions (U15), the
neighbours (U14), the remainders of cut versions before and after an input (U17, U18), the versions that an
input touches (D4), and the check that periods of a key do not overlap.  No version meets the inputs of its key
in a join, and the rows of a hot key are cut into time slices before they are dealt.

    frag  = inputs, deleted versions and remainders        norm = frag coalesced per (key, HIS, flag)
    set   = new flag-0 rows [as_of, open)  U  refreshed keeps  U  closed versions

``norm`` meets the versions once, in a join on the whole version identity.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.nulls import canonical, with_canonical
from ..functions.periods import BUS_OPEN_FROM, SYS_OPEN_END, null_or_before, null_or_not_meeting, ts_lit
from ..session import ensure_checkpoint_dir
from ._joins import join_on
from ._stage import stage
from .apply import apply_versions
from .periods import containing, islands
from .roles import Resolved, Roles, resolve_roles
from .scd2 import DELETE_FLAG
from .timeline import SLICE, Layout, carried, measure

FLAG = "prog_flag"
_R, _L, _V, _D = 1, 2, 3, 4  # at one instant in this order


class OverlapError(ValueError):
    """Periods of one key overlap where a merge needs them apart (precondition D6)."""


@dataclass
class TemporalPlan:
    """The named frames of one bitemporal run (``hot`` and ``timeline`` are materialised by building it)."""

    roles: Resolved
    K: list[str]
    H: list[str]
    cur: DataFrame
    hot: DataFrame
    timeline: DataFrame
    norm: DataFrame
    merge_set: DataFrame
    events: _Events

    def _part(self, part: Column) -> DataFrame:
        return self.events.fragments(self.timeline, part).select(*self.events.row_columns, *self.K, *self.H, FLAG)

    @property
    def inp(self) -> DataFrame:
        """Inputs and deleted versions."""
        return self._part(self.events.loaded)

    @property
    def left(self) -> DataFrame:
        """Remainders of versions before an input."""
        return self._part(self.events.left)

    @property
    def right(self) -> DataFrame:
        """Remainders of versions after an input."""
        return self._part(self.events.right)

    @property
    def neighbours(self) -> DataFrame:
        """Inputs with the bounds of the inputs around them."""
        ev = self.events
        inputs = self.timeline.where(F.col("__ev") == _L)
        return inputs.select(*ev.row_columns, *self.K, *self.H, FLAG, ev.prev_end.alias("prev_end"), ev.next_start.alias("next_start"))


def _canon(df: DataFrame, r: Resolved) -> DataFrame:
    df = with_canonical(df, r.key, "__k", r.types)
    return with_canonical(df, r.his, "__h", r.types)


class _Events:
    """Builds the timeline of one run and reads results off its scan."""

    def __init__(self, r: Resolved, K: list[str], H: list[str]):
        self.r, self.K, self.H = r, K, H
        self.bs, self.be = r.bus
        self.eff, self.exp = r.sys
        self.ident = [*r.key, *r.his, *H, self.bs, self.be]
        self.row_columns = [*r.key, *r.his, self.bs, self.be]
        self.open = ts_lit(BUS_OPEN_FROM, r.types[self.be])

    def _event(self, df: DataFrame, kind: int, at: str, flag: int | None, source: bool) -> DataFrame:
        t = self.r.types
        have = set(df.columns)
        row = [F.col(c) if c in have else F.lit(None).cast(t[c]).alias(c) for c in [*self.r.key, *self.r.his, self.bs, self.be, self.eff, self.exp]]
        hidden = [F.col(h) if h in have else F.lit(None).cast(t[c]).alias(h) for h, c in zip(self.H, self.r.his)]
        return df.select(*self.K, *hidden, *row, F.col(at).alias("__at"), F.lit(kind).alias("__ev"), F.lit(flag).cast("int").alias(FLAG), F.lit(source).alias("__src"))

    def versions(self, hot: DataFrame) -> DataFrame:
        return self._event(hot, _V, self.bs, None, False)

    def inputs(self, rows: DataFrame, flag: int, source: bool) -> DataFrame:
        return self._event(rows, _L, self.bs, flag, source).unionByName(self._event(rows, _R, self.be, flag, source))

    def deletes(self, points: DataFrame, at: str) -> DataFrame:
        return self._event(points, _D, at, None, False)

    def scan(self, events: DataFrame, slice_rows: int | None, check: bool) -> tuple[DataFrame, Layout]:
        """Every event with what lies around it, staged once; overlaps are counted on the way."""
        ev, s, e = F.col("__ev"), F.col(self.bs), F.col(self.be)
        lay = measure([(events, "__at")], self.K, slice_rows)
        order = ["__at", "__ev", self.be, FLAG, *self.H]
        own = F.struct(*self.ident)
        start = F.struct(s.alias("x"))
        t = carried(lay.deal(events, "__at"), lay, order, [
            ("__next_l", "next", F.when(ev == _L, start)), ("__next_d", "next", F.when(ev == _D, F.struct(F.col("__at").alias("x"))))])
        t = t.withColumn("__deleted", F.coalesce((ev == _V) & (F.col("__next_d.x") < e), F.lit(False)))
        t = carried(t, lay, order, [
            ("__last_l", "last", F.when(ev == _L, F.struct(*self.ident, FLAG))),
            ("__live", "last", F.when((ev == _V) & ~F.col("__deleted"), own)),
            ("__last_v", "last", F.when(ev == _V, own)),
            ("__reach_l", "max", F.when(ev == _L, e)),
            ("__reach_v", "max", F.when(ev == _V, e)),
            ("__reach_s", "max", F.when((ev == _L) & F.col("__src"), e)),
        ])
        touched = F.coalesce(F.col("__deleted") | (F.col("__reach_l") > s) | (F.col("__next_l.x") < e), F.lit(False))
        t = t.withColumn("__touched", (ev == _V) & touched)
        # rows equal to the one before count once
        t = t.withColumns({
            "__bad_v": F.coalesce((ev == _V) & (F.col("__reach_v") > s) & ~F.coalesce(F.col("__last_v") == own, F.lit(False)), F.lit(False)),
            "__bad_s": F.coalesce((ev == _L) & F.col("__src") & (F.col("__reach_s") > s), F.lit(False)),
        })
        t = t.withColumns({
            "__prev": F.col(f"__last_l.{self.be}"),
            "__alone": F.coalesce(F.col("__last_l") == F.struct(*self.ident, FLAG), F.lit(False)),  # at an input's end: no other input starts between
            "__live": F.when(ev.isin(_L, _R), F.col("__live")),
        }).drop("__last_v", "__last_l", "__reach_l", "__reach_v", "__reach_s", "__next_d", "__at", "__src")
        obs = Observation()
        ensure_checkpoint_dir(t.sparkSession)
        kinds = t.dtypes
        t = t.observe(obs, F.count_if("__bad_v").alias("v"), F.count_if("__bad_s").alias("s"))
        # in columns and compressed it takes a fraction of a checkpoint's rows; a checkpoint keeps cut rows spread as they were dealt,
        # and holds the void and interval columns that a table has not
        rows = lay.cuts is not None or any(x in k for _, k in kinds for x in ("void", "interval"))
        t = stage(t, "checkpoint" if rows else "table")
        # read back, canonical columns are never NULL again
        t = t.withColumns({h: canonical(h, self.r.types[c]) for h, c in [*zip(self.K, self.r.key), *zip(self.H, self.r.his)]})
        found = obs.get if check else {"v": 0, "s": 0}
        for label, n, bad in (("current target", found["v"], "__bad_v"), ("source", found["s"], "__bad_s")):
            if n:
                row = t.where(bad).select(*self.r.key, self.bs, self.be).first()
                raise OverlapError(f"{n} {label} periods overlap, for example {row.asDict()}; split_overlapping sets such rows aside")
        return t, lay

    # ---- results ----

    def row(self, v: str, s: Column, e: Column, flag) -> Column:
        """A fragment: the row of version struct ``v`` with another period."""
        return F.struct(*[F.col(f"{v}{c}").alias(c) for c in [*self.r.key, *self.r.his, *self.H]], s.alias(self.bs), e.alias(self.be), F.lit(flag).cast("int").alias(FLAG) if not isinstance(flag, Column) else flag.alias(FLAG))

    @property
    def prev_end(self) -> Column:
        prev = F.col("__prev")
        return F.when(prev >= self.open, F.col(self.bs)).otherwise(prev)

    @property
    def next_start(self) -> Column:
        nxt, e = F.col("__next_l.x"), F.col(self.be)
        return F.when((nxt < e) & (e < self.open), e).otherwise(nxt)

    @property
    def left(self) -> Column:
        """At an input's start: what remains of the version that holds it, after the input before."""
        s, vs, ve = F.col(self.bs), F.col(f"__live.{self.bs}"), F.col(f"__live.{self.be}")
        cut = (F.col("__ev") == _L) & (vs < s) & (ve > s) & null_or_before(self.prev_end, s)
        return F.when(cut, self.row("__live.", F.when(self.prev_end > vs, self.prev_end).otherwise(vs), s, 0))

    @property
    def right(self) -> Column:
        """At an input's end: what remains of the version that holds it, up to the next input (none starts inside)."""
        e, ve, nxt = F.col(self.be), F.col(f"__live.{self.be}"), F.col("__next_l.x")
        cut = (F.col("__ev") == _R) & F.col("__alone") & (ve > e) & null_or_not_meeting(nxt, e)
        return F.when(cut, self.row("__live.", e, F.when(nxt < ve, nxt).otherwise(ve), 1 if self.r.kem else 0))

    @property
    def loaded(self) -> Column:
        """An input itself, or a deleted version as one (flag 1)."""
        own = self.row("", F.col(self.bs), F.col(self.be), F.when(F.col("__ev") == _L, F.col(FLAG)).otherwise(1))
        return F.when((F.col("__ev") == _L) | F.col("__deleted"), own)

    def fragments(self, t: DataFrame, *parts: Column) -> DataFrame:
        some = F.filter(F.array(*parts), lambda x: x.isNotNull())
        return t.select(*self.K, F.inline(some))


def plan_temporal(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    driver: DataFrame | None = None,
    slice_rows: int | None = None,
    overlaps_checked: bool = False,
) -> TemporalPlan:
    """Build every stage of the bitemporal merge (decisions D4-D8, D17-D19, D23).

    The current target is scanned once: its rows of the run's keys (or, with a
    key master, of the run's master keys) are staged as ``hot``; the scanned timeline is
    staged too, and everything else is read off it.  A key with more than ``slice_rows``
    events (by default an eighth of a task's share) is dealt in time slices.

    The periods of a key must not overlap among the source rows to be loaded, nor
    among its current versions.  The scan counts both, and an overlap raises
    :class:`OverlapError`, unless the caller has checked (``overlaps_checked``).  Open ends
    are one instant: an input that ends at or after 9999-12-31 leaves no remainder when another starts inside it.
    """
    r = resolve_roles(src.schema, tgt.schema, roles, "temporal")
    bs, be = r.bus
    eff, exp = r.sys
    K = [f"__k{i}" for i in range(len(r.key))]
    H = [f"__h{i}" for i in range(len(r.his))]
    KM = K[: len(r.kem)]
    raw = r.key + r.his
    row = raw + [bs, be]
    base = [*row, *K, *H]
    as_of_c = ts_lit(as_of, r.types[exp])
    open_c = ts_lit(SYS_OPEN_END, r.types[exp])
    ev = _Events(r, K, H)

    s = _canon(src, r)
    cur = _canon(tgt.filter(F.col(exp) > as_of_c), r)
    drv = None
    if r.kem:
        d = driver if driver is not None else src
        drv = with_canonical(d, r.kem, "__k", r.types).select(*KM, F.col(bs).alias("__m_s"), F.col(be).alias("__m_e")).distinct()
        touch_cols = KM
        touch = s.select(*KM).unionByName(drv.select(*KM)).distinct()
    else:
        touch_cols = K
        touch = s.select(*K).distinct()
    # Current versions of every key (master key) the run can touch: one pass over the target, not dealt by key.
    hot = stage(join_on(cur, touch, touch_cols, "left_semi").select(*base, eff, exp))

    flag = F.coalesce(F.col(r.opr).cast("string"), F.lit("")) if r.opr else None
    keep = s.filter(flag != DELETE_FLAG) if r.opr else s
    events = [ev.versions(hot), ev.inputs(keep.select(*base).distinct(), 0, True)]
    points = s.filter(flag == DELETE_FLAG).select(*K, F.col(bs).alias("__d_s")).distinct() if r.opr else None
    if points is not None:
        events.append(ev.deletes(points, "__d_s"))
    if r.kem:
        # U16: current versions of a driver master key whose period contains the driver
        # period, where the source lacks that full key with that period.
        held = containing(hot.select(*base), drv, KM, bs, be, "__m_s", "__m_e")
        if points is not None:  # a delete and a key-master row for one version: the delete counts
            gone, _ = ev.scan(ev.versions(hot).unionByName(ev.deletes(points, "__d_s")), slice_rows, False)
            gone = gone.where("__deleted").select(*K, *H, F.col(bs).alias("__m_s"), F.col(be).alias("__m_e"))
            held = join_on(held, gone, [*K, *H, "__m_s", "__m_e"], "left_anti")
        have = s.select(*K, F.col(bs).alias("__m_s"), F.col(be).alias("__m_e")).distinct()
        expiring = join_on(held, have, [*K, "__m_s", "__m_e"], "left_anti")
        expiring = expiring.select(*raw, F.col("__m_s").alias(bs), F.col("__m_e").alias(be), *K, *H).distinct()
        events.append(ev.inputs(stage(expiring), 1, False))  # read by the layout, and twice by the scan

    every = events[0]
    for e in events[1:]:
        every = every.unionByName(e)
    t, lay = ev.scan(every, slice_rows, not overlaps_checked)

    frag = ev.fragments(t, ev.loaded, ev.left, ev.right)
    # a remainder may begin in another slice; dealt by the whole key, islands and their fates need no shuffle of their own
    frag = lay.deal(frag, bs)
    norm = islands(frag, lay, [*H, FLAG], raw, bs, be)

    # A version and the coalesced rows of its identity (one with flag 0, one with flag 1 at most) settle its fate.
    ident = K + H + [bs, be]
    is0 = F.col(FLAG) == 0
    flags = norm.groupBy(*ident).agg(
        F.max(is0.cast("int")).alias("__n0"),
        F.max((~is0).cast("int")).alias("__n1"),
        *[F.max(F.when(is0, F.col(c))).alias(f"__r_{c}") for c in raw],
    )
    # Rows that a version stands in several times, or with several system ends, are settled as one, where they lie.
    own = [*base, eff] + ([SLICE] if lay.cuts is not None else [])
    versions = t.where(F.col("__ev") == _V).groupBy(*own).agg(
        F.bool_or("__touched").alias("__touched"), F.bool_or(F.col(exp) != open_c).alias("__ends"), F.lit(True).alias("__hot")).drop(SLICE)
    both = join_on(versions, flags, ident, "full_outer")
    on_hot = F.coalesce(F.col("__hot"), F.lit(False))
    n0 = F.coalesce(F.col("__n0"), F.lit(0)) == 1
    n1 = F.coalesce(F.col("__n1"), F.lit(0)) == 1
    fate = (
        F.when(~on_hot & n0, F.lit("new"))
        .when(on_hot & n0 & F.col("__ends"), F.lit("refresh"))  # D18
        # a flag-0 identical row wins over flag 1; D4: only versions that overlap an input, with no identical coalesced row
        .when(on_hot & ~n0 & (n1 | F.col("__touched")), F.lit("close"))
    )
    is_new, is_close = F.col("__fate") == "new", F.col("__fate") == "close"
    merge_set = both.withColumn("__fate", fate).where("__fate IS NOT NULL").select(
        *ident, *[F.when(is_new, F.col(f"__r_{c}")).otherwise(F.col(c)).alias(c) for c in raw],
        F.when(is_new, as_of_c).otherwise(F.col(eff)).alias(eff), F.when(is_close, as_of_c).otherwise(open_c).alias(exp),
    ).select(*row, eff, exp)

    return TemporalPlan(r, K, H, cur, hot, t, norm, merge_set, ev)


def temporal_merge_set(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    driver: DataFrame | None = None,
) -> DataFrame:
    """Versions to insert, refresh and close: key, HIS, business period, system period."""
    return plan_temporal(src, tgt, roles, as_of, driver).merge_set


def temporal_merge(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    driver: DataFrame | None = None,
    keep_action: bool = False,
    slice_rows: int | None = None,
) -> DataFrame:
    """The whole new target: merge set applied on key + business period + HIS."""
    p = plan_temporal(src, tgt, roles, as_of, driver, slice_rows)
    r = p.roles
    return apply_versions(tgt, p.merge_set, r.key + r.bus + r.his, r.sys, as_of, keep_action, hot=p.hot)
