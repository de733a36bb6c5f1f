"""Type-2 history merge on one time axis.

Plan shape: the source is reduced to distinct (key, HIS) rows and distinct keys;
the current target meets them only through semi/anti joins on the canonical key
(and key + HIS), which never emit pairs, so a hot key cannot blow up a task.
The small sides are broadcast by AQE when their measured size allows it.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import with_canonical
from ..functions.periods import SYS_OPEN_END, ts_lit
from ._joins import join_on
from ._stage import stage
from .apply import apply_versions
from .roles import Resolved, Roles, resolve_roles

# Fixed value: the logical-delete marker in the OPR column (must equal the reference's).
DELETE_FLAG = "E"


def _canon(df: DataFrame, r: Resolved) -> DataFrame:
    df = with_canonical(df, r.key, "__k", r.types)
    return with_canonical(df, r.his, "__h", r.types)


class ScdPlan(NamedTuple):
    merge_set: DataFrame
    hot: DataFrame


def scd2_merge_set(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    window: str | None = None,
    stage_mode: str = "checkpoint",
) -> DataFrame:
    """Versions to insert and to close for a type-2 merge (see :func:`plan_scd2`)."""
    return plan_scd2(src, tgt, roles, as_of, window, stage_mode).merge_set


def plan_scd2(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    window: str | None = None,
    stage_mode: str = "checkpoint",
) -> ScdPlan:
    """Versions to insert and to close for a type-2 merge.

    * source row whose key has no identical current version: inserted
      ``[as_of, open)`` (new keys too, decision D1);
    * current version of a source key that differs from every source row of the
      key: closed at ``as_of``;
    * with ``roles.opr``: rows flagged ``'E'`` are not loaded and close the current
      versions of their key, in delta mode as well (D2);
    * with ``window`` (a SQL predicate over the target only, D15): current versions
      inside it whose key is absent from the source are closed too (full mode).

    Columns: key, HIS, system start, system end; exact duplicates collapse.
    The current versions of the source's keys (and, in full mode, those inside the
    window, by a scan of their own that the predicate reaches) are materialised
    together with the distinct source rows; both are delta-sized (or window-sized).
    """
    r = resolve_roles(src.schema, tgt.schema, roles, "scd2")
    eff, exp = r.sys
    K = [f"__k{i}" for i in range(len(r.key))]
    H = [f"__h{i}" for i in range(len(r.his))]
    as_of_c = ts_lit(as_of, r.types[exp])
    open_c = ts_lit(SYS_OPEN_END, r.types[exp])
    out_cols = r.key + r.his

    s = _canon(src, r)
    if r.opr:
        flag = F.coalesce(F.col(r.opr).cast("string"), F.lit(""))
        keep = s.filter(flag != DELETE_FLAG)
        dels = s.filter(flag == DELETE_FLAG).select(*K).distinct()
    else:
        keep, dels = s, None
    inp = stage(keep.select(*out_cols, *K, *H).distinct(), mode=stage_mode)  # lies by key and HIS, so a hot key is spread
    inp_keys = inp.select(*K).distinct()
    run_keys = s.select(*K).distinct()

    cur = _canon(tgt.filter(F.col(exp) > as_of_c), r)
    keep_cols = [*out_cols, eff, exp, *K, *H]
    # Current versions of the source's keys, plus in full mode the versions inside the window of other keys.
    if window:
        # two scans, so that the window predicate reaches the second one
        of_run = join_on(cur, run_keys, K, "left_semi").select(*keep_cols, F.lit(True).alias("__hit"))
        beside = join_on(cur.filter(F.expr(window)), run_keys, K, "left_anti").select(*keep_cols, F.lit(False).alias("__hit"))
        hot = stage(of_run.unionByName(beside), mode=stage_mode)
        orphans = hot.filter(~F.col("__hit"))
        in_run = hot.filter(F.col("__hit"))
    else:
        hot = stage(join_on(cur, run_keys, K, "left_semi").select(*keep_cols), mode=stage_mode)
        orphans, in_run = None, hot

    changed = join_on(join_on(in_run, inp_keys, K, "left_semi"), inp.select(*K, *H), K + H, "left_anti")
    closing = [changed]
    if dels is not None:
        closing.append(join_on(in_run, dels, K, "left_semi"))
    if orphans is not None:
        closing.append(orphans)
    close = closing[0].select(*keep_cols)
    for c in closing[1:]:
        close = close.unionByName(c.select(*keep_cols))
    close = close.select(*out_cols, F.col(eff), as_of_c.alias(exp)).distinct()

    insert = join_on(inp, in_run.select(*K, *H), K + H, "left_anti").select(
        *out_cols, as_of_c.alias(eff), open_c.alias(exp)
    )
    return ScdPlan(insert.unionByName(close), hot)


def source_duplicates(src: DataFrame, tgt: DataFrame, roles: Roles) -> DataFrame:
    """Source keys carrying more than one distinct HIS row (D16 report).

    Such keys would get two current versions; exact duplicate rows are not
    reported (they collapse).  Columns: key columns, ``n_versions``.
    """
    r = resolve_roles(src.schema, tgt.schema, roles, "scd2")
    K = [f"__k{i}" for i in range(len(r.key))]
    H = [f"__h{i}" for i in range(len(r.his))]
    s = _canon(src, r)
    if r.opr:
        s = s.filter(F.coalesce(F.col(r.opr).cast("string"), F.lit("")) != DELETE_FLAG)
    rows = s.select(*K, *H, *r.key).groupBy(*K, *H).agg(*[F.max(k).alias(k) for k in r.key])
    return rows.groupBy(*K).agg(
        *[F.max(k).alias(k) for k in r.key], F.count(F.lit(1)).alias("n_versions")
    ).filter(F.col("n_versions") > 1).drop(*K)


def scd2_merge(
    src: DataFrame,
    tgt: DataFrame,
    roles: Roles,
    as_of: str | _dt.datetime,
    window: str | None = None,
    keep_action: bool = False,
) -> DataFrame:
    """The whole new target after a type-2 merge (merge set applied on key, HIS and system start)."""
    r = resolve_roles(src.schema, tgt.schema, roles, "scd2")
    p = plan_scd2(src, tgt, roles, as_of, window)
    return apply_versions(tgt, p.merge_set, r.key + r.his + [r.sys[0]], r.sys, as_of, keep_action, hot=p.hot)
