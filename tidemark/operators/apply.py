"""Version upsert without MERGE (U22, U23) and merge metrics.

File tables have no ``MERGE INTO``; the new target is a copy-on-write rewrite:
history rows pass through untouched (no shuffle), current rows take a new system
end where the merge set matches them, and unmatched merge-set rows are appended.
Only current rows meet the merge set, through joins that AQE turns into
broadcasts when the merge set is small and into shuffled hash/sort-merge joins
when it is not.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.nulls import with_canonical
from ..functions.periods import ts_lit
from ._joins import join_on

ACTION = "__action"


def apply_versions(
    tgt: DataFrame,
    merge_set: DataFrame,
    on: list[str],
    sys: tuple[str, str] | list[str],
    as_of: str | _dt.datetime,
    keep_action: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Apply a merge set to a versioned target; returns the whole new target.

    Match: NULL-or-default equality on ``on`` among current target rows
    (``sys_end > as_of``).  Matched with a different system end: the end is set to
    the merge set's; unmatched merge-set rows are inserted.  When several
    merge-set rows match one target row, the latest end wins (a keep beats a
    close), so a target row is never duplicated.

    With ``keep_action`` the result has a column ``__action`` in
    ``history | current | update | insert`` for :func:`merge_summary`.
    ``hot``: already materialised current rows holding every key of the merge
    set (the merges pass theirs), so finding inserts does not scan the target again.
    """
    eff, exp = sys
    types = {f.name: f.dataType for f in tgt.schema.fields}
    is_cur = F.col(exp) > ts_lit(as_of, types[exp])
    canon = [f"__o{i}" for i in range(len(on))]

    rest = tgt.filter(~F.coalesce(is_cur, F.lit(False))).withColumn(ACTION, F.lit("history"))
    cur = with_canonical(tgt.filter(is_cur), on, "__o", types)
    m = with_canonical(merge_set, on, "__o", types)

    new_end = m.groupBy(*canon).agg(F.max(exp).alias("__new_exp"))
    upd = join_on(cur, new_end, canon, "left")
    changed = F.col("__new_exp").isNotNull() & (F.col("__new_exp") != F.col(exp))
    upd = upd.select(
        *[F.when(changed, F.col("__new_exp")).otherwise(F.col(exp)).alias(c) if c == exp else F.col(c)
          for c in tgt.columns],
        F.when(changed, F.lit("update")).otherwise(F.lit("current")).alias(ACTION),
    )

    # Only current rows of keys in the merge set can match an insert candidate.
    if hot is None:
        hot_on = join_on(cur, m.select(*canon).distinct(), canon, "left_semi").select(*canon)
    else:
        hot_on = with_canonical(hot.select(*on), on, "__o", types).select(*canon)
    ins = join_on(m, hot_on, canon, "left_anti").withColumn(ACTION, F.lit("insert"))
    ins = ins.select(*[F.col(c) if c in ins.columns else F.lit(None).cast(types[c]).alias(c)
                       for c in tgt.columns], ACTION)

    out = rest.unionByName(upd).unionByName(ins)
    return out if keep_action else out.drop(ACTION)


def merge_summary(applied: DataFrame) -> DataFrame:
    """Rows inserted and rows updated, one row, from :func:`apply_versions` with actions."""
    return applied.agg(
        F.count_if(F.col(ACTION) == "insert").alias("rows_inserted"),
        F.count_if(F.col(ACTION) == "update").alias("rows_updated"),
    )


def observed(applied: DataFrame, obs: Observation) -> DataFrame:
    """``applied`` (with actions), its inserted and updated rows counted by ``obs`` while it is written."""
    return applied.observe(
        obs,
        F.count_if(F.col(ACTION) == "insert").alias("rows_inserted"),
        F.count_if(F.col(ACTION) == "update").alias("rows_updated"),
    )


def write_merged(applied: DataFrame, path: str) -> dict:
    """Write a merged target (with actions) to a new ``path`` in one job; returns the rows inserted and updated in it."""
    obs = Observation()
    observed(applied, obs).drop(ACTION).write.parquet(path)
    return dict(obs.get)


def split_applied(applied: DataFrame, sys: tuple[str, str] | list[str], as_of) -> tuple[DataFrame, DataFrame]:
    """Cut a merged target (with actions) into ``(closed_now, current)``.

    For a two-table layout, where history is append-only and only the current
    table is rewritten: ``closed_now`` holds the versions this run closed (append
    them to history); ``current`` holds every version still current (the new
    current table). Rows that were history before the run belong to neither.
    """
    _, exp = sys
    types = {f.name: f.dataType for f in applied.schema.fields}
    still = F.col(exp) > ts_lit(as_of, types[exp])
    run_rows = applied.filter(F.col(ACTION) != "history")
    closed = run_rows.filter(~F.coalesce(still, F.lit(False))).drop(ACTION)
    current = run_rows.filter(still).drop(ACTION)
    return closed, current


def write_split(
    applied: DataFrame, sys: tuple[str, str] | list[str], as_of, history_path: str, run_path: str
) -> tuple[str, dict]:
    """Write one merge run in the two-table layout.

    One job writes the run's rows partitioned into ``closed`` and ``current`` under
    ``run_path`` (a new folder) and observes the merge metrics on the way; the
    closed rows (delta-sized) are then appended to the history table. History is
    never rewritten, and the table being read is never overwritten. Pass the
    *current* table as the merge target. Returns the new current table's path and
    ``{"rows_inserted": n, "rows_updated": m}``.
    """
    _, exp = sys
    types = {f.name: f.dataType for f in applied.schema.fields}
    still = F.coalesce(F.col(exp) > ts_lit(as_of, types[exp]), F.lit(False))
    part = F.when(still, F.lit("current")).otherwise(F.lit("closed"))
    obs = Observation()
    (observed(applied, obs).filter(F.col(ACTION) != "history")
     .withColumn("__part", part).drop(ACTION)
     .write.partitionBy("__part").parquet(run_path))
    metrics = dict(obs.get)
    spark = applied.sparkSession
    closed_dir = f"{run_path.rstrip('/')}/__part=closed"
    try:
        closed = spark.read.parquet(closed_dir)
    except AnalysisException:  # no version closed in this run: the folder does not exist
        closed = None
    if closed is not None:
        closed.write.mode("append").parquet(history_path)
    return f"{run_path.rstrip('/')}/__part=current", metrics
