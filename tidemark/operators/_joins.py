"""Join helper on hidden canonical columns shared by both sides."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on(
    left: DataFrame,
    right: DataFrame,
    cols: list[str],
    how: str = "inner",
    extra: Column | None = None,
) -> DataFrame:
    """Null-safe equi-join on columns named alike on both sides.

    The right side's copies are renamed before the join and dropped after it, so
    the result carries each join column once.  On the non-nullable canonical
    columns Catalyst reduces ``<=>`` to ``=``, so the keys stay plain hash keys and
    exchanges on the same columns are shared across joins and windows.  ``extra``
    may reference right-side columns by their own (non-join) names.
    """
    if not cols:
        raise ValueError("join_on needs at least one column")
    ren = {c: f"{c}__r" for c in cols}
    r = right.select(*[F.col(c).alias(ren[c]) if c in ren else F.col(c) for c in right.columns])
    cond = reduce(and_, [left[c].eqNullSafe(r[ren[c]]) for c in cols])
    if extra is not None:
        cond = cond & extra
    out = left.join(r, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return out
    if how in ("right", "right_outer", "rightouter"):
        for c in cols:
            out = out.withColumn(c, F.col(ren[c]))
    elif how in ("full", "full_outer", "outer", "fullouter"):
        for c in cols:
            out = out.withColumn(c, F.coalesce(left[c], F.col(ren[c])))
    return out.drop(*ren.values())
