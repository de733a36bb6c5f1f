"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins, so no node's neighbours are ever gathered in one
task; hubs are pre-aggregated by Spark's partial aggregation and skewed joins are split by AQE.
Edges are cut with ``checkpoint()`` after each round, so lost executors re-read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir


def _finger(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; ``component`` is the smallest node reachable.

    Edges with a null end and loops between a node and itself link nothing; repeated edges count
    once; an empty edge table gives an empty result.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    nodes = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = nodes.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = _finger(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        # large star: every neighbour above u is hung on the least of u and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are hung on the least of them
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        hung = e.join(least, "u")
        e = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        after = _finger(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    heads = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads.select("node", F.col("node").alias("component")))
