"""Materialising a stage that several branches of a plan read.

The merges read their input set, the current versions of the touched keys and
the coalesced set several times each; left lazy, every branch would recompute the
whole upstream plan (and re-scan the target).  These stages are delta-sized, so
they are cut once into the shared checkpoint folder (``spark.checkpoint.dir``), as
they lie: dealing them by key would put every row of a hot key into one task.  A
lost executor re-reads the checkpoint instead of recomputing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_path

MODES = ("table", "checkpoint", "persist", "none")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is defined and written here gives its shuffle files back when it is written, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Materialise ``df``.

    ``table``: written as parquet to a new folder under the shared checkpoint root
    and read back (columnar, compressed; lineage cut); ``checkpoint``: Spark's
    reliable checkpoint (keeps the partitioning, lineage cut); ``persist``:
    cached, recomputed on loss; ``none``: left lazy.
    """
    if mode not in MODES:
        raise ValueError(f"stage mode must be one of {MODES}, not {mode!r}")
    if mode == "none":
        return df
    if mode == "table":
        path = scratch_path(df.sparkSession, "stage")
        with shuffles_freed(df.sparkSession):
            df.write.option("compression", "zstd").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
