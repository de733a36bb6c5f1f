"""Continuous file landing with Structured Streaming (U1, T1-T3) and a merge adapter.

The file source keeps a log of the files it has committed in the checkpoint, so a
restart loads only new files and never one twice.  ``availableNow`` drains what
is there and stops (for jobs); ``processingTime`` keeps polling (for services).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import LANDING_SCHEMA, _reader, land_files, landing_frame
from ..sources.variant import discover_paths, save_paths, top_fields


def landing_stream_frame(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Streaming frame of landing rows over the files under ``path``.

    File streams need a schema; for non-JSON sources without one it is taken from
    all files present now (a metadata read, done anew at each start); :func:`land_stream_checked` lands
    columns that later files bring while it runs.  JSON without a schema lands whole
    records as variants, exactly as the batch reader does.
    """
    if schema is None and fmt != "json":
        schema = _reader(spark, fmt, None, options, stream=False)[0].load(path).schema
    r, value_col = _reader(spark, fmt, schema, options, stream=True)
    return landing_frame(r.load(path), value_col)


def land_stream(
    spark: SparkSession,
    path: str,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict | None = None,
    trigger: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append every new file under ``path`` to the landing table at ``sink`` (parquet).

    ``trigger=None`` runs ``availableNow`` (and waits when ``wait``); otherwise it is a
    ``processingTime`` interval such as ``'1 minute'``.  ``checkpoint`` must be a
    shared folder; a fresh one re-lands everything (use with :func:`create_landing`).
    """
    df = landing_stream_frame(spark, path, fmt, schema, options)
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    q = w.outputMode("append").start()
    if trigger is None and wait:
        q.awaitTermination()
    return q


class SchemaDrift(ValueError):
    """Files brought columns or types that the log of the landing does not know, and drift is refused."""


_NUMBERS = ("bigint", "int", "decimal", "double", "float")


def schema_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, field, type, is_new``: the top-level fields that each batch brought, and which no batch before had."""
    return spark.read.schema("batch_id long, field string, type string, is_new boolean").parquet(f"{checkpoint.rstrip('/')}/schema_log")


def land_stream_checked(
    spark: SparkSession,
    path: str,
    sink: str,
    quarantine: str,
    checkpoint: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict | None = None,
    on_drift: str = "widen",
    max_files: int = 1000,
    paths: str | None = None,
    trigger: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Land every new file under ``path`` whole, whatever columns it has, and set malformed records aside.

    The stream lists files only (never their content); each micro-batch reads its at most ``max_files`` files by their own
    columns (:func:`..sources.landing.land_files`), so a column that a later file brings is landed by the running
    stream.  Per batch one folder ``batch_id=N`` is written to ``sink`` (landing rows), one to ``quarantine`` (file name,
    load time, raw text), and one to the schema log under ``checkpoint``; a batch that is repeated after a failure
    overwrites its own folders, so nothing lands twice.  Records read, landed and set aside are counted while they
    are written and must agree.  ``on_drift="fail"`` raises :class:`SchemaDrift` before anything of the batch is written
    when a file has a field, or a type of a field, that no batch had before; the files stay to be landed.  ``paths``: a folder
    in which the paths of each batch are saved (:func:`..sources.variant.saved_paths` has those of all).
    """
    if on_drift not in ("widen", "fail"):
        raise ValueError("on_drift is 'widen' or 'fail'")
    listing = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    listing = listing.option("maxFilesPerTrigger", max_files)
    for k in ("pathGlobFilter", "recursiveFileLookup"):
        if options and k in options:
            listing = listing.option(k, options[k])
    log = f"{checkpoint.rstrip('/')}/schema_log"

    def land(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        files = [r["path"] for r in batch.select("path").collect()]  # at most max_files names
        if not files:
            return
        rows = land_files(own, files, fmt, schema, options)
        found = rows.where("value IS NOT NULL").agg(F.schema_of_variant_agg("value").alias("s")).first()["s"]
        # numbers are one kind whatever their width; a field seen as null only has no kind yet
        seen = {f: "number" if t.startswith(_NUMBERS) else t.split("<")[0] for f, t in top_fields(found).items() if t != "void"}
        try:
            earlier = {(r["field"], r["type"]) for r in schema_log(own, checkpoint).where(F.col("batch_id") < batch_id).collect()}
        except AnalysisException:  # the first batch
            earlier = set()
        new = {f for f in seen.items() if f not in earlier}
        if on_drift == "fail" and earlier and new:
            raise SchemaDrift(f"batch {batch_id} brings {sorted(new)}")
        entries = [(f, t, (f, t) in new) for f, t in seen.items()]
        own.createDataFrame(entries, "field string, type string, is_new boolean").write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
        good, bad = Observation(), Observation()
        is_bad = F.col("bad_record").isNotNull()
        counts = [F.count(F.lit(1)).alias("n"), F.count_if(is_bad).alias("bad")]
        rows.observe(good, *counts).where(~is_bad).drop("bad_record").write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")
        rows.observe(bad, *counts).where(is_bad).drop("value").write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
        if paths is not None:
            save_paths(discover_paths(own.read.schema(LANDING_SCHEMA).parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")), paths, batch_id)
        if good.get != bad.get:
            raise RuntimeError(f"batch {batch_id}: the files changed while they were landed ({good.get}, then {bad.get})")

    return merge_each_batch(listing.load(path).select("path"), f"{checkpoint.rstrip('/')}/files", land, trigger, wait)


def merge_each_batch(
    stream: DataFrame,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    trigger: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Run ``apply(batch_df, batch_id)`` per micro-batch, e.g. a type-2 or bitemporal merge
    of the landed rows into a target (write a new current table per batch).

    ``trigger=None`` drains what is there (``availableNow``) and waits when ``wait``;
    otherwise a ``processingTime`` interval such as ``'5 minutes'`` for a service.
    """
    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    q = w.start()
    if trigger is None and wait:
        q.awaitTermination()
    return q
