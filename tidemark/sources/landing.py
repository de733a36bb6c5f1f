"""File landing as a batch job (U1 batch twin, U2, S1-S3, S7, S8) and table writers.

A landing record is ``(src_file_nm string, load_ts timestamp_ntz, value variant)``:
the file the row came from (the scan's ``_metadata.file_path``), the load time,
and the whole record as a variant.  The scan is a plain file source, so it splits
files across tasks like any other read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("src_file_nm", T.StringType()),
        T.StructField("load_ts", T.TimestampNTZType()),
        T.StructField("value", T.VariantType()),
    ]
)


def record_variant(df: DataFrame, value_col: str | None = None) -> Column:
    """The whole record as one variant object (``$1`` of the landing copy)."""
    if value_col is not None:
        return F.col(value_col)
    data = [c for c in df.columns]
    return F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in data]))


def landing_frame(df: DataFrame, value_col: str | None = None, load_ts: Column | None = None) -> DataFrame:
    """Project a file-source frame to the landing schema."""
    return df.select(
        F.col("_metadata.file_path").alias("src_file_nm"),
        (load_ts if load_ts is not None else F.localtimestamp()).alias("load_ts"),
        record_variant(df, value_col).alias("value"),
    )


#: Reader options that keep whole records where files of one folder differ: columns of all parquet and ORC files
#: (a column that a file lacks is null in its rows), and an error when a CSV header is not the one read by.
_WHOLE = {"parquet": {"mergeSchema": "true"}, "orc": {"mergeSchema": "true"}, "csv": {"enforceSchema": "false"}}


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None, options: dict | None, stream: bool):
    r = spark.readStream if stream else spark.read
    r = r.format(fmt)
    opts = {**_WHOLE.get(fmt, {}), **(options or {})}
    value_col = None
    if fmt == "json" and "singleVariantColumn" not in opts and schema is None:
        # JSON lands whole: one variant per record, shapes may differ per file.
        opts["singleVariantColumn"] = "value"
    if fmt == "json" and "singleVariantColumn" in opts:
        value_col = opts["singleVariantColumn"]
    if schema is not None and value_col is None:
        r = r.schema(schema)
    return r.options(**opts), value_col


def land_batch(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Every record under ``path`` as a landing row (batch twin of :func:`land_stream`).

    ``fmt`` is any file source name (parquet, json, csv, orc, text, xml ...);
    ``options`` go to the reader (e.g. ``pathGlobFilter``, ``header``). Files of one folder may differ in their
    columns: parquet and ORC land the columns of all files, CSV files with another header fail.
    """
    r, value_col = _reader(spark, fmt, schema, options, stream=False)
    return landing_frame(r.load(path), value_col)


BAD = "bad_record"


def _header(spark: SparkSession, file: str, options: dict) -> tuple[str, ...]:
    return tuple(spark.read.format("csv").options(**{**options, "inferSchema": "false"}).load(file).columns)


def _named(options: dict) -> bool:
    return str(options.get("header", "false")).lower() == "true"


def land_files(spark: SparkSession, files: list[str], fmt: str, schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:
    """The records of ``files`` as landing rows with ``bad_record``: the raw text of a record that is malformed, else NULL.

    Each file is read by its own columns: parquet and ORC files by the columns of all of them (by their own, where types
    conflict), CSV files with a header in groups of equal headers.  JSON lines are parsed one by one, so a broken one is
    set aside with its text (``multiLine``: a file is one record); CSV and XML records that do not fit are found
    by the reader.  A bad record has a NULL value.
    """
    opts = {k: v for k, v in (options or {}).items() if k not in ("pathGlobFilter", "recursiveFileLookup")}
    none = F.lit(None).cast("string").alias(BAD)
    if fmt == "json":
        whole = str(opts.get("multiLine", "false")).lower() == "true"
        lines = spark.read.option("wholetext", whole).text(files).where(F.trim("value") != "")
        value = F.try_parse_json("value")
        return lines.select(F.col("_metadata.file_path").alias("src_file_nm"), F.localtimestamp().alias("load_ts"), value.alias("value"),
                            F.when(value.isNull(), F.col("value")).alias(BAD))
    if fmt in ("csv", "xml"):
        groups: dict[tuple, list[str]] = {}
        if fmt == "csv" and schema is None and _named(opts):
            for f in files:
                groups.setdefault(_header(spark, f, opts), []).append(f)
        else:
            groups[()] = list(files)
        out = None
        for names, some in groups.items():
            own = schema or (T.StructType([T.StructField(c, T.StringType()) for c in names]) if names else spark.read.format(fmt).options(**opts).load(some).schema)
            own = T.StructType([f for f in own.fields if f.name != "__bad"])
            read = spark.read.format(fmt).options(**opts).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad")
            df = read.schema(T.StructType([*own.fields, T.StructField("__bad", T.StringType())])).load(some)
            value = F.when(F.col("__bad").isNull(), F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in own.fieldNames()])))
            one = df.select(F.col("_metadata.file_path").alias("src_file_nm"), F.localtimestamp().alias("load_ts"), value.alias("value"), F.col("__bad").alias(BAD))
            out = one if out is None else out.unionByName(one)
        return out
    r, value_col = _reader(spark, fmt, schema, opts, stream=False)
    try:
        return landing_frame(r.load(files), value_col).withColumn(BAD, none)
    except (Py4JJavaError, PySparkException) as e:
        if "MERGE_SCHEMAS" not in str(e) or len(files) == 1:
            raise
    alike: dict[str, list[str]] = {}  # a name with two types: files of one schema together
    for f in files:
        alike.setdefault(spark.read.format(fmt).options(**opts).load(f).schema.json(), []).append(f)
    out = None
    for some in alike.values():
        one = landing_frame(r.load(some), value_col).withColumn(BAD, none)
        out = one if out is None else out.unionByName(one)
    return out


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing rows under ``path`` (a sink of :func:`..streaming.landing.land_stream_checked` or of a batch)."""
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def create_landing(spark: SparkSession, path: str, replace: bool = True) -> DataFrame:
    """(Re)create an empty landing table at ``path`` (U2); earlier content is dropped.

    A stream writing into it must start from a fresh checkpoint afterwards, or it
    would believe the old files are already loaded.
    """
    empty = spark.createDataFrame([], LANDING_SCHEMA)
    empty.write.mode("overwrite" if replace else "errorifexists").parquet(path)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Write a frame as parquet.  Overwrite a *new* path and swap, never the one being read."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
