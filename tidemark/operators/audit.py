"""Run audit log (U26, S10, F13): one append of a small frame per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("log_ts", T.TimestampNTZType()),
        T.StructField("src_nm", T.StringType()),
        T.StructField("user_nm", T.StringType()),
        T.StructField("role_nm", T.StringType()),
        T.StructField("wh_nm", T.StringType()),
        T.StructField("msg_txt", T.StringType()),
        T.StructField("extra_txt", T.StringType()),
    ]
)


def audit_frame(spark: SparkSession, src_nm: str, messages: list[tuple[str, str | None]]) -> DataFrame:
    """The audit rows of one run: stage message + detail, stamped with user and time.

    Role and warehouse have no Spark counterpart and stay NULL.
    """
    base = spark.createDataFrame(
        [(i, m, x) for i, (m, x) in enumerate(messages)], "seq int, msg_txt string, extra_txt string"
    )
    return base.orderBy("seq").select(
        F.localtimestamp().alias("log_ts"),
        F.lit(src_nm).alias("src_nm"),
        F.current_user().alias("user_nm"),
        F.lit(None).cast("string").alias("role_nm"),
        F.lit(None).cast("string").alias("wh_nm"),
        "msg_txt",
        "extra_txt",
    )


def audit(spark: SparkSession, path: str, src_nm: str, rows: DataFrame) -> DataFrame:
    """Append ``rows`` (``msg_txt, extra_txt``) to the audit table at ``path``; returns them."""
    out = rows.select(
        F.localtimestamp().alias("log_ts"),
        F.lit(src_nm).alias("src_nm"),
        F.current_user().alias("user_nm"),
        F.lit(None).cast("string").alias("role_nm"),
        F.lit(None).cast("string").alias("wh_nm"),
        F.col("msg_txt").cast("string"),
        F.col("extra_txt").cast("string"),
    )
    out.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def audit_run(spark: SparkSession, path: str, run_id: str, src_nm: str, messages: list[tuple[str, str | None]]) -> DataFrame:
    """Log the messages of one run under its id; a run that is repeated replaces its rows instead of adding some."""
    audit_frame(spark, src_nm, messages).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")
    return spark.read.parquet(path)
