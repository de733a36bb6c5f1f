"""Test frames F1-F5 (FIXTURES.md section 3) built on the driver's tables, and F6 (ours):
25 nation timelines, so that every key is hot.

The modulus expressions decide *which* rows change, are deleted or are new, so
each merge has every case to handle; the targets span the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.periods import SYS_OPEN_END, ts_lit
from ..operators.periods import neighbour_bounds

AS_OF = "2024-06-01 00:00:00"
SYS_START = "2020-01-01 00:00:00"
BUS_OPEN = "9999-12-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(n: int):
    return F.expr(f"INTERVAL {n} DAYS")


def f1_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    now = c.filter(F.col("c_custkey") % 20 != 3).select(
        "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey",
        ts_lit(SYS_START).alias("icw_eff_ts"), ts_lit(SYS_OPEN_END).alias("icw_exp_ts"),
    )
    old = c.filter(F.col("c_custkey") % 4 == 0).select(
        "c_custkey", F.lit("OLD").alias("c_mktsegment"), "c_acctbal", "c_nationkey",
        ts_lit("2019-01-01 00:00:00").alias("icw_eff_ts"), ts_lit(SYS_START).alias("icw_exp_ts"),
    )
    return now.unionByName(old)


def f1_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.filter(k % 7 != 0).select(
        "c_custkey",
        F.when(k % 10 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(k % 15 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_nationkey",
        F.when(k % 25 == 0, F.lit("E")).alias("opr"),
    )


def _apart(df: DataFrame, key: list[str], date: str, tie: str) -> DataFrame:
    """``bus_eff_ts``: the date, later by a millisecond for each earlier row of the same key and date, so no row is lost to a tie."""
    nth = F.row_number().over(Window.partitionBy(*key, date).orderBy(tie)) - 1
    return df.withColumn("bus_eff_ts", F.col(date) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), nth.cast("decimal(18,6)") / 1000))


def _closed_by_next(df: DataFrame, key: list[str], tie: str) -> DataFrame:
    """``bus_exp_ts``: the start of the key's next row, or open."""
    nb = neighbour_bounds(df, key, "bus_eff_ts", "bus_eff_ts", [tie])
    return nb.withColumn("bus_exp_ts", F.coalesce("next_start", ts_lit(BUS_OPEN))).drop("prev_end", "next_start")


def f2_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order from its date to the customer's next one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey"))
    nb = _closed_by_next(_apart(j, ["o_custkey"], "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderkey")
    return nb.select("o_orderkey", "o_custkey", "c_nationkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts")


def f2_tgt(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else f2_base(spark, sf_dir)
    return b.filter(F.col("o_custkey") % 9 != 3).select(
        "c_nationkey", "o_custkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts",
        ts_lit(SYS_START).alias("icw_eff_ts"), ts_lit(SYS_OPEN_END).alias("icw_exp_ts"),
    )


def f2_src(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else f2_base(spark, sf_dir)
    ok = F.col("o_orderkey")
    return b.filter(
        (F.col("o_custkey") % 3 == 0) & (ok % 4 == 0) & (F.col("bus_exp_ts") > F.col("bus_eff_ts") + _days(5))
    ).select(
        "c_nationkey", "o_custkey",
        F.when(ok % 8 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("bus_eff_ts") + _days(5)).alias("bus_eff_ts"),
        F.least(F.col("bus_exp_ts"), F.col("bus_eff_ts") + _days(40)).alias("bus_exp_ts"),
        F.when(ok % 12 == 0, F.lit("E")).alias("opr"),
    )


def f3_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.filter(k % 5 != 0).select(
        "c_name", (k + 1000).alias("cust_id"), ts_lit(SYS_START).alias("icw_eff_ts"),
        F.when(k % 11 == 0, ts_lit("2021-01-01 00:00:00")).otherwise(ts_lit(SYS_OPEN_END)).alias("icw_exp_ts"),
    )


def f3_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "o_orderkey", "o_totalprice")


def f4_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON text, with a nested name holding a space and an array."""
    o = table(spark, sf_dir, "orders")
    body = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")).alias("ship to"),
            F.array("o_orderpriority", "o_orderstatus").alias("tags"),
        )
    )
    return o.select(F.col("_metadata.file_path").alias("src_file_nm"), "o_orderkey", body.alias("body"))


def f5_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line; lines of an order that share a number are told apart by ``l_copy``."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    copy = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_shipdate", "l_returnflag"))
    return li.withColumn("l_copy", copy).join(o, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_copy", "l_returnflag",
        F.col("o_orderdate").alias("bus_eff_ts"), ts_lit(BUS_OPEN).alias("bus_exp_ts"),
        ts_lit(SYS_START).alias("icw_eff_ts"), ts_lit(SYS_OPEN_END).alias("icw_exp_ts"),
    )


def f5_src(spark: SparkSession, sf_dir: str, tgt: DataFrame | None = None) -> DataFrame:
    t = tgt if tgt is not None else f5_tgt(spark, sf_dir)
    return t.filter((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") != 2)).select(
        "l_orderkey", "l_linenumber", "l_copy",
        F.when(F.col("l_linenumber") == 3, F.lit("Z")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        (F.col("bus_eff_ts") + _days(10)).alias("bus_eff_ts"),
        F.when(F.col("l_orderkey") % 10 == 0, F.col("bus_eff_ts") + _days(40))
        .otherwise(F.col("bus_exp_ts")).alias("bus_exp_ts"),
    )


def f5_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A driver table of its own: two periods for some orders, also of orders that the source lacks."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 3 == 0)
    first = o.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderdate") + _days(10)).alias("bus_eff_ts"), (F.col("o_orderdate") + _days(40)).alias("bus_exp_ts"))
    later = o.filter(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderdate") + _days(50)).alias("bus_eff_ts"), ts_lit(BUS_OPEN).alias("bus_exp_ts"))
    return first.unionByName(later)


def f6_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few hot keys: each nation's orders as one timeline, an order from its date to the nation's next one."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey"))
    nb = _closed_by_next(_apart(j, ["c_nationkey"], "o_orderdate", "o_orderkey"), ["c_nationkey"], "o_orderkey")
    return nb.select("c_nationkey", "o_orderkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts")


def f6_tgt(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else f6_base(spark, sf_dir)
    return b.select(
        "c_nationkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts",
        ts_lit(SYS_START).alias("icw_eff_ts"), ts_lit(SYS_OPEN_END).alias("icw_exp_ts"),
    )


def f6_src(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Inputs that begin an hour into a version where it lasts so long, else with it."""
    b = base if base is not None else f6_base(spark, sf_dir)
    ok, hour = F.col("o_orderkey"), F.col("bus_eff_ts") + F.expr("INTERVAL 1 HOUR")
    return b.filter(ok % 3 == 0).select(
        "c_nationkey",
        F.when(ok % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("bus_exp_ts") > hour, hour).otherwise(F.col("bus_eff_ts")).alias("bus_eff_ts"),
        "bus_exp_ts",
    )
