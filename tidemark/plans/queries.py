"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Timestamps leave as text ``yyyy-MM-dd HH:mm:ss.SSS`` because the open end
``9999-12-31 23:59:59.999`` does not fit a nanosecond pandas timestamp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import canonical, columntype_default, null_default_join
from ..functions.tokens import explode_tokens
from ..operators._joins import join_on
from ..operators._stage import stage
from ..operators.apply import ACTION, apply_versions, merge_summary, write_merged
from ..operators.audit import audit_run
from ..operators.buckets import create_buckets, merge_buckets, read_buckets
from ..operators.keygen import assign_keys, keygen, keygen_summary, lookup_keys
from ..operators.periods import envelope_versions, normalise_periods, period_envelope, period_neighbours, resolve_overlapping, split_overlapping
from ..operators.roles import Roles
from ..operators.scd2 import scd2_merge, scd2_merge_set
from ..operators.temporal import plan_temporal
from ..session import scratch_path
from ..sources.landing import create_landing, land_batch, read_landing, write_table
from ..sources.variant import discover_paths, flatten, persist_view, saved_paths
from ..streaming.landing import land_stream, land_stream_checked
from . import frames as fr

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def present(df: DataFrame) -> DataFrame:
    """Timestamps as fixed-format text; everything else unchanged."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(F.col(f.name), TS_FORMAT).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _basename(c: str = "src_file_nm"):
    """The table file a row came from; of a table that is a folder of part files, the folder."""
    return F.regexp_extract(F.col(c), r"([^/]+\.parquet)(?:/[^/]*)?$", 1)


# ---- roles of the frames ------------------------------------------------------------

F1_ROLES = Roles(key=("c_custkey",), his=("c_mktsegment", "c_acctbal", "c_nationkey"))
F1_ROLES_OPR = Roles(key=("c_custkey",), his=("c_mktsegment", "c_acctbal", "c_nationkey"), opr="opr")
F1_WINDOW = "c_nationkey < 10"
F2_ROLES = Roles(key=("o_custkey",), his=("o_orderstatus",), bus=("bus_eff_ts", "bus_exp_ts"))
F2_ROLES_OPR = Roles(key=("o_custkey",), his=("o_orderstatus",), bus=("bus_eff_ts", "bus_exp_ts"), opr="opr")
F5_ROLES = Roles(key=("l_linenumber", "l_copy"), kem=("l_orderkey",), his=("l_returnflag",), bus=("bus_eff_ts", "bus_exp_ts"))


# ---- type 2 -------------------------------------------------------------------------------

def scd2_delta(spark: SparkSession, sf: str) -> DataFrame:
    src = fr.f1_src(spark, sf).drop("opr")
    return present(scd2_merge_set(src, fr.f1_tgt(spark, sf), F1_ROLES, fr.AS_OF))


def scd2_delete(spark: SparkSession, sf: str) -> DataFrame:
    return present(scd2_merge_set(fr.f1_src(spark, sf), fr.f1_tgt(spark, sf), F1_ROLES_OPR, fr.AS_OF))


def scd2_window(spark: SparkSession, sf: str) -> DataFrame:
    return present(
        scd2_merge_set(fr.f1_src(spark, sf), fr.f1_tgt(spark, sf), F1_ROLES_OPR, fr.AS_OF, window=F1_WINDOW)
    )


def scd2_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge from a role string and a source with other column order, spelling and one column too many."""
    src = fr.f1_src(spark, sf).select("opr", F.lit("x").alias("loaded_by"), "c_nationkey", F.col("c_acctbal").alias("C_ACCTBAL"), "c_mktsegment", F.col("c_custkey").alias("C_CUSTKEY"))
    return present(scd2_merge_set(src, fr.f1_tgt(spark, sf), Roles.parse("KEY:[C_Custkey]; OPR:opr"), fr.AS_OF))


def _scd2_applied(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_merge(
        fr.f1_src(spark, sf), fr.f1_tgt(spark, sf), F1_ROLES_OPR, fr.AS_OF, window=F1_WINDOW, keep_action=True
    )


def scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    return present(_scd2_applied(spark, sf).drop(ACTION))


def scd2_merge_summary(spark: SparkSession, sf: str) -> DataFrame:
    return merge_summary(_scd2_applied(spark, sf))


def audit_append(spark: SparkSession, sf: str) -> DataFrame:
    """One merge written, its rows counted by that write, and logged under a run id; the run is logged twice and stands once."""
    metrics = write_merged(_scd2_applied(spark, sf), scratch_path(spark, "scd2_merged"))
    path = scratch_path(spark, "audit_log")
    for _ in range(2):
        logged = audit_run(spark, path, "run-1", "scd2_merge", [("Versions written", ", ".join(f"{k}: {v}" for k, v in metrics.items()))])
    return logged.select("src_nm", "msg_txt", "extra_txt")


# ---- bitemporal ---------------------------------------------------------------------------

def _f2(spark: SparkSession, sf: str, opr: bool):
    # every merge stage reads the derived frame: cut it once, as an input table would be
    base = stage(fr.f2_base(spark, sf))
    tgt = fr.f2_tgt(spark, sf, base).drop("c_nationkey")
    src = fr.f2_src(spark, sf, base).drop("c_nationkey")
    if not opr:
        src = src.drop("opr")
    return src, tgt


_F2_ROW = ["o_custkey", "o_orderstatus", "bus_eff_ts", "bus_exp_ts"]


def q_period_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    src, _ = _f2(spark, sf, opr=True)
    return present(period_neighbours(src, ["o_custkey"], "bus_eff_ts", "bus_exp_ts"))


def period_left_diff(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=False)
    return present(plan_temporal(src, tgt, F2_ROLES, fr.AS_OF).left.select(*_F2_ROW))


def period_right_diff(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=False)
    return present(plan_temporal(src, tgt, F2_ROLES, fr.AS_OF).right.select(*_F2_ROW))


def period_normalise(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=False)
    return present(plan_temporal(src, tgt, F2_ROLES, fr.AS_OF).norm.select(*_F2_ROW, "prog_flag"))


def q_period_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Per source key: envelope of its input periods, current versions inside it and
    versions holding its first or last instant."""
    src, tgt = _f2(spark, sf, opr=False)
    env = period_envelope(src, ["o_custkey"], "bus_eff_ts", "bus_exp_ts")
    cur = tgt.filter(F.col("icw_exp_ts") > F.lit(fr.AS_OF).cast("timestamp_ntz"))
    near = envelope_versions(src, cur, ["o_custkey"], "bus_eff_ts", "bus_exp_ts").groupBy("o_custkey").agg(
        F.count_if("inside").alias("n_inside"), F.count_if(F.expr("holds_start OR holds_end")).alias("n_boundary"))
    out = env.join(near, "o_custkey", "left")
    return present(out.select("o_custkey", "env_start", "env_end", F.coalesce("n_inside", F.lit(0)).alias("n_inside"), F.coalesce("n_boundary", F.lit(0)).alias("n_boundary")))


def period_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a 30-day period: periods of one customer and status that overlap or meet become one."""
    orders = fr.table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_orderdate").alias("bus_eff_ts"), (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias("bus_exp_ts"))
    return present(normalise_periods(orders, ["o_custkey", "o_orderstatus"], "bus_eff_ts", "bus_exp_ts"))


def temporal_merge_set(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=False)
    return present(plan_temporal(src, tgt, F2_ROLES, fr.AS_OF).merge_set)


def temporal_delete(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=True)
    return present(plan_temporal(src, tgt, F2_ROLES_OPR, fr.AS_OF).merge_set)


def temporal_apply(spark: SparkSession, sf: str) -> DataFrame:
    src, tgt = _f2(spark, sf, opr=True)
    p = plan_temporal(src, tgt, F2_ROLES_OPR, fr.AS_OF)
    r = p.roles
    return present(apply_versions(tgt, p.merge_set, r.key + r.bus + r.his, r.sys, fr.AS_OF, hot=p.hot))


def temporal_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into a bucketed table: only buckets of the run's keys are rewritten, closed versions are added."""
    src, tgt = _f2(spark, sf, opr=True)
    path = scratch_path(spark, "bucketed")
    create_buckets(tgt, path, ["o_custkey"], buckets=32)
    for _ in range(2):  # the second run finds its work done
        merge_buckets(spark, path, src, F2_ROLES_OPR, fr.AS_OF, "run-1", buckets=32)
    return present(read_buckets(spark, path, "icw_exp_ts").select(*tgt.columns))


def temporal_key_master(spark: SparkSession, sf: str) -> DataFrame:
    tgt = stage(fr.f5_tgt(spark, sf))
    src = fr.f5_src(spark, sf, tgt)
    return present(plan_temporal(src, tgt, F5_ROLES, fr.AS_OF).merge_set)


def temporal_key_driver(spark: SparkSession, sf: str) -> DataFrame:
    """Key-master expiry steered by a driver table with periods of its own."""
    tgt = stage(fr.f5_tgt(spark, sf))
    src = fr.f5_src(spark, sf, tgt)
    return present(plan_temporal(src, tgt, F5_ROLES, fr.AS_OF, driver=fr.f5_driver(spark, sf)).merge_set)


F6_ROLES = Roles(key=("c_nationkey",), his=("o_orderstatus",), bus=("bus_eff_ts", "bus_exp_ts"))


def temporal_overlap_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a 200-day period of its customer; periods that overlap an earlier one are set aside."""
    orders = fr.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("bus_eff_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL '200' DAY")).alias("bus_exp_ts"),
    )
    clean, rejected = split_overlapping(orders, ["o_custkey"], "bus_eff_ts", "bus_exp_ts")
    return present(clean.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True))))


def temporal_overlap_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """The same periods, as many kept per customer as there can be without overlap."""
    orders = fr.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("bus_eff_ts"),
        (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 400 + 1).cast("int"))).alias("bus_exp_ts"),
    )
    clean, rejected = resolve_overlapping(orders, ["o_custkey"], "bus_eff_ts", "bus_exp_ts")
    return present(clean.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True))))


def temporal_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Bitemporal merge set where every key is hot (25 nation timelines), on the sliced path."""
    base = stage(fr.f6_base(spark, sf))
    tgt, src = fr.f6_tgt(spark, sf, base), fr.f6_src(spark, sf, base)
    return present(plan_temporal(src, tgt, F6_ROLES, fr.AS_OF, slice_rows=256).merge_set)


# ---- keys ---------------------------------------------------------------------------------

def _f3(spark: SparkSession, sf: str):
    return fr.f3_src(spark, sf), fr.f3_hub(spark, sf)


def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    src, hub = _f3(spark, sf)
    return lookup_keys(src, hub, ["c_name"], "cust_id", fr.AS_OF)


def key_assign(spark: SparkSession, sf: str) -> DataFrame:
    src, hub = _f3(spark, sf)
    return assign_keys(lookup_keys(src, hub, ["c_name"], "cust_id", fr.AS_OF), hub, ["c_name"], "cust_id")


def keygen_target(spark: SparkSession, sf: str) -> DataFrame:
    src, hub = _f3(spark, sf)
    return keygen(src, hub, ["c_name"], "cust_id", fr.AS_OF, mode="target")


def keygen_source(spark: SparkSession, sf: str) -> DataFrame:
    src, hub = _f3(spark, sf)
    src = src.withColumn("cust_id", F.lit(None).cast("bigint"))
    return keygen(src, hub, ["c_name"], "cust_id", fr.AS_OF, mode="source")


def keygen_written(spark: SparkSession, sf: str) -> DataFrame:
    """Keys written to a new target and, by a second run over the grown hub, found again: no key is made twice."""
    src, hub = _f3(spark, sf)
    target, grown = scratch_path(spark, "keyed"), scratch_path(spark, "hub")
    lacking = spark.createDataFrame([], "c_name string, o_orderkey long, o_totalprice double, cust_id long")
    write_table(keygen(src, hub, ["c_name"], "cust_id", fr.AS_OF, mode="target", tgt=lacking), target)
    keyed = spark.read.parquet(target)
    old = hub.where(F.col("icw_exp_ts") > F.lit(fr.AS_OF).cast("timestamp_ntz")).select("c_name")
    new = keyed.select("c_name", "cust_id").distinct().join(old, "c_name", "left_anti")
    template = hub.select("icw_eff_ts", "icw_exp_ts").where(F.col("icw_exp_ts") > F.lit(fr.AS_OF).cast("timestamp_ntz")).limit(1)
    write_table(hub.unionByName(new.join(F.broadcast(template)).select(*hub.columns)), grown)
    again = keygen(src, spark.read.parquet(grown), ["c_name"], "cust_id", fr.AS_OF, mode="target", tgt=keyed)
    write_table(again, target, mode="overwrite")
    return spark.read.parquet(target)


def q_keygen_summary(spark: SparkSession, sf: str) -> DataFrame:
    src, hub = _f3(spark, sf)
    cache = assign_keys(lookup_keys(src, hub, ["c_name"], "cust_id", fr.AS_OF), hub, ["c_name"], "cust_id")
    written = keygen(src, hub, ["c_name"], "cust_id", fr.AS_OF, mode="target", cache=cache)
    return keygen_summary(cache, written)


# ---- helpers, landing, variant ---------------------------------------------------------

def q_null_default_join(spark: SparkSession, sf: str) -> DataFrame:
    c = fr.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
    )
    n = fr.table(spark, sf, "nation").select(
        F.when(F.col("n_nationkey") == 0, F.lit(None)).otherwise(F.col("n_nationkey")).alias("n_nationkey"),
        "n_name",
    )
    j = null_default_join(c, n, [("c_nationkey", "n_nationkey")])
    return j.select("c_custkey", "c_nationkey", "n_nationkey", "n_name")


def q_explode_tokens(spark: SparkSession, sf: str) -> DataFrame:
    p = fr.table(spark, sf, "part").select("p_partkey", "p_type")
    return explode_tokens(p, "p_type")


def explode_tokens_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole document texts split on the delimiter set: tokens per document."""
    d = fr.table(spark, sf, "documents").select("doc_id", "text")
    t = explode_tokens(d, "text", upper=False, distinct_col="n_distinct")
    # tokens stay in the task that splits their text; only one row a document is dealt
    each = stage(t.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.max("n_distinct").cast("long").alias("n_distinct"),
        F.max("token_no").alias("last_no"), F.count_if(F.col("token_no") == 1).alias("n_texts"),
    ), "table")
    again = stage(each.where("n_texts > 1").select("doc_id"), "table")
    if again.isEmpty():
        return each.drop("n_texts")
    # texts that share a doc_id meet in one task, and their tokens are compared
    shared = explode_tokens(join_on(d, again, ["doc_id"], "left_semi").repartition("doc_id"), "text", upper=False)
    shared = shared.groupBy("doc_id").agg(F.count_distinct("token").alias("n_all"))
    out = join_on(each, shared, ["doc_id"], "left")
    return out.select("doc_id", "n_tokens", F.coalesce("n_all", "n_distinct").alias("n_distinct"), "last_no")


def land_batch_parquet(spark: SparkSession, sf: str) -> DataFrame:
    landed = land_batch(spark, f"{sf.rstrip('/')}/orders.parquet", "parquet")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return landed.select(
        _basename().alias("src_file_nm"), *[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in cols]
    )


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _land_derived(spark: SparkSession, sf: str, fmt: str) -> DataFrame:
    """Orders written by Spark as ``fmt`` files into the shared folder, then landed."""
    path = scratch_path(spark, f"orders-{fmt}")
    w = fr.table(spark, sf, "orders").write
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)
    landed = land_batch(spark, path, fmt, options={"header": "true"} if fmt == "csv" else None)
    return landed.select(
        F.regexp_extract("src_file_nm", r"\.([a-z]+)$", 1).alias("file_ext"),
        *[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in _ORDER_COLS],
    )


def land_batch_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files land whole: one variant per record (``singleVariantColumn``)."""
    return _land_derived(spark, sf, "json")


def land_batch_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files land with their header's field names; every field is text."""
    return _land_derived(spark, sf, "csv")


def land_batch_mixed_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet files of one folder with different columns: the columns of all files land."""
    path = scratch_path(spark, "orders-mixed")
    orders = fr.table(spark, sf, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    orders.filter(odd).write.parquet(path)
    orders.filter(~odd).drop("o_orderpriority", "o_totalprice").write.mode("append").parquet(path)
    landed = land_batch(spark, path)
    return landed.select(*[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in _ORDER_COLS if c != "o_orderdate"])


def land_stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """Land ``documents`` (a file, or a folder of part files) with an availableNow stream, run it twice, count rows per table file."""
    base = scratch_path(spark, "landing")
    sink, ckpt = f"{base}/b_documents", f"{base}/_checkpoint"
    source = f"{sf.rstrip('/')}/documents.parque[t]"  # a pattern: a stream lists a plain path as a folder only
    for _ in range(2):  # the second run finds no new file and loads nothing
        land_stream(spark, source, sink, ckpt, fmt="parquet")
    landed = spark.read.parquet(sink)
    return landed.groupBy(_basename().alias("src_file_nm")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.try_variant_get("value", "$.doc_id", "bigint")).alias("n_docs"),
    )


def land_recreated(spark: SparkSession, sf: str) -> DataFrame:
    """A landing table is filled in two appends, made anew, and filled again: the earlier rows are gone."""
    path, orders = scratch_path(spark, "recreated"), f"{sf.rstrip('/')}/orders.parquet"
    landed = land_batch(spark, orders)
    odd = F.try_variant_get("value", "$.o_orderkey", "bigint") % 2 == 1
    create_landing(spark, path)
    write_table(landed, path, mode="append")
    create_landing(spark, path)
    for part in (odd, ~odd):
        write_table(landed.where(part), path, mode="append")
    return read_landing(spark, path).select(_basename().alias("src_file_nm"), F.try_variant_get("value", "$.o_orderkey", "string").alias("o_orderkey"))


def land_load_times(spark: SparkSession, sf: str) -> DataFrame:
    """One load time for all rows of a load, between its begin and its end."""
    path = scratch_path(spark, "times")
    now = lambda: spark.range(1).select(F.localtimestamp().alias("t")).first()["t"]
    begin = now()
    write_table(land_batch(spark, f"{sf.rstrip('/')}/orders.parquet"), path)
    end = now()
    t = F.col("load_ts")
    return read_landing(spark, path).groupBy(_basename().alias("src_file_nm")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(t).alias("n_times"), F.every((t >= F.lit(begin)) & (t <= F.lit(end))).alias("in_time"))


def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """The NULL default of each type family, by schema and by type name, over all orders."""
    o = fr.table(spark, sf, "orders")
    third = F.col("o_orderkey") % 3 == 0
    cols = {"o_orderstatus": "TEXT", "o_totalprice": "REAL", "o_custkey": "NUMBER", "o_orderdate": "TIMESTAMP_NTZ"}
    gaps = o.select("o_orderkey", F.when(~third, F.col("o_orderdate").cast("date")).alias("day"), *[F.when(~third, F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType for f in gaps.schema.fields}
    by_name = lambda c, family: F.coalesce(F.col(c), F.expr(columntype_default(family)).cast(types[c]))
    return present(gaps.select(
        "o_orderkey", canonical("day", types["day"]).cast("string").alias("day"),
        *[canonical(c, types[c]).alias(c) for c in cols], by_name("o_orderstatus", "TEXT").alias("status_by_name"), by_name("o_custkey", "NUMBER").alias("cust_by_name"),
        by_name("day", "DATE").cast("string").alias("day_by_name")))


def land_batch_orc(spark: SparkSession, sf: str) -> DataFrame:
    return _land_derived(spark, sf, "orc")


def land_batch_xml(spark: SparkSession, sf: str) -> DataFrame:
    """XML files land with their elements' names."""
    path = scratch_path(spark, "orders-xml")
    fr.table(spark, sf, "orders").select(*_ORDER_COLS).write.format("xml").option("rowTag", "order").save(path)
    landed = land_batch(spark, path, "xml", options={"rowTag": "order", "inferSchema": "false"})
    return landed.select(*[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in _ORDER_COLS if c not in ("o_orderdate", "o_totalprice")])


def land_batch_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text files land line by line."""
    path = scratch_path(spark, "orders-text")
    fr.table(spark, sf, "orders").select(F.concat_ws(" ", "o_orderkey", "o_custkey", "o_orderpriority").alias("value")).write.text(path)
    return land_batch(spark, path, "text").select(F.try_variant_get("value", "$.value", "string").alias("line"))


def land_stream_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """A running landing service meets files with columns that the first files lacked; it lands them without a restart."""
    base, orders = scratch_path(spark, "drift"), fr.table(spark, sf, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    orders.where(odd).select("o_orderkey", "o_custkey").write.parquet(f"{base}/in/a")
    q = land_stream_checked(spark, f"{base}/in", f"{base}/landing", f"{base}/bad", f"{base}/ckpt", options={"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}, trigger="100 milliseconds")
    try:
        q.processAllAvailable()
        orders.where(~odd).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.parquet(f"{base}/in/b")
        q.processAllAvailable()
    finally:
        q.stop()
    landed = read_landing(spark, f"{base}/landing")
    return landed.select(*[F.try_variant_get("value", f"$.{c}", "string").alias(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")])


def land_json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of all orders, every seventh cut short: whole records land, broken ones are set aside with their text."""
    base = scratch_path(spark, "malformed")
    body = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    broken = F.when(F.col("o_orderkey") % 7 == 0, F.expr("left(body, length(body) - 3)")).otherwise(F.col("body"))
    fr.table(spark, sf, "orders").withColumn("body", body).select(broken.alias("value")).write.text(f"{base}/in")
    for _ in range(2):  # the second run finds no new file
        land_stream_checked(spark, f"{base}/in", f"{base}/landing", f"{base}/bad", f"{base}/ckpt", "json", options={"pathGlobFilter": "*.txt"})
    landed = read_landing(spark, f"{base}/landing").select(
        F.lit("landed").alias("side"), F.try_variant_get("value", "$.o_orderkey", "string").alias("o_orderkey"), F.try_variant_get("value", "$.o_orderstatus", "string").alias("content"))
    bad = spark.read.parquet(f"{base}/bad").select(F.lit("set aside").alias("side"), F.regexp_extract("bad_record", "([0-9]+)", 1).alias("o_orderkey"), F.col("bad_record").alias("content"))
    return landed.unionByName(bad)


def _f4_landed(spark: SparkSession, sf: str) -> DataFrame:
    d = fr.f4_docs(spark, sf)
    return d.select("src_file_nm", F.localtimestamp().alias("load_ts"), F.parse_json("body").alias("value"))


def variant_paths(spark: SparkSession, sf: str) -> DataFrame:
    return discover_paths(_f4_landed(spark, sf), "value", max_depth=3).select(
        "path", "depth", "kind", "n_rows", F.col("max_width").cast("bigint").alias("max_width")
    )


def variant_paths_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The same paths from two streamed batches, each discovered once and saved."""
    base = scratch_path(spark, "paths")
    d = fr.f4_docs(spark, sf)
    for part in (0, 1):
        d.where(F.col("o_orderkey") % 2 == part).select("body").write.text(f"{base}/in/{part}")
        land_stream_checked(spark, f"{base}/in", f"{base}/landing", f"{base}/bad", f"{base}/ckpt", "json", options={"recursiveFileLookup": "true", "pathGlobFilter": "*.txt"}, paths=f"{base}/paths")
    return saved_paths(spark, f"{base}/paths").select("path", "depth", "kind", "n_rows", F.col("max_width").cast("bigint").alias("max_width"))


def variant_paths_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = fr.table(spark, sf, "events").select(F.parse_json("props").alias("value"))
    return discover_paths(ev, "value", max_depth=3).select(
        "path", "depth", "kind", "n_rows", F.col("max_width").cast("bigint").alias("max_width")
    )


def _f4_flat(spark: SparkSession, sf: str) -> DataFrame:
    return flatten(_f4_landed(spark, sf), max_depth=3)


def variant_flatten_scalar(spark: SparkSession, sf: str) -> DataFrame:
    return _f4_flat(spark, sf).select(_basename().alias("src_file_nm"), "id")


def variant_flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    return _f4_flat(spark, sf).select("id", "ship_to_cust", "ship_to_status")


def variant_flatten_array(spark: SparkSession, sf: str) -> DataFrame:
    return _f4_flat(spark, sf).select("id", F.to_json("tags").alias("tags"), "tags_0", "tags_1")


def variant_flatten_all(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flattened view: every column of every record."""
    flat = _f4_flat(spark, sf)
    return flat.select(_basename().alias("src_file_nm"), "id", F.to_json("ship_to").alias("ship_to"), "ship_to_cust", "ship_to_status", F.to_json("tags").alias("tags"), "tags_0", "tags_1")


def variant_persistent_view(spark: SparkSession, sf: str) -> DataFrame:
    """A catalogue view over a landing table, read by another session; rows landed after it was made show in it."""
    path, view = scratch_path(spark, "landing-table"), "v_landed_orders"
    landed = _f4_landed(spark, sf)
    odd = F.try_variant_get("value", "$.id", "bigint") % 2 == 1
    write_table(landed.where(odd), path)
    persist_view(spark, f"parquet.`{path}`", view)
    write_table(landed.where(~odd), path, mode="append")
    return spark.newSession().table(view).select("id", "ship_to_cust", "ship_to_status", "tags_0", "tags_1")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scd2_delta": scd2_delta,
    "scd2_delete": scd2_delete,
    "scd2_window": scd2_window,
    "scd2_reconciled": scd2_reconciled,
    "scd2_apply": scd2_apply,
    "merge_summary": scd2_merge_summary,
    "audit_append": audit_append,
    "period_neighbours": q_period_neighbours,
    "period_left_diff": period_left_diff,
    "period_right_diff": period_right_diff,
    "period_normalise": period_normalise,
    "period_envelope": q_period_envelope,
    "temporal_merge_set": temporal_merge_set,
    "temporal_delete": temporal_delete,
    "temporal_apply": temporal_apply,
    "temporal_key_master": temporal_key_master,
    "temporal_key_driver": temporal_key_driver,
    "temporal_bucketed": temporal_bucketed,
    "temporal_overlap_resolved": temporal_overlap_resolved,
    "temporal_hot_keys": temporal_hot_keys,
    "period_coalesce": period_coalesce,
    "temporal_overlap_quarantine": temporal_overlap_quarantine,
    "key_lookup": key_lookup,
    "key_assign": key_assign,
    "keygen_target": keygen_target,
    "keygen_source": keygen_source,
    "keygen_summary": q_keygen_summary,
    "keygen_written": keygen_written,
    "null_defaults": null_defaults,
    "null_default_join": q_null_default_join,
    "explode_tokens": q_explode_tokens,
    "explode_tokens_docs": explode_tokens_docs,
    "land_batch_parquet": land_batch_parquet,
    "land_batch_json": land_batch_json,
    "land_batch_csv": land_batch_csv,
    "land_batch_orc": land_batch_orc,
    "land_recreated": land_recreated,
    "land_load_times": land_load_times,
    "land_batch_xml": land_batch_xml,
    "land_batch_text": land_batch_text,
    "land_stream_new_column": land_stream_new_column,
    "land_json_quarantine": land_json_quarantine,
    "land_batch_mixed_schema": land_batch_mixed_schema,
    "land_stream_available_now": land_stream_available_now,
    "variant_paths": variant_paths,
    "variant_paths_incremental": variant_paths_incremental,
    "variant_paths_events": variant_paths_events,
    "variant_flatten_scalar": variant_flatten_scalar,
    "variant_flatten_nested": variant_flatten_nested,
    "variant_flatten_array": variant_flatten_array,
    "variant_flatten_all": variant_flatten_all,
    "variant_persistent_view": variant_persistent_view,
}
