"""Landing of files that differ, malformed records, refused drift, and the catalogue view."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import discover_paths, land_files, land_stream_checked, persist_view, read_landing, schema_log
from tidemark.session import scratch_path
from tidemark.sources.variant import save_paths, saved_paths, top_fields, view_sql

RECURSE = {"recursiveFileLookup": "true"}


def text(df):
    return sorted(r[0] for r in df.select(F.to_json("value")).collect())


def paths(spark, root):
    return [r.path for r in spark.read.format("binaryFile").options(**RECURSE, pathGlobFilter="*.*").load(root).select("path").collect() if not r.path.split("/")[-1].startswith("_")]


def test_types_that_conflict_land_file_by_file(spark):
    root = scratch_path(spark, "types")
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(f"{root}/x")
    spark.createDataFrame([("s", 3.5)], "a string, c double").coalesce(1).write.parquet(f"{root}/y")
    got = land_files(spark, paths(spark, root), "parquet")
    assert text(got) == ['{"a":"s","c":3.5}', '{"a":1,"b":2}'] and got.where("bad_record IS NOT NULL").count() == 0


def test_csv_headers_and_bad_rows(spark):
    root = scratch_path(spark, "csv")
    for name, lines in (("x", ["a,b", "1,2", "3", "4,5,6"]), ("y", ["b,c,d", "7,8,9"])):
        spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"{root}/{name}")
    got = land_files(spark, paths(spark, root), "csv", options={"header": "true"})
    assert text(got.where("bad_record IS NULL")) == ['{"a":"1","b":"2"}', '{"b":"7","c":"8","d":"9"}']
    assert sorted(r.bad_record for r in got.where("bad_record IS NOT NULL").collect()) == ["3", "4,5,6"]


def test_json_lines_of_any_shape(spark):
    root = scratch_path(spark, "json")
    lines = ['{"a":1}', "", "  ", "null", "[1,2]", '"x"', '{"a":', "nonsense", '{"b":{"c":null}}']
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(root)
    got = land_files(spark, [root], "json")
    assert text(got.where("bad_record IS NULL")) == ['"x"', '[1,2]', 'null', '{"a":1}', '{"b":{"c":null}}']
    assert sorted(r.bad_record for r in got.where("bad_record IS NOT NULL").collect()) == ["nonsense", '{"a":']


def test_drift_is_logged_or_refused(spark):
    base = scratch_path(spark, "drift")
    land = lambda how: land_stream_checked(spark, f"{base}/in", f"{base}/land", f"{base}/bad", f"{base}/ckpt", options={**RECURSE, "pathGlobFilter": "*.parquet"}, on_drift=how)
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{base}/in/1")
    land("fail")
    spark.createDataFrame([(2_000_000,)], "a int").write.parquet(f"{base}/in/2")  # another width is no drift
    land("fail")
    spark.createDataFrame([(3, "x")], "a int, b string").write.parquet(f"{base}/in/3")
    with pytest.raises(StreamingQueryException, match="SchemaDrift"):
        land("fail")
    assert read_landing(spark, f"{base}/land").count() == 2  # nothing of the batch was written
    land("widen")
    assert text(read_landing(spark, f"{base}/land")) == ['{"a":1}', '{"a":2000000}', '{"a":3,"b":"x"}']
    assert sorted((r.field, r.is_new) for r in schema_log(spark, f"{base}/ckpt").collect()) == [("a", False), ("a", False), ("a", True), ("b", True)]
    assert spark.read.schema("bad_record string").parquet(f"{base}/bad").count() == 0


def test_schema_text():
    assert top_fields("OBJECT<a: BIGINT, `b:OBJECT<c`: OBJECT<x: ARRAY<VARIANT>>, v: VOID>") == {"a": "bigint", "b:OBJECT<c": "struct<x:array<variant>>", "v": "void"}
    assert top_fields("VARIANT") == {} and top_fields(None) == {}


def test_persistent_view(spark):
    path = scratch_path(spark, "landing")
    rows = ['{"a":1,"it\'s":{"x y":"q"}}', '{"a":2}']
    landed = lambda some: spark.createDataFrame([(r,) for r in some], "j string").select(F.lit("f").alias("src_file_nm"), F.localtimestamp().alias("load_ts"), F.parse_json("j").alias("value"))
    landed(rows).write.parquet(path)
    table, view = f"parquet.`{path}`", "v_drift_test"
    assert persist_view(spark, table, view) is True and persist_view(spark, table, view) is False
    other = spark.newSession()
    assert sorted(map(tuple, other.table(view).drop("src_file_nm", "load_ts").select("a", "it_s_x_y").collect()), key=str) == [("1", "q"), ("2", None)]
    landed(['{"a":3,"new":[1]}']).write.mode("append").parquet(path)
    assert persist_view(spark, table, view) is True and other.table(view).where("new_0 = '1'").count() == 1
    assert "SELECT" in view_sql(table, discover_paths(spark.read.parquet(path)))
    with pytest.raises(ValueError):
        view_sql(table, [])
    spark.sql(f"DROP VIEW {view}")


def listed(df):
    return sorted((r.path, r.depth, r.kind, r.n_rows, r.max_width) for r in df.collect())


ROWS = ['{"a":1,"b":{"c":null,"d":[1,2]},"m":1}', '{"a":null,"b":{"c":2},"m":{"x":[1],"y":{"z":1}}}', '{"b":null,"m":"s"}', '{"e":[],"f":{}}', '{"e":[1,2,3],"b":{"d":null}}']


def test_paths_of_plain_and_mixed_kinds(spark):
    df = spark.createDataFrame([(r,) for r in ROWS], "j string").select(F.parse_json("j").alias("value"))
    want = [("a", 0, "null", 1, None), ("a", 0, "scalar", 1, None), ("b", 0, "null", 1, None), ("b", 0, "object", 3, None), ("b.c", 1, "null", 1, None), ("b.c", 1, "scalar", 1, None),
            ("b.d", 1, "array", 1, 2), ("b.d", 1, "null", 1, None), ("e", 0, "array", 2, 3), ("f", 0, "object", 1, None), ("m", 0, "object", 1, None), ("m", 0, "scalar", 2, None),
            ("m.x", 1, "array", 1, 1), ("m.y", 1, "object", 1, None), ("m.y.z", 2, "scalar", 1, None)]
    assert listed(discover_paths(df)) == want
    with_array = df.unionByName(spark.sql("SELECT parse_json('[1]') AS value"))  # a record that is no object: the general scan
    assert listed(discover_paths(with_array)) == want
    assert listed(discover_paths(df, max_depth=0)) == [w for w in want if w[1] == 0]
    assert discover_paths(df.limit(0)).count() == 0
    odd = spark.createDataFrame([('{"q\\"x":{"y":1}}',)], "j string").select(F.parse_json("j").alias("value"))
    assert [r[0] for r in listed(discover_paths(odd))] == ['q"x', 'q"x.y']


def test_saved_paths_equal_a_full_run(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ROWS * 2)], "i int, j string").select("i", F.parse_json("j").alias("value"))
    state = scratch_path(spark, "paths")
    for k in range(3):
        save_paths(discover_paths(df.where(F.col("i") % 3 == k)), state, k)
    save_paths(discover_paths(df.where(F.col("i") % 3 == 1)), state, 1)  # repeated
    assert listed(saved_paths(spark, state)) == listed(discover_paths(df))
