import pytest

import json

from pyspark.sql import functions as F

from tidemark import check_overlaps, discover_paths, flatten, land_batch, land_stream, schema_diff
from tidemark.session import scratch_path

DOC = {"a": 1, "b": {"c d": 2, "e": None}, "l": [{"x": 1}, 5]}


def landed(spark):
    return spark.createDataFrame([(json.dumps(DOC),)], "body string").select(
        F.lit("f").alias("src_file_nm"), F.localtimestamp().alias("load_ts"), F.parse_json("body").alias("value"))


def test_flatten_fixture(spark):
    flat = flatten(landed(spark), max_depth=1)
    assert flat.columns == ["src_file_nm", "load_ts", "a", "b", "b_c_d", "b_e", "l", "l_0", "l_1"]
    r = flat.first()
    assert r.a == "1" and r.b_c_d == "2" and r.l_0 == '{"x":1}' and r.l_1 == "5"
    shallow = flatten(landed(spark), max_depth=0)
    assert "b_c_d" not in shallow.columns and "b_e" not in shallow.columns and "b" in shallow.columns


def test_discover_paths_kinds(spark):
    rows = {(r.path, r.kind): r for r in discover_paths(landed(spark), max_depth=3).collect()}
    assert rows[("a", "scalar")].depth == 0
    assert rows[("b", "object")].n_rows == 1
    assert rows[("b.e", "null")].depth == 1
    assert rows[("l", "array")].max_width == 2


def test_land_batch_json_and_csv(spark, tmp_path):
    j = tmp_path / "j"
    j.mkdir()
    (j / "one.json").write_text('{"id": 1, "n": {"x": "y"}}\n{"id": 2}\n')
    rows = land_batch(spark, str(j), "json").select(
        "src_file_nm", F.try_variant_get("value", "$.n.x", "string").alias("x")).collect()
    assert sorted(r.x or "" for r in rows) == ["", "y"] and rows[0].src_file_nm.endswith("one.json")
    c = tmp_path / "c"
    c.mkdir()
    (c / "a.csv").write_text("id,name\n1,x\n2,y\n")
    got = land_batch(spark, str(c), "csv", options={"header": "true"}).select(
        F.try_variant_get("value", "$.name", "string").alias("n")).collect()
    assert sorted(r.n for r in got) == ["x", "y"]


def test_stream_restart_loads_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    spark.range(3).write.parquet(str(src / "f1"))
    base = scratch_path(spark, "test-landing")
    opts = {"recursiveFileLookup": "true"}
    land_stream(spark, str(src), f"{base}/sink", f"{base}/ckpt", options=opts)
    land_stream(spark, str(src), f"{base}/sink", f"{base}/ckpt", options=opts)
    assert spark.read.parquet(f"{base}/sink").count() == 3
    spark.range(10, 12).write.parquet(str(src / "f2"))
    land_stream(spark, str(src), f"{base}/sink", f"{base}/ckpt", options=opts)
    assert spark.read.parquet(f"{base}/sink").count() == 5


def test_schema_diff_and_overlaps(spark):
    a = spark.createDataFrame([], "k string, v int, opr string")
    b = spark.createDataFrame([], "k string, v int, icw_eff_ts timestamp_ntz")
    d = {r.column_name: (r.role, r.status) for r in schema_diff(a, b).collect()}
    assert d["icw_eff_ts"] == ("SYS", "target_only") and d["opr"][1] == "source_only" and d["k"][1] == "both"
    p = spark.createDataFrame([("a", 1, 5), ("a", 3, 4), ("a", 5, 6), ("b", 1, 2)], "k string, s int, e int")
    bad = check_overlaps(p, ["k"], "s", "e").collect()
    assert [(r.k, r.s) for r in bad] == [("a", 3)]


def test_stream_json_lands_whole_records(spark, tmp_path):
    src = tmp_path / "js"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "tags": ["x", "y"]}\n{"id": 2, "extra": {"k": true}}\n')
    base = scratch_path(spark, "test-json-landing")
    land_stream(spark, str(src), f"{base}/sink", f"{base}/ckpt", fmt="json")
    rows = spark.read.parquet(f"{base}/sink").select(
        F.try_variant_get("value", "$.id", "int").alias("id"),
        F.try_variant_get("value", "$.tags[1]", "string").alias("t"),
        F.try_variant_get("value", "$.extra.k", "boolean").alias("k"),
    ).collect()
    assert sorted((r.id, r.t, r.k) for r in rows) == [(1, "y", None), (2, None, True)]


def test_create_landing_then_stream(spark, tmp_path):
    from tidemark import create_landing
    base = scratch_path(spark, "test-create-landing")
    empty = create_landing(spark, f"{base}/b_orders")
    assert empty.count() == 0 and [f.name for f in empty.schema.fields] == ["src_file_nm", "load_ts", "value"]
    src = tmp_path / "p"
    src.mkdir()
    spark.range(4).write.parquet(str(src / "f1"))
    land_stream(spark, str(src), f"{base}/b_orders", f"{base}/ckpt", options={"recursiveFileLookup": "true"})
    assert spark.read.parquet(f"{base}/b_orders").count() == 4


def test_landing_keeps_columns_of_all_files(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(2, 3)], "a int, b int").write.mode("append").parquet(str(tmp_path / "p"))
    got = land_batch(spark, str(tmp_path / "p")).selectExpr("try_variant_get(value, '$.a', 'int') a", "try_variant_get(value, '$.b', 'int') b").collect()
    assert sorted(map(tuple, got), key=str) == [(1, None), (2, 3)]
    for k, text in enumerate(("id,name\n1,x\n", "name,id\nz,3\n")):
        (tmp_path / "c").mkdir(exist_ok=True)
        (tmp_path / "c" / f"{k}.csv").write_text(text)
    with pytest.raises(Exception, match="CSV header"):
        land_batch(spark, str(tmp_path / "c"), "csv", options={"header": "true"}).collect()


def test_flatten_of_nothing_and_column_bound(spark):
    empty = spark.createDataFrame([], "j string").selectExpr("parse_json(j) AS value")
    with pytest.raises(ValueError):
        flatten(empty)
    wide = spark.createDataFrame([('{"a": 1, "b": 2}',)], "j string").selectExpr("parse_json(j) AS value")
    assert flatten(wide).columns == ["a", "b"]
    with pytest.raises(ValueError):
        flatten(wide, max_columns=1)
