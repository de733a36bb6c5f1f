import pytest
from pyspark.sql import types as T

from tidemark import Roles, RoleError, audit_frame, publish_view, resolve_roles


def test_source_only_column_warns_and_opr_is_exempt():
    src = T.StructType([T.StructField("k", T.StringType()), T.StructField("extra", T.IntegerType()),
                        T.StructField("op", T.StringType()), T.StructField("v", T.StringType())])
    tgt = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("icw_eff_ts", T.TimestampNTZType()),
                        T.StructField("icw_exp_ts", T.TimestampNTZType())])
    r = resolve_roles(src, tgt, Roles(key=("K",), opr="op"), "scd2")
    assert r.key == ["k"] and r.sys == ["icw_eff_ts", "icw_exp_ts"] and r.his == ["v"]
    assert r.warnings == ["source column extra is left out: the target has no such column"]


def test_untracked_columns_are_tracked_and_one_is_needed():
    f = lambda *names: T.StructType([T.StructField(n, T.StringType()) for n in names])
    cols = ("k", "a", "b", "icw_eff_ts", "icw_exp_ts")
    assert resolve_roles(f("k", "a", "b"), f(*cols), Roles(key=("k",), his=("a",)), "scd2").his == ["a", "b"]
    with pytest.raises(RoleError):
        resolve_roles(f("k", "a"), f(*cols), Roles(key=("k",), his=("a",)), "scd2")  # b would be blanked
    with pytest.raises(RoleError):
        resolve_roles(f("k"), f("k", "icw_eff_ts", "icw_exp_ts"), Roles(key=("k",)), "scd2")


def test_keygen_reconciles_source_and_target():
    f = lambda *names: T.StructType([T.StructField(n, T.StringType()) for n in names])
    with pytest.raises(RoleError):
        resolve_roles(f("k", "x"), f("k", "id"), Roles(key=("k",), sys=("id",)), "keygen")
    assert len(resolve_roles(f("k"), f("k", "y", "id"), Roles(key=("k",), sys=("id",)), "keygen").warnings) == 1


def test_sys_count_rules():
    one = T.StructType([T.StructField("k", T.StringType()), T.StructField("s", T.TimestampNTZType())])
    with pytest.raises(RoleError):
        resolve_roles(one, one, Roles(key=("k",)), "scd2")  # no SYS pair
    with pytest.raises(RoleError):
        resolve_roles(one, one, Roles(key=("k",), sys=("s", "s2")), "keygen")  # keygen takes exactly one
    assert resolve_roles(one, one, Roles(key=("k",), sys=("s",)), "keygen").sys == ["s"]


def test_publish_view(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    publish_view(df, "v_test_landing")
    assert spark.sql("select y from v_test_landing where x = 'a'").first().y == 1


def test_audit_frame(spark):
    rows = audit_frame(spark, "scd2_merge", [("Parameters:", "src=a"), ("Merge - rows inserted: 1", None)]).collect()
    assert [r.msg_txt for r in rows] == ["Parameters:", "Merge - rows inserted: 1"]
    assert rows[0].src_nm == "scd2_merge" and rows[0].user_nm and rows[0].role_nm is None


def test_schema_diff_tables(spark):
    from tidemark import schema_diff_tables
    spark.createDataFrame([], "k string, v int").createOrReplaceTempView("sd_src")
    spark.createDataFrame([], "k string, w int").createOrReplaceTempView("sd_tgt")
    got = {r.column_name: r.status for r in schema_diff_tables(spark, "sd_src", "sd_tgt").collect()}
    assert got == {"k": "both", "v": "source_only", "w": "target_only"}
