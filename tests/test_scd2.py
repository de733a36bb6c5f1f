"""Type-2 hand cases of FIXTURES.md section 2 (decisions D1, D2, D7, D16)."""

import pytest

from tidemark import Roles, RoleError, merge_summary, scd2_merge, scd2_merge_set

from conftest import as_of, day

OPEN_SYS = "9999-12-31 23:59:59.999"
TGT = "k string, his string, icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz"
ROLES = Roles(key=("k",), his=("his",))


def tgt_frame(spark, rows):
    from datetime import datetime
    open_end = datetime(9999, 12, 31, 23, 59, 59, 999000)
    return spark.createDataFrame([(k, h, day(1), open_end) for k, h in rows], TGT)


def run(spark, tgt_rows, src_rows, window=None, opr=False):
    tgt = tgt_frame(spark, tgt_rows)
    schema = "k string, his string" + (", opr string" if opr else "")
    src = spark.createDataFrame(src_rows, schema)
    roles = Roles(key=("k",), his=("his",), opr="opr" if opr else None)
    ms = scd2_merge_set(src, tgt, roles, as_of(), window=window).collect()
    closed = sorted((r.k, r.his) for r in ms if r.icw_exp_ts == day(100))
    inserted = sorted((r.k, r.his) for r in ms if r.icw_eff_ts == day(100))
    return closed, inserted


def test_delta(spark):
    closed, ins = run(spark, [("same", "a"), ("chg", "a"), ("gone", "q")], [("same", "a"), ("chg", "b"), ("new", "c")])
    assert closed == [("chg", "a")]
    assert ins == [("chg", "b"), ("new", "c")]


def test_window_all(spark):
    closed, ins = run(spark, [("same", "a"), ("chg", "a"), ("gone", "q")],
                      [("same", "a"), ("chg", "b"), ("new", "c")], window="1=1")
    assert closed == [("chg", "a"), ("gone", "q")]
    assert ins == [("chg", "b"), ("new", "c")]


def test_null_key_window_keeps_row(spark):
    assert run(spark, [(None, "a")], [(None, "a")], window="1=1") == ([], [])


def test_null_equals_default(spark):
    assert run(spark, [("k", None)], [("k", "")]) == ([], [])


def test_delete_in_delta_mode(spark):
    closed, ins = run(spark, [("k", "a")], [("k", "a", "E")], opr=True)
    assert closed == [("k", "a")] and ins == []


def test_exact_duplicate_source(spark):
    closed, ins = run(spark, [("k", "a")], [("k", "b"), ("k", "b")])
    assert closed == [("k", "a")] and ins == [("k", "b")]


def test_apply_and_summary(spark):
    tgt = tgt_frame(spark, [("same", "a"), ("chg", "a"), ("gone", "q")])
    src = spark.createDataFrame([("same", "a"), ("chg", "b"), ("new", "c")], "k string, his string")
    out = scd2_merge(src, tgt, ROLES, as_of(), keep_action=True)
    s = merge_summary(out).first()
    assert (s.rows_inserted, s.rows_updated) == (2, 1)
    rows = out.drop("__action").collect()
    assert len(rows) == 5
    current = sorted((r.k, r.his) for r in rows if r.icw_exp_ts > day(100))
    assert current == [("chg", "b"), ("gone", "q"), ("new", "c"), ("same", "a")]
    # a second run with the same input and as_of changes nothing
    again = scd2_merge(src, out.drop("__action"), ROLES, as_of(), keep_action=True)
    s2 = merge_summary(again).first()
    assert (s2.rows_inserted, s2.rows_updated) == (0, 0)


def test_role_checks(spark):
    tgt = tgt_frame(spark, [("k", "a")])
    src = spark.createDataFrame([("k", "a")], "k string, his string")
    with pytest.raises(RoleError):
        scd2_merge_set(src, tgt, Roles(key=()), as_of())
    with pytest.raises(RoleError):
        scd2_merge_set(src.drop("his"), tgt, ROLES, as_of())  # target HIS column missing in source
    with pytest.raises(RoleError):
        scd2_merge_set(src, tgt, Roles(key=("k",), bus=("icw_eff_ts", "icw_exp_ts")), as_of())
    with pytest.raises(RoleError):
        Roles.parse("KEY:k; UPD:x")
    with pytest.raises(RoleError):
        Roles.parse("KEY:k; FOO:x")
    r = Roles.parse("KEY:[k1, k2]; BUS:[s,e]; OPR:op")
    assert r.key == ("k1", "k2") and r.bus == ("s", "e") and r.opr == "op"


def test_source_duplicates_report(spark):
    from tidemark import source_duplicates
    tgt = tgt_frame(spark, [("k", "a")])
    src = spark.createDataFrame([("k", "b"), ("k", "b"), ("j", "x"), ("j", "y"), ("m", None), ("m", "")],
                                "k string, his string")
    got = sorted((r.k, r.n_versions) for r in source_duplicates(src, tgt, ROLES).collect())
    assert got == [("j", 2)]  # exact duplicates collapse; NULL equals '' for text


def test_second_run_keeps_the_other_row_of_a_key(spark):
    """Two tracked rows of one key, then only one of them: the other is closed, this one stays current."""
    schema = "k string, his string"
    none = spark.createDataFrame([], schema + ", icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz")
    one = scd2_merge(spark.createDataFrame([("k", "a"), ("k", "b")], schema), none, ROLES, "2000-02-01 00:00:00")
    two = scd2_merge(spark.createDataFrame([("k", "a")], schema), one, ROLES, "2000-03-01 00:00:00").collect()
    assert sorted((r.his, r.icw_exp_ts.year) for r in two) == [("a", 9999), ("b", 2000)]
