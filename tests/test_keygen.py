from datetime import datetime

from tidemark import assign_keys, dense_number, keygen, keygen_summary, lookup_keys

OPEN = datetime(9999, 12, 31, 23, 59, 59)
AS_OF = "2024-06-01 00:00:00"


def hub(spark):
    return spark.createDataFrame(
        [("a", 1, datetime(2020, 1, 1), OPEN), ("b", 7, datetime(2020, 1, 1), datetime(2021, 1, 1))],
        "k string, sk bigint, icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz",
    )


def test_keygen_fixture(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "k string, v int")
    h = hub(spark)
    cache = assign_keys(lookup_keys(src, h, ["k"], "sk", AS_OF), h, ["k"], "sk")
    assert sorted((r.k, r.sk, r.is_new) for r in cache.collect()) == [("a", 1, False), ("b", 8, True), ("c", 9, True)]
    out = keygen(src, h, ["k"], "sk", AS_OF, mode="target", cache=cache)
    assert sorted((r.k, r.v, r.sk) for r in out.collect()) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 8), ("c", 4, 9)]
    s = keygen_summary(cache, out).first()
    assert (s.keys_needed, s.keys_generated, s.rows_written) == (3, 2, 4)


def test_keygen_source_mode_and_null_keys(spark):
    src = spark.createDataFrame([(None, 1, None), ("", 2, None), ("a", 3, 99)], "k string, v int, sk bigint")
    h = hub(spark)
    out = keygen(src, h, ["k"], "sk", AS_OF, mode="source").collect()
    got = sorted((r.v, r.sk) for r in out)
    # NULL and '' are one key (D9) and get one new number; existing keys take the hub's
    assert got == [(1, 8), (2, 8), (3, 1)]


def test_dense_number_matches_global_order(spark):
    df = spark.range(0, 5000).selectExpr("cast((id * 7919) % 5003 as bigint) as x")
    rows = dense_number(df, ["x"], "n", partitions=7).collect()
    pairs = sorted((r.x, r.n) for r in rows)
    assert [n for _, n in pairs] == list(range(1, 5001))


def test_duplicate_current_hub_rows_take_smallest(spark):
    from tidemark.operators.keygen import hub_duplicates
    h = spark.createDataFrame(
        [("a", 5, datetime(2020, 1, 1), OPEN), ("a", 3, datetime(2020, 1, 1), OPEN), ("b", 9, datetime(2020, 1, 1), OPEN)],
        "k string, sk bigint, icw_eff_ts timestamp_ntz, icw_exp_ts timestamp_ntz",
    )
    src = spark.createDataFrame([("a",), ("b",)], "k string")
    got = sorted((r.k, r.sk) for r in lookup_keys(src, h, ["k"], "sk", AS_OF).collect())
    assert got == [("a", 3), ("b", 9)]
    assert [(r.k, r.n_current) for r in hub_duplicates(h, ["k"], AS_OF).collect()] == [("a", 2)]
