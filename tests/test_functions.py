from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import normalise_name, unique_names, variant_path
from tidemark.functions.nulls import canonical, columntype_default, null_default, null_default_join
from tidemark.functions.tokens import explode_tokens


def test_normalise_names():
    assert normalise_name("leg[2]_cabinClass") == "leg_2_cabinClass"
    assert normalise_name('"ship to"."cust"') == "ship_to_cust"
    assert normalise_name('"l"[0]') == "l_0"
    assert normalise_name("a,b-c") == "a_b_c"
    assert unique_names(["a_b", "a_b", "A_B"]) == ["a_b", "a_b_2", "A_B_3"]
    assert variant_path(["b", "c d"], 1) == '$["b"]["c d"][1]'


def test_columntype_default_text():
    assert columntype_default("TEXT") == "''"
    assert columntype_default("NUMBER") == "0"
    assert "0001-01-01" in columntype_default("DATE")


def test_null_default_values(spark):
    df = spark.sql(
        "select cast(null as string) s, cast(null as int) i, cast(null as date) d, "
        "cast(null as timestamp_ntz) t, cast(null as decimal(10,2)) m, cast(null as boolean) b"
    )
    c = df.select(*[canonical(f.name, f.dataType).alias(f.name) for f in df.schema.fields])
    row = c.drop("t").first()
    assert row.s == "" and row.i == 0 and str(row.d) == "0001-01-01" and row.m == 0 and row.b is False
    # year 0000 does not fit a Python datetime; check it on the Spark side
    assert c.select(F.year("t").alias("y")).first().y == 0
    assert null_default(T.ArrayType(T.IntegerType())) is None


def test_null_default_join_matches_null_and_zero(spark):
    a = spark.createDataFrame([(1, None), (2, 0), (3, 5)], "id int, k int")
    b = spark.createDataFrame([(0, "zero"), (5, "five"), (None, "null")], "k2 int, name string")
    rows = null_default_join(a, b, [("k", "k2")]).select("id", "name").collect()
    got = sorted((r.id, r.name) for r in rows)
    # NULL equals 0 and NULL under the default rule
    assert got == [(1, "null"), (1, "zero"), (2, "null"), (2, "zero"), (3, "five")]


def test_explode_tokens(spark):
    df = spark.createDataFrame([(1, "key:a, b [c]  d"), (2, ""), (3, None)], "id int, t string")
    rows = explode_tokens(df, "t").collect()
    assert [(r.id, r.token_no, r.token) for r in rows] == [
        (1, 1, "KEY:A"), (1, 2, "B"), (1, 3, "C"), (1, 4, "D")
    ]
