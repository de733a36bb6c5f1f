"""Queries over tables that are folders of part files, and over documents that share an id."""

from pyspark.sql import functions as F

from tidemark.functions.tokens import explode_tokens
from tidemark.plans.queries import QUERIES


def _documents(spark, path, rows, parts):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(parts).write.parquet(f"{path}/documents.parquet")


def test_a_folder_of_parts_lands_as_one_table(spark, tmp_path):
    _documents(spark, tmp_path, [(i, f"text {i}") for i in range(20)], 4)
    got = QUERIES["land_stream_available_now"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("documents.parquet", 20, 20)]


def test_tokens_of_a_shared_id_are_compared(spark, tmp_path):
    _documents(spark, tmp_path, [(1, "a b, a"), (1, "b [c] d e"), (2, "x  x"), (None, "p q"), (None, "q"), (4, None), (5, " ,")], 3)
    got = QUERIES["explode_tokens_docs"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {(1, 7, 5, 4), (2, 2, 1, 2), (None, 3, 2, 2)}


def test_tokens_are_not_dealt(spark, tmp_path):
    _documents(spark, tmp_path, [(i, " ".join(f"w{j}" for j in range(500))) for i in range(4)], 2)
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    t = explode_tokens(d, "text", upper=False, distinct_col="n")
    assert t.columns == ["doc_id", "n", "token_no", "token"]
    assert {tuple(r) for r in t.groupBy("doc_id").agg(F.max("n"), F.count("*")).collect()} == {(i, 500, 500) for i in range(4)}
    plan = QUERIES["explode_tokens_docs"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "token" not in plan.replace("n_tokens", "").replace("stage", "")  # one row a document is left, tokens are read no more
