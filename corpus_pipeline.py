"""Corpus pipeline: stages of the corpus operators, each over all that its predecessor kept.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``. ``run`` applies them to ``documents``.

Defined cases: documents with a null text go through unless the classifier rejects them; a null
doc_id is never a near copy and never contaminated by id; of a repeated row one stays; a document with two unlike texts
keeps both; other columns pass through all stages but the last; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontam, ngram_join, pii, quality_pu
from tidemark.llm._util import stage as _write


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on this input and the labels, does not reject."""
    return quality_pu.quality_filter(docs, quality_pu.train(docs, _table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return ngram_join.keep_one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; a given n_chars follows the text."""
    out = pii.replace_pii(docs, count=None)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and whether they decode to the text again."""
    import public_tokenizers  # needed by this stage alone

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source", "text"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("encode", encode),
]

#: The classifier and the encoder have no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is written to the shared checkpoint folder for the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = _write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
