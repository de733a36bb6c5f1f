"""Registered queries of the corpus operators: thin calls with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: F401

from . import bpe as _bpe
from . import decontam as _decontam
from . import hard_negatives as _negatives
from . import html_text as _html
from . import langid as _langid
from . import ngram_join as _join
from . import phrases as _phrases
from . import pii as _pii
from . import quality_pu as _pu
from . import quality_rules as _rules
from . import substring as _substring
from . import token_counts as _counts
from . import url_rules as _urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rules.quality_rules(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words", "failed")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls.filter_urls(_table(spark, sf_dir, "pages"))


def op8_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _pu.score_quality(docs, _pu.train(docs, _table(spark, sf_dir, "labels")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _langid.identify(docs, _langid.train(docs))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = _bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _html.extract_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.replace_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _substring.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _join.link_documents(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return _negatives.mine_hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phrases.mine_phrases(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return _counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op9_quality_rules": op9_quality_rules,
    "op3_url_rules": op3_url_rules,
    "op1_byte_bpe": op1_byte_bpe,
    "op4_html_text": op4_html_text,
    "op5_decontaminate": op5_decontaminate,
    "op10_pii": op10_pii,
    "op7_substring_dedup": op7_substring_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op8_quality_pu": op8_quality_pu,
    "op6_language_id": op6_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_counts": op12_token_counts,
    "op13_phrases": op13_phrases,
}
