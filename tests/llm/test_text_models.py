"""Positive-unlabelled classifier and language filters: learning, folds, odd inputs."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid, quality_pu


def is_held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_nnpu_separates_without_negative_labels():
    rng = np.random.default_rng(1)
    k = len(quality_pu.FEATURES)
    good, bad = rng.normal(0, 1, (800, k)), rng.normal(4, 1, (200, k))
    model = quality_pu.fit_nnpu(good[:400], np.concatenate((good[400:], bad)), 2 / 3)
    assert (model.score(rng.normal(0, 1, (200, k))) > 0.5).mean() > 0.95
    assert (model.score(rng.normal(4, 1, (200, k))) < 0.5).mean() > 0.95


def quality_tables(spark):
    good = [(i, f"the house number {i} of the street is on the left and the garden of it is large, with trees and a lake {i * 7}.") for i in range(300)]
    junk = [(1000 + i, "### ".join(f"w{i}x{j}" for j in range(20))) for i in range(80)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_on_held_out_rows(spark, odd):
    docs, labels = quality_tables(spark)
    model = quality_pu.train(docs, labels)
    got = quality_pu.score_quality(docs, model).collect()
    assert all(r.held_out == is_held(r.doc_id) for r in got) and any(r.held_out for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([(r.predicted == 1) == (r.doc_id < 1000) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    scored = quality_pu.score_quality(odd, model)
    assert scored.count() == odd.count() and scored.where("score IS NULL").count() == 0
    same = [r.score for r in scored.where("doc_id = 5").collect()]
    assert same[0] == same[1]
    kept = quality_pu.quality_filter(odd, model)
    assert kept.columns == odd.columns and kept.where("doc_id = 4").count() == scored.where("doc_id = 4 AND predicted = 1").count()


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = quality_tables(spark)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_pu.train(docs, x) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior


def test_quality_without_anything_to_learn(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_pu.train(none, labels)
    assert quality_pu.score_quality(none, model).count() == 0
    assert {r.score for r in quality_pu.score_quality(odd, quality_pu.train(odd, labels)).collect()} == {0.5}


LANGS = {"en": "the weather of this morning was with the rain and thunder", "fr": "le château près de la rivière était très agréable pour les élèves",
         "de": "das schöne Wetter heute morgen überraschte die fröhlichen Kinder", "ru": "сегодня утром шёл сильный дождь над городом"}


def language_docs(spark):
    rows = []
    for k, (lang, s) in enumerate(LANGS.items()):
        w = s.split()
        rows += [(1000 * k + i, " ".join(w[(i + j) % len(w)] for j in range(len(w))), lang) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_on_held_out_rows(spark, odd):
    docs = language_docs(spark)
    model = langid.train(docs)
    assert model.names == sorted(LANGS) and model.table.shape == (1 << 20, 1)
    got = langid.identify(docs.withColumn("lang", F.lit("xx")), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in got) and all(r.held_out == is_held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    out = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == out[7].lang_pred == "und" and out[1].score == 0
    assert out[8].lang_pred in LANGS and langid.identify(odd, model).count() == odd.count()


def test_bit_sliced_lookup_equals_single_filters(spark):
    model = langid.train(language_docs(spark))
    h, _ = langid.gram_hashes([langid.letters_only(LANGS["de"])], model.n)
    masks = model.masks(h)[:, 0]
    for b in range(len(model.names)):
        bits = (model.table[:, 0] >> np.uint64(b)) & np.uint64(1)
        single = np.ones(len(h), dtype=np.uint64)
        for k in range(model.hashes):
            single &= bits[((h + np.uint64(k) * ((h >> np.uint64(32)) | np.uint64(1))) % np.uint64(len(bits))).astype(np.int64)]
        assert np.array_equal((masks >> np.uint64(b)) & np.uint64(1), single)


def test_one_ngram_names_all_its_languages(spark):
    rows = [(100 * k + i, f"gemeinsam {own} gemeinsam", lang) for k, (lang, own) in enumerate({"aa": "rovka", "bb": "tulpe", "cc": "quilf", "zz": ""}.items()) for i in range(20)]
    rows = [(i, t if lang != "zz" else "other words entirely", lang) for i, t, lang in rows] + [(900 + i, "other words entirely", "zz") for i in range(40)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    h, _ = langid.gram_hashes([" gemeinsam "], model.n)
    assert set(model.masks(h)[:, 0].tolist()) == {0b111} and model.names[model.default] == "zz"
    lang, score = model.judge(["gemeinsam", "gemeinsam tulpe", "words"])
    assert lang == ["aa", "bb", "zz"] and abs(score[0] - 1 / 3) < 0.01 and score[1] > 1 / 3


def test_filters_grow_with_their_ngrams(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list(letters), 6)) for _ in range(40)), lang) for lang, letters in (("aa", "abcdefgh"), ("bb", "ijklmnop")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = langid.train(docs, slots=1 << 10, min_count=1)
    assert len(small.table) > 1 << 10 and small.fpr.max() <= 0.015
    bound = langid.train(docs, slots=1 << 10, min_count=1, max_bytes=1 << 14)
    assert bound.table.nbytes <= 1 << 14 and bound.fpr.max() <= 0.015
    again = langid.train(docs.crossJoin(spark.range(4).select()), slots=1 << 10, min_count=1, min_rate=2e-4)
    assert np.array_equal(again.table, langid.train(docs, slots=1 << 10, min_count=1, min_rate=2e-4).table)  # the same at every size
    got = langid.identify(docs, small).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    assert got.count() > 0 and set(small.judge([t for _, t, lang in rows if lang == "bb"])[0]) == {"bb"}


def test_more_languages_than_a_word_has_bits(spark):
    rows = [(10 * k + i, f"{chr(0x4E00 + k * 8)}{chr(0x4E01 + k * 8)}{chr(0x4E02 + k * 8)}{chr(0x4E03 + k * 8)}" * 3, f"l{k:02d}") for k in range(70) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.table.shape[1] == 2
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred <> lang").count() == 0


def test_language_without_anything_to_learn(spark, odd, none):
    model = langid.train(none)
    assert langid.identify(none, model).count() == 0
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()} == {("und", 0.0)}
