"""Language identification by bit-sliced Bloom filters of character n-grams.

Every language learned is one bit. A table of ``slots`` words holds all the languages' Bloom
filters side by side: the word at a slot has the bits of the languages that set it, so looking up
an n-gram in all filters at once is an AND of its ``hashes`` words, whose bits name the languages
that contain the n-gram. Over a text, the popcount of each language is the number of n-grams it
contains, an n-gram of k languages counting 1/k for each; what a filter of that fill would answer
by chance (``fill ** hashes``) is taken out: ``(hits - n * fpr) / (1 - fpr)``. The language with
the highest corrected share wins; ties go to the language first by name. More than 64 languages take further words per slot.

Training counts n-grams over all documents of the training fold, by language, as Spark
aggregates; an n-gram enters the filter of every language in which it makes up at least
``min_rate`` of all n-grams (and occurs ``min_count`` times, which matters for small folds). So no
language has more than ``1 / min_rate`` of them, however large the input. They are counted first:
the filters have ``slots`` words, doubled until the fullest one answers by chance in at most
``max_fpr`` of cases, and where that takes more than ``max_bytes``, the rate doubles instead. Only
the filters (at most ``max_bytes``, unless ``slots`` is more) reach the driver and the tasks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a text none of whose
n-grams is known gets the language most frequent in training, with score 0; very long texts are read
whole; null languages are not learned; without anything to learn every text is ``und``; repeated
rows are judged alike; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
import regex

from ._util import fold, mix, slices, stage

_U = np.uint64
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}]+")


def letters_only(t: str | None) -> str:
    """Lower-cased letters with single spaces between and around words."""
    return " " + _OTHER.sub(" ", t.lower()).strip() + " " if t else "  "


def gram_hashes(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of ``texts`` and the index of the text of each."""
    joined = "\x00".join(texts) + "\x00"
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    m = len(c) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(m, n, dtype=np.uint64)
    ok = np.ones(m, dtype=bool)
    for i in range(n):
        part = c[i:i + m]
        h = h * _U(0x100000001B3) + part * _U(0x9E3779B97F4A7C15)
        ok &= part != 0
    doc = np.cumsum(c == 0)[:m]
    return mix(h[ok]), doc[ok]


@dataclass
class LanguageFilters:
    """``table[slot, word]``: bits of languages; ``fpr`` per language; ``names`` in bit order."""

    names: list[str]
    table: np.ndarray
    fpr: np.ndarray
    hashes: int
    n: int
    default: int

    def masks(self, h: np.ndarray) -> np.ndarray:
        """For each n-gram the languages whose filters contain it, as bit words."""
        slots, out = _U(len(self.table)), None
        for k in range(self.hashes):
            row = self.table[((h + _U(k) * ((h >> _U(32)) | _U(1))) % slots).astype(np.int64)]
            out = row if out is None else out & row
        return out

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        lang, score = [], np.zeros(len(texts))
        clean = [letters_only(t) for t in texts]
        for i, j in slices([4 * len(t) for t in clean], 1 << 19):
            h, doc = gram_hashes(clean[i:j], self.n)
            masks = self.masks(h)
            total = np.bincount(doc, minlength=j - i).astype(float)
            share = np.zeros((j - i, len(self.names)))
            weight = 1.0 / np.maximum(np.bitwise_count(masks).sum(axis=1), 1)
            weights = np.bincount(doc, weights=weight, minlength=j - i)
            for b in range(len(self.names)):
                hits = np.bincount(doc, weights=((masks[:, b // 64] >> _U(b % 64)) & _U(1)) * weight, minlength=j - i)
                fixed = (hits - weights * self.fpr[b]) / (1 - self.fpr[b])
                share[:, b] = np.clip(fixed / np.maximum(total, 1), 0, 1)
            best = np.argmax(share, axis=1)
            for k in range(j - i):
                if not _LETTER.search(clean[i + k]):
                    lang.append("und")
                    continue
                s = share[k].sum()
                lang.append(self.names[best[k] if s > 0 else self.default])
                score[i + k] = share[k, best[k]] / s if s > 0 else 0.0
        return lang, score


def train(docs: DataFrame, n: int = 4, slots: int = 1 << 20, hashes: int = 3, min_count: int = 3, min_rate: float = 1e-6,
          max_fpr: float = 0.01, max_bytes: int = 1 << 26) -> LanguageFilters:
    """Learn the filters from text and non-null ``lang`` of the training fold."""
    spark = docs.sparkSession
    d = docs.select("text", "lang", fold(F.col("doc_id")).alias("f")).where("f <> 0 AND lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # n-grams of a batch are summed before they leave the task
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                clean = [letters_only(t) for t in texts]
                parts = [np.unique(gram_hashes(clean[i:j], n)[0], return_counts=True) for i, j in slices([4 * len(t) for t in clean], 1 << 22)]
                if parts:
                    g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    c = np.bincount(at, weights=np.concatenate([p[1] for p in parts]))
                    yield pd.DataFrame({"lang": lang, "g": g.view(np.int64), "c": c.astype(np.int64)})

    sizes = d.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).orderBy("lang").collect()  # one row per language
    names = [r[0] for r in sizes]
    words = max(1, (len(names) + 63) // 64)
    if not names:
        return LanguageFilters([], np.zeros((1, 1), np.uint64), np.zeros(0), hashes, n, 0)
    grams = stage(d.mapInPandas(count, "lang string, g long, c long").groupBy("g", "lang").agg(F.sum("c").alias("c")), "langid")
    totals = {r[0]: r[1] for r in grams.groupBy("lang").agg(F.sum("c")).collect()}
    bit = {name: b for b, name in enumerate(names)}
    number = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(bit[name]))])
    rate = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(1.0 / max(1, totals.get(name, 0))))])
    least = slots
    while True:
        chosen = grams.where((F.col("c") >= min_count) & (F.col("c") * rate[F.col("lang")] >= min_rate))
        most = max((r[1] for r in chosen.groupBy("lang").count().collect()), default=0)  # one row per language
        slots = least
        while 1 - math.exp(-hashes * most / slots) > max_fpr ** (1 / hashes):
            slots *= 2
        if slots == least or slots * words * 8 <= max_bytes:
            break
        min_rate *= 2

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h = b["g"].to_numpy(np.int64).view(np.uint64)
            for k in range(hashes):
                s = ((h + _U(k) * ((h >> _U(32)) | _U(1))) % _U(slots)).astype(np.int64)
                yield pd.DataFrame({"slot": s, "b": b["b"].to_numpy(np.int32)})

    set_bits = chosen.select("g", number[F.col("lang")].alias("b")).mapInPandas(place, "slot long, b int")
    part = set_bits.groupBy("slot", F.expr("b div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("m"))
    got = part.toPandas()  # at most `slots` rows per word of languages
    table = np.zeros((slots, words), dtype=np.uint64)
    table[got["slot"].to_numpy(np.int64), got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64).view(np.uint64)
    fill = np.array([float(((table[:, b // 64] >> _U(b % 64)) & _U(1)).mean()) for b in range(len(names))])
    default = max(range(len(names)), key=lambda b: (sizes[b][1], -b))
    return LanguageFilters(names, table, np.minimum(fill**hashes, 0.99), hashes, n, default)


def identify(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``; reads only the text."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # slots * 8 bytes per 64 languages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = LanguageFilters(**shared.value)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            if not filters.names:
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
            else:
                lang, score = filters.judge(texts)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "lang_pred": lang, "score": score})

    out = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
