"""Removal of passages that repeat anywhere: count-min prefilter, then exact grouping.

A window is ``window`` consecutive words. Each window has an anchor: of its ``gram``-word runs the
one with the least hash, at its place in the text. Equal windows have equal anchors, so the number
of places with an anchor is never less than the number of places with the window; neighbouring
windows mostly share theirs, which makes anchors far fewer than windows.

First pass: every partition sketches its anchors (``depth`` cells of ``2 ** bits``, counted to two);
the sketches are merged cell block by cell block, and only the bits "counted twice" reach the driver
(``depth * 2 ** bits / 8`` bytes, whatever the input) and are broadcast. A window whose anchor has a
cell counted once is unique for certain. Second pass: the windows estimated repeated are grouped
exactly, by 128-bit hash, with partial sums before the shuffle; those that turn out to be unique
(``sum = 1``) go back to their text, and what remains of the estimate is exact. No repeated window
is lost; more text than the sketch was sized for only sends more windows to the exact pass.

Long texts are windows like any other; a hot passage is summed map-side and never gathered. Texts
are named by 64-bit hashes where unique windows return to them (a window of a repeated text is
repeated, so only texts that occur once are ever named).

Defined cases: null and empty texts have no words; texts shorter than a window lose none; repeated
rows lose every word that a window covers; an empty table gives an empty result; all columns of
the input pass through (but for earlier n_words and n_removed), the text replaced by the kept words joined by one space (null stays null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ._util import free_name, mix, slices, stage, text_bytes, text_parts, window_hashes, without, word_hashes

_U = np.uint64
_BLOCK_BITS = 18


def anchors(h: np.ndarray, owner: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows inside one text, and place and hash of each window's anchor.

    ``h``: word hashes; ``owner``: the text of each word. Ties take the first of the least.
    """
    m = len(h) - window + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    g = window_hashes(h, gram, 7)
    # sliding minimum over the grams of a window by doubling, carrying the places
    low, at, span, width = g, np.arange(len(g)), window - gram + 1, 1
    while width < span:
        step = min(width, span - width)
        a, b = low[:-step], low[step:]
        left = a <= b
        low, at = np.where(left, a, b), np.where(left, at[:-step], at[step:])
        width += step
    starts = np.flatnonzero(owner[:m] == owner[window - 1:])
    return starts, at[starts], low[starts]


def cells(h: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    """Cell of each hash in every row of the sketch, rows one after the other."""
    return [(mix(h + _U(k + 1)) >> _U(64 - bits)) + _U(k << bits) for k in range(depth)]


def pack_cells(h: np.ndarray, depth: int, bits: int) -> pa.RecordBatch:
    """Cells of the hashes ``h`` by block, each cell with whether its hash comes twice or more."""
    h, n = np.unique(h, return_counts=True)
    all_cells, twice = np.concatenate(cells(h, depth, bits)), np.tile(n > 1, depth)
    order = np.argsort(all_cells)
    packed = (all_cells[order] & _U((1 << _BLOCK_BITS) - 1)).astype("<u4") << 1 | twice[order]
    block = (all_cells[order] >> _U(_BLOCK_BITS)).astype(np.int64)
    heads = np.flatnonzero(np.diff(block, prepend=-1))
    raw = [x.astype("<u4").tobytes() for x in np.split(packed, heads[1:])]
    return pa.RecordBatch.from_arrays([pa.array(block[heads].astype(np.int32)), pa.array(raw, pa.binary())], names=["block", "cells"])


def merge_cells(parts: DataFrame, depth: int, bits: int) -> np.ndarray:
    """Bits of the merged sketch of ``block, cells`` rows: whether a cell was counted at least twice.

    A block has a fixed size and is summed as it streams in, at the cells that a part fills only; blocks are merged in parallel
    tasks and staged, and the driver reads ``depth * 2 ** bits / 8`` bytes of them in all.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = np.frombuffer(raw, dtype="<u4")
                total = sums.setdefault(block, np.zeros(1 << _BLOCK_BITS, dtype=np.uint8))
                cell, times = got >> 1, 1 + (got & 1)
                heads = np.flatnonzero(np.diff(cell, prepend=cell[0] + 1))  # in order; cells repeat within one part where hashes share them
                cell, times = cell[heads], np.add.reduceat(times, heads)
                total[cell] = np.minimum(total[cell] + np.minimum(times, 2), 2)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(total > 1).tobytes()], pa.binary())], names=["block", "twice"])

    out = np.zeros((depth << bits) // 8, dtype=np.uint8)
    size = (1 << _BLOCK_BITS) // 8
    # staged first: an iterator over the merge itself would run its tasks one after the other
    for block, twice in stage(parts.repartition("block").mapInArrow(merge, "block int, twice binary"), "cells").toLocalIterator():
        out[block * size:(block + 1) * size] = np.frombuffer(twice, dtype=np.uint8)
    return out


def sketch(docs: DataFrame, window: int = 35, gram: int = 8, depth: int = 2, bits: int = 25, text: str = "text") -> np.ndarray:
    """Merged sketch of the anchors of all windows: bits of the cells counted at least twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for b in batches:
            for texts, i, j in ((texts, i, j) for texts in text_parts(b.column(0)) for i, j in slices([len(t) for t in texts])):
                h, offsets = word_hashes(texts[i:j])
                owner = np.repeat(np.arange(j - i), np.diff(offsets))
                _, place, low = anchors(h, owner, window, gram)
                if len(place):
                    kept.append(low[np.flatnonzero(np.diff(place, prepend=-1))])
                    held += len(kept[-1])
                if held > 2_000_000:
                    yield pack_cells(np.concatenate(kept), depth, bits)
                    kept, held = [], 0
        if kept:
            yield pack_cells(np.concatenate(kept), depth, bits)

    return merge_cells(docs.select(text).mapInArrow(count, "block int, cells binary"), depth, bits)


def estimated(twice: np.ndarray, h: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """Whether every cell of each hash was counted at least twice."""
    out = np.ones(len(h), dtype=bool)
    for c in cells(h, depth, bits):
        c = c.astype(np.int64)
        out &= (twice[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return out


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8, depth: int = 2, bits: int = 25, text: str = "text") -> DataFrame:
    """``docs`` (all columns, ``text`` the kept words) with ``n_words`` and ``n_removed``."""
    spark, docs = docs.sparkSession, without(docs, "n_words", "n_removed")
    shared = spark.sparkContext.broadcast(sketch(docs, window, gram, depth, bits, text))

    def flagged(texts: list[bytes]):
        """Word hashes, offsets and estimated window starts of a slice of texts."""
        h, offsets = word_hashes(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        starts, _, low = anchors(h, owner, window, gram)
        return h, offsets, owner, starts[estimated(shared.value, low, depth, bits)] if len(starts) else starts

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, names = text_bytes(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
            for i, j in slices([len(t) for t in texts], 1 << 21):
                h, offsets, owner, at = flagged(texts[i:j])
                if len(at):
                    first, second = window_hashes(h, window, 1)[at], window_hashes(h, window, 2)[at]
                    key, where, n = np.unique(first, return_index=True, return_counts=True)  # sums equal windows of the slice
                    if len(key) < len(np.unique(second)):  # a collision of half a key: no sums here
                        key, where, n = first, np.arange(len(first)), np.ones(len(first), dtype=np.int64)
                    at, second = at[where], second[where]
                    place = at - offsets[owner[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(second.view(np.int64)), pa.array(names[i:j][owner[at]]),
                                                      pa.array(place << 2 | np.minimum(n, 2))], names=["h1", "h2", "doc", "at"])

    named = docs.select(F.col(text), F.xxhash64(F.col(text)).alias("doc")).where(F.col(text) != "")
    found = named.mapInArrow(windows, "h1 long, h2 long, doc long, at long")
    # at = place * 4 + count (to two); a group is unique when its counts sum to one
    single = found.groupBy("h1", "h2").agg(F.sum(F.col("at").bitwiseAND(F.lit(3))).alias("n"), F.min("doc").alias("doc"), F.min(F.shiftright("at", 2)).alias("place")).where("n = 1")
    unique = single.groupBy("doc").agg(F.collect_list(F.col("place").cast("int")).alias("_unique"))  # bounded by a text
    columns, at_text = docs.columns, docs.columns.index(text)
    name, places = free_name(docs, "_doc"), free_name(docs, "_unique")
    keyed = docs.withColumn(name, F.xxhash64(F.col(text)))
    unique = unique.select(F.col("doc").alias(name), F.col("_unique").alias(places))
    joined = keyed.join(unique, name, "left").select(*[keyed[c] for c in columns], places)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, unique_at = b.column(at_text), b.column(len(columns))
            texts, given = text_bytes(column), column.is_valid().to_numpy(zero_copy_only=False)
            kept: list[str | None] = []
            n_words, n_removed = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for i, j in slices([len(t) for t in texts], 1 << 21):
                _, offsets, owner, at = flagged(texts[i:j])
                for k in range(i, j):
                    a, z = offsets[k - i], offsets[k - i + 1]
                    own = at[np.searchsorted(at, a):np.searchsorted(at, z)] - a
                    words = texts[k].split()
                    n_words[k] = len(words)
                    if len(own):
                        here = unique_at[k].values
                        if here is not None and len(here):
                            own = np.setdiff1d(own, here.to_numpy(zero_copy_only=False), assume_unique=True)
                        edge = np.zeros(len(words) + 1, dtype=np.int32)
                        np.add.at(edge, own, 1)
                        np.add.at(edge, own + window, -1)
                        gone = np.cumsum(edge)[:-1] > 0
                        n_removed[k] = gone.sum()
                        if n_removed[k]:
                            words = [w for w, g in zip(words, gone.tolist()) if not g]
                    kept.append(b" ".join(words).decode("utf-8", "surrogatepass") if given[k] else None)
            out = [pa.array(kept, pa.string()) if c == at_text else b.column(c) for c in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*out, pa.array(n_words), pa.array(n_removed)], names=schema.names)

    return joined.mapInArrow(strip, schema)
