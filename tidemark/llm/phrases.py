"""Phrase collocations by weighted acyclic automata.

Words of one language carry a 64-bit label (of language and word). A count transducer maps sequences of
labels to their counts: an acyclic automaton whose equal states (same arcs, same outputs) are one state, with
the count on a path's last arc. Three passes over the texts count single words, pairs and runs of three and
four; since a phrase is never more frequent than its parts, the second pass takes only words counted
``least`` times, and the third only runs of such pairs. (Bitmaps of the frequent labels and pairs are
broadcast; their size is bounded, and a wrong hit costs time only.)

Each pass: a task cuts its texts into shards of ``shard`` words, sorts a shard's runs, and builds one
transducer for every range of an order-preserving key of the runs. The ranges are quantiles of a sample, so
that a frequent prefix is cut like any other (the sample settles balance, never results). A range's
transducers are united in sorted order, their weights summed; sums of prefixes that lie in several ranges are added up at last.

The frequent phrases form a count transducer again, in slices by first label; composing it with a candidate's
parts gives their counts. It is broadcast up to ``broadcast_phrases`` counted phrases; beyond that the parts meet the phrases in joins.
A candidate is dropped where a candidate one word longer that holds it has ``held`` percent of its count: a
longer one that does implies one in between that does.

Defined cases: a null or empty text has no words; a null language counts as ``und``; very long texts are read
whole, in slices of rows; repeated rows count each; ties are settled by count, then phrase; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._util import hashed_words, mix, slices, stage, text_bytes

_U = np.uint64
_DEPTH = 4
_UPPER, _BREAKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_UPPER + _BREAKS, _UPPER.lower() + b"\n" * len(_BREAKS))
_ROWS = "slice int, paths binary, label long, lang string, word string"


# ---- count transducers ------------------------------------------------------------------------

class CountTransducer:
    """Counts of sequences of ``depth`` labels; label 0 fills up shorter ones.

    ``labels``: sorted distinct labels; a level holds, for its states in turn, the number of arcs, and for the arcs the label's
    place and the next state, or the count at the last level.
    """

    def __init__(self, labels: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.labels, self.levels = labels, levels

    @classmethod
    def build(cls, labels: np.ndarray, places: np.ndarray, counts: np.ndarray) -> CountTransducer:
        """From sorted distinct rows of label places; states are shared from the last level up."""
        n, depth = places.shape
        if not n:
            return cls(labels, [(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))] * depth)
        new = np.logical_or.accumulate(places[1:] != places[:-1], axis=1)
        heads = [np.zeros(1, np.int64)] + [np.concatenate(([0], np.flatnonzero(new[:, d]) + 1)) for d in range(depth)]
        levels, out = [], counts.astype(np.int64)
        for d in range(depth - 1, -1, -1):
            arc, state = heads[d + 1], heads[d]
            label, start = places[arc, d], np.searchsorted(arc, state)
            width = np.diff(np.append(start, len(arc)))
            owner = np.repeat(np.arange(len(state)), width)
            print_ = np.add.reduceat(mix(mix(label.astype(_U) + _U(1)) ^ out.astype(_U)), start) + width.astype(_U)
            _, first, group = np.unique(print_, return_index=True, return_inverse=True)
            like = first[group]  # the state that looks the same; arcs are compared, so a hash never decides
            twin = start[like[owner]] + np.minimum(np.arange(len(arc)) - start[owner], width[like[owner]] - 1)
            same = (width == width[like]) & np.logical_and.reduceat((label == label[twin]) & (out == out[twin]), start)
            final = np.where(same, like, np.arange(len(state)))
            kept = np.unique(final)
            arcs = _ranges(start[kept], width[kept])
            levels.append((width[kept], label[arcs], out[arcs]))
            out = np.searchsorted(kept, final)
        return cls(labels, levels[::-1])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences (rows of labels, in order) and their counts."""
        state, columns = np.zeros(1, np.int64), []
        for width, label, out in self.levels:
            start = np.cumsum(width) - width
            arcs = _ranges(start[state], width[state])
            columns = [np.repeat(c, width[state]) for c in columns] + [label[arcs]]
            state = out[arcs]
        return self.labels[np.stack(columns, axis=1)], state

    def weights(self, rows: np.ndarray) -> np.ndarray:
        """Counts of the sequences ``rows`` (labels), 0 where the transducer has none: its composition with each row."""
        state, ok = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.labels) > 0)
        for d, (width, label, out) in enumerate(self.levels):
            if not len(label):
                return np.zeros(len(rows), np.int64)
            place = np.minimum(np.searchsorted(self.labels, rows[:, d]), len(self.labels) - 1)
            ok &= self.labels[place] == rows[:, d]
            key = np.repeat(np.arange(len(width)), width) * len(self.labels) + label
            wanted = state * len(self.labels) + place
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            ok &= key[at] == wanted
            state = np.where(ok, out[at], 0)
        return np.where(ok, state, 0)

    def pack(self) -> bytes:
        arrays = [self.labels, *(a for level in self.levels for a in level)]
        small = [arrays[0].astype("<u8"), *(a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays[1:])]
        raw = b"".join(struct.pack("<BI", a.dtype.itemsize, len(a)) + a.tobytes() for a in small)
        return struct.pack("<I", len(raw)) + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def unpack(cls, data: bytes) -> CountTransducer:
        raw, at, arrays = pa.decompress(data[4:], struct.unpack_from("<I", data)[0], codec="zstd", asbytes=True), 0, []
        while at < len(raw):
            width, n = struct.unpack_from("<BI", raw, at)
            arrays.append(np.frombuffer(raw, f"<u{width}", n, at + 5))
            at += 5 + width * n
        rest = [a.astype(np.int64) for a in arrays[1:]]
        return cls(arrays[0].astype(_U), [tuple(rest[i:i + 3]) for i in range(0, len(rest), 3)])


def _ranges(start: np.ndarray, width: np.ndarray) -> np.ndarray:
    """``start[i], .., start[i] + width[i] - 1`` for each i, one after the other."""
    return np.repeat(start - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))


def unite(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of all ``parts`` (rows, counts), their counts summed."""
    rows, counts = np.concatenate([r for r, _ in parts]), np.concatenate([c for _, c in parts])
    if len(parts) == 1 or not len(rows):
        return rows, counts
    keys = [rows[:, 0]]
    if rows.shape[1] > 1:  # two labels in one number, by their places
        labels = distinct(rows)[0]
        place = places_of(labels, rows).reshape(rows.shape)
        keys = [place[:, d] * len(labels) + place[:, d + 1] for d in range(0, rows.shape[1], 2)]
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    heads = np.flatnonzero(new)
    return rows[order[heads]], np.add.reduceat(counts[order], heads)


# ---- texts to labels and runs -------------------------------------------------------------------

def lang_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _labelled(h: np.ndarray, salt: np.ndarray | np.uint64) -> np.ndarray:
    x = mix(h ^ salt)
    return np.where(x == 0, _U(1), x)


#: Hash of the empty word; its count in a language is the number of all words.
_EMPTY = mix(np.array([0x5BD1E995], dtype=np.uint64))


def words_of(texts: list[bytes], salts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, whether the next word follows in the same piece, owner, and the words' places in the joined bytes."""
    joined, starts, stops, h, offsets = hashed_words([t.translate(_TABLE) for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    piece = np.cumsum(joined == 10)[starts] if len(starts) else starts
    follows = np.append((piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1]), False)[:len(h)]
    return _labelled(h, salts[owner]), follows, owner, joined, starts, stops


def order_key(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row that takes an equal share of bits from every label."""
    depth = rows.shape[1]
    share = 64 // depth
    out = np.zeros(len(rows), dtype=_U)
    for d in range(depth):
        out |= (rows[:, d] >> _U(64 - share)) << _U(64 - share * (d + 1))
    return out


def _signed(key: np.ndarray) -> np.ndarray:
    return (key ^ _U(1 << 63)).view(np.int64)


def _has(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(h), dtype=bool)
    cell = (h >> _U(64 - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 1


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _U(0x9E3779B97F4A7C15)) ^ b)


def runs(label: np.ndarray, follows: np.ndarray, depth: int, words, pairs) -> np.ndarray:
    """Rows of labels to count: single words, pairs of frequent words, or runs of three or four with frequent pairs."""
    if depth == 1:
        return label[:, None]
    known = _has(words, label)
    link = follows[:-1] & known[:-1] & known[1:] if len(label) else follows
    if depth == 2:
        at = np.flatnonzero(link)
        return np.stack((label[at], label[at + 1]), axis=1)
    at = np.flatnonzero(link)
    link[at] = _has(pairs, pair_hash(label[at], label[at + 1]))
    at = np.flatnonzero(link[:-1] & link[1:])
    four = np.append(link, False)[at + 2]
    last = np.where(four, np.append(label, _U(0))[at + 3], _U(0))
    return np.stack((label[at], label[at + 1], label[at + 2], last), axis=1)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs (a plain sort; no order of places is needed)."""
    x = np.sort(values, axis=None)
    heads = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)
    return x[heads], np.diff(heads, append=len(x))


def places_of(labels: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value (all occur) among the sorted distinct ``labels``: labels are hashes, so their first bits nearly say it."""
    bits = max(1, min(22, len(labels).bit_length() + 1))
    start = np.searchsorted(labels, np.arange(1 << bits, dtype=_U) << _U(64 - bits))
    values = values.ravel()
    place = start[(values >> _U(64 - bits)).astype(np.int64)]
    left = np.flatnonzero(labels[place] != values)
    for _ in range(8):
        place[left] += 1
        left = left[labels[np.minimum(place[left], len(labels) - 1)] != values[left]]
        if not len(left):
            return place
    place[left] = np.searchsorted(labels, values[left])  # where many labels begin alike
    return place


def counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct labels, distinct rows as places among them (in order), and their counts."""
    labels, times = distinct(rows)
    if rows.shape[1] == 1:
        return labels, np.arange(len(labels))[:, None], times
    place, n = places_of(labels, rows).reshape(rows.shape), len(labels)
    if rows.shape[1] == 2:
        key, count = distinct(place[:, 0] * n + place[:, 1])
        return labels, np.stack((key // n, key % n), axis=1), count
    pairs = [np.unique(place[:, d] * n + place[:, d + 1], return_inverse=True) for d in range(0, rows.shape[1], 2)]
    key = pairs[0][1].astype(np.int64)
    for _, at in pairs[1:]:
        key = key * len(pairs[1][0]) + at
    key, count = distinct(key)
    whole = [pairs[0][0][key // len(pairs[1][0])], pairs[1][0][key % len(pairs[1][0])]]
    return labels, np.stack([c for p in whole for c in (p // n, p % n)], axis=1), count


class SeenLabels:
    """Labels met before in a task: a table of one label a slot settles nearly all, a set the rest."""

    def __init__(self, bits: int = 18):
        self.shift, self.table, self.all = _U(64 - bits), np.zeros(1 << bits, dtype=_U), set()

    def new(self, labels: np.ndarray) -> np.ndarray:
        """Places of the labels (never 0) that were not met before, the first of each."""
        some = np.flatnonzero(self.table[(labels >> self.shift).astype(np.int64)] != labels)
        if not len(some):
            return some
        first, once = np.unique(labels[some], return_index=True)
        fresh = np.fromiter((x not in self.all for x in first.tolist()), bool, len(first))
        self.all.update(first[fresh].tolist())
        self.table[(first >> self.shift).astype(np.int64)] = first
        return some[once[fresh]]


# ---- the passes ---------------------------------------------------------------------------------

def _shards(docs: DataFrame, depth: int, shard: int, words, pairs, bounds: np.ndarray, strings: bool = False) -> DataFrame:
    """Transducers of the shards by range (``slice, paths``); with ``strings`` also the frequent words behind the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, p = (x.value if x is not None else None for x in (words, pairs))
        held, seen, totals, size = [], SeenLabels(), {}, 0

        def row(slice_=None, paths=None, label=None, lang=None, word=None) -> pa.RecordBatch:
            n = len(paths if paths is not None else label)
            given = ((slice_, pa.int32()), (paths, pa.binary()), (label, pa.int64()), (lang, pa.string()), (word, pa.string()))
            return pa.RecordBatch.from_arrays([pa.nulls(n, t) if x is None else pa.array(x, t) for x, t in given], names=["slice", "paths", "label", "lang", "word"])

        def flush() -> Iterator[pa.RecordBatch]:
            rows = runs(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]), depth, w, p)
            if not len(rows):
                return
            labels, places, counts = counted(rows)
            if depth == 1 and totals:  # the empty word's counts
                more = np.array(list(totals), dtype=_U)
                both, at = np.unique(np.concatenate((labels, more)), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate((counts, list(totals.values()))), minlength=len(both)).astype(np.int64)
                labels, places = both, np.arange(len(both))[:, None]
            where = np.searchsorted(bounds, _signed(order_key(labels[places])), side="right")
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
            for group in np.split(order, cuts[1:]):
                used, own = np.unique(places[group], return_inverse=True)
                packed = CountTransducer.build(labels[used], own.reshape(-1, places.shape[1]), counts[group]).pack()
                yield row([int(where[group[0]])], [packed])

        for b in batches:
            langs = [x if x is not None else "und" for x in b.column(1).to_pylist()]
            salts = np.array([lang_salt(x) for x in langs], dtype=_U) if langs else np.empty(0, dtype=_U)
            for lo in range(0, b.num_rows, 512):
                texts = text_bytes(b.column(0).slice(lo, 512))
                for i, j in slices([len(t) for t in texts]):
                    label, follows, owner, joined, starts, stops = words_of(texts[i:j], salts[lo + i:lo + j])
                    if depth == 1:
                        for t, n in zip(*(x.tolist() for x in np.unique(owner, return_counts=True))):
                            name = int(_labelled(_EMPTY, salts[lo + i + t])[0])
                            totals[name] = totals.get(name, 0) + n
                    if strings:  # the words of frequent pairs, once a task
                        known = _has(w, label)
                        link = np.flatnonzero(follows[:-1] & known[:-1] & known[1:]) if len(label) else follows
                        link = link[_has(p, pair_hash(label[link], label[link + 1]))] if len(link) else np.empty(0, np.int64)
                        linked = np.zeros(len(label), dtype=bool)
                        linked[link] = linked[link + 1] = True
                        at = np.flatnonzero(linked)
                        at = at[seen.new(label[at])]
                        if len(at):
                            raw = joined.tobytes()
                            yield row(label=label[at].view(np.int64), lang=[langs[lo + i + int(owner[k])] for k in at],
                                      word=[raw[starts[k]:stops[k]].decode("utf-8", "replace") for k in at])
                        names = sorted({langs[lo + i + int(t)] for t in np.unique(owner)})
                        empty = np.array([_labelled(_EMPTY, _U(lang_salt(x)))[0] for x in names], dtype=_U)
                        unseen = seen.new(empty)
                        if len(unseen):
                            yield row(label=empty[unseen].view(np.int64), lang=[names[k] for k in unseen], word=[""] * len(unseen))
                    held.append((label, follows))
                    size += len(label)
                    if size >= shard:
                        yield from flush()
                        held, totals, size = [], {}, 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, _ROWS)


def _united(parts: DataFrame, depth: int, ranges: int, least: int, bounds: np.ndarray, at_once: int = 1_000_000) -> DataFrame:
    """``p1 .. p4, m, a`` of the phrases of ``depth`` words (three and four: both) counted ``least`` times or more."""
    lengths = (3, 4) if depth == _DEPTH else (depth,)

    def frequent(slice_: int, rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for m in lengths:
            real = rows[:, m - 1] != 0
            r, c = rows[real], counts[real]
            if not len(r):
                continue
            heads = np.flatnonzero(np.concatenate(([True], (r[1:, :m] != r[:-1, :m]).any(axis=1))))
            total = np.add.reduceat(c, heads)
            low = r[heads].copy()
            low[:, m:] = 0
            high = low.copy()
            high[:, m:] = ~_U(0)
            inside = [np.searchsorted(bounds, _signed(order_key(x)), side="right") == slice_ for x in (low, high)]
            keep = (total >= least) | ~(inside[0] & inside[1])  # a prefix that reaches into other ranges is summed later
            full = np.zeros((int(keep.sum()), _DEPTH), dtype=_U)
            full[:, :m] = low[keep, :m]
            columns = [pa.array(np.ascontiguousarray(full[:, d]).view(np.int64)) for d in range(_DEPTH)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(full), m, np.int32)), pa.array(total[keep])], names=["p1", "p2", "p3", "p4", "m", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, new = None, [], 0
        for b in batches:
            for slice_, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if slice_ != now:
                    if waiting:
                        yield from frequent(now, *unite(waiting))
                    now, waiting, new = slice_, [], 0
                waiting.append(CountTransducer.unpack(packed).paths())
                new += len(waiting[-1][1])
                if new > max(at_once, len(waiting[0][1])):
                    waiting, new = [unite(waiting)], 0
        if waiting:
            yield from frequent(now, *unite(waiting))

    rows = parts.where("paths IS NOT NULL").select("slice", "paths").repartitionById(ranges, F.col("slice")).sortWithinPartitions("slice")
    found = rows.mapInArrow(run, "p1 long, p2 long, p3 long, p4 long, m int, a long")
    return found.groupBy("p1", "p2", "p3", "p4", "m").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _bounds(docs: DataFrame, depth: int, ranges: int, share: int, words, pairs) -> np.ndarray:
    """Keys that cut the runs into ``ranges`` of about equal size, from one in ``share`` documents."""
    if ranges == 1:
        return np.empty(0, np.int64)
    if depth == 1:  # labels are hashes: equal parts of their range
        return _signed((np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(_U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, p = (x.value if x is not None else None for x in (words, pairs))
        for b in batches:
            salts = np.array([lang_salt(x if x is not None else "und") for x in b.column(1).to_pylist()], dtype=_U)
            for lo in range(0, b.num_rows, 512):
                texts = text_bytes(b.column(0).slice(lo, 512))
                for i, j in slices([len(t) for t in texts]):
                    label, follows, *_ = words_of(texts[i:j], salts[lo + i:lo + j])
                    key = order_key(np.unique(runs(label, follows, depth, w, p), axis=0))
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(key[mix(key) % _U(8) == 0]))], names=["key"])

    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).mapInArrow(run, "key long").distinct()
    cuts = some.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)], F.lit(max(10_000, 8 * ranges)))).first()[0]
    return np.unique(np.array(cuts or [], dtype=np.int64))


def bitmap(hashes: DataFrame, column: Column, most: int) -> np.ndarray:
    """Bits of the cells that the hashes fill, 16 cells a hash and ``2 ** most`` at most (so much reaches the driver)."""
    n = hashes.count()
    bits = min(most, max(16, (16 * n).bit_length()))
    cell = F.shiftrightunsigned(column, 64 - bits) + 1
    blocks = hashes.groupBy(F.bitmap_bucket_number(cell).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("x"))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for b, x in blocks.toLocalIterator():
        out[(b - 1) * 4096:b * 4096] = np.frombuffer(x, np.uint8)
    return out


def count_phrases(docs: DataFrame, least: int = 30, shard: int = 3_000_000, range_bytes: int = 32 << 20) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words counted ``least`` times or more (``p1 .. p4, m, a``), and ``label, lang, word`` of the words of the longer ones.

    ``docs``: ``text, lang``. The phrase of the empty word alone counts all words of its language.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    ranges = max(1, -(-(size or 0) // range_bytes))
    share = max(1, (size or 0) // max(16 << 20, ranges << 9))  # the sample: 16 MB of texts, or 512 bytes a range

    def one_pass(depth: int, words, pairs, strings: bool = False) -> tuple[DataFrame, DataFrame]:
        bounds = _bounds(docs, depth, ranges, share, words, pairs)
        parts = _shards(docs, depth, shard, words, pairs, bounds, strings)
        parts = stage(parts, f"shards-{depth}") if strings else parts
        return stage(_united(parts, depth, ranges, least, bounds), f"phrases-{depth}"), parts

    single, _ = one_pass(1, None, None)
    words = spark.sparkContext.broadcast(bitmap(single, F.col("p1"), 27))
    double, _ = one_pass(2, words, None)
    # the pairs' hash, as pair_hash has it
    hashed = double.select("p1", "p2").mapInArrow(_hash_pairs, "h long")
    pairs = spark.sparkContext.broadcast(bitmap(hashed, F.col("h"), 28))
    longer, parts = one_pass(_DEPTH, words, pairs, strings=True)
    named = parts.where("label IS NOT NULL").groupBy("label").agg(F.min("lang").alias("lang"), F.min("word").alias("word"))
    named = stage(named, "words")
    words.destroy()
    pairs.destroy()
    return single.union(double).union(longer), named


def _hash_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a, c = (b.column(i).to_numpy(zero_copy_only=False).view(_U) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(pair_hash(a, c).view(np.int64))], names=["h"])


# ---- parts, scores and the report ---------------------------------------------------------------

_P = ["p1", "p2", "p3", "p4"]
_CUTS = {(side, k): f"{side}{k}" for k in (1, 2, 3) for side in "lr"}


def _part(side: str, k: int) -> list[Column]:
    """The labels of the first ``k`` words, or of the rest, filled up with 0."""
    first = [F.col(p) for p in _P]
    own = first[:k] if side == "l" else first[k:]
    return own + [F.lit(0).cast("long")] * (_DEPTH - len(own))


def compose(phrases: DataFrame, slice_phrases: int = 100_000) -> list[CountTransducer]:
    """Count transducers of the phrases, by first label: the driver gets them packed, so bound the phrases first."""
    n = max(1, -(-phrases.count() // slice_phrases))
    own = F.floor(F.shiftrightunsigned("p1", 32) * F.lit(n) / F.lit(1 << 32)).cast("int")

    def build(key: tuple, t: pa.Table) -> pa.Table:
        rows = np.stack([t.column(p).to_numpy().view(_U) for p in _P], axis=1)
        rows, counts = unite([(rows, t.column("a").to_numpy()), (rows[:0], t.column("a").to_numpy()[:0])])
        labels, places = np.unique(rows, return_inverse=True)
        packed = CountTransducer.build(labels, places.reshape(rows.shape).astype(np.int64), counts).pack()
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "paths": pa.array([packed], pa.binary())})

    packed = phrases.withColumn("slice", own).groupBy("slice").applyInArrow(build, "slice int, paths binary")
    out = [CountTransducer(np.empty(0, _U), [])] * n
    for i, data in packed.toLocalIterator():
        out[i] = CountTransducer.unpack(data)
    return out


def _parts_composed(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """``candidates`` with the counts ``l1, r1, .. l3, r3`` of the parts of each cut, from the broadcast transducers."""
    sent = candidates.sparkSession.sparkContext.broadcast(compose(phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices_ = sent.value
        for b in batches:
            rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).view(_U) for i in range(_DEPTH)], axis=1)
            m = b.column(4).to_numpy(zero_copy_only=False)
            columns = []
            for side, k in _CUTS:
                part = np.zeros_like(rows)
                if side == "l":
                    part[:, :k] = rows[:, :k]
                else:
                    part[:, :_DEPTH - k] = rows[:, k:]
                own, got = ((part[:, 0] >> _U(32)) * _U(len(slices_)) >> _U(32)).astype(np.int64), np.zeros(len(rows), np.int64)
                for s in np.unique(own[m > k]).tolist():
                    at = np.flatnonzero((own == s) & (m > k))
                    got[at] = slices_[s].weights(part[at])
                columns.append(pa.array(got, mask=m <= k))
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *_CUTS.values()])

    out = stage(candidates.mapInArrow(run, "p1 long, p2 long, p3 long, p4 long, m int, a long, " + ", ".join(f"{c} long" for c in _CUTS.values())), "parts")
    sent.destroy()
    return out


def _parts_joined(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """The same by joins, for more phrases than may be broadcast."""
    out = candidates
    for (side, k), name in _CUTS.items():
        known = phrases.select(*[F.col(p).alias(f"{name}_{p}") for p in _P], F.col("a").alias(f"{name}_a"))
        on = [c.eqNullSafe(F.col(f"{name}_{p}")) for c, p in zip(_part(side, k), _P)]
        cond = F.col("m") > k
        for c in on:
            cond = cond & c
        out = out.join(known, cond, "left").withColumnRenamed(f"{name}_a", name).drop(*[f"{name}_{p}" for p in _P])
    return out


def mine_phrases(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, held: int = 80, broadcast_phrases: int = 1_000_000, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two to four words of each language."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    phrases, words = count_phrases(texts, least, **options)
    phrases = stage(phrases, "phrases")
    candidates = phrases.where("m > 1")
    few = phrases.count() <= broadcast_phrases
    parts = (_parts_composed if few else _parts_joined)(candidates, phrases)

    # a candidate's most frequent extension by one word, on either side
    longer = candidates.where("m > 2")
    zero = F.lit(0).cast("long")
    front = longer.select("p1", "p2", F.when(F.col("m") > 3, F.col("p3")).otherwise(zero).alias("p3"), zero.alias("p4"), "a")
    back = longer.select(F.col("p2").alias("p1"), F.col("p3").alias("p2"), F.col("p4").alias("p3"), zero.alias("p4"), "a")
    most = front.union(back).groupBy(*_P).agg(F.max("a").alias("most"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    kept = parts.join(most, _P, "left").where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * held))

    cuts = [F.when(F.col(f"l{k}").isNotNull() & (F.col("m") > k), F.struct(
        F.expr(f"(cast({scale} as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in (1, 2, 3)]
    scored = kept.withColumn("cut", F.array_min(F.array(*cuts))).select(*_P, "a", "cut.l", "cut.r", "cut.score")
    for i, p in enumerate(_P):
        name = words.select(F.col("label").alias(p), F.col("word").alias(f"w{i}"), *([F.col("lang")] if i == 0 else []))
        scored = scored.join(name, p, "left")
    totals = words.where("word = ''").join(phrases.where("m = 1").select(F.col("p1").alias("label"), F.col("a").alias("n")), "label").select("lang", "n")
    ready = scored.withColumn("phrase", F.concat_ws(" ", *[f"w{i}" for i in range(_DEPTH)])).join(totals, "lang")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of each of many parts of a language, then of these
    part = F.pmod(F.xxhash64(*_P), F.lit(64))
    some = ready.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return first.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
