"""Hard-negative mining by rotated one-bit codes with stored code-vector alignment.

Vectors become integers (``floor(scale * x)``) and are rotated by a random orthogonal map (signs and a
Walsh-Hadamard transform, twice). A rotated vector x is written as ``a1 b1 + a2 b2 + .. + e``: b1 has the
signs of x (one bit a dimension, unit length), a1 is the stored alignment <x, b1>, and the residual is
coded again in the same way, ``levels`` times. The index keeps bits, alignments and residual lengths of every row.

For an anchor q, quantised to ``planes`` bits a dimension, popcounts of its bit planes with a code give <q, b>
but for the known quantisation error d, and by Cauchy-Schwarz, with certainty,

    | <q, x> - sum a_i <q, b_i> |  <=  |d| sum a_i + sqrt(|q|^2 - <q, b_l>^2) |e_l|      (e_l is orthogonal to b_l)

after any level l. Rows whose interval lies outside what the anchor still looks for are dropped level by level;
those that survive all levels get their integer inner product, so results are exact.

Anchors are taken in blocks of at most ``block`` rows, each broadcast (a bounded size) and compared with every
row: one pass finds the positives, one the negatives. A task keeps the best of its rows for each anchor, and
Spark takes the best of those. No pair is written and no label, copy or tie is cut: ties go to the smaller id.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no part, nor
do those with a component beyond 2^24 after scaling, whose scores would not fit 64 bits; repeated rows count
once; rows that share the anchor's id are none of its partners; a shorter vector is filled with zeros; an
anchor without positives, or a positive without fitting rows, has no result rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ._util import stage

_LIMIT = 1 << 24
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def signs(dim: int, seed: int) -> np.ndarray:
    """Two rows of random signs for the rotation of ``dim`` dimensions (a power of two)."""
    return np.random.default_rng(seed).integers(0, 2, size=(2, dim)).astype(np.float64) * 2 - 1


def rotate(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Rows of ``x``, filled up to the rotation's dimensions, under the orthogonal map of ``s``."""
    dim = s.shape[1]
    y = np.zeros((len(x), dim))
    y[:, :x.shape[1]] = x
    for row in s:
        y *= row
        width = 1
        while width < dim:
            z = y.reshape(len(x), -1, 2, width)
            y = np.stack((z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]), axis=2).reshape(len(x), dim)
            width *= 2
        y /= np.sqrt(dim)
    return y


def encode(x: np.ndarray, s: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, levels, words of 64 bits), alignments and residual lengths (rows, levels) of integer rows."""
    e, dim = rotate(x.astype(np.float64), s), s.shape[1]
    codes, align, rest = [], [], []
    for _ in range(levels):
        up = e >= 0
        a = np.abs(e).sum(axis=1) / np.sqrt(dim)
        e = e - np.where(up, 1.0, -1.0) * (a / np.sqrt(dim))[:, None]
        codes.append(np.packbits(up, axis=1, bitorder="little").view(np.uint64))
        align.append(a)
        rest.append(np.sqrt((e * e).sum(axis=1)))
    return np.stack(codes, axis=1), np.stack(align, axis=1), np.stack(rest, axis=1)


class Query:
    """One anchor: bit planes of its quantised rotation and what the intervals need."""

    def __init__(self, q: np.ndarray, rotated: np.ndarray, planes: int):
        dim = len(rotated)
        self.q, self.low = q.astype(np.int64), float(rotated.min())
        self.step = (float(rotated.max()) - self.low) / ((1 << planes) - 1) or 1.0
        u = np.rint((rotated - self.low) / self.step).astype(np.int64)
        self.error = float(np.linalg.norm(rotated - (self.low + self.step * u)))
        self.norm2, self.total, self.dim = float((rotated * rotated).sum()), int(u.sum()), dim
        self.planes = [np.packbits((u >> p & 1).astype(np.uint8), bitorder="little").view(np.uint64) for p in range(planes)]

    def along(self, codes: np.ndarray) -> np.ndarray:
        """<q, b> of each code (rows, words), but for at most ``error``."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        hits = np.zeros(len(codes), np.int64)
        for p, plane in enumerate(self.planes):
            hits += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << p
        return (self.low * (2 * ones - self.dim) + self.step * (2 * hits - self.total)) / np.sqrt(self.dim)

    def narrow(self, part: Part, at: np.ndarray, keep) -> np.ndarray:
        """Of the rows ``at``, those that ``keep(lo, hi)`` does not rule out after any level."""
        estimate, slack = np.zeros(len(at)), np.zeros(len(at))
        for level in range(part.codes.shape[1]):
            if not len(at):
                break
            a, b = part.align[at, level], self.along(part.codes[at, level])
            estimate = estimate + a * b
            slack = slack + a * self.error
            sure = np.maximum(np.abs(b) - self.error, 0)
            half = slack + np.sqrt(np.maximum(self.norm2 - sure * sure, 0)) * part.rest[at, level]
            half += 1e-6 + 1e-9 * np.sqrt(self.norm2) * (part.align[at, 0] + part.rest[at, 0])  # floating-point error
            ok = keep(estimate - half, estimate + half)
            at, estimate, slack = at[ok], estimate[ok], slack[ok]
        return at


class Part:
    """Rows of one batch of the index."""

    def __init__(self, b: pa.RecordBatch, dim: int, levels: int):
        n, words = b.num_rows, 0
        whole = lambda i, t: np.frombuffer(b"".join(b.column(i).to_pylist()), t)
        self.id = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.label = np.array(b.column(1).to_pylist(), dtype=object)
        self.q = whole(2, "<i4").reshape(n, dim)
        words = len(b.column(3)[0].as_py()) // (8 * levels) if n else 1
        self.codes = whole(3, "<u8").reshape(n, levels, words)
        self.align = whole(4, "<f8").reshape(n, levels)
        self.rest = whole(5, "<f8").reshape(n, levels)
        order = np.argsort(self.label, kind="stable")
        names, heads = np.unique(self.label[order].astype(str), return_index=True)
        self.of = {x: np.sort(order[i:j]) for x, i, j in zip(names.tolist(), heads, [*heads[1:], n])}


def _kth(x: np.ndarray, k: int) -> float:
    """The k-th greatest, minus infinity where there are fewer."""
    return float(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else -np.inf


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest scores, smaller ids first where they tie."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def build_index(vectors: DataFrame, dim: int, scale: int, levels: int, seed: int) -> DataFrame:
    """``vec_id, label, q, codes, align, rest`` of every row that takes part (binary columns), each row once."""
    turn = signs(max(64, 1 << max(dim - 1, 1).bit_length()), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                raw = [np.frombuffer(r, ">i4") for r in b.column(2).to_pylist()]
                x = np.zeros((len(raw), dim), np.int64)
                for k, r in enumerate(raw):
                    x[k, :len(r)] = r
                codes, align, rest = encode(x, turn, levels)
                rows = lambda a, t: pa.array([r.tobytes() for r in np.ascontiguousarray(a.astype(t))], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rows(x, "<i4"), rows(codes, "<u8"), rows(align, "<f8"), rows(rest, "<f8")],
                                                 names=["vec_id", "label", "q", "codes", "align", "rest"])

    return _whole(vectors, scale).mapInArrow(run, "vec_id long, label string, q binary, codes binary, align binary, rest binary")


def _whole(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, once each: ``vec_id, label, q`` (big-endian 32-bit integers)."""
    x = lambda v: F.floor(v.cast("double") * F.lit(float(scale)))
    fits = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")) & (F.abs(v.cast("double") * F.lit(float(scale))) <= _LIMIT))
    ok = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fits)
    packed = F.unhex(F.array_join(F.transform("embedding", lambda v: F.lpad(F.right(F.hex(x(v)), F.lit(8)), 8, "0")), ""))
    return ok.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), packed.alias("q")).distinct()


def _positives(index: DataFrame, anchors, dim: int, levels: int, k: int) -> DataFrame:
    """``anchor, vec_id, score``: each task's first ``k`` rows of an anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            part = Part(b, dim, levels)
            for i, (own, label, query) in enumerate(anchors.value):
                at = part.of.get(label)
                if at is None or not len(at := at[part.id[at] != own]):
                    continue
                ids, scores = mine.get(i, (np.empty(0, np.int64), np.empty(0, np.int64)))
                least = _kth(scores, k)
                at = query.narrow(part, at, lambda lo, hi: hi >= max(least, _kth(lo, k)))
                mine[i] = best(np.concatenate((ids, part.id[at])), np.concatenate((scores, part.q[at].astype(np.int64) @ query.q)), k)
        for i, (ids, scores) in mine.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i, np.int32)), pa.array(ids), pa.array(scores)], names=["anchor", "vec_id", "score"])

    return index.mapInArrow(run, "anchor int, vec_id long, score long")


def _negatives(index: DataFrame, anchors, bands, dim: int, levels: int, k: int) -> DataFrame:
    """``anchor, band, vec_id, score``: each task's first ``k`` rows of other labels within each band of an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        for b in batches:
            part = Part(b, dim, levels)
            every = np.arange(len(part.id))
            for i, (own, label, query) in enumerate(anchors.value):
                wanted = bands.value.get(i)
                if not wanted:
                    continue
                other = np.ones(len(every), dtype=bool)
                other[part.of.get(label, every[:0])] = False
                other &= part.id != own
                least = {j: max(low, _kth(mine.get((i, j), none)[1], k)) for j, (low, _) in wanted.items()}

                def keep(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
                    ok = np.zeros(len(lo), dtype=bool)
                    for j, (low, high) in wanted.items():
                        inside = lo[(lo >= low) & (hi <= high)]  # in the band for certain
                        ok |= (lo <= high) & (hi >= max(least[j], _kth(inside, k)))
                    return ok

                at = query.narrow(part, every[other], keep)
                scores = part.q[at].astype(np.int64) @ query.q
                for j, (low, high) in wanted.items():
                    fits = (scores >= low) & (scores <= high)
                    if fits.any():
                        ids, had = mine.get((i, j), none)
                        mine[i, j] = best(np.concatenate((ids, part.id[at[fits]])), np.concatenate((had, scores[fits])), k)
        for (i, j), (ids, scores) in mine.items():
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int32)), pa.array(np.full(n, j, np.int32)), pa.array(ids), pa.array(scores)], names=["anchor", "band", "vec_id", "score"])

    return index.mapInArrow(run, "anchor int, band int, vec_id long, score long")


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group by score, then id, with their rank; a task sent ``k`` a group at most."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
                        scale: int = 256, levels: int = 4, planes: int = 8, block: int = 2048, seed: int = 11) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors``: ``vec_id, label, embedding``; ``anchors``: which rows are anchors, by ``vec_id``. A negative's score lies
    between ``low`` and ``high`` percent of the positive's.
    """
    spark: SparkSession = vectors.sparkSession
    dim = max(1, vectors.agg(F.max(F.size("embedding"))).first()[0] or 1)
    index = stage(build_index(vectors, dim, scale, levels, seed), "codes")
    turn, found = signs(max(64, 1 << max(dim - 1, 1).bit_length()), seed), None
    rows = index.where(anchors).select("vec_id", "label", "q").toLocalIterator()  # one partition at a time
    while some := list(itertools.islice(rows, block)):
        q = np.stack([np.frombuffer(r["q"], "<i4") for r in some])
        queries = [(r["vec_id"], r["label"], Query(x, y, planes)) for r, x, y in zip(some, q, rotate(q.astype(np.float64), turn))]
        sent = spark.sparkContext.broadcast(queries)
        near = _first(_positives(index, sent, dim, levels, n_positives), ["anchor"], n_positives).select("anchor", "vec_id", "score").collect()
        pairs, bands = [], {}
        for anchor, positive, score in near:  # at most n_positives a row of the block
            lo, hi = -(-low * score // 100), high * score // 100
            pairs.append((anchor, len(pairs), queries[anchor][0], positive, score))
            if lo <= hi:
                bands.setdefault(anchor, {})[len(pairs) - 1] = (lo, hi)
        ranges = spark.sparkContext.broadcast(bands)
        mined = _first(_negatives(index, sent, ranges, dim, levels, n_negatives), ["anchor", "band"], n_negatives)
        named = spark.createDataFrame(pairs, "anchor int, band int, anchor_id long, positive_id long, positive_score long")
        joined = mined.join(named, ["anchor", "band"])
        got = stage(joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
        found = got if found is None else found.union(got)
        sent.destroy()
        ranges.destroy()
    return spark.createDataFrame([], RESULT) if found is None else found
