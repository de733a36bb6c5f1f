"""Small helpers shared by the corpus operators: column choice, folds, stages, word hashing."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators._stage import shuffles_freed
from ..session import ensure_checkpoint_dir, scratch_path

#: ASCII white space as the contracts define words: ``[^\\x20\\x09-\\x0D]+``.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def fold(doc_id: Column, n: int = 5) -> Column:
    """``crc32(doc_id as text) mod n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator adds under these names."""
    return df.drop(*[c for c in df.columns if c.lower() in names])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (cuts lineage); its shuffle files go then."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """From now on rows go to Python in batches of at most ``size`` bytes in this session (Spark's default is 64 MB).

    A result may run long after the call that defined it, so the setting stays; a lower one is left as it is.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(re.sub(r"\D", "", spark.conf.get(name)) or 0)
    if not 0 < now <= size:
        spark.conf.set(name, str(size))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each value, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def per_process(key: tuple, make):
    """What ``make()`` returned for ``key`` earlier in this Python worker, else its result now (caches outlive tasks)."""
    store = sys.modules.setdefault("_corpus_operator_caches", types.ModuleType("_corpus_operator_caches")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Drop what :func:`per_process` keeps, and return memory that this Python process freed but still holds.

    Workers outlive tasks and runs, so one that encoded texts before would go on holding the encoder's tables.
    """
    if "_corpus_operator_caches" in sys.modules:
        sys.modules["_corpus_operator_caches"].__dict__.clear()
    gc.collect()
    trim()


def trim() -> None:
    """Return memory that this Python process freed but still holds; cheap enough for every batch."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


def text_parts(column: pa.Array, rows: int = 512):
    """:func:`text_bytes` in runs of rows, so that a batch is never held twice."""
    for i in range(0, len(column), rows):
        yield text_bytes(column.slice(i, rows))


# ---- word hashing over whole batches, vectorised ---------------------------------------------

_U = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_R = _U(0x9E3779B97F4A7C15 | 1)
_RINV = _U(pow(int(_R), -1, 2**64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R^j and R^-j for j < n (kept for reuse; grows to the longest slice seen)."""
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("p", _R), ("q", _RINV)):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (bijective)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes joined by a space, starts and stops of all words in them, their hashes, and offsets of each text's words.

    A word's hash is a polynomial over per-byte random values, taken from one running sum over
    the joined bytes, then mixed with the word's length; no word spans two texts.
    """
    n = len(texts)
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, n)
    ends = np.cumsum(lens + 1)  # position after each text's separator
    gap = _SPACE[joined]
    edge = np.diff(np.concatenate(([True], gap)).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    p, q = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * p[:-1], out=sums[1:])
    h = mix((sums[stops] - sums[starts]) * q[starts] + (stops - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    return joined, starts, stops, h, np.concatenate(([0], np.searchsorted(starts, ends)))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``texts``, and offsets of each text's words (len + 1)."""
    return hashed_words(texts)[3:]


def _join(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """Hash of two neighbouring runs (order matters)."""
    x = (a ^ (a >> _U(29))) * _U(0xBF58476D1CE4E5B9 + 2 * seed) + b
    return (x ^ (x >> _U(32))) * _U(0x94D049BB133111EB)


def window_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values; runs over text borders are the caller's to mask.

    Runs of 1, 2, 4, .. values are joined from halves, then those that make up ``n``.
    """
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out, done, part, width = None, 0, h, 1
    while True:
        if n & width:
            piece = part[done:done + m]
            out = piece if out is None else _join(out, piece, seed)
            done += width
        if 2 * width > n:
            return mix(out + _U(seed + n))
        part = _join(part[:-width], part[width:], seed)
        width *= 2


def slices(sizes: list[int], target: int = 1 << 18):
    """Runs ``(i, j)`` of rows of about ``target`` bytes, so that working arrays stay small."""
    i, total = 0, 0
    for j, s in enumerate(sizes):
        if j > i and total + s > target:
            yield i, j
            i, total = j, 0
        total += s
    if i < len(sizes):
        yield i, len(sizes)
