"""N-gram Jaccard self-join by token-combination prefixes, and the components of its links.

The tokens of a text are its distinct ``n``-word shingles. Two texts link when their token sets
have Jaccard similarity ``percent / 100`` or more. Texts with equal sets form one class, which
joins once, so copies are never expanded.

Prefixes. Tokens are ordered rare before frequent, then by hash. If a set x links to a set y at
least as large, at most ``x - ceil(2 p x / (100 + p))`` tokens of x are missing in y and at most
``y - ceil(p y / 100)`` of y in x (sizes; p percent). Rare tokens form class 1, frequent tokens form
further classes by their hash; with tau missing tokens allowed, a prefix is extended until

    (rare tokens) + sum over frequent classes of max(0, tokens - 1)  >=  tau + 1,

and then both prefixes share a rare token, or two tokens of one frequent class. So the keys are
single rare tokens and pairs of frequent tokens of a class: index keys from the first bound, probe
keys from the second, and pairs meet where the smaller set has an index key. How many frequent
classes there are follows a set's size, so that a class has a few tokens in the prefix; sets of
neighbouring sizes meet because a set has index keys for every class count of the sizes up to
``x * 100 / percent``. Any choice of frequent tokens gives the same links; they are tokens whose
counts, summed over parts of ``_PART`` tokens where they occur twice or more, reach ``frequent``
(raised so that at most ``2 ** 21`` tokens can).

Index keys that only one class uses are dropped early by a merged one-row count sketch (it never
misses a key used twice). Candidates are verified on the whole sets.

Groups. In a key's group every class is compared with one head, the class that shares most of its
keys; components of the verified links follow, the head leaves the group, and a group inside one
component is done. Rounds go on while the pairs left would be more than a small multiple of the
group rows (at most ``star_rounds``); then the pairs across components that were not compared yet
are compared, large groups block against block inside the tasks. Of keys with the same classes
only one is kept. Groups of copies and near copies thus cost passes, not a square, and no link between
components is lost.

Defined cases: null and empty texts, and texts without words, have no tokens and link to nothing
(their component is their own id); fewer words than ``n`` make one token of the whole sequence;
very long texts are read whole; rows with the same id are one node, whatever their texts; a null id has a null
component; an empty table gives an empty result; other columns are ignored. Sets and tokens are
named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._util import bound_batches, free_name, give_back, mix, slices, stage, text_bytes, text_parts, trim, window_hashes, word_hashes
from .components import components
from .substring import cells, merge_cells, pack_cells

_U = np.uint64
_PART = 250_000
_MAX_FREQUENT = 1 << 21


def token_sets(texts: list[bytes], n: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for i, j in slices([len(t) for t in texts]):
        h, offsets = word_hashes([t.lower() for t in texts[i:j]])  # bytes.lower changes A-Z only
        grams = window_hashes(h, n)
        for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if z - a >= n:
                s = np.sort(grams[a:z - n + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            else:
                yield window_hashes(h[a:z], z - a, 3) if z > a else np.empty(0, dtype=np.uint64)


def set_name(s: np.ndarray) -> int:
    """64-bit name of a token set."""
    at = np.arange(1, len(s) + 1, dtype=np.uint64)
    return int(mix(np.array([(mix(s + at * _U(0x9E3779B97F4A7C15))).sum() + _U(len(s))], dtype=np.uint64)).view(np.int64)[0])


def class_level(size: int) -> int:
    """Frequent tokens of a set this large fall into 2 ** level classes; -1: they are indexed singly."""
    return -1 if size < 16 else (size // 8).bit_length() - 1


def _pairs_of_classes(hot: np.ndarray, need: int, level: int) -> np.ndarray:
    """Keys of the shortest run of frequent tokens that adds ``need`` to the prefix count."""
    if level < 0:
        return hot[:need]
    kind = (mix(hot) & _U((1 << level) - 1)).astype(np.int64)
    order = np.argsort(kind, kind="stable")
    first = np.zeros(len(hot), dtype=bool)
    first[order[np.concatenate(([True], kind[order[1:]] != kind[order[:-1]]))]] = True
    reached = np.cumsum(~first) >= need
    end = int(np.argmax(reached)) + 1 if reached.any() else len(hot)
    order = np.argsort(kind[:end], kind="stable")
    tokens, kind = hot[:end][order], kind[:end][order]
    out = []
    for gap in range(1, end):  # pairs of one class, by their distance in the ordered class
        same = kind[gap:] == kind[:-gap]
        if not same.any():
            break
        out.append(mix(mix(tokens[:-gap][same] + _U(level + 1)) ^ tokens[gap:][same]))
    return np.concatenate(out) if out else hot[:0]


def signatures(s: np.ndarray, common: np.ndarray, percent: int = 75) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a token set and which of them are index keys; ``common``: sorted frequent tokens."""
    size = len(s)
    need_probe = size - -(-percent * size // 100) + 1
    need_index = size - -(-2 * percent * size // (100 + percent)) + 1
    rare = hot = s
    if len(common):
        often = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
        rare, hot = s[~often], s[often]
    index = [rare[:need_index]]
    probe = [rare[need_index:need_probe]]
    if len(rare) < need_index:
        index += [_pairs_of_classes(hot, need_index - len(rare), level) for level in {class_level(size), class_level(100 * size // percent)}]
    if len(rare) < need_probe:
        probe.append(_pairs_of_classes(hot, need_probe - len(rare), class_level(size)))
    first = np.concatenate(index)
    keys, at = np.unique(np.concatenate((first, *probe)), return_index=True)
    return keys, at < len(first)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows ``doc_id, text_key, size, name`` of the texts, and rows ``token, times`` of tokens met twice or more in a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        part: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            token, times = np.unique(np.concatenate(part), return_counts=True)
            part.clear()
            token, times = token[times > 1], times[times > 1]
            empty = pa.nulls(len(token), pa.int64())
            return pa.RecordBatch.from_arrays([empty, empty, empty, empty, pa.array(token.view(np.int64)), pa.array(times)], names=["doc_id", "text_key", "size", "name", "token", "times"])

        held = 0
        for b in batches:
            sizes, names = [], []
            for s in (s for texts in text_parts(b.column(2)) for s in token_sets(texts, n)):
                sizes.append(len(s))
                names.append(set_name(s))
                part.append(s)
                held += len(s)
                if held >= _PART:
                    yield counted()
                    held = 0
            trim()
            empty = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), empty, empty], names=["doc_id", "text_key", "size", "name", "token", "times"])
        if part:
            yield counted()

    return docs.mapInArrow(run, "doc_id long, text_key long, size long, name long, token long, times long")


def bitmap(s: np.ndarray) -> bytes:
    """Which hash cells the tokens of a set fill: 4 to 8 cells a token, a power of two in number."""
    bits = np.zeros(max(64, 4 << (len(s) - 1).bit_length()), dtype=np.uint8)
    bits[(s & _U(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    while len(x) > size:  # the cell in a half as large table is the hash without its highest bit
        x = x[:len(x) // 2] | x[len(x) // 2:]
    return x


def may_link(x: bytes, nx: int, y: bytes, ny: int, percent: int) -> bool:
    """False only if the bitmaps prove that two sets do not link: a cell that only one set fills holds a token of its own."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(a), len(b))
    a, b = _folded(a, size), _folded(b, size)
    most = min(nx - int(np.bitwise_count(a & ~b).sum()), ny - int(np.bitwise_count(b & ~a).sum()))
    return 100 * most >= percent * (nx + ny - most)


def prune(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Candidate ``(a, b)`` pairs that the classes' bitmaps (``name, size, bits``) do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            columns = [t.column(i).to_pylist() for i in range(2, 6)]
            yes = [may_link(x, nx, y, ny, percent) for x, nx, y, ny in zip(*columns)]
            yield t.select([0, 1]).filter(pa.array(yes, pa.bool_()))

    end = lambda c: maps.select(F.col("name").alias(c), F.col("bits").alias("x" + c), F.col("size").alias("n" + c))
    both = pairs.join(end("a"), "a").join(end("b"), "b")
    return both.select("a", "b", "xa", "na", "xb", "nb").mapInArrow(run, "a long, b long")


def compare_blocks(rows: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Pairs ``(a, b)`` of different components within a key that sizes and bitmaps do not rule out.

    ``rows``: ``key, name, size, index, component, bits, n`` with the number ``n`` of rows of the key. A key's rows are
    dealt to blocks of about ``block`` rows, and each task group compares two blocks, so no group grows with its key and
    only pairs that may link leave it.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("name", F.lit(3)), blocks).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("n", "other")

    def likely_of(names: np.ndarray, sizes: np.ndarray, index: np.ndarray, part: np.ndarray, own: np.ndarray, maps: list[bytes], one_block: bool) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a group that sizes and indexes allow, a few megabytes of bitmaps at a time."""
        order = np.argsort(sizes, kind="stable")
        names, sizes, index, part, own = (x[order] for x in (names, sizes, index, part, own))
        maps = [maps[k] for k in order.tolist()]
        lengths = np.fromiter(map(len, maps), np.int64, len(maps))
        # by size each row meets the later ones up to the greatest size that can link
        last = np.searchsorted(sizes, 100 * sizes // percent, side="right")
        n = last - np.arange(len(sizes)) - 1
        i = np.repeat(np.arange(len(sizes)), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - last, n)
        fits = (part[i] != part[j]) & (one_block | (own[i] != own[j])) & (index[i] | (sizes[i] == sizes[j]) & index[j])
        i, j = i[fits], j[fits]
        tables, place = {}, np.zeros(len(maps), np.int64)
        for size in np.unique(lengths[np.union1d(i, j)]).tolist():
            at = np.flatnonzero(lengths == size)
            place[at] = np.arange(len(at))
            tables[size, size] = np.frombuffer(b"".join(maps[k] for k in at.tolist()), np.uint8).reshape(-1, size)

        def table(size: int, width: int) -> np.ndarray:
            if (size, width) not in tables:
                x = tables[size, size]
                while x.shape[1] > width:
                    x = x[:, :x.shape[1] // 2] | x[:, x.shape[1] // 2:]
                tables[size, width] = np.ascontiguousarray(x)
            return tables[size, width].view(np.uint64)

        yes = np.zeros(len(i), dtype=bool)
        kind = lengths[i] << 32 | lengths[j]
        for both in np.unique(kind).tolist():
            size, other = both >> 32, both & 0xFFFFFFFF
            pairs = np.flatnonzero(kind == both)
            a, b = table(size, min(size, other)), table(other, min(size, other))
            for at in np.array_split(pairs, -(-len(pairs) * min(size, other) // (1 << 21))):
                x, y, nx, ny = a[place[i[at]]], b[place[j[at]]], sizes[i[at]], sizes[j[at]]
                most = np.minimum(nx - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), ny - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
                yes[at] = 100 * most >= percent * (nx + ny - most)
        return names[i[yes]], names[j[yes]]

    columns = ["key", "lo", "hi", "name", "size", "index", "component", "own", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups lie together; the last one of a batch may go on in the next."""
        rest: list[pa.RecordBatch] = []

        def compared(t: pa.Table, cuts: list[int]) -> pa.RecordBatch:
            names, sizes, index, part, own = (t.column(c).to_numpy() for c in columns[3:8])
            one_block, maps = t.column("lo").to_numpy() == t.column("hi").to_numpy(), t.column("bits").to_pylist()
            found = [likely_of(names[x:y], sizes[x:y], index[x:y], part[x:y], own[x:y], maps[x:y], bool(one_block[x])) for x, y in zip(cuts[:-1], cuts[1:])]
            left, right = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))], names=["a", "b"])

        for b in batches:
            t = pa.Table.from_batches([*rest, b])
            key, lo, hi = (t.column(c).to_numpy() for c in columns[:3])
            heads = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            if len(heads):
                yield compared(t.slice(0, int(heads[-1])), [0, *heads.tolist()])
                rest = t.slice(int(heads[-1])).to_batches()
            else:
                rest = t.to_batches()
            trim()
        if rest:
            t = pa.Table.from_batches(rest)
            yield compared(t, [0, t.num_rows])
        trim()

    grouped = dealt.select(*columns).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return grouped.mapInArrow(run, "a long, b long").distinct()


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Of candidate ``(a, b)`` class names those whose sets link; ``texts``: ``name, text`` per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            names_a, names_b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yes = np.zeros(batch.num_rows, dtype=bool)
            texts_a, texts_b = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            for k, (a, b) in enumerate(zip(names_a, names_b)):
                x = next(token_sets([texts_a[k]], n))
                y = kept.get(b)  # a group's common end comes again and again
                if y is None:
                    if len(kept) > 64:
                        kept.clear()
                    y = kept[b] = next(token_sets([texts_b[k]], n))
                both = _overlap(x, y)
                yes[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(yes))
        kept.clear()
        give_back()

    left = pairs.join(texts.select(F.col("name").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("name").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def link_documents(docs: DataFrame, n: int = 5, percent: int = 75, frequent: int = 32, bits: int = 28, star_rounds: int = 1, small_group: int = 16, broadcast_texts: int = 500_000) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    rows, member = _classes(docs, n, percent, frequent, bits, star_rounds, small_group, broadcast_texts)
    # the sets of one document hang together
    whole = rows.where("size > 0 AND doc_id IS NOT NULL").join(member, "name", "left").select("doc_id", F.coalesce("component", "name").alias("component"))
    several = whole.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("doc_id", "a")
    tied = stage(whole.join(several, "doc_id").where("component <> a").select("a", F.col("component").alias("b")).distinct(), "tied")
    if tied.limit(1).count():
        over = components(tied).select(F.col("node").alias("component"), F.col("component").alias("over"))
        member = member.join(over, "component", "left").select("name", F.coalesce("over", "component").alias("component")).union(over.select(F.col("component").alias("name"), F.col("over").alias("component")))
        member = stage(member.groupBy("name").agg(F.min("component").alias("component")), "members")

    # classes to documents: the least id of a component
    classes = rows.where("size > 0 AND doc_id IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("least"))
    classes = classes.join(member, "name", "left").select("name", "least", F.coalesce("component", "name").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = classes.join(lowest, "component").select("name", "component_id")
    out = rows.join(by_class, "name", "left")
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def _classes(docs: DataFrame, n: int, percent: int, frequent: int, bits: int, star_rounds: int, small_group: int, broadcast_texts: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, text_key, size, name`` of all texts, and ``name, component`` of the classes that link."""
    spark = docs.sparkSession
    bound_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    first = stage(_sets(d, n), "sets")
    rows = first.where("size IS NOT NULL").select("doc_id", "text_key", "size", "name")
    total = rows.agg(F.sum("size")).first()[0] or 0
    bits = min(bits, max(18, (4 * total).bit_length()))  # of the counted tokens about a third become keys
    least = max(frequent, -(-total // _MAX_FREQUENT))  # so at most _MAX_FREQUENT tokens reach it
    often = first.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("t")).where(F.col("t") >= least).select("token")
    common = np.sort(often.toPandas()["token"].to_numpy(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(common)

    def keys(column: pa.Array):
        for s in (s for texts in text_parts(column) for s in token_sets(texts, n)):
            yield s, *(signatures(s, shared.value, percent) if len(s) else (s, s))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = [], 0
        for b in batches:
            for _, k, _ in keys(b.column(0)):
                part.append(k)
                held += len(k)
                if held >= _PART:
                    yield pack_cells(np.concatenate(part), 1, bits)
                    part, held = [], 0
        if held:
            yield pack_cells(np.concatenate(part), 1, bits)
        part.clear()
        give_back()

    twice = spark.sparkContext.broadcast(merge_cells(d.select("text").mapInArrow(count, "block int, cells binary"), 1, bits))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, 512) for whole in batches for i in range(0, whole.num_rows, 512)):
            key, name, size, shared_of, indexed, maps = [], [], [], [], [], []
            for s, k, is_index in keys(b.column(0)):
                keys_of = len(k)
                if len(k):
                    c = cells(k, 1, bits)[0].astype(np.int64)
                    again = (twice.value[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
                    k, is_index = k[again], is_index[again]
                if len(k):
                    own = set_name(s)
                    key.append(k)
                    name.append(np.full(len(k), own))
                    size.append(np.full(len(k), len(s)))
                    shared_of.append(np.full(len(k), 1000 * len(k) // keys_of))
                    indexed.append(is_index)
                    maps.append((own, len(s), bitmap(s)))
            if key:
                keyed = np.concatenate(key).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keyed), pa.array(np.concatenate(name)), pa.array(np.concatenate(size)), pa.array(np.concatenate(shared_of)), pa.array(np.concatenate(indexed)), pa.nulls(len(keyed), pa.binary())], names=["key", "name", "size", "central", "index", "bits"])
                yield pa.RecordBatch.from_arrays([pa.nulls(len(maps), pa.int64()), pa.array([m[0] for m in maps]), pa.array([m[1] for m in maps]), pa.nulls(len(maps), pa.int64()), pa.nulls(len(maps), pa.bool_()), pa.array([m[2] for m in maps], pa.binary())], names=["key", "name", "size", "central", "index", "bits"])

    listed = stage(d.select("text").mapInArrow(index, "key long, name long, size long, central long, index boolean, bits binary"), "posts")
    for used in (shared, twice):
        used.destroy()
    posts = listed.where("key IS NOT NULL").select("key", "name", "size", "central", "index")
    maps = listed.where("key IS NULL").groupBy("name", "size").agg(F.min("bits").alias("bits"))

    def near(size: str, index: str, size2: str, index2: str):
        """Sizes that can link, the smaller set meeting by an index key."""
        a, b, ia, ib = map(F.col, (size, size2, index, index2))
        return (a * 100 >= b * percent) & (b * 100 >= a * percent) & (((a <= b) & ia) | ((b <= a) & ib))

    spot = rows.where("size > 0").groupBy("name").agg(F.min("text_key").alias("text_key"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Candidates that link: ruled out by bitmaps first, then verified on one text per class."""
        likely = stage(prune(pairs, maps, percent), "likely")
        ends = likely.select(F.col("a").alias("name")).union(likely.select("b")).distinct()
        wanted = stage(spot.join(ends, "name", "left_semi"), "wanted")
        small = wanted.count() <= broadcast_texts
        picked = d.select("text_key", "text").join(F.broadcast(wanted) if small else wanted, "text_key")
        texts = stage(picked.groupBy("name").agg(F.min("text").alias("text")), "texts")
        return stage(verify(likely, texts, n, percent), "links")

    member = links = tested = None
    used = posts.groupBy("key").agg(F.min("name").alias("lo"), F.max("name").alias("hi"), F.max("index").alias("i")).where("i AND lo <> hi").select("key")
    open_ = posts.join(used, "key", "left_semi").withColumn("component", F.col("name"))
    for last in [False] * star_rounds + [True]:
        # a row per class of a key whose classes lie in different components; of keys with the same classes one is enough
        open_ = open_.distinct()
        member_hash = F.xxhash64("name", "index")
        print_ = open_.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(member_hash.cast("decimal(38,0)")).alias("h"), F.expr("bit_xor(xxhash64(name, index, 1))").alias("x"))
        one = print_.groupBy("n", "h", "x").agg(F.min("key").alias("key")).select("key", "n")
        open_ = stage(open_.drop("n").join(one, "key"), "open")
        counts = open_.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("index").cast("long")).alias("i"))
        left = counts.groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("sq"), F.sum("i").alias("i"))
        n_open, n_pairs = left.agg(F.sum("n"), F.sum(F.least((F.col("n") * F.col("n") - F.col("sq")) / 2, F.col("n") * F.col("i")))).first()
        if not n_open:
            break
        if last or n_pairs <= 2 * n_open:
            few = open_.where(F.col("n") <= small_group)
            other = few.select("key", F.col("name").alias("name2"), F.col("size").alias("size2"), F.col("index").alias("index2"), F.col("component").alias("component2"))
            pairs = few.join(other, "key").where("name < name2 AND component <> component2").where(near("size", "index", "size2", "index2")).select(F.col("name").alias("a"), F.col("name2").alias("b"))
            many = open_.where(F.col("n") > small_group).join(maps.select("name", "bits"), "name")
            pairs = pairs.union(compare_blocks(many, percent))
            last = True
        else:
            # the class that shares most of its keys is near the middle of a group
            heads = open_.groupBy("key").agg(F.max(F.struct("central", "name", "size", "index", "component")).alias("h")).select("key", "h.name", "h.size", "h.index", "h.component")
            heads = heads.toDF("key", "head", "head_size", "head_index", "head_component")
            star = open_.join(heads, "key").where("name <> head")
            pairs = star.where("component <> head_component").where(near("size", "index", "head_size", "head_index")).select(F.least("name", "head").alias("a"), F.greatest("name", "head").alias("b"))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = linked(pairs)
        links = found if links is None else links.union(found)
        member = stage(components(links), "members")
        if last:
            break
        rest = star.select("key", "name", "size", "central", "index").join(member.withColumnRenamed("node", "name"), "name", "left")
        rest = rest.withColumn("component", F.coalesce("component", "name"))
        mixed = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("index").alias("i")).where("i AND lo <> hi").select("key")
        open_ = rest.join(mixed, "key", "left_semi").select("key", "name", "size", "central", "index", "component")
    if member is None:
        member = spark.createDataFrame([], "node long, component long")
    return rows, member.withColumnRenamed("node", "name")


def keep_one_per_group(docs: DataFrame, n: int = 5, percent: int = 75, frequent: int = 32, bits: int = 28, star_rounds: int = 1, small_group: int = 16, broadcast_texts: int = 500_000) -> DataFrame:
    """``docs`` (all columns) with one row of each group of linked texts, one with the least id; rows with a null id or without words stay.

    Groups are of texts here, so where one id has two texts that do not link, neither is lost.
    """
    rows, member = _classes(docs, n, percent, frequent, bits, star_rounds, small_group, broadcast_texts)
    own = rows.where("size > 0 AND doc_id IS NOT NULL").join(member, "name", "left")
    own = own.groupBy(F.coalesce("component", "name").alias("component"), "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = own.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    own = stage(own.join(first, "component").select("doc_id", "text_key", "n", (F.struct("doc_id", "text_key") == F.col("first")).alias("stays")), "kept")
    i, t = free_name(docs, "_id"), free_name(docs, "_text_key")
    keyed = docs.withColumns({i: F.col("doc_id").cast("long"), t: F.xxhash64("text")})
    on = lambda d: d.select(F.col("doc_id").alias(i), F.col("text_key").alias(t))
    kept = keyed.join(on(own.where("NOT stays")), [i, t], "left_anti")
    again = own.where("stays AND n > 1")
    if again.limit(1).count():  # the row that stays is there more than once
        kept = kept.join(on(again), [i, t], "left_anti").union(keyed.join(on(again), [i, t], "left_semi").dropDuplicates([i, t]))
    return kept.select(*docs.columns)
