"""Token counts by rank-synchronous merging over ragged arrays.

A text is cut at the strings of the added tokens (one token each), the rest into pre-tokens by the
byte-level pattern. The distinct pre-tokens of a run of texts are held as one flat array of symbols
with the sequence that each belongs to. In a round every sequence finds the least rank among its
neighbouring pairs and merges all places of that pair at once (of overlapping places the first, third,
.. of a run); a sequence without a ranked pair is done, and its surviving symbols are counted.

All places of a pair may be merged at once because a later merge never outranks an earlier one: each
symbol is made by one merge, and merges that use it come after it. The vocabulary is checked for that;
one that breaks the rule merges a sequence's first place only in each round, which is exact for any.

Long pre-tokens are sequences like any other. A run holds at most ``run_bytes`` of pre-tokens (one
longer pre-token is a run of its own) and counts of frequent pre-tokens are kept in two bounded tables.

Defined cases: a null or empty text has no bytes and no tokens; very long texts are split in bounded
runs and read whole; repeated rows are counted each; an empty table gives an empty result; other
columns pass only where named in ``keep``, also under names that the operator adds (its own win).
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ._util import per_process

#: Pattern of byte-level pre-tokens (a fixed value, the tokenizer library's).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else the next free one from U+0100."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b) if b in printed else chr(next(spare)) for b in range(256)]


class Merges:
    """Ranked pairs of symbols as sorted arrays. Symbols 0 to 255 are the bytes."""

    def __init__(self, pairs: list[tuple[str, str]]):
        symbol = {c: b for b, c in enumerate(byte_alphabet())}
        made, left, right, out = {}, [], [], []
        self.ordered = True
        for rank, (a, b) in enumerate(pairs):
            if a not in symbol or b not in symbol:
                raise ValueError(f"merge {rank} joins a symbol that no byte or merge makes")
            new = symbol.setdefault(a + b, len(symbol))
            self.ordered &= a + b not in made  # made twice: its second merge may come after merges that use it
            made[a + b] = rank
            left.append(symbol[a])
            right.append(symbol[b])
            out.append(new)
        self.n = len(symbol)
        key = np.array(left, np.int64) * self.n + np.array(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.out = key[order], order.astype(np.int64), np.array(out, np.int64)
        first = np.flatnonzero(np.diff(self.key, prepend=-1))  # a pair listed twice has its first rank
        self.key, self.rank = self.key[first], self.rank[first]

    @classmethod
    def read(cls, model: dict) -> Merges:
        return cls([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, the greatest number where it is no merge."""
        if not len(self.key):
            return np.full(len(a), _NONE)
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NONE)


def count_symbols(pieces: list[bytes], merges: Merges) -> np.ndarray:
    """Symbols that survive in each of the non-empty ``pieces``."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = sizes.copy()
    s = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    rank = merges.ranks(s[:-1], s[1:]) if len(s) > 1 else np.empty(0, np.int64)
    rank[owner[1:] != owner[:-1]] = _NONE
    rank = np.append(rank, _NONE)[:len(s)]  # of the pair that begins at each symbol
    while len(s):
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        lengths = np.diff(np.append(heads, len(s)))
        least = np.minimum.reduceat(rank, heads)
        live = least != _NONE
        out[owner[heads]] = lengths
        if not live.all():  # finished sequences leave
            keep = np.repeat(live, lengths)
            s, owner, rank, lengths, least = s[keep], owner[keep], rank[keep], lengths[live], least[live]
            if not len(s):
                break
        hit = rank == np.repeat(least, lengths)
        at = np.flatnonzero(hit)
        if merges.ordered:  # of touching places (a a a) every other one
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
        else:  # a vocabulary that breaks the order: the first place of each sequence
            at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]
        s[at] = merges.out[rank[at]]
        stay = np.ones(len(s), dtype=bool)
        stay[at + 1] = False
        rank[at] = rank[at + 1]  # a merged symbol's own pair is looked up below
        place = np.cumsum(stay) - 1
        s, owner, rank = s[stay], owner[stay], rank[stay]
        new = place[at]
        for i in (new, new[new > 0] - 1):  # pairs that begin and end at a merged symbol
            i = i[i + 1 < len(s)]
            same = owner[i] == owner[i + 1]
            rank[i] = np.where(same, merges.ranks(s[i], s[i + 1]), _NONE)
        rank[-1] = _NONE
    return out


class Counter:
    """Tokens of whole texts; counts of pre-tokens are kept in a young and an old table of bounded size."""

    def __init__(self, tokenizer: dict, max_pieces: int = 200_000, run_bytes: int = 1 << 20, max_kept: int = 64):
        pre, model = tokenizer.get("pre_tokenizer") or {}, tokenizer["model"]
        plain = {"model": model.get("type") == "BPE", "pre_tokenizer": pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"),
                 "normalizer": tokenizer.get("normalizer") is None,
                 "options": not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))}
        if bad := [k for k, ok in plain.items() if not ok]:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {', '.join(bad)}")
        added = [t for t in tokenizer.get("added_tokens", [])]
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("added tokens that take in white space or need word borders are not served")
        names = sorted((t["content"] for t in added), key=len, reverse=True)  # the longest that fits wins
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.merges, self.pattern = Merges.read(model), regex.compile(BYTE_LEVEL)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.max_pieces, self.run_bytes, self.max_kept = max_pieces, run_bytes, max_kept

    def _learn(self, pieces: set[str]) -> dict[str, int]:
        """Counts of pieces met for the first time, merged in runs of bounded size."""
        out: dict[str, int] = {}
        todo, raw, held = [], [], 0

        def run() -> None:
            out.update(zip(todo, count_symbols(raw, self.merges).tolist()))
            todo.clear()
            raw.clear()

        for p in pieces:
            b = p.encode()
            if todo and held + len(b) > self.run_bytes:
                run()
                held = 0
            todo.append(p)
            raw.append(b)
            held += len(b)
        if todo:
            run()
        return out

    def _pieces(self, text: str, most: int = 1 << 17) -> Iterator[list[str]]:
        if len(text) <= most:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while some := list(itertools.islice(found, most)):
            yield some

    def __call__(self, texts: list[str]) -> list[int]:
        """Tokens of each text; pre-tokens new to the tables are merged together, some texts at a time."""
        out, waiting, held = [0] * len(texts), [], 0

        def settle() -> None:
            nonlocal held
            if len(self.young) > self.max_pieces:
                self.old, self.young = self.young, {}
            new = set().union(*(p for _, p in waiting)).difference(self.young)
            known = {p: n for p in new if (n := self.old.get(p)) is not None}
            known.update(self._learn(new.difference(known)))
            self.young.update((p, n) for p, n in known.items() if len(p) <= self.max_kept)
            get = {**self.young, **known}.__getitem__ if any(len(p) > self.max_kept for p in known) else self.young.__getitem__
            for i, pieces in waiting:
                out[i] += sum(map(get, pieces))
            waiting.clear()
            held = 0

        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and self.special.search(text):
                out[i] += sum(1 for _ in self.special.finditer(text))
                parts = self.special.split(text)
            for part in parts:
                for pieces in self._pieces(part):
                    waiting.append((i, pieces))
                    held += len(pieces)
                    if held > 1 << 17:
                        settle()
        settle()
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rows: int = 512) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of every row.

    ``path`` is the tokenizer's JSON file, which every executor can read (it comes with the tokenizer package).
    """
    keep = tuple(c for c in keep if c.lower() not in ("n_bytes", "n_tokens", "over_limit"))
    added = [T.StructField("n_bytes", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False), T.StructField("over_limit", T.BooleanType(), False)]
    schema = T.StructType([*(docs.schema[c] for c in keep), *added])
    own = [f"_k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build() -> Counter:
            with open(path, encoding="utf-8") as f:
                return Counter(json.load(f))

        counter = per_process(("token_counts", path), build)
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                b = whole.slice(start, rows)
                n = np.array(counter([t or "" for t in b.column(len(keep)).to_pylist()]), np.int64)
                columns = [*(b.column(i) for i in range(len(keep))), b.column(len(keep) + 1), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    picked = docs.select(*[F.col(c).alias(o) for c, o in zip(keep, own)], F.col(text).alias("_text"), size.alias("_bytes"))
    return picked.mapInArrow(run, schema)
