"""Byte-level BPE by a lazily determinised finite-state transducer, and a streaming decoder.

Encoding. Two neighbouring tokens are *compatible* when merging their joined bytes from scratch
gives these two tokens again; a token sequence is the BPE encoding of its bytes exactly when all
its neighbours are compatible. That makes encoding a walk of a non-deterministic transducer: a
hypothesis is (last token, bytes read since), it may end a token where those bytes are one that
is compatible with the last, and exactly one hypothesis has just ended a token at every position.
:class:`Transducer` runs all hypotheses at once and determinises lazily: a state is the set of
live hypotheses (once few tokens remain possible, these stand for the last token, so that states
recur); its transitions, each with the token that ends there, are computed when a byte is
first met in it and kept. The tokens that all live hypotheses have in common are emitted once
more than a few of the longest tokens' bytes are open, so the lookahead is bounded however long a
piece is. The table of states is bounded and starts anew when full.

Compatibility needs no merging: the parts at the border (the right spine of the one token, the
left spine of the other) exist side by side in the order of their ranks; the pair is broken when
two of them that exist together form a token of lower rank than what consumes them.

A vocabulary file has a line ``base64(token) rank`` per token. Tokens that merging cannot reach
from single bytes are only ever emitted for a piece that equals them, as the tiktoken library does.

Decoding. :class:`Utf8Stream` takes bytes in any cuts and hands out text as soon as it is
complete: a state machine over lead and continuation bytes keeps the (at most three) open bytes;
malformed bytes come out as U+FFFD.

Defined cases: null and empty texts have no ids; very long texts are encoded whole, one after the
other within a task, with no limit on length; repeated rows are encoded each; an empty table
gives an empty result; other columns are ignored (or passed on, see ``keep``).
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from ._util import bound_batches, per_process

_NEVER = 1 << 60


class Vocabulary:
    """Tokens by rank, all prefixes of tokens, and how tokens were merged (found when asked for)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.prefixes: dict[bytes, int] = {}
        for t in ranks:
            for k in range(1, len(t)):
                self.prefixes.setdefault(t[:k], -1)
        self.prefixes.update(ranks)
        self._under: dict[bytes, list[int]] = {}  # longer tokens that begin so
        for t, i in ranks.items():
            for k in range(1, len(t)):
                self._under.setdefault(t[:k], []).append(i)
        self._narrow: dict[tuple[int, bytes], tuple[int, ...]] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._right: dict[int, list[tuple[int, int]] | None] = {}
        self._left: dict[int, list[tuple[int, int]] | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    @classmethod
    def read(cls, lines: Iterable[bytes]) -> Vocabulary:
        return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())})

    def merge(self, piece: bytes, below: int = _NEVER) -> list[bytes]:
        """Plain merging, lowest rank first and leftmost among equals; ranks from ``below`` on are not used."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], _NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; (-1, -1) for a byte; None if merging cannot make it."""
        if token not in self._halves:
            t = self.tokens[token]
            if len(t) == 1:
                self._halves[token] = (-1, -1)
            else:
                parts = self.merge(t, token)
                ok = len(parts) == 2 and all(p in self.ranks and self.halves(self.ranks[p]) for p in parts)
                self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if ok else None
        return self._halves[token]

    def _spine(self, token: int, side: int) -> list[tuple[int, int]] | None:
        """(part, rank of the merge that consumes it) on one border of ``token``, from the byte up."""
        kept = self._right if side else self._left
        if token not in kept:
            out, consumer, t = [], _NEVER, token
            while t >= 0:
                out.append((t, consumer))
                h = self.halves(t)
                if h is None:
                    out = None
                    break
                consumer, t = t, h[side]
            kept[token] = out[::-1] if out else None
        return kept[token]

    def fits(self, p: int, t: int) -> bool:
        """Whether ``t`` may follow ``p`` (-1: the start of a piece)."""
        if p < 0:
            return self._spine(t, 0) is not None
        got = self._fits.get((p, t))
        if got is None:
            got = self._fits[(p, t)] = self._compatible(p, t)
            if len(self._fits) > 2_000_000:
                self._fits.clear()
        return got

    def narrow(self, last: int, read: bytes) -> tuple[int, ...] | None:
        """The longer tokens that begin with ``read`` and may follow ``last``; None where many begin so."""
        longer = self._under.get(read, ())
        if len(longer) > 6:
            return None
        got = self._narrow.get((last, read))
        if got is None:
            if len(self._narrow) > 500_000:
                self._narrow.clear()
            got = self._narrow[(last, read)] = tuple(t for t in longer if self.fits(last, t))
        return got

    def _compatible(self, p: int, t: int) -> bool:
        left, right = self._spine(p, 1), self._spine(t, 0)
        if left is None or right is None:
            return False
        i = j = 0
        tokens, ranks = self.tokens, self.ranks
        while True:
            (a, a_end), (b, b_end) = left[i], right[j]
            c = ranks.get(tokens[a] + tokens[b], _NEVER)
            # at equal ranks the leftmost merge is done first
            if c < a_end and c <= b_end and c != _NEVER:
                return False
            if a_end == _NEVER and b_end == _NEVER:
                return True
            if a_end <= b_end:
                i += 1
            else:
                j += 1


class _State:
    __slots__ = ("hypotheses", "step")

    def __init__(self, hypotheses):
        self.hypotheses = hypotheses
        self.step: dict[int, tuple[_State, int]] = {}


class Transducer:
    """Lazily determinised encoder of one piece at a time."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = 120_000):
        self.v, self.max_states = vocabulary, max_states
        self.lengths = {i: len(t) for i, t in vocabulary.tokens.items()}
        self.lookahead = 4 * max(self.lengths.values(), default=1)
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, _State] = {}
        self.start = self._state(((-1, b""),))

    def _state(self, hypotheses: tuple) -> _State:
        s = self.states.get(hypotheses)
        if s is None:
            s = self.states[hypotheses] = _State(hypotheses)
        return s

    def _extend(self, s: _State, byte: int) -> tuple[_State, int]:
        """Compute and keep the transition of ``s`` on ``byte``: next state and the token that ends here."""
        v, b, live, ended = self.v, bytes((byte,)), [], -1
        prefixes, tokens = v.prefixes, v.tokens
        for last, read in s.hypotheses:  # the longest come first
            read += b
            if type(last) is tuple:  # the tokens that it may still become
                if (at := prefixes.get(read)) is not None:
                    if at in last:
                        ended = at
                    if rest := tuple(t for t in last if t != at and tokens[t].startswith(read)):
                        live.append((rest, read))
                continue
            token = prefixes.get(read)
            if token is None:
                continue
            rest = v.narrow(last, read)
            if rest is None:
                live.append((last, read))
            elif rest:
                live.append((rest, read))
            if ended < 0 <= token and v.fits(last, token):  # no second one can end here
                ended = token
        if ended >= 0:
            live.append((ended, b""))
        if len(self.states) >= self.max_states:
            self._reset()
        got = s.step[byte] = (self._state(tuple(live)), ended)
        return got

    def _path(self, ends: list[int], at: int) -> list[int]:
        """Tokens, last first, of the hypothesis that ended a token before byte ``at`` of the open bytes."""
        out, lengths = [], self.lengths
        while at:
            token = ends[at - 1]
            if token < 0:
                raise ValueError("the vocabulary lacks a byte of the text")
            out.append(token)
            at -= lengths[token]
        return out

    def _settle(self, s: _State, ends: list[int], out: list[int]) -> None:
        """Emit the tokens that all live hypotheses have in common; ``ends`` keeps what is open."""
        paths = [self._path(ends, len(ends) - len(read))[::-1] for _, read in s.hypotheses]
        n = 0
        for column in zip(*paths):
            if any(x != column[0] for x in column):
                break
            n += 1
        out += paths[0][:n]
        del ends[:sum(self.lengths[t] for t in paths[0][:n])]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        whole = self.v.ranks.get(piece)
        if whole is not None and self.v.halves(whole) is None:
            return (whole,)
        s, ends, out = self.start, [], []
        for byte in piece:
            got = s.step.get(byte)
            if got is None:
                got = self._extend(s, byte)
            s, token = got
            ends.append(token)
            if len(ends) > self.lookahead:
                self._settle(s, ends, out)
        return (*out, *self._path(ends, len(ends))[::-1])


class Encoder:
    """Splits texts by ``pattern`` and encodes every match on its own; keeps ids of frequent pieces.

    Two tables of pieces: when the young one is full it becomes the old one, and pieces met again
    return from there, so frequent pieces are not forgotten.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, max_pieces: int = 150_000):
        self.transducer, self.pattern = Transducer(vocabulary), regex.compile(pattern)
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.max_pieces = max_pieces

    def __call__(self, text: str) -> list[int]:
        pieces = self.pattern.findall(text)
        if len(self.young) > self.max_pieces:
            self.old, self.young = self.young, {}
        young, old, encode = self.young, self.old, self.transducer.encode
        for p in set(pieces).difference(young):
            young[p] = old.get(p) or encode(p.encode())
        return list(itertools.chain.from_iterable(map(young.__getitem__, pieces)))


class Utf8Stream:
    """Incremental UTF-8 decoding: ``push`` bytes in any cuts, ``finish`` at the end."""

    def __init__(self):
        self.open = b""

    @staticmethod
    def _open_tail(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete yet."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:  # a lead byte says how many bytes follow
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if 0xC2 <= byte <= 0xF4 and back < need else 0
        return 0

    def push(self, data: bytes) -> str:
        data = self.open + data
        n = len(data) - self._open_tail(data)
        self.open = data[n:]
        return data[:n].decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.open = self.open, b""
        return data.decode("utf-8", "replace")


def decode(ids: Iterable[int], tokens: dict[int, bytes], chunk: int = 4096) -> Iterator[str]:
    """Text of ``ids`` in pieces, without waiting for the end."""
    ids, stream = iter(ids), Utf8Stream()
    while some := list(itertools.islice(ids, chunk)):
        yield stream.push(b"".join(map(tokens.__getitem__, some)))
    yield stream.finish()


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     rows: int = 512) -> DataFrame:
    """``keep`` columns, ``ids`` (array<int>) and ``decoded`` (the text decoded from them again).

    ``path`` is the vocabulary file, which every executor can read (it comes with the tokenizer package).
    """
    bound_batches(docs.sparkSession)
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build() -> Encoder:
            with open(path, "rb") as f:
                return Encoder(Vocabulary.read(f), pattern)

        encoder = per_process(("bpe", path, pattern), build)
        tokens = encoder.transducer.v.tokens
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                b = whole.slice(start, rows)
                ids, texts = [], []
                for t in b.column(len(keep)).to_pylist():
                    got = encoder(t) if t else []
                    ids.append(got)
                    texts.append("".join(decode(got, tokens)))
                columns = [b.column(i) for i in range(len(keep))]
                lists = pa.ListArray.from_arrays(pa.array(list(itertools.accumulate(map(len, ids), initial=0)), pa.int32()),
                                                 pa.array(itertools.chain.from_iterable(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(texts, pa.string())], names=[*keep, "ids", "decoded"])

    return docs.select(*keep, text).mapInArrow(run, schema)
