"""Token counts against the tokenizer library; merging against one pair at a time; odd inputs."""

import json
import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm.queries import QUERIES
from tidemark.llm.token_counts import Counter, Merges, byte_alphabet, count_symbols, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


LIBRARY, OWN = Tokenizer.from_file(PATH), Counter(json.load(open(PATH, encoding="utf-8")), max_pieces=500, run_bytes=4000)


HARD = ["", " ", "a", "aaaaaaa", "a" * 5001, "\n\n  \t x", "it's we'll I'd 'tis", "<|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|>b", "<|endof text|>", "日本語のテキスト と 漢字", "Füße ʼn ǅ ٣٤ ½ ²",
        "  x​ y\u0085z\x1c\x1d q", "🙂🙂👩‍👩‍👧 áe", "== == ======== ----", " " * 3000, "x1y22z333", "\x00\x01\x7f", "ﬀ ß İ ı", "word " * 3000, "xyzzy" * 2000]


def test_hard_texts():
    assert OWN(HARD) == [len(LIBRARY.encode(t, add_special_tokens=False)) for t in HARD]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab '\n<|>endoftx1 ", max_size=80)), max_size=6))
def test_any_texts(texts):
    assert OWN(texts) == [len(LIBRARY.encode(t, add_special_tokens=False)) for t in texts]


def one_by_one(piece, ranks, sym):
    """The definition: the leftmost pair of least rank is merged, again and again."""
    s = [sym[b] for b in piece]
    while True:
        found = min(((ranks[s[i], s[i + 1]], i) for i in range(len(s) - 1) if (s[i], s[i + 1]) in ranks), default=None)
        if found is None:
            return len(s)
        s[found[1]:found[1] + 2] = [s[found[1]] + s[found[1] + 1]]


@pytest.mark.parametrize("seed", range(30))
def test_merging_of_made_up_vocabularies(seed):
    """Random merges, also such that make one symbol twice (merged one place at a time)."""
    rng, alphabet = random.Random(seed), byte_alphabet()
    symbols, pairs = [alphabet[b] for b in b"abc"], []
    for _ in range(25):
        p = (rng.choice(symbols), rng.choice(symbols))
        if p not in pairs and len(p[0] + p[1]) < 9 and (seed % 2 or p[0] + p[1] not in symbols):
            pairs.append(p)
            symbols.append(p[0] + p[1])
    merges, ranks = Merges(pairs), {p: i for i, p in enumerate(pairs)}
    pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    assert count_symbols(pieces, merges).tolist() == [one_by_one(p, ranks, alphabet) for p in pieces]


def test_query_and_odd_inputs(spark, odd, none):
    got = count_tokens(odd, PATH, keep=("doc_id", "name", "text_key", "_gone")).collect()
    texts = odd.select("doc_id", "text").collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(LIBRARY.encode(r[1] or ""))) for r in texts)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want and all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert count_tokens(none, PATH).collect() == []
    clash = odd.withColumn("n_tokens", odd["name"]).withColumn("_k0", odd["name"])
    assert count_tokens(clash, PATH, keep=("doc_id", "n_tokens", "_k0")).columns == ["doc_id", "_k0", "n_bytes", "n_tokens", "over_limit"]
    whole = QUERIES["op12_token_counts"](spark, "/root/testdata/sf0.001")
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in whole.collect()} == {i: (len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in texts.items()}
