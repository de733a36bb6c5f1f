"""Phrases against brute force; transducers against plain dictionaries; odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import phrases
from tidemark.llm.phrases import CountTransducer, mine_phrases, order_key, unite

FINISHED = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top, scale=2_000_000):
    count, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            count.update((lang, tuple(w[i:i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    most = Counter()
    for (lang, p), a in cand.items():
        for j in range(2, len(p)):
            for i in range(len(p) - j + 1):
                most[lang, p[i:i + j]] = max(most[lang, p[i:i + j]], a)
    by = {}
    for (lang, p), a in cand.items():
        if 100 * most[lang, p] >= 80 * a:
            continue
        score, k, l, r = min((scale * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p)))
        by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, got in by.items() for k, (s, a, p, l, r) in enumerate(sorted(got)[:top], 1))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Straße", "ÀB", "x'y", "日本"]
    fixed = ["new york city hall", "in spite of", "a b a b a b", "UPPER lower"]
    rows = []
    for _ in range(160):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, weights=range(1, 17), k=rng.randrange(1, 9))) for _ in range(rng.randrange(12))]
        rows.append((rng.choice([" ", ". ", "\n", "\t", ",", " ; "]).join(parts), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" .\n", "de"), rows[0], ("a b " * 6000, "fr"), ("once only", "zz")]


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(t, l, 1, "x", 2) for t, l in rows], "text string, lang string, p1 int, word string, a int").repartition(3)
    got = mine_phrases(df, least=5, top=20 + 400 * seed, shard=700 if seed else 2_000_000, range_bytes=3000, broadcast_phrases=0 if seed else 1_000_000)
    assert got.columns == FINISHED
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 20 + 400 * seed)


def test_empty_and_odd(spark, odd, none):
    assert mine_phrases(none).collect() == []
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert sorted(map(tuple, mine_phrases(odd, least=2).collect())) == brute(rows, 2, 2000)


@pytest.mark.parametrize("seed", range(20))
def test_transducer(seed):
    rng = np.random.default_rng(seed)
    depth = [1, 2, 4][seed % 3]
    rows = rng.integers(1, 6, (400, depth)).astype(np.uint64) << np.uint64(60)
    if depth == 4:
        rows[rng.random(400) < 0.3, 3] = 0
    want = Counter(map(tuple, rows.tolist()))
    parts = []
    for some in np.array_split(rows, 3):
        r, c = unite([(some, np.ones(len(some), np.int64)), (some[:0], np.empty(0, np.int64))])
        labels, places = np.unique(r, return_inverse=True)
        t = CountTransducer.unpack(CountTransducer.build(labels, places.reshape(r.shape).astype(np.int64), c).pack())
        assert sum(len(x[0]) for x in t.levels) <= sum(len(np.unique(r[:, :d], axis=0)) if d else 1 for d in range(depth))
        back, n = t.paths()
        assert (back == r).all() and (n == c).all()
        assert (t.weights(r) == c).all() and (t.weights(r + np.uint64(1)) == 0).all()
        parts.append((back, n))
    rows, n = unite(parts)
    assert {tuple(r): k for r, k in zip(rows.tolist(), n.tolist())} == want
    key = order_key(rows)
    assert all(a <= b for a, b, x, y in zip(key[:-1], key[1:], rows[:-1], rows[1:]) if tuple(x) <= tuple(y))


def test_equal_tails_are_shared():
    """Two contexts with the same continuations and counts end in one state."""
    places = np.array([[0, 2, 3], [0, 2, 4], [1, 2, 3], [1, 2, 4]])
    t = CountTransducer.build(np.arange(5, dtype=np.uint64), places, np.array([7, 1, 7, 1]))
    assert [len(x[0]) for x in t.levels] == [1, 1, 1]
    t = CountTransducer.build(np.arange(5, dtype=np.uint64), places, np.array([7, 1, 7, 2]))
    assert [len(x[0]) for x in t.levels] == [1, 2, 2]


def test_counts_places_and_unions_equal_brute_force():
    rng = np.random.default_rng(6)
    words = rng.integers(1, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
    words[:100] >>= np.uint64(40)  # labels that begin alike
    for depth in (1, 2, 4):
        parts, expect = [], Counter()
        for n in (0, 1, 400, 3000):
            rows = words[np.minimum(rng.zipf(1.2, (n, depth)), 300) - 1]
            expect.update(map(tuple, rows.tolist()))
            if n:
                labels, places, counts = phrases.counted(rows)
                assert dict(zip(map(tuple, labels[places].tolist()), counts.tolist())) == Counter(map(tuple, rows.tolist()))
                parts.append((labels[places], counts))
        rows, counts = phrases.unite(parts)
        assert [tuple(r) for r in rows.tolist()] == sorted(expect) and counts.tolist() == [expect[r] for r in sorted(expect)]


def test_labels_are_new_once():
    rng, seen, known = np.random.default_rng(7), phrases.SeenLabels(bits=3), set()
    words = rng.integers(1, 1 << 63, 60).astype(np.uint64) * np.uint64(2)
    for _ in range(30):
        some = words[rng.integers(0, 60, 25)]
        new = some[seen.new(some)].tolist()
        assert sorted(new) == sorted(set(some.tolist()) - known)
        known.update(new)
