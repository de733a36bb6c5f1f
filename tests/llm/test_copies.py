"""N-gram join and substring removal against brute force; odd inputs."""

import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import ngram_join, substring
from tidemark.llm.components import components
from tidemark.llm.ngram_join import bitmap, class_level, keep_one_per_group, link_documents, may_link, signatures, token_sets
from tidemark.llm.substring import remove_repeats


def documents(seed=3):
    """Originals, exact and near copies with edits, shared passages, short texts and repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(45)]
    out, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.choice([4, 8, 30, 120]))]
        if rng.random() < 0.4:
            base = base[:10] + passage + base[10:]
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = word()
            out.append((i, " ".join(w)))
            i += 1
    return out + [(i, None), (i + 1, ""), (i + 2, " \n "), (i + 3, "One Two"), (i + 4, "one two"), (3, out[3][1])]


def linked(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    head = {i: i for i in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                head[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_join_matches_brute_force(spark):
    rows = documents()
    expect = linked(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (3, 32):  # frequent tokens change the index, never the links
        got = link_documents(df, frequent=frequent, bits=18).collect()
        assert len(got) == len(rows) and {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expect
    kept = keep_one_per_group(df).collect()
    assert {r.doc_id for r in kept} == {c for _, c in expect.values()}


def test_join_odd_inputs(spark, odd, none):
    got = link_documents(odd, bits=18)
    assert got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].component_id == 1 and by[1].n_shingles == 0 and by[5].component_id == 4 and by[None].component_id is None
    assert keep_one_per_group(odd).columns == odd.columns
    assert link_documents(none, bits=18).count() == 0


def test_one_id_with_two_texts(spark):
    """The id is one node for the links; of its texts none is lost."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(1, a), (5, a), (5, b), (5, b), (7, b), (9, "some other words that stand alone here"), (None, a), (None, a)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in link_documents(df, bits=18).collect()} == {(1, 1), (5, 1), (7, 1), (9, 9), (None, None)}
    kept = sorted((str(r.doc_id), r.text) for r in keep_one_per_group(df).collect())
    assert kept == [("1", a), ("5", b), ("9", "some other words that stand alone here"), ("None", a), ("None", a)]


def test_prefix_keys_meet_and_bitmaps_never_reject_links():
    rng = np.random.default_rng(5)
    for n in (1, 2, 4, 7, 15, 16, 20, 33, 64, 150):
        for _ in range(25):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            m = rng.integers(0, n // 4 + 2)
            y = np.unique(np.concatenate((rng.permutation(x)[:max(0, len(x) - m)], rng.integers(0, 2**63, rng.integers(0, n // 4 + 1), dtype=np.uint64))))
            both = len(np.intersect1d(x, y))
            if not len(y) or 100 * both < 75 * (len(x) + len(y) - both):
                continue
            assert may_link(bitmap(x), len(x), bitmap(y), len(y), 75)
            for share in (0, 0.5, 0.9, 1):
                common = np.sort(np.concatenate((x, y))[rng.random(len(x) + len(y)) < share])
                common = np.unique(common)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                (ks, index), (kl, _) = signatures(small, common), signatures(large, common)
                assert len(np.intersect1d(ks[index], kl)), (n, share)
    assert class_level(15) == -1 and class_level(16) == 1


def test_components_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[j] == 100 for j in range(100, 140)) and len(got) == 81
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_substring_matches_brute_force(spark):
    rows = documents(9) + [(900, "a b " * 40), (901, "x " * 34), (902, "y " * 36)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window, gram, bits in ((35, 8, 18), (12, 3, 18)):
        got = remove_repeats(df, window=window, gram=gram, bits=bits).collect()
        expect = Counter((i, *x) for (i, _), x in zip(rows, removed(rows, window)))
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.text or "") for r in got) == expect


def test_substring_odd_inputs(odd, none):
    got = remove_repeats(odd, bits=18).collect()
    assert len(got) == odd.count() and got[0].asDict().keys() >= set(odd.columns)
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[2].text == "" and by[6].n_words == 60_000 and by[6].n_removed == 60_000
    assert remove_repeats(none, bits=18).count() == 0


def test_sketch_blocks_merge_in_parallel_tasks(spark, monkeypatch):
    rng, frame = np.random.default_rng(3), type(spark.range(1))
    parts = [rng.integers(0, 400, n).astype(np.uint64) for n in (1, 50, 300, 300)]
    rows = [tuple(r) for p in parts for r in zip(*(c.to_pylist() for c in substring.pack_cells(p, 2, 19).columns))]
    plans, real = [], frame.toLocalIterator

    def seen(self, *args, **options):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return real(self, *args, **options)

    monkeypatch.setattr(frame, "toLocalIterator", seen)
    twice = substring.merge_cells(spark.createDataFrame(rows, "block int, cells binary").repartition(3), 2, 19)
    assert plans and not any("MapInArrow" in p or "Exchange" in p for p in plans)  # what is iterated is merged already
    cell, n = np.unique(np.concatenate([np.concatenate(substring.cells(p, 2, 19)) for p in parts]), return_counts=True)
    assert np.flatnonzero(np.unpackbits(twice)).tolist() == cell[n > 1].tolist()


def test_blocks_compared_like_single_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key, n in ((1, 90), (2, 30), (3, 1)):
        base = rng.integers(0, 1 << 63, 260).astype(np.uint64)
        for k in range(n):
            size = int(rng.choice([5, 15, 16, 17, 20, 60, 64, 65, 80, 200, 250]))
            s = np.unique(np.concatenate((base[:size - size // 9], rng.integers(0, 1 << 63, size // 9).astype(np.uint64))))
            rows.append((key, 1000 * key + k, len(s), bool(rng.integers(0, 2)), int(rng.integers(0, 3)), ngram_join.bitmap(s), n))
    expect = set()
    for a in rows:
        for b in rows:
            (x, y) = (a, b) if a[2] <= b[2] else (b, a)
            if a[0] == b[0] and a[1] < b[1] and a[4] != b[4] and 100 * x[2] >= 75 * y[2] and (x[3] or x[2] == y[2] and y[3]) and ngram_join.may_link(x[5], x[2], y[5], y[2], 75):
                expect.add((a[1], b[1]))
    df = spark.createDataFrame(rows, "key long, name long, size long, index boolean, component long, bits binary, n long")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups go over the batches
    try:
        got = [tuple(r) for r in ngram_join.compare_blocks(df, 75, block=16).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert len(expect) > 100 and len(got) == len(set(got)) and set(got) == expect
    assert ngram_join.compare_blocks(df.limit(0), 75).count() == 0
