"""BPE against tiktoken, page text, decontamination, surrogates and the pipeline on small tables."""

import random
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from tidemark.llm import bpe, decontam, html_text, pii

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary.read(f)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def strange_texts():
    rng = random.Random(2)
    letters = [chr(c) for c in range(1, 0x250)] + [chr(c) for c in (0x85, 0xA0, 0x301, 0x416, 0x5D0, 0x627, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0xFEFF)]
    for alphabet in (letters, list(" \n\t.a'st1"), list("aeiounstr "), list("=-_*#!. ")):
        for n in (1, 3, 20, 200):
            for _ in range(40):
                yield "".join(rng.choice(alphabet) for _ in range(n))
    yield from ("", " " * 3000, "a" * 9000, "ab" * 4000, "\n" * 500, "=" * 1234, "<|endoftext|>")


def test_transducer_equals_tiktoken(vocabulary, reference):
    encoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN, max_pieces=50)
    for t in strange_texts():
        ids = encoder(t)
        assert ids == reference.encode_ordinary(t)
        assert "".join(bpe.decode(ids, vocabulary.tokens, chunk=3)) == t
    small = bpe.Transducer(vocabulary, max_states=20)  # starting the table anew changes nothing
    for t in ("internationalisation", "überraschenderweise", "a" * 700):
        assert list(small.encode(t.encode())) == reference.encode_ordinary(t)
        assert b"".join(vocabulary.tokens[i] for i in small.encode(t.encode())) == t.encode()


def test_unreachable_tokens_only_as_whole_pieces():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}
    v = bpe.Vocabulary(ranks)
    own = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    t = bpe.Transducer(v)
    for piece in ("ab", "xyz", "xyzab", "abxyz", "aab"):
        assert list(t.encode(piece.encode())) == own.encode_ordinary(piece)


def test_utf8_stream_any_cuts():
    data = "aé中😀".encode() + b"\xff\xc3(" + "ñ".encode() + b"\xe4\xb8"
    for cut in range(1, 6):
        s = bpe.Utf8Stream()
        got = "".join(s.push(data[i:i + cut]) for i in range(0, len(data), cut)) + s.finish()
        assert got.startswith("aé中😀") and "ñ" in got and got.endswith("�")
    s = bpe.Utf8Stream()
    assert s.push("中".encode()[:2]) == "" and s.push("中".encode()[2:]) == "中" and s.finish() == ""


def test_encode_documents_odd_inputs(odd, none, reference):
    got = bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN)
    rows = {r.doc_id: r for r in got.collect()}
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert got.count() == odd.count()
    for i, r in rows.items():
        if i is not None:
            assert r.ids == reference.encode_ordinary(texts[i] or "") and r.decoded == (texts[i] or "")
    assert bpe.encode_documents(none, PATH, public_tokenizers.PATTERN).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p><p>no";</script></head><body class="has-sidebar"><nav><ul><li>Home</li></ul></nav>
<header><h1>Site</h1></header><div class="ad">buy</div><article><header><h1>Title &amp; more</h1></header><p><b>One&nbsp; two<br>three <p>four<i>five</i>
<aside>see also</aside><form><input name=q>go</form><div id="comments"><p>nice!</p></div></article><div class="cookie-notice">ok?</div><footer>&copy; x</footer>"""


def test_blocks_of_a_marked_page():
    got = html_text.blocks(PAGE)
    assert " ".join(t for p, t in got if p == "main") == "Title & more One two three fourfive"
    assert html_text.blocks("<p>cut <b off") == [("open", "cut")] or html_text.blocks("<p>cut <b off")[0][1].startswith("cut")
    assert html_text.blocks("<main><p>a</p></main><p>b</p>") == [("main", "a"), ("drop", "b")]


def test_class_names_never_drop_the_article():
    main = lambda page: " ".join(t for p, t in html_text.blocks(page) if p == "main")
    for wrapper in ("site has-sidebar", "no-sidebar", "with-menu", "sidebar", "search", "mainNav menu"):
        assert main(f"<div class='{wrapper}'><div id='search'><article class='post-42 category-social tag-search'><p>the text</p></article></div></div>") == "the text"
        assert main(f"<div id=page class='{wrapper}'><main class=comments><p>the text</p></main></div>") == "the text"
        assert main(f"<article><h1>t</h1><div class='{wrapper}'>most of the text</div></article>") == "t most of the text"
    assert main("<article class='promo related'>one</article><article class='widget'>two</article>") == "one two"
    beside = "<div class=sidebar><article>teaser</article></div><div class=comments><article class=comment>a longer answer than the text</article></div>"
    assert main(f"<div class=widget><article>a whole text<div class='share-buttons'>share</div><p class=cookie-notice>ok?</p></article>{beside}</div>") == "a whole text"
    assert main("<div class=widget><article>one</article></div><div class=widget><article>two</article></div>") == "one two"
    assert html_text.blocks("<div class='site sidebar'><p>a</p><nav>b</nav></div>") == [("open", "a"), ("drop", "b")]


def test_arrays_judge_what_only_a_class_names(spark):
    notice = "this site uses cookies to give you the best possible experience here"
    rows = [(i, f"http://h.org/{i}", f"<div class='site sidebar'><div class='cookie-notice'>{notice}</div><p>text{i} of{i} page{i}</p></div>") for i in range(4)]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"text{i} of{i} page{i}" for i in range(4)}


def test_pages_odd_and_repeated_runs(spark):
    menu = "home about products contact imprint privacy terms and conditions of use"
    rows = [(i, f"http://h.org/{i}", f"<div>{menu}</div><div>text{i} only{i} here{i}</div>") for i in range(5)]
    rows += [(90, None, None), (91, "http://h.org/x", ""), (92, "http://o.org/", f"<div>{menu}</div>"), (92, "http://o.org/", f"<div>{menu}</div>"), (93, "u", PAGE), (None, None, "<p>x")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, host int, stream string")
    got = html_text.extract_text(df).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and [text[i] for i in range(5)] == [f"text{i} only{i} here{i}" for i in range(5)]
    assert text[90] == text[91] == "" and text[92] == menu and text[93] == "Title & more One two three fourfive" and text[None] == "x"
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_suffix_runs_equal_brute_force():
    rng = random.Random(4)
    streams = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40))).encode() for _ in range(30)]
    _, n = html_text.suffix_runs(streams, 5)
    words = [s.split() for s in streams]
    expect = {}
    for k, w in enumerate(words):
        for i in range(len(w) - 4):
            expect.setdefault(tuple(w[i:i + 5]), set()).add(k)
    assert sorted(n.tolist()) == sorted(len(x) for x in expect.values())


ITEM = "A train leaves the station of Oxford at 9 and travels 120 km in 3 hours while a second train called Mary travels 120 km in 4 hours"


def test_templates_find_copies_and_new_parameters(spark, odd, none):
    other = ITEM.replace("120", "75").replace("Oxford", "Leeds").replace(" 3 ", " 2 ").replace(" 4 ", " 6 ").replace(" 9 ", " 11 ")
    mixed = ITEM.replace("120 km in 3", "70 km in 3").replace("120 km in 4", "90 km in 4").replace("3 hours", "8 hours").replace(" 9 ", " 90 ")
    docs = spark.createDataFrame([(1, f"some words before. {ITEM} and after"), (2, other), (3, "the weather is fine and nothing of this kind happens in the town"), (4, ITEM.upper()),
                                  (5, None), (6, ""), (1, f"some words before. {ITEM} and after"), (7, mixed)], "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS item_id")
    bench = spark.createDataFrame([(10, ITEM), (11, None), (12, "two words"), (13, "")], "item_id long, text string")
    got = decontam.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.reparameterised) for r in got} >= {(1, 10, False), (2, 10, True)} and {r.doc_id for r in got} <= {1, 2, 4}
    assert sum(r.doc_id == 1 for r in got) == 2
    joined = decontam.find_leaks(docs, bench, broadcast_windows=0, broadcast_texts=0).collect()  # beyond the broadcast bound
    assert sorted(map(tuple, joined)) == sorted(map(tuple, got))
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns and {3, 5, 6, 7} <= {r.doc_id for r in clean.collect()}
    assert decontam.find_leaks(odd, bench).count() == 0 and decontam.find_leaks(none, bench).count() == 0 and decontam.find_leaks(docs, bench.limit(0)).count() == 0


def test_one_altered_value_loses_no_long_copy(spark):
    words = "worker carries heavy boxes from old house near river with great care".split()
    parts = [f"number {k} " + " ".join(w + c for w in words) for k, c in zip((3, 5, 8, 13, 5), "abcde")]
    item = " and ".join(parts)
    swapped, once = item.replace("number 13", "number 3"), item[:item.rindex("5")] + "6" + item[item.rindex("5") + 1:]  # another slot's value; one of two equal values
    docs = spark.createDataFrame([(1, item), (2, swapped), (3, once), (4, "nothing of this kind is here")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontam.find_leaks(docs, spark.createDataFrame([(10, item)], "item_id long, text string")).collect()}
    assert set(got) == {1, 2, 3} and not any(r.reparameterised for r in got.values())
    whole = got[1].n_windows
    assert whole == got[1].item_windows and all(whole - 8 <= got[k].n_windows < whole and got[k].n_slots >= 3 for k in (2, 3))


def test_surrogates_formats_and_coreference():
    text = "Mrs. Mary Smith (mary.smith@mail.example.com, +1 (017) 555-7713) and Иван Петров; Smith paid 4111 1111 1111 1111 or 4111111111111111 from 10.1.2.3, DE89 3704 0044 0532 0130 00."
    new, n = pii.replace_entities(text, b"k", {})
    assert n == 11 and pii.replace_entities(text, b"k", {})[0] == new != pii.replace_entities(text, b"other", {})[0]
    for old in ("Smith", "mary.smith", "555-7713", "Петров", "4111", "3704"):
        assert old not in new
    found = {k: v for _, _, k, v in pii.find_entities(new)}
    assert pii.luhn(found["card"]) and found["ip"].startswith("10.") and "+1 (" in new and new.count("DE") == 1
    iban = found["iban"]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    numbers = [x[3] for x in pii.find_entities(new) if x[2] == "card"]
    assert len(numbers) == 2 and numbers[0] == numbers[1]  # one entity in two ways of writing
    last = [new[s:e] for s, e, k, _ in pii.find_entities(new.replace(";", "; Mrs.")) if k == "surname"]
    assert last
    for clean in ("Nothing here, 12 apples and 3.14 or 2024-05-01.", "", "Erin is to be the one. Thea and An."):
        assert pii.replace_entities(clean, b"k", {}) == (clean, 0)


def test_surrogates_stay_distinct(spark, odd, none, monkeypatch):
    rows = [(i, f"call 10.0.{i // 250}.{i % 250} or user{i}@a.org now") for i in range(300)] + [(1, None), (2, ""), (3, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS text_key", "5 AS n_entities")
    out = pii.replace_pii(docs, broadcast_entities=200_000).collect()
    ips = [pii.find_entities(r.text)[0][3] for r in out if r.n_entities]
    mails = [pii.find_entities(r.text)[1][3] for r in out if r.n_entities]
    assert len(ips) == len(set(ips)) == 300 and len(set(mails)) == 300 and not set(ips) & {f"10.0.{i // 250}.{i % 250}" for i in range(300)}
    joined = pii.replace_pii(docs, broadcast_entities=-1).collect()  # beyond the broadcast bound
    assert sorted(map(str, joined)) == sorted(map(str, out))
    tight = [(i, f"ssn 123-45-{i:04d}") for i in range(5)]
    assert len({r.text for r in pii.replace_pii(spark.createDataFrame(tight, "doc_id long, text string")).collect()}) == 5
    got = pii.replace_pii(odd)
    assert got.count() == odd.count() and got.columns == [*odd.columns, "n_entities"] and pii.replace_pii(none).count() == 0


MASKED = ("Password: ********", "pwd=______", "token: ......", "Secret:\n------------", "api_key=sk-________________ here", "mail ²@-.org")


def test_masked_secrets_and_full_spaces(spark):
    full = [f"pwd=******{i}" for i in range(10)] + [f"call +1 {i:02d}-{j:02d} now" for i in range(100) for j in range(100)]
    full += [f"host 192.168.{i}.{j}" for i in range(256) for j in range(256)] + ["password: ١٢٣٤٥٦", "pin +49 ١٢٣ ٤٥٦", "secret: ªªªªªª", "Mr Αβ", "a@b.org"]
    docs = spark.createDataFrame(list(enumerate([*MASKED, *full])), "doc_id long, text string")
    out = {r.doc_id: (r.text, r.n_entities) for r in pii.replace_pii(docs).collect()}
    assert len(out) == len(MASKED) + len(full)
    assert [out[i] for i in range(len(MASKED))] == [(t, 0) for t in MASKED]
    new = [out[len(MASKED) + i] for i in range(len(full))]
    assert all(n == 1 for _, n in new) and len({t for t, _ in new}) == len(full) and not {t for t, _ in new} & set(full)
    assert not any(c in t for t, _ in new[-5:-3] for c in ("١٢٣", "٤٥٦"))


def test_pipeline_stages_and_registration(spark, tmp_path):
    names = __spark_entry__.queries()
    assert {f"op{k}_" for k in range(1, 11)} <= {n[:n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontaminate", "personal_data", "encode"]
    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[2:4]:
        after = stage(spark, kept, sf)
        assert after.columns == docs.columns and after.count() <= kept.count()
        kept = after
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert last.count() == kept.count() and last.where("NOT round_trip").count() == 0


def test_one_form_for_each_entity(spark):
    forms = lambda t: [x[2:] for x in pii.find_entities(t)]
    assert forms("+15551234567 / +1 555 123 4567 / +1 (555) 123-4567") == [("phone", "+1 5551234567")] * 3
    assert forms("+49 30 1234567 or 030 1234567, 555 123 4567, and 12 345 678 times") == [("phone", "+49 301234567"), ("phone", "0301234567"), ("phone", "5551234567")]
    assert forms("2001:db8::1 = 2001:0DB8:0:0:0:0:0:1, at 10:20:30, std::vector, ::1") == [("ip6", "2001:0db8:0000:0000:0000:0000:0000:0001")] * 2
    assert forms("Mr Alex Smith; Dr Alex Smith; Alex Smith. Alex's dog") == [("given", "alex"), ("surname", "smith")] * 3 + [("given", "alex")]
    assert forms("Mr. O'Neil; my name is Priya Sharma; 王小明先生, 王小明") == [("surname", "o'neil"), ("given", "priya"), ("surname", "sharma"), ("surname", "王小明"), ("surname", "王小明")]
    for clean in ("Will the Rose Garden open in May? A New York Times story.", "ratio 100 200 3000 4 and 1 000 000 000", "a::b c:d:e"):
        assert forms(clean) == []


def test_table_is_distinct_and_coreferent(spark):
    """Every entity has one surrogate everywhere, no two share one, none is an entity of the table; genders follow titles."""
    rows = [f"Ms {n} Smith wrote to {m}@mail.org from 10.0.0.{k}" for k, (n, m) in enumerate((n, m) for n in ("Robin", "Kim", "Alexis") for m in "abcd")]
    rows += ["Dr Robin Miller and Kim Smith. Robin left", "Mr Sam Lee; Sam Lee", *[f"code: secret={d:06d}"[:40] for d in range(40)], *[f"token={d}aaaaa" for d in range(10)]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.replace_pii(docs).collect()}
    pairs = {}
    for i, t in enumerate(rows):
        new, shift = out[i], 0
        found = pii.find_entities(t)
        for n, (s, e, kind, norm) in enumerate(found):
            until = found[n + 1][0] if n + 1 < len(found) else len(t)
            tail = t[e:until]
            end = new.index(tail, s + shift + 1) if tail else len(new)
            pairs.setdefault((kind, norm), set()).add(new[s + shift:end].lower())
            shift = end - e
    assert all(len(x) == 1 for x in pairs.values())
    flat = [(k, *x) for (k, _), x in pairs.items()]
    assert len(flat) == len(set(flat)) and not {(k, x) for k, x in flat} & set(pairs)
    female = ("lia", "nna", "ssa", "rina")
    assert all(next(iter(pairs["given", n])).endswith(female) for n in ("robin", "kim", "alexis")) and not next(iter(pairs["given", "sam"])).endswith(female)
    full = spark.createDataFrame([(d, f"secret={d:06d}") for d in range(300)] + [(i, f"secret=a{i}bbbb") for i in range(10)], "doc_id long, text string")
    assert len({r.text for r in pii.replace_pii(full).collect()}) == 310


CUT_PAGE = """<!DOCTYPE html><html><head><title>T</title></head><body class='x'><nav><a href="/a?b>c">menu</a></nav><article><h1>Head &amp; line</h1>
<p title="a > b" data-x='c > d'>One <b>two</b> three.</p><!-- no > text --><p id=don't>Four</p><div class="discussion"><p>said so</p></div></article><footer>end</footer></body></html>"""


def test_pages_cut_anywhere_leave_no_markup():
    main = lambda page: " ".join(t for part, t in html_text.blocks(page) if part == "main")
    assert main(CUT_PAGE) == "Head & line One two three. Four"
    for n in range(len(CUT_PAGE) + 1):
        for part, t in html_text.blocks(CUT_PAGE[:n]):
            assert "<" not in t and ">" not in t and "href" not in t and "title" not in t, (n, part, t)
        assert "Head & line One two three. Four said so".startswith(main(CUT_PAGE[:n]).replace("&am", "").replace("&a", "").rstrip("&").rstrip()) or "&" in main(CUT_PAGE[:n])
    assert html_text.blocks('<article><p title="x>lost text') == [] and html_text.blocks('<article>kept <a href="http://exa') == [("main", "kept")]
    assert main("<article>" + "<p a='" * 20_000) == ""  # no quadratic search


def test_pipeline_against_brute_force(spark, tmp_path, reference):
    """All five stages on a small table with copies, leaks, personal data, nulls, repeated rows and clashing columns."""
    from .test_copies import linked
    from tidemark.llm.quality_pu import features_of, train

    rng = random.Random(8)
    word = lambda: rng.choice("the of town river market people house old story between walking winter letter garden bridge music".split()) + rng.choice(["", "", "s", "ly"])
    text = lambda n: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(n)) + "."
    rows = [(i, text(12) + f" Write to kim{i}@mail.org." * (i % 3 == 0)) for i in range(60)]
    rows += [(100 + k, rows[k][1].replace("river", "rivers", 1)) for k in range(8)] + [(110 + k, rows[k][1]) for k in range(4)]
    rows += [(120 + k, f"{text(3)} {ITEM} {text(3)}") for k in range(3)] + [(131, None), (132, ""), (None, text(5)), (5, text(7)), (60, rows[60 - 1][1]), rows[20]]
    rows += [(200 + k, "$$$ !!! CLICK <<>> || ## ** " * 30) for k in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 7 if t is None else len(t), "k", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, text_key string, _id int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1 if i < 100 else 0) for i in [*range(40), *range(200, 220)]], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = [(i, t) for (i, t), s in zip(rows, model.score(features_of([t for _, t in rows]))) if s >= 0.3]
    assert 60 < len(good) <= len(rows) - 20
    sets = dict(enumerate(good))
    group = {k: g for k, (_, g) in linked([(k, t) for k, (_, t) in sets.items()]).items()}
    first = {}
    for k, (i, t) in sets.items():
        if i is not None and (t or "").split():
            first[group[k]] = min(first.get(group[k], (i, k)), (i, k))
    kept = [(i, t) for k, (i, t) in sets.items() if i is None or not (t or "").split() or first[group[k]] == (i, k)]
    kept = [(i, t) for i, t in kept if ITEM not in (t or "")]
    want = sorted((str(i), tuple(reference.encode_ordinary(pii.replace_entities(t, pii.DEFAULT_KEY, {})[0] if t else ""))) for i, t in kept)
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in got) == want and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert sum("@" in (t or "") for _, t in kept) > 5 and sum(i == 5 for i, _ in kept) == 2  # one id, two texts
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0 and (name == "encode" or empty.columns == docs.columns)


def test_a_host_has_one_suffix_array(spark, tmp_path, monkeypatch):
    menu = "one menu of eight words that is repeated"
    rows = [(i, f"http://{'a' if i < 30 else 'b'}.org/{i}", f"<p>{menu}</p><p>own{i} words</p>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    real, out = html_text.suffix_runs, str(tmp_path)

    def counted(streams, run):
        import uuid
        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(streams)))
        return real(streams, run)

    monkeypatch.setattr(html_text, "suffix_runs", counted)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        whole = sorted(tuple(r) for r in html_text.extract_text(pages).collect())
        sizes = sorted(int(f.read_text()) for f in tmp_path.iterdir())
        parts = sorted(tuple(r) for r in html_text.extract_text(pages, array_bytes=200).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert sizes == [10, 30]
    assert whole == parts == [(i, u, f"own{i} words") for i, u, _ in rows]


def test_runs_are_counted_on_whole_pages(spark):
    menu, words = "home about products contact imprint privacy terms and conditions of use", "a paragraph of ten words that several pages have alike"
    rows = [(i, f"http://m.org/{i}", f"<div>{menu}</div><article>text{i} of{i}</article>") for i in range(5)]  # one menu, five articles
    rows += [(10 + i, f"http://a.org/{i}", f"<article>{words} and own{i}</article>") for i in range(2)]  # in two articles and open
    rows += [(20, "http://m.org/x", f"<div>{menu}</div><p>open text</p>"), (21, "http://a.org/x", f"<p>{words}</p><p>open text</p>")]
    rows += [(30 + i, f"http://b.org/{i}", f"<article>{words} and own{i}</article>") for i in range(4)]
    rows += [(40 + i, f"http://c.org/{i}", "<div>one two three four</div><article>five six seven eight</article>" * (i < 2) or "<p>one two three four five six seven eight</p>") for i in range(3)]
    for array_bytes in (1 << 22, 120):
        got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"), array_bytes=array_bytes).collect()
        text = {r.page_id: r.text for r in got}
        assert len(got) == len(rows) and text[20] == text[21] == "open text"
        assert all(text[i] == f"text{i} of{i}" for i in range(5)) and all(text[30 + i] == f"{words} and own{i}" for i in range(4))
        assert text[42] == "one two three four five six seven eight"  # no run goes from the menu into the article
