"""Quality rules and url filter: contract cases, odd inputs, brute force."""

import re

from tidemark.llm.quality_rules import Rule, quality_rules
from tidemark.llm.url_rules import filter_urls, page_links


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    covered = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered |= set(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_metrics_match_brute_force(spark):
    texts = ["a b c d e f g a b c d e x", "x\nx\n\n y \nx", "#a$ <b>|", "a a a a a a a a", "é ü ß", None, "", "one two three four five"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_verdicts_and_odd_inputs(spark, odd, none):
    got = quality_rules(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[1].base_failed and by[2].base_failed and by[3].n_words == 0 and not by[1].kept
    assert by[4].kept and by[4].failed == "" and by[6].n_words == 60_000
    assert quality_rules(none).count() == 0
    strict = quality_rules(odd, rules=(Rule("tiny", "n_words", "<", 1000),)).where("kept").collect()
    assert [r.doc_id for r in strict if r.doc_id != 6] == []


def test_symbol_tables_capitals_fail(spark):
    good = "the cat of the house is on the mat and it was to be in a room with all that"
    rows = [(1, " | ".join(good.split())), (2, good.upper()), (3, good), (4, "!! ".join(good.split()))]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, verdict string")


def test_rules_longest_and_parts(spark):
    rows = [
        (1, "HTTP://A.Example.NET/en/x?q#f", ""), (2, "http://example.net/de/", None), (3, "http://net/", ""), (4, "http://x.net", ""),
        (5, "https://www.example.com/de/1", ""), (6, "http://example.com/DE/1", ""), (7, "http://a.org/fr/", ""), (8, None, ""), (9, "no scheme", ""),
        (10, "http://magnet/x", ""), (11, "http://h.org?x=/fr/", ""), (11, "http://h.org?x=/fr/", ""),
    ]
    got = {r.page_id: tuple(r)[1:] for r in filter_urls(pages(spark, rows)).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/de/", "net/", "block") and got[3][2] == "net/" and got[4] == ("x.net", "", None, "allow")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == (None, "allow") and got[7][2:] == ("org/fr/", "allow")
    assert got[8] == ("", "", None, "allow") and got[9] == ("", "", None, "allow") and got[10][2] is None and got[11][:2] == ("h.org", "")
    assert filter_urls(pages(spark, rows)).count() == len(rows)
    assert filter_urls(pages(spark, rows).limit(0)).count() == 0


def test_links_carry_blocks_and_allow_wins(spark):
    canonical = '<head><link href="{}" rel=canonical></head>'
    refresh = "<META HTTP-EQUIV='refresh' content='0; URL={}'>"
    rows = [
        (1, "http://a.info/1", canonical.format("http://bad.net/x")),  # alias of a blocked page
        (2, "http://a.info/2#top", refresh.format("/1")),  # redirect to that alias
        (3, "http://a.info/3", canonical.format("//bad.net/y")), (4, "http://b.info/", canonical.format("http://bad.net/y")),
        (5, "http://c.info/", canonical.format("http://bad.net/z?a=1&amp;b=2")), (6, "http://d.org/fr/ok", refresh.format("http://bad.net/z?a=1&b=2")),
        (7, "http://e.info/", "<link rel='stylesheet' href='http://bad.net/x'>"), (8, "http://a.info/dir/p", canonical.format("q")),
    ]
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages(spark, rows)).collect()}
    assert [got[k] for k in (1, 2, 3, 4)] == [(None, "block")] * 4
    assert got[5] == (None, "allow") and got[6] == ("org/fr/", "allow")  # an allowed member wins
    assert got[7] == (None, "allow") and got[8] == (None, "allow")
    ends = {(r.a, r.b) for r in page_links(pages(spark, rows)).collect()}
    assert ("a.info/dir/p", "a.info/dir/q") in ends and ("a.info/2", "a.info/1") in ends and len(ends) == 7
