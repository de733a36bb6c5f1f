"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Texts become templates: numbers turn into ``<num>``, units after a number into ``<unit>``,
capitalised words inside a sentence into ``<name>``; other words lose punctuation and case. The
windows of ``window`` template tokens of the benchmark and of the documents meet in a hash join.
Matches of one document and item at one shift are an alignment; the raw words under its typed
placeholders must map one to one in both directions (a re-parameterised question replaces each
value by one other value everywhere). Of other alignments the windows count whose raw words equal
the item's, so a copy with one value altered is not lost. These windows of an item are taken together, and a
document is contaminated when they cover ``min(max_needed, half of the item's windows)`` of the
item's windows or more.

Names are typed by their capitals, so a lower- or upper-cased copy shows only the windows without names.
Items with fewer of those than are needed are searched a second time, by windows of bare lower-case words. Items of fewer
than ``min_tokens`` words are no windows; they are found where they make up a whole line of a document, case aside.

The benchmark side is broadcast only when its counted windows stay under ``broadcast_windows``;
beyond that the join shuffles on the window hash; so are the keys of matched texts under ``broadcast_texts``,
of about 50 bytes each. Texts are matched by their 128-bit key, so raw
words are fetched for matched texts only, once per text.

Defined cases: null and empty texts and items match nothing; an item of fewer template tokens
than ``window`` but at least ``min_tokens`` is one window of its own length; a copy in which every word has a capital
is found by its numbers and units only; very long texts are read whole; repeated documents are each reported; repeated
items are reported under each id; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ._util import SPACE_CLASS, free_name, stage

WS = r"[\x20\x09-\x0D]"
#: Unit words recognised after a number (parameter).
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "miles", "mile", "feet", "inches", "meters", "metres", "grams", "liters", "litres",
         "seconds", "minutes", "hours", "days", "weeks", "months", "years", "dollars", "euros", "cents", "percent", "degrees", "mph", "kmh", "gallons", "pounds")


def template_steps(units: tuple[str, ...] = UNITS) -> list[tuple[str, str]]:
    """Patterns and replacements, valid for Java's and RE2's expressions alike."""
    return [
        (rf"(^|[.!?:][\"')\]]*{WS}+|\n{WS}*)([\"'(]*)(\p{{Lu}})", "{1}{2}\x01{3}"),  # marks the start of a sentence
        (rf"({WS}[\"'(]*)\p{{Lu}}\p{{Ll}}\p{{L}}*", "{1}<name>"),
        (r"[0-9]+([.,:/][0-9]+)*", "<num>"),
        (rf"(<num>{WS}*)({'|'.join(units)})([^\p{{L}}\p{{N}}]|$)", "{1}<unit>{3}"),
        (r"[^\p{L}\p{N}<>\x20\x09-\x0D]+", ""),
    ]


def template(text: Column, units: tuple[str, ...] = UNITS) -> Column:
    """The text with typed placeholders, lower case and bare words; white space stays, so words stay aligned."""
    for pattern, to in template_steps(units):
        for k in (1, 2, 3):
            to = to.replace(f"{{{k}}}", f"${k}")
        text = F.regexp_replace(text, pattern, to)
    return F.lower(text)


def _key(text: Column) -> Column:
    return F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit("k"), F.length(text), text))


def _tokens(canon: Column) -> Column:
    return F.filter(F.split(canon, SPACE_CLASS), lambda w: w != "")


def bare(text: Column) -> Column:
    """Letters, digits and white space of a text, in lower case."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")


def _raw_words(text: Column, canon: Column) -> Column:
    """Raw words in step with the template's tokens (words that are only punctuation are in neither)."""
    pair = F.arrays_zip(F.split(text, SPACE_CLASS).alias("r"), F.split(canon, SPACE_CLASS).alias("t"))
    return F.transform(F.filter(pair, lambda x: x["t"] != ""), lambda x: F.regexp_replace(F.lower(x["r"]), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def _windows(tokens: str, n: int) -> Column:
    """Hash of every window of ``n`` tokens, in order; empty when there are fewer."""
    w = F.col(tokens)
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(F.lit(n), *[F.get(w, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def _spread(t: DataFrame, sizes: list[int]) -> DataFrame:
    """``key, p, h``: the windows of these sizes of each row's tokens."""
    if len(sizes) == 1:
        return t.select("key", F.posexplode(_windows("tok", sizes[0])).alias("p", "h"))
    every = F.concat(*[F.transform(_windows("tok", n), lambda h, i: F.struct(h.alias("h"), i.alias("p"))) for n in sizes])
    return t.select("key", F.inline(every)).select("key", "p", "h")


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, min_tokens: int = 4, max_needed: int = 6,
               units: tuple[str, ...] = UNITS, broadcast_windows: int = 1_000_000, broadcast_texts: int = 300_000) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, n_slots, reparameterised`` per contaminated document and item."""
    every_item = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    every_item = every_item.withColumn("canon", template(F.col("text"), units)).withColumn("tok", _tokens(F.col("canon"))).withColumn("raw", _raw_words(F.col("text"), F.col("canon")))
    items = every_item.withColumn("n", F.least(F.lit(window), F.size("tok"))).where(F.col("n") >= min_tokens)
    by_size = F.coalesce(*[F.when(F.col("n") == n, _windows("tok", n)) for n in range(min_tokens, window + 1)])
    items = items.withColumn("item_windows", F.size("tok") - F.col("n") + 1)
    grams = items.select("item_id", "n", "item_windows", "tok", "raw", F.posexplode(by_size).alias("at", "h"))
    grams = grams.select("item_id", "n", "item_windows", "at", "h", F.slice("tok", F.col("at") + 1, F.col("n")).alias("itok"), F.slice("raw", F.col("at") + 1, F.col("n")).alias("iraw"))
    grams = stage(grams, "grams")  # read by every branch below
    # counting settles the window sizes in use and whether the benchmark may be broadcast
    seen = {r[0]: r[1] for r in grams.groupBy("n").count().collect()}  # at most window - min_tokens + 1 rows
    sizes, total = sorted(seen) or [window], sum(seen.values())
    hashes = grams.select("h").distinct()

    d = docs.select("doc_id", "text").where("text IS NOT NULL")
    t = d.select(_key(F.col("text")).alias("key"), _tokens(template(F.col("text"), units)).alias("tok"))
    spread = _spread(t, sizes)
    hit = spread.join(F.broadcast(hashes) if total <= broadcast_windows else hashes, "h", "left_semi").distinct()
    match = stage(hit.join(grams.select("item_id", "n", "item_windows", "at", "h"), "h").select("key", "p", "item_id", "n", "item_windows", "at"), "matches")
    needed = F.least(F.lit(max_needed), F.ceil(F.col("item_windows") / 2))
    near = match.groupBy("key", "item_id", "item_windows").agg(F.count_distinct("at").alias("m")).where(F.col("m") >= needed).select("key", "item_id")
    near = stage(near, "near")
    match = match.join(near, ["key", "item_id"], "left_semi")

    # the raw words of matched texts, once per text
    keyed = d.withColumn("key", _key(F.col("text")))
    keys = stage(near.select("key").distinct(), "keys")
    texts = keyed.join(F.broadcast(keys) if keys.count() <= broadcast_texts else keys, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    raws = texts.select("key", _raw_words(F.col("text"), template(F.col("text"), units)).alias("draw"))
    aligned = match.join(raws, "key").join(grams.select("item_id", "at", "n", "itok", "iraw").distinct(), ["item_id", "at", "n"])
    aligned = aligned.select("key", "item_id", "item_windows", "at", (F.col("p") - F.col("at")).alias("shift"), F.transform(
        F.filter(F.arrays_zip("itok", "iraw", F.slice("draw", F.col("p") + 1, F.col("n")).alias("draw")), lambda x: x["itok"].rlike("<(num|name|unit)>")),
        lambda x: F.struct(x["iraw"].alias("a"), x["draw"].alias("b"))).alias("slots"))
    aligned = stage(aligned.withColumn("same", F.forall("slots", lambda x: x["a"].eqNullSafe(x["b"]))), "aligned")  # raw words equal the item's
    pairs = aligned.select("key", "item_id", "shift", "same", F.explode_outer("slots").alias("s"))
    judged = pairs.groupBy("key", "item_id", "shift").agg(
        F.count_distinct("s.a").alias("na"), F.count_distinct("s.b").alias("nb"), F.count_distinct("s.a", "s.b").alias("nab"),
        F.count_distinct(F.when(F.col("same"), F.col("s.a"))).alias("equal"),
        F.coalesce(F.max(F.col("s.a") != F.col("s.b")), F.lit(False)).alias("changed"))
    one = F.expr("na = nab AND nb = nab")
    judged = judged.select("key", "item_id", "shift", one.alias("one"), F.when(one, F.col("nab")).otherwise(F.col("equal")).alias("nab"), (one & F.col("changed")).alias("changed"))
    found = aligned.select("key", "item_id", "item_windows", "at", "shift", "same").join(judged, ["key", "item_id", "shift"]).where("one OR same")
    leaks = found.groupBy("key", "item_id", "item_windows").agg(
        F.count_distinct("at").cast("long").alias("n_windows"), F.max("nab").alias("n_slots"), F.min("changed").alias("reparameterised"))
    leaks = leaks.where(F.col("n_windows") >= needed)

    # items that a copy in another case would not show
    nameless = F.sum((~F.array_contains("itok", "<name>")).cast("int"))
    named = stage(grams.groupBy("item_id", "item_windows").agg(nameless.alias("free")).where(F.col("free") < needed).select("item_id").distinct(), "named")
    more = []
    if named.limit(1).count():
        again = every_item.join(named, "item_id", "left_semi").select("item_id", _tokens(bare(F.col("text"))).alias("tok")).withColumn("n", F.least(F.lit(window), F.size("tok")))
        again = again.where(F.col("n") >= min_tokens).withColumn("item_windows", F.size("tok") - F.col("n") + 1)
        plain = stage(again.select("item_id", "item_windows", "n", F.posexplode(by_size).alias("at", "h")), "plain")
        lengths = sorted(r[0] for r in plain.select("n").distinct().collect()) or [window]
        words = _spread(d.select(_key(F.col("text")).alias("key"), _tokens(bare(F.col("text"))).alias("tok")), lengths).select("key", "h")
        wanted = plain.select("h").distinct()
        equal = words.join(F.broadcast(wanted) if total <= broadcast_windows else wanted, "h", "left_semi").distinct().join(plain, "h")
        equal = equal.groupBy("key", "item_id", "item_windows").agg(F.count_distinct("at").cast("long").alias("n_windows"))
        more.append(equal.where(F.col("n_windows") >= needed))
    short = every_item.where((F.size("tok") > 0) & (F.size("tok") < min_tokens)).select("item_id", F.concat_ws(" ", _tokens(bare(F.col("text")))).alias("line")).where("line <> ''")
    short = stage(short.distinct(), "short")
    if short.limit(1).count():
        longest = short.agg(F.max(F.length("line"))).first()[0]
        line = F.concat_ws(" ", _tokens(bare(F.col("line"))))
        lines = d.select(_key(F.col("text")).alias("key"), F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") <= 8 * longest + 64).withColumn("line", line)
        more.append(lines.join(short, "line").select("key", "item_id").distinct().select("key", "item_id", F.lit(1).alias("item_windows"), F.lit(1).cast("long").alias("n_windows")))
    for found in more:
        found = found.select("key", "item_id", "item_windows", "n_windows", F.lit(0).cast("long").alias("n_slots"), F.lit(False).alias("reparameterised"))
        leaks = leaks.unionByName(found.join(leaks, ["key", "item_id"], "left_anti"))
    return keyed.select("doc_id", "key").join(leaks, "key").select("doc_id", "item_id", "n_windows", F.col("item_windows").cast("long").alias("item_windows"), "n_slots", "reparameterised")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` (all columns) without the contaminated documents; a null doc_id is judged by nothing and stays."""
    leak = free_name(docs, "_leak")
    leaks = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(leaks, docs["doc_id"] == leaks[leak], "left_anti")
