"""Threshold table compiled into Spark projections of length, symbol, stop-word and line ratios.

All metrics and every rule are built-in expressions: no user function, no shuffle. The words of a
text become one array; from it follow the counts, and each rule of the table becomes one
comparison of whole numbers (``100 * a > limit * b``), so no rounding decides.

Defined cases: a null or empty text has no words and fails the base rules; very long texts are
judged whole; repeated rows are judged row by row; an empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ._util import lower_ascii, words

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages served (parameter of :func:`quality_rules`).
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by this at from or an not a "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es "
    "le la les de et des en un une du est que qui dans pour par sur au pas avec "
    "el los las y del se por con una para su al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """Fails a row when ``100 * metric`` is ``op`` ``limit * per`` (per None: plain ``metric op limit``)."""

    name: str
    metric: str
    op: str
    limit: int
    per: str | None = None

    def fails(self) -> Column:
        a = F.col(self.metric) if self.per is None else F.col(self.metric) * 100
        b = F.lit(self.limit) if self.per is None else F.col(self.per) * self.limit
        return a > b if self.op == ">" else a < b


BASE_RULES = (
    Rule("few_words", "n_words", "<", 10),
    Rule("repeated_words", "n_repeat_words", ">", 20, "n_words"),
)
METHOD_RULES = (
    Rule("short_words", "word_chars", "<", 200, "n_words"),
    Rule("long_words", "word_chars", ">", 2000, "n_words"),
    Rule("symbols", "n_symbols", ">", 10, "n_words"),
    Rule("few_stop_words", "n_stop_words", "<", 2, "n_words"),
    Rule("duplicate_lines", "n_dup_lines", ">", 30, "n_lines"),
    Rule("upper_case", "n_upper", ">", 30, "word_chars"),
    Rule("exclamations", "n_bangs", ">", 50, "n_words"),
)
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_upper", "n_bangs")


def _covered(starts: Column, n: int) -> Column:
    """Words covered by ``n``-word windows starting at the ascending positions ``starts``."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(-(1 << 30)).alias("last")),
        lambda acc, p: F.struct((acc["total"] + F.least(F.lit(n), p - acc["last"])).alias("total"), p.alias("last")),
        lambda acc: acc["total"],
    )


def text_metrics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS), window: int = 5) -> DataFrame:
    """``keep`` columns and the METRICS of every row's whole text."""
    stop = list(stop_words)
    df = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    df = df.withColumn("_w", words(F.col("_t")))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0))
    grams = F.when(F.size("_w") >= window, F.transform(
        F.sequence(F.lit(0), F.size("_w") - window),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(window)]),
    )).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_g", grams).withColumn("_s", F.sort_array("_g"))
    df = df.withColumn("_dup", F.exists(
        F.transform("_s", lambda x, i: (i > 0) & (x == F.get(F.col("_s"), i - 1))), lambda x: x))
    # only texts with a repeated window pay for finding where the windows start
    pairs = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("_p", F.when(F.col("_dup"), pairs))
    same = lambda i, j: F.coalesce(F.get(F.col("_p"), i)["g"] == F.get(F.col("_p"), j)["g"], F.lit(False))
    starts = F.sort_array(F.transform(
        F.filter(F.transform("_p", lambda x, i: F.struct(x["i"].alias("i"), (same(i, i - 1) | same(i, i + 1)).alias("d"))), lambda x: x["d"]),
        lambda x: x["i"]))
    n_chars = F.length("_t")
    bare = F.translate("_t", " \t\n\x0b\f\r", "")
    lower_stop = lambda w: lower_ascii(w).isin(stop)
    # a one-row generator: a filter on the metrics is not pushed below it, where it would copy (and repeat) all of this
    row = F.struct(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (n_chars - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_dup"), _covered(starts, window)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_w", lower_stop)).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_t", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        (n_chars - F.length(F.translate("_t", "!", ""))).cast("long").alias("n_bangs"),
    )
    return df.select(F.inline(F.array(row)))


def quality_rules(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = METHOD_RULES,
                  stop_words: list[str] | tuple[str, ...] = tuple(STOP_WORDS)) -> DataFrame:
    """Metrics, ``base_failed``, ``kept`` and the names of the ``failed`` rules for every row."""
    m = text_metrics(df, text, keep, stop_words)
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | r.fails()
    failed = F.filter(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in (*base, *rules)]), lambda x: x.isNotNull())
    out = m.withColumn("base_failed", base_failed).withColumn("failed", F.array_join(failed, ","))
    return out.withColumn("kept", F.col("failed") == "")
