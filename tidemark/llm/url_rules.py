"""URL filter whose block decisions follow redirect and canonical links.

Rules name a host (with its subdomains) and a path prefix; the longest fitting rule decides a url.
Urls without a rule take the verdict of their equivalence class: distributed connected components
over the canonical (``<link rel=canonical>``) and redirect (``<meta http-equiv=refresh>``) links
of the pages. A class with a member that a rule blocks is blocked, unless a rule explicitly
allows one of its members; every other class, and a url that no link touches, is allowed.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule, joins no
class and is allowed; a null html has no links; repeated rows are judged alike, one row each; an
empty table gives an empty result; other columns are ignored. A url's node is its host, path and
query (scheme and fragment do not tell servers' pages apart).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ._util import lower_ascii
from .components import components


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("net", "/", "block"),
    UrlRule("example.net", "/en/", "allow"),
    UrlRule("example.com", "/de/", "block"),
    UrlRule("org", "/fr/", "allow"),
)


def _rest(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.when(F.instr(url, "://") > 0, lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))).otherwise("")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def url_node(url: Column) -> Column:
    """Host, path and query: the name of a page in the link graph (null without ``://``)."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(url_host(url), url_path(url), query))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES, field: str = "name") -> Column:
    """Name (or verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, field))).otherwise(out)
    return out


_ATTR = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attr(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag."""
    pattern = rf"(?i)\s{name}{_ATTR}"
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def resolve(base: Column, href: Column) -> Column:
    """``href`` as an absolute url on a page at ``base`` (no dot segments)."""
    origin = F.regexp_extract(base, r"^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^[^:]*://[^/?#]*([^?#]*/)", 1)
    return (F.when(F.instr(href, "://") > 0, href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([^:]*:)", 1), href))
            .when(href.startswith("/"), F.concat(origin, href))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), href)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)`` nodes joined by a canonical or redirect link, one row per link."""
    p = pages.select(F.col(url).alias("u"), F.col(html).alias("h")).where("u IS NOT NULL AND h IS NOT NULL")
    p = p.where(F.lower("h").rlike(r"rel\s*=\s*[\"']?canonical|http-equiv\s*=\s*[\"']?refresh"))
    tag = p.select("u", F.explode(F.regexp_extract_all("h", F.lit(r"(?is)(<(?:link|meta)\s[^>]*>)"), F.lit(1))).alias("t"))
    # each step is a column of its own, so that long expressions are not repeated inside others
    tag = tag.withColumns({"rel": F.lower(F.trim(_attr(F.col("t"), "rel"))), "equiv": F.lower(F.trim(_attr(F.col("t"), "http-equiv")))})
    canonical = F.when(F.col("rel") == "canonical", F.trim(_attr(F.col("t"), "href")))
    refresh = F.when(F.col("equiv") == "refresh", F.trim(F.regexp_extract(_attr(F.col("t"), "content"), r"(?i)url\s*=\s*'?([^'\s]+)", 1)))
    href = tag.select("u", F.inline(F.array(F.struct(F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&")).alias("href"))))).where("href <> ''")
    href = href.withColumn("to", resolve(F.col("u"), F.col("href")))
    # a one-row generator: later filters on the ends are not pushed below it, which would copy the long expressions
    ends = F.array(F.struct(url_node(F.col("u")).alias("a"), url_node(F.col("to")).alias("b")))
    return href.select(F.inline(ends)).where("a IS NOT NULL AND b IS NOT NULL")


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, links: DataFrame | None = None,
                page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page; ``links`` (a, b urls) adds known redirects."""
    edges = page_links(pages, url, html)
    if links is not None:
        edges = edges.union(links.select(url_node(F.col("a")).alias("a"), url_node(F.col("b")).alias("b")))
    members = components(edges)
    named = members.withColumns({"h": F.regexp_extract("node", r"^([^/?]*)", 1), "p": F.regexp_extract("node", r"^[^/?]*([^?]*)", 1)})
    judged = named.withColumn("v", rule_of(F.col("h"), F.col("p"), rules, "verdict"))
    classes = judged.groupBy("component").agg(F.max(F.col("v") == "block").alias("blocked"), F.max(F.col("v") == "allow").alias("allowed"))
    bad = classes.where("blocked AND NOT coalesce(allowed, false)").select("component")
    blocked = members.join(bad, "component", "left_semi").select(F.col("node").alias("_node"), F.lit(True).alias("_blocked"))
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_u"))
    p = p.select("page_id", url_host(F.col("_u")).alias("host"), url_path(F.col("_u")).alias("path"), url_node(F.col("_u")).alias("_node"))
    p = p.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_v", rule_of(F.col("host"), F.col("path"), rules, "verdict"))
    out = p.join(blocked, "_node", "left")
    verdict = F.coalesce("_v", F.when(F.col("_blocked"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
