"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .decontam import template_steps
from .quality_rules import BASE_RULES, METHOD_RULES, STOP_WORDS, SYMBOLS
from .url_rules import RULES

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _rule_sql(r) -> str:
    return f"{r.metric} {r.op} {r.limit}" if r.per is None else f"100 * {r.metric} {r.op} {r.limit} * {r.per}"


def _op9() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    failed = ", ".join(f"CASE WHEN {_rule_sql(r)} THEN '{r.name}' END" for r in (*BASE_RULES, *METHOD_RULES))
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
tok AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
gram AS (SELECT rid, i, x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s || ' ' || lead(x, 4) OVER s AS g
         FROM tok WINDOW s AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM gram WHERE g IS NOT NULL),
gap AS (SELECT rid, least(5, i - lag(i, 1, i - 5) OVER (PARTITION BY rid ORDER BY i)) AS c FROM twice WHERE n > 1),
rep AS (SELECT rid, sum(c) AS n_repeat_words FROM gap GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: translate(x, '{up}', '{low}') IN ({stop})))::BIGINT AS n_stop_words,
        len(l)::BIGINT AS n_lines,
        length(regexp_replace(t, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
        (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs
      FROM d JOIN ln USING (rid) LEFT JOIN rep USING (rid)),
j AS (SELECT *, concat_ws(',', {failed}) AS failed, {' OR '.join(_rule_sql(r) for r in BASE_RULES)} AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed = '' AS kept, n_stop_words, failed FROM j
"""


def _case(field: str, host: str = "host", path: str = "path") -> str:
    arms = " ".join(
        f"WHEN ({host} = '{r.host}' OR {host} LIKE '%.{r.host}') AND starts_with({path}, '{r.path}') THEN '{getattr(r, field)}'"
        for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE {arms} END"


def _op3() -> str:
    attr = r"""\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))"""
    val = lambda name: " || ".join(rf"regexp_extract(t, '(?i)\s{name}{attr}', {k})" for k in (1, 2, 3))
    node = lambda u: rf"translate(regexp_extract(substr({u}, strpos({u}, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1) || regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^?#]*(\?[^#]*)', 1)"
    return rf"""
WITH RECURSIVE p AS (SELECT page_id, url, coalesce(strpos(url, '://'), 0) > 0 AS ok, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
q AS (SELECT page_id, CASE WHEN ok THEN translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
             CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
             CASE WHEN ok THEN {node('url')} END AS node FROM p),
tag AS (SELECT url AS u, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*>')) AS t FROM pages WHERE strpos(url, '://') > 0),
ref AS (SELECT u, replace(CASE WHEN lower(trim({val('rel')})) = 'canonical' THEN trim({val('href')})
                  WHEN lower(trim({val('http-equiv')})) = 'refresh' THEN trim(regexp_extract({val('content')}, '(?i)url\s*=\s*''?([^''\s]+)', 1)) END, '&amp;', '&') AS h FROM tag),
ab AS (SELECT u, CASE WHEN strpos(h, '://') > 0 THEN h
              WHEN starts_with(h, '//') THEN regexp_extract(u, '^([^:]*:)', 1) || h
              WHEN starts_with(h, '/') THEN regexp_extract(u, '^([^:]*://[^/?#]*)', 1) || h
              ELSE regexp_extract(u, '^([^:]*://[^/?#]*)', 1) || coalesce(nullif(regexp_extract(u, '^[^:]*://[^/?#]*([^?#]*/)', 1), ''), '/') || h END AS v
       FROM ref WHERE h <> ''),
ed AS (SELECT {node('u')} AS a, {node('v')} AS b FROM ab),
sym AS (SELECT a, b FROM ed WHERE a <> b UNION SELECT b, a FROM ed WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON r.b = s.a),
near AS (SELECT r.a, max(v = 'block') AS blocked, max(v = 'allow') AS allowed
         FROM (SELECT a, {_case('verdict', "regexp_extract(b, '^([^/?]*)', 1)", "regexp_extract(b, '^[^/?]*([^?]*)', 1)")} AS v FROM (SELECT a, b FROM reach UNION SELECT a, a FROM sym)) r GROUP BY r.a)
SELECT page_id, host, path, {_case('name')} AS rule,
       coalesce({_case('verdict')}, CASE WHEN blocked AND NOT coalesce(allowed, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN near ON node = near.a
"""


def _op5(window: int = 8, min_tokens: int = 4, max_needed: int = 6) -> str:
    def canon(c: str) -> str:
        for pattern, to in template_steps():
            for k in (1, 2, 3):
                to = to.replace(f"{{{k}}}", f"\\{k}")
            pattern, to = pattern.replace("'", "''"), to.replace("\x01", "' || chr(1) || '")
            c = f"regexp_replace({c}, '{pattern}', '{to}', 'g')"
        return f"lower({c})"

    ws = r"[\x20\x09-\x0D]+"
    bare = r"regexp_replace(lower(x[1]), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')"
    prepared = lambda table, idc: f"""(SELECT {idc}, list_transform(z, lambda x: x[2]) AS tok, list_transform(z, lambda x: {bare}) AS raw FROM (
        SELECT {idc}, list_filter(list_transform(list_zip(string_split_regex(text, '{ws}'), string_split_regex({canon('text')}, '{ws}')), lambda x: [x[1], x[2]]), lambda x: x[2] <> '') AS z
        FROM {table}))"""  # noqa: E731
    bared = rf"list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g'), '{ws}'), lambda x: x <> '')"
    enough = f"count(DISTINCT pos) >= least({max_needed}, ceil(item_windows / 2.0))"
    return f"""
WITH src AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, text FROM documents WHERE text IS NOT NULL),
item AS (SELECT *, least({window}, len(tok)) AS n, len(tok) - least({window}, len(tok)) + 1 AS item_windows
              FROM {prepared("(SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)", "item_id")} WHERE len(tok) >= {min_tokens}),
ig AS (SELECT item_id, n, item_windows, pos, tok[pos:pos + n - 1] AS g, raw[pos:pos + n - 1] AS iraw FROM (SELECT *, unnest(range(1, item_windows + 1)) AS pos FROM item)),
doc AS MATERIALIZED {prepared("src", "rid, doc_id")},
dg AS (SELECT rid, p, n, tok[p:p + n - 1] AS g, raw[p:p + n - 1] AS draw
       FROM (SELECT rid, tok, raw, n, unnest(range(1, len(tok) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM item))),
m AS (SELECT rid, item_id, item_windows, pos, p - pos AS shift, list_filter(list_transform(range(1, ig.n + 1), lambda i: [ig.g[i], iraw[i], draw[i]]), lambda x: regexp_matches(x[1], '<(num|name|unit)>')) AS slots
      FROM dg JOIN ig ON dg.g = ig.g AND dg.n = ig.n),
mm AS (SELECT *, len(list_filter(slots, lambda x: x[2] <> x[3])) = 0 AS same FROM m),
sl AS (SELECT rid, item_id, shift, same, unnest(CASE WHEN len(slots) = 0 THEN [NULL] ELSE slots END) AS s FROM mm),
ok AS (SELECT rid, item_id, shift, count(DISTINCT s) AS pairs, coalesce(bool_or(s[2] <> s[3]), false) AS changed, count(DISTINCT CASE WHEN same THEN s[2] END) AS equal,
              count(DISTINCT s[2]) = count(DISTINCT s[2:3]) AND count(DISTINCT s[3]) = count(DISTINCT s[2:3]) AS one FROM sl GROUP BY ALL),
typed AS (SELECT rid, item_id, item_windows, count(DISTINCT pos) AS n_windows, max(CASE WHEN one THEN pairs ELSE equal END) AS n_slots, bool_and(one AND changed) AS reparameterised
          FROM mm JOIN ok USING (rid, item_id, shift) WHERE one OR same GROUP BY ALL
          HAVING {enough}),
named AS (SELECT item_id FROM ig GROUP BY item_id, item_windows HAVING count(*) FILTER (NOT list_contains(g, '<name>')) < least({max_needed}, ceil(item_windows / 2.0))),
bitem AS (SELECT item_id, w, least({window}, len(w)) AS n FROM (SELECT DISTINCT item_id, {bared} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IN (SELECT item_id FROM named)) WHERE len(w) >= {min_tokens}),
bg AS (SELECT item_id, n, len(w) - n + 1 AS item_windows, pos, w[pos:pos + n - 1] AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS pos FROM bitem)),
bdoc AS (SELECT rid, {bared} AS w FROM src),
bdg AS (SELECT rid, n, w[p:p + n - 1] AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM bdoc, (SELECT DISTINCT n FROM bitem))),
plain AS (SELECT rid, item_id, item_windows, count(DISTINCT pos) AS n_windows FROM bdg JOIN bg ON bdg.g = bg.g AND bdg.n = bg.n
          WHERE NOT EXISTS (SELECT 1 FROM typed t WHERE t.rid = bdg.rid AND t.item_id = bg.item_id) GROUP BY ALL HAVING {enough}),
short AS (SELECT DISTINCT item_id, array_to_string({bared}, ' ') AS line FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
          WHERE item_id IN (SELECT item_id FROM {prepared("(SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)", "item_id")} WHERE len(tok) BETWEEN 1 AND {min_tokens - 1})),
lined AS (SELECT DISTINCT rid, item_id FROM (SELECT rid, array_to_string({bared}, ' ') AS line FROM (SELECT rid, unnest(string_split(text, chr(10))) AS text FROM src)) JOIN short USING (line) WHERE line <> ''),
found AS (SELECT rid, item_id, n_windows, item_windows, n_slots, reparameterised FROM typed
          UNION ALL SELECT rid, item_id, n_windows, item_windows, 0, false FROM plain
          UNION ALL SELECT rid, item_id, 1, 1, 0, false FROM lined)
SELECT doc_id, item_id, n_windows, item_windows::BIGINT AS item_windows, n_slots, reparameterised FROM found JOIN src USING (rid)
"""


def _op11(positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> str:
    return f"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {positives})
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= {negatives}
"""


def _op13(least: int = 30, top: int = 2000, scale: int = 2_000_000, held: int = 80) -> str:
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, w[i:i + {m - 1}] AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {m} + 2)) AS i FROM piece)" for m in range(1, 5))
    return rf"""
WITH piece AS (SELECT lang, list_filter(string_split_regex(x, '[\x20\x09]+'), lambda w: w <> '') AS w FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{up}', '{low}'), '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
f AS MATERIALIZED (SELECT lang, m, p, count(*) AS a FROM ({grams}) GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT * FROM f WHERE m > 1 AND a >= {least}),
inner_ AS (SELECT lang, p[i:i + j - 1] AS p, max(a) AS most
           FROM (SELECT lang, p, m, a, j, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM cand)) GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ i ON i.lang = c.lang AND i.p = c.p WHERE most IS NULL OR 100 * most < {held} * c.a),
cut AS (SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, ({scale}::HUGEINT * c.a) // (x.a + y.a) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
        JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:c.m]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER w AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM best JOIN total USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) QUALIFY row_number() OVER w <= {top}
"""


ORACLES: dict[str, str] = {"op9_quality_rules": _op9(), "op3_url_rules": _op3(), "op5_decontaminate": _op5(),
                           "op11_hard_negatives": _op11(), "op13_phrases": _op13()}
