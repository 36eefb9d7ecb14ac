"""Queries over pages of reports: every text, cut into pages of twelve lines, in which some lines, by their length, are such as reports hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.operators import forms, mining
from gleanery.plans.registry import query

_LINES = 12
#: By the length of a line modulo 13; other lines stay as they are.
_MADE = {
    0: "INDEPENDENT AUDITOR'S REPORT",
    1: "To the Board of Directors",
    2: "Springfield, Ohio",
    3: "JUNE 30, 2023",
    4: "March 3, 2024",
    6: "Schedule of Federal Awards",
    8: "Contents ......... 3",
    9: "Columbus, Ohio",
    10: "The Members of the board",
    11: "Dayton, New York",
}


def _pages(t):
    def line(x):
        n = F.length(x) % 13
        out = F.when(n == 5, F.concat(F.lit("Note "), F.length(x).cast("string"), F.lit(" "), x)).when(n == 7, F.upper(F.regexp_replace(F.left(x, F.lit(20)), "[^ -~]", ""))).otherwise(x)
        for k, made in _MADE.items():
            out = F.when(n == k, made).otherwise(out)
        return out

    lines = F.transform(F.split("text", "\n", -1), line)
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / _LINES).cast("int")), lambda p: F.array_join(F.slice("l", p * _LINES + 1, _LINES), "\n"))
    return t.documents.where("text IS NOT NULL").select("doc_id", lines.alias("l")).select("doc_id", F.posexplode(cut).alias("p", "text")).select("doc_id", (F.col("p") + 1).alias("page"), "text")


_LINE_SQL = "CASE length(x) % 13 " + " ".join(f"WHEN {k} THEN '" + v.replace("'", "''") + "'" for k, v in _MADE.items()) + " WHEN 5 THEN 'Note ' || length(x) || ' ' || x WHEN 7 THEN upper(regexp_replace(left(x, 20), '[^ -~]', '', 'g')) ELSE x END"
_PAGES = f"""
made AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: {_LINE_SQL}) AS l FROM documents WHERE text IS NOT NULL),
pages AS (SELECT doc_id, p + 1 AS page, array_to_string(list_slice(l, p * {_LINES} + 1, p * {_LINES} + {_LINES}), chr(10)) AS text FROM (SELECT doc_id, l, unnest(range(0, (len(l) - 1) // {_LINES} + 1)) AS p FROM made)),
filled AS (SELECT doc_id, page, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM pages),
ln AS (SELECT doc_id, page, i, l[i] AS text, list_slice(l, i + 1, i + 6) AS ahead, len(l) - i + 1 AS from_end FROM (SELECT doc_id, page, l, unnest(range(1, len(l) + 1)) AS i FROM filled))
"""


@query(
    rf"""
WITH {_PAGES}, a AS (SELECT doc_id, page, i, ahead, list_position(list_transform(ahead, lambda y: regexp_matches(y, '{mining.SALUTATION}')), true) AS s FROM ln WHERE contains(upper(text), '{mining.ANCHOR}') AND len(list_filter(ahead, lambda y: regexp_matches(y, '{mining.LEADERS}'))) = 0),
f AS (SELECT doc_id, page, i, ahead[s + 1] AS entity, ahead[s + 2] AS city FROM a WHERE s > 0)
SELECT doc_id, arg_min(page, (page, i))::INTEGER AS page, md5(arg_min(entity, (page, i))) AS entity, arg_min(city, (page, i)) AS city FROM f WHERE entity IS NOT NULL AND regexp_matches(city, '{mining.CITY}') GROUP BY doc_id
"""
)
def report_blocks(t):
    """Entity and city of the first auditor's report."""
    return mining.report_blocks(_pages(t)).select("doc_id", "page", F.md5("entity").alias("entity"), "city")


_DATED = rf"""
d AS (SELECT *, regexp_extract(text, '(?i){mining.DATE}', 1) AS value FROM ln)
"""


@query(
    rf"""
WITH {_PAGES}, {_DATED}, c AS (SELECT *, CASE WHEN text = value AND text = upper(text) THEN 0.92 WHEN text = value AND length(text) < 30 THEN 0.85 WHEN length(text) < 40 THEN 0.75 ELSE 0.55 END::DOUBLE AS confidence FROM d WHERE value <> '' AND page <= 3)
SELECT doc_id, arg_max(value, (confidence, -page, -i)) AS value, max(confidence) AS confidence, arg_max(page, (confidence, -page, -i))::INTEGER AS page FROM c GROUP BY doc_id
"""
)
def fiscal_year_end(t):
    """The best date of the first pages."""
    return mining.fiscal_year_end(_pages(t))


@query(f"WITH {_PAGES}, {_DATED}, c AS (SELECT *, CASE WHEN length(text) < 25 THEN 0.85 ELSE 0.72 END::DOUBLE AS confidence FROM d WHERE value <> '' AND from_end <= 6 AND length(text) < 40) SELECT doc_id, arg_min(value, (page, i)) AS value, arg_min(confidence, (page, i)) AS confidence, min(page)::INTEGER AS page FROM c GROUP BY doc_id")
def sign_off_dates(t):
    """The date on a short line near the end of a page."""
    return mining.sign_off(_pages(t))


@query(f"WITH {_PAGES}, h AS (SELECT doc_id, page, i, text FROM ln WHERE page <= 3 AND i <= 8 AND text = upper(text) AND regexp_matches(text, '[A-Z]{{3}}')) SELECT doc_id, arg_min(text, (page, i)) AS hint FROM h GROUP BY doc_id")
def header_hints(t):
    """The first line in capitals of the first pages."""
    return forms.header_hint(_pages(t))


@query(
    f"""
WITH {_PAGES}, p AS (SELECT * FROM (VALUES ('federal', 'schedule of federal awards', 1), ('opinion', 'independent auditor', 2), ('opinion', 'note 7', 3), ('words', ' the ', 4)) p(target, pattern, pos)),
h AS (SELECT doc_id, target, page > 5 AS body, pos, page FROM pages JOIN p ON contains(lower(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')), pattern))
SELECT doc_id, target, CASE WHEN (min((body, pos, page)))[1] THEN 'body' ELSE 'toc' END AS location, ((min((body, pos, page)))[3])::INTEGER AS page FROM h GROUP BY doc_id, target
"""
)
def section_detection(t):
    """Where sections are found first."""
    patterns = t.rows("target string, pattern string, pos int", ("federal", "Schedule of Federal Awards", 1), ("opinion", "independent auditor", 2), ("opinion", "NOTE 7", 3), ("words", " the ", 4))
    return forms.detected(_pages(t), patterns)


@query(
    f"""
WITH {_PAGES}, r AS (SELECT doc_id, page, i, x[i] AS text FROM (SELECT doc_id, page, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, page, string_split(text, chr(10)) AS x FROM pages))),
s AS (SELECT *, regexp_matches(text, '(?i)^\\s*note\\s+\\d+\\b') AS h, sum(regexp_matches(text, '(?i)^\\s*note\\s+\\d+\\b')::INT) OVER (PARTITION BY doc_id ORDER BY page, i) AS section FROM r WHERE trim(text) <> '')
SELECT doc_id, section::BIGINT AS section, md5(coalesce(max(text) FILTER (WHERE h), '')) AS heading, md5(coalesce(string_agg(text, chr(10) ORDER BY page, i) FILTER (WHERE NOT h), '')) AS content FROM s GROUP BY doc_id, section
"""
)
def note_headings(t):
    """Pages split at numbered notes."""
    return mining.note_sections(_pages(t)).select("doc_id", "section", F.md5(F.coalesce("heading", F.lit(""))).alias("heading"), F.md5("content").alias("content"))


def _greedy(prefixes: dict[str, str]) -> str:
    """Each prefix takes the first line that begins with it and that none before took, in SQL: a step a prefix."""
    steps, taken = [], "list_value(-1)"
    for n, (name, prefix) in enumerate(prefixes.items()):
        before = f"s{n - 1}" if n else "s"
        steps.append(f"s{n} AS (SELECT *, (list_filter(range(1, len(l) + 1), lambda i: starts_with(l[i], '{prefix}') AND NOT list_contains({taken}, i)))[1] AS {name} FROM {before})")
        taken = f"list_append({taken}, coalesce({name}, -1))"
    rows = " UNION ALL ".join(f"SELECT doc_id, '{x}' AS question, ({x} - 1)::INTEGER AS row FROM s{len(prefixes) - 1} WHERE {x} IS NOT NULL" for x in prefixes)
    return f"WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), {', '.join(steps)} {rows}"


_PREFIXES = {"a": "The", "b": "Th", "c": "T", "d": "A", "e": "An", "f": "zz"}


@query(_greedy(_PREFIXES))
def question_rows(t):
    """Each question takes the first free line that begins with its prefix."""
    rows = t.documents.where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("row", "text"))
    return forms.prefix_rows(t.rows("question string, prefix string, pos int", *[(q, p, n) for n, (q, p) in enumerate(_PREFIXES.items())]), rows)
