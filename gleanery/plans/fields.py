"""Queries over fields: agreement, record scores, aliases, facts, authority."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.operators import aliases as A
from gleanery.operators import authority as U
from gleanery.operators import facts as X
from gleanery.operators import mining, scoring
from gleanery.plans.registry import query

_SLOTS = """
slots AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '' ELSE o_orderstatus END AS a,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '[EIN]' WHEN o_orderkey % 5 = 2 THEN 'Z' ELSE ' ' || lower(o_orderstatus) || ' ' END AS b,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE o_orderstatus END AS c FROM orders),
n AS (SELECT *, lower(trim(coalesce(a, ''))) AS na, lower(trim(coalesce(b, ''))) AS nb, lower(trim(coalesce(c, ''))) AS nc,
 (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS ran FROM slots),
e AS (SELECT *, na = '' AS ea, nb IN ('', '[ein]') AS eb, nc = '' AS ec FROM n),
s AS (SELECT *, CASE WHEN ran = 0 OR (ea AND eb AND ec) THEN 0.0 WHEN ran = 1 THEN 0.6
 WHEN ran = 2 THEN CASE WHEN (a IS NULL AND nb = nc) OR (b IS NULL AND na = nc) OR (c IS NULL AND na = nb) THEN 0.9 ELSE 0.3 END
 WHEN na = nb AND nb = nc THEN 1.0 WHEN na = nb OR nb = nc OR na = nc THEN 0.7 ELSE 0.2 END::DOUBLE AS score FROM e)
"""


def _slots(t):
    k = F.col("o_orderkey")
    a = F.when(k % 7 == 0, None).when(k % 7 == 1, "").otherwise(F.col("o_orderstatus"))
    b = F.when(k % 5 == 0, None).when(k % 5 == 1, "[EIN]").when(k % 5 == 2, "Z").otherwise(F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit(" ")))
    c = F.when(k % 3 == 0, None).when(k % 3 == 1, "").otherwise(F.col("o_orderstatus"))
    return t.orders.select(k.alias("k"), a.alias("a"), b.alias("b"), c.alias("c"))


@query(f"WITH {_SLOTS} SELECT k, score FROM s")
def slot_agreement(t):
    """Agreement of three extractors on a value."""
    return _slots(t).select("k", scoring.slot_score(F.col("a"), F.col("b"), F.col("c")).alias("score"))


_TIERS = [(f"f{i}", 1 if i <= 8 else 2 if i <= 17 else 3, i in (1, 9)) for i in range(1, 21)]


def _scores(t):
    """A record for each order, with the fields that its lines touch."""
    line = t.lineitem.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("f"), (F.col("l_partkey") % 20 + 1).cast("string")).alias("field"), F.when(F.col("l_linenumber") == 2, 0.0).otherwise(F.round(F.col("l_discount") * 100) * 0.08).alias("score"))
    return line.groupBy("doc_id", "field").agg(F.max("score").alias("score"))


_SCORES = """
tiers AS (SELECT 'f' || i AS field, CASE WHEN i <= 8 THEN 1 WHEN i <= 17 THEN 2 ELSE 3 END AS tier, i IN (1, 9) AS exempt FROM range(1, 21) r(i)),
scores AS (SELECT l_orderkey AS doc_id, 'f' || (l_partkey % 20 + 1) AS field, max(CASE WHEN l_linenumber = 2 THEN 0.0::DOUBLE ELSE round(l_discount * 100) * 0.08::DOUBLE END) AS score FROM lineitem GROUP BY 1, 2)
"""


@query(
    f"""
WITH {_SCORES}, j AS (SELECT s.*, tier, exempt, CASE WHEN exempt AND score = 0 THEN 1.0::DOUBLE ELSE score END AS e FROM scores s JOIN tiers USING (field)),
g AS (SELECT doc_id, coalesce(sum(e) FILTER (WHERE tier = 1), 0) AS s1, coalesce(sum(e) FILTER (WHERE tier = 2), 0) AS s2, count(*) FILTER (WHERE tier = 1 AND e > 0) AS n1, count(*) FILTER (WHERE tier = 2 AND e > 0) AS n2,
 count(*) FILTER (WHERE tier = 1 AND exempt) AS x1, count(*) FILTER (WHERE tier = 2 AND exempt) AS x2 FROM j GROUP BY doc_id),
f AS (SELECT doc_id, s1 + 1 - x1 AS s1, s2 + 1 - x2 AS s2, n1 + 1 - x1 AS n1, n2 + 1 - x2 AS n2 FROM g),
l AS (SELECT *, CASE WHEN n1 >= 8 THEN 0.82 WHEN n1 >= 7 THEN 0.75 WHEN n1 >= 5 THEN 0.65 WHEN n1 >= 3 THEN 0.55 ELSE 0.0 END::DOUBLE AS floor FROM f),
a AS (SELECT *, round(least(greatest(s1 / 8 * 0.7::DOUBLE + s2 / 9 * 0.3::DOUBLE, floor), 1.0::DOUBLE), 4) AS aggregate FROM l)
SELECT doc_id, aggregate, n1 AS t1_found, n2 AS t2_found, floor, aggregate >= 0.5 AS extraction_gate, aggregate >= 0.7 AS quality_gate FROM a
"""
)
def record_scores(t):
    """Record scores by tier, with floors and gates."""
    return scoring.record_scores(_scores(t), t.rows("field string, tier int, exempt boolean", *_TIERS))


@query(f"WITH {_SCORES} SELECT doc_id, coalesce(array_to_string(list_sort(list(field) FILTER (WHERE score > 0)), ','), '') AS present, coalesce(array_to_string(list_sort(list(field) FILTER (WHERE score = 0)), ','), '') AS missing, coalesce(array_to_string(list_sort(list(field) FILTER (WHERE score > 0 AND score < 0.7)), ','), '') AS low FROM scores GROUP BY doc_id")
def field_lists(t):
    out = scoring.field_lists(_scores(t))
    return out.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("present", "missing", "low")])


@query(
    f"""
WITH {_SLOTS}, c AS (SELECT *, na <> '' OR nb <> '' AS has_det, c IS NOT NULL AND ((na <> '' AND nc = na) OR (nb <> '' AND nc = nb)) AS agrees, k % 2 = 0 AS sure, k % 4 = 1 AS t1, k % 11 <> 0 AS found FROM s)
SELECT k, CASE WHEN NOT found THEN score WHEN NOT has_det THEN round(CASE WHEN t1 THEN least(0.65 + CASE WHEN sure THEN 0.05 ELSE 0 END, 0.72) ELSE 0.65 + CASE WHEN sure THEN 0.05 ELSE 0 END END::DOUBLE, 4)
 WHEN agrees THEN round(0.85::DOUBLE + CASE WHEN sure THEN 0.05 ELSE 0 END::DOUBLE, 4) ELSE score END::DOUBLE AS score, found AND has_det AND NOT agrees AS contradicts FROM c
"""
)
def calibrated_scores(t):
    """Scores of fields that a model filled."""
    k, cols = F.col("k"), [F.col(c) for c in "abc"]
    score, against = scoring.calibrated(scoring.slot_score(*cols), *cols, k % 11 != 0, k % 2 == 0, k % 4 == 1)
    return _slots(t).select("k", score.alias("score"), against.alias("contradicts"))


@query(f"WITH {_SLOTS}, f AS (SELECT k % 50 AS doc_id, k, 'f' || (k % 20 + 1) AS field, a, b, c, score FROM s) SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list(field) FILTER (WHERE (a IS NULL AND b IS NULL AND c IS NOT NULL) OR (k % 20 < 8 AND score < 0.7) OR k % 97 = 0))), ','), '') AS flagged FROM f GROUP BY doc_id")
def flagged_fields(t):
    """Fields that need a look."""
    k = F.col("k")
    rows = _slots(t).select((k % 50).alias("doc_id"), F.concat(F.lit("f"), (k % 20 + 1).cast("string")).alias("field"), F.col("a").alias("val_a"), F.col("b").alias("val_b"), F.col("c").alias("val_c"), scoring.slot_score(F.col("a"), F.col("b"), F.col("c")).alias("score"), F.when(k % 20 < 8, 1).otherwise(2).alias("tier"), (k % 97 == 0).alias("asked_model"))
    return scoring.flagged_fields(rows).select("doc_id", F.array_join("flagged", ",").alias("flagged"))


_PARTED = r"""
d AS (SELECT doc_id AS k, lang, text, n_chars % 4 AS m, length(text) AS n, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL),
c AS (SELECT *, CASE WHEN m <> 0 THEN 'ENGAGEMENT TYPE: x' || chr(10) ELSE '' END || CASE WHEN m <> 1 THEN 'FINDINGS:' || chr(10) ELSE '' END
 || array_to_string(list_transform(l, lambda x, i: CASE WHEN length(x) % 3 = 0 THEN i || '. ' || x || CASE WHEN length(x) % 2 = 0 THEN ' SOP §3.1(a)' ELSE '' END || CASE WHEN length(x) % 5 < 3 THEN ' Severity: low' ELSE '' END ELSE x END), chr(10))
 || CASE WHEN m <> 2 THEN chr(10) || 'RECOMMENDATION: ' || left(text, 40) ELSE '' END || CASE WHEN n % 7 = 0 THEN ' ensure field completed' ELSE '' END AS t FROM d),
q AS (SELECT *, len(regexp_extract_all(t, '(?m)^\s*\d+\.\s+.+')) AS lines, contains(t, 'ENGAGEMENT TYPE:')::INT + contains(t, 'FINDINGS:')::INT + contains(t, 'RECOMMENDATION:')::INT AS sections,
 len(regexp_extract_all(t, '(?i)(?:SOP[\w-]*\s+)?§\s*[A-Za-z0-9]+(?:[.\-][A-Za-z0-9]+)*(?:\([^)]*\))?')) AS cited, len(regexp_extract_all(t, '(?i)Severity:\s*(High|Medium|Low|Informational)')) AS graded,
 trim(regexp_extract(t, '(?is)RECOMMENDATION:\s*(.+)\z', 1)) AS advice, regexp_matches(t, '(?i)§X\.X|\[Finding label\]|REQUIRES MANUAL COMPLETION|\[add more findings|field X missing|ensure field completed') AS unfilled FROM c),
s AS (SELECT *, CASE WHEN lines > 0 THEN least(cited / lines, 1.0) WHEN n % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS share_c, CASE WHEN lines > 0 THEN least(graded / lines, 1.0) WHEN n % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS share_s, CASE WHEN contains(lower(advice), lang) THEN 1.0 WHEN advice <> '' THEN 0.5 ELSE 0.0 END::DOUBLE AS client FROM q),
r AS (SELECT *, round(least(0.30::DOUBLE * sections / 3 + 0.20::DOUBLE * share_c + 0.20::DOUBLE * share_s + 0.20::DOUBLE * client + CASE WHEN unfilled THEN 0.0 ELSE 0.10 END::DOUBLE, 1.0::DOUBLE), 4) AS rubric FROM s)
"""


@query(
    f"""
WITH {_PARTED} SELECT k, rubric, round(greatest(0, least(1, g - least(taken, g * 0.2::DOUBLE))), 4) AS final, CASE WHEN n % 5 = 0 THEN 0.35 ELSE round(greatest(0, least(1, rubric - ((n % 3) * 0.05::DOUBLE + least((n % 10) / 10.0::DOUBLE * 0.1::DOUBLE, 0.15::DOUBLE) + CASE WHEN sections = 3 THEN 0.0 ELSE 0.2 END::DOUBLE))), 4) END::DOUBLE AS classified
FROM (SELECT *, rubric * (0.7::DOUBLE + (n % 4) / 3.0::DOUBLE * 0.3::DOUBLE) AS g, (n % 3) * 0.15::DOUBLE + (n % 2) * 0.1::DOUBLE + (n % 4) * 0.03::DOUBLE + 0.5::DOUBLE * (n % 5) * 0.08::DOUBLE AS taken FROM r)
"""
)
def completion_scores(t):
    """Rubric and final scores of completions made of whole texts."""
    n, m = F.length("text"), F.col("n_chars") % 4

    def line(x, i):
        w = F.length(x)
        made = F.concat((i + 1).cast("string"), F.lit(". "), x, F.when(w % 2 == 0, " SOP §3.1(a)").otherwise(""), F.when(w % 5 < 3, " Severity: low").otherwise(""))
        return F.when(w % 3 == 0, made).otherwise(x)

    body = F.array_join(F.transform(F.split("text", "\n", -1), line), "\n")
    whole = F.concat(F.when(m != 0, "ENGAGEMENT TYPE: x\n").otherwise(""), F.when(m != 1, "FINDINGS:\n").otherwise(""), body, F.when(m != 2, F.concat(F.lit("\nRECOMMENDATION: "), F.left("text", F.lit(40)))).otherwise(""), F.when(n % 7 == 0, " ensure field completed").otherwise(""))
    d = t.documents.where("text IS NOT NULL AND lang IS NOT NULL AND n_chars IS NOT NULL").select(F.col("doc_id").alias("k"), n.alias("n"), "lang", whole.alias("t"))
    n = F.col("n")
    rows = d.select("k", "n", F.regexp_count("t", F.lit("ENGAGEMENT TYPE:|FINDINGS:|RECOMMENDATION:")).alias("sections"), scoring.rubric(F.col("t"), F.when(n % 2 == 0, 0).otherwise(2), F.col("lang")).alias("rubric"))
    final = scoring.completion_score(F.col("rubric"), (n % 4) / F.lit(3.0), n % 3, n % 2, n % 4, F.lit(0.5), n % 5)
    classified = scoring.classified_score(F.col("rubric"), F.when(n % 5 == 0, 1).otherwise(0), n % 3, (n % 10) / F.lit(10.0), F.col("sections") == 3)
    return rows.select("k", "rubric", final.alias("final"), classified.alias("classified"))


@query(
    """
WITH p AS (SELECT l_linenumber % 3 AS a, l_suppkey % 3 AS b FROM lineitem), g AS (SELECT count(*) AS n, count(*) FILTER (WHERE a = b) AS same, corr(a, b) AS r FROM p),
x AS (SELECT sum(l.n * r.n) AS chance FROM (SELECT a AS v, count(*) AS n FROM p GROUP BY a) l JOIN (SELECT b AS v, count(*) AS n FROM p GROUP BY b) r USING (v))
SELECT n, round(same / n, 4) AS agreement, round((same / n - chance / (n * n)) / (1 - chance / (n * n)), 4) AS kappa, round(r, 4) AS pearson FROM g, x
"""
)
def rater_agreement(t):
    """Agreement of two raters: share, kappa and correlation."""
    return scoring.rated(t.lineitem.select((F.col("l_linenumber") % 3).cast("long").alias("a"), (F.col("l_suppkey") % 3).alias("b")))


_NAMES = "(SELECT n_name AS canonical, v.variant, n_nationkey * 10 + v.pos AS pos FROM nation, LATERAL (VALUES (lower(n_name), 0), (left(n_name, 4) || ' land', 1)) v(variant, pos))"


def _names(t):
    pairs = F.explode(F.array(F.struct(F.lower("n_name").alias("variant"), F.lit(0).alias("p")), F.struct(F.concat(F.left("n_name", F.lit(4)), F.lit(" land")).alias("variant"), F.lit(1).alias("p")))).alias("x")
    return t.nation.select(F.col("n_name").alias("canonical"), "n_nationkey", pairs).select("canonical", "x.variant", (F.col("n_nationkey") * 10 + F.col("x.p")).alias("pos"))


@query(f"WITH m AS (SELECT lower(trim(variant)) AS v, arg_max(canonical, pos) AS c FROM {_NAMES} GROUP BY 1), l AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '  ' || upper(n_name) WHEN s_suppkey % 3 = 1 THEN left(n_name, 4) || ' Land' ELSE s_name END AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, label, c AS canonical, coalesce(c, label) AS field FROM l LEFT JOIN m ON lower(trim(label)) = v")
def alias_resolution(t):
    """Labels to canonical names; of equal aliases the last one holds."""
    k = F.col("s_suppkey")
    label = F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper("n_name"))).when(k % 3 == 1, F.concat(F.left("n_name", F.lit(4)), F.lit(" Land"))).otherwise(F.col("s_name"))
    labels = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", label.alias("label"))
    return A.resolved(labels, _names(t))


_TERMS = "(VALUES ('article', 'the', 1), ('order', 'then', 2), ('order', 'thing', 3), ('place', 'ther', 4), ('place', 'un', 5), ('place', 'les', 6), ('noun', 'heit', 7)) a(canonical, variant, pos)"
_TERM_ROWS = (("article", "the", 1), ("order", "then", 2), ("order", "thing", 3), ("place", "ther", 4), ("place", "un", 5), ("place", "les", 6), ("noun", "heit", 7))


@query(f"SELECT doc_id, arg_min(canonical, (-length(variant), variant)) AS canonical, arg_min(variant, (-length(variant), variant)) AS variant FROM documents JOIN {_TERMS} ON contains(lower(text), variant) AND length(variant) >= 3 GROUP BY doc_id")
def longest_alias(t):
    """The longest alias that a text contains."""
    return A.longest_contained(t.documents, t.rows("canonical string, variant string, pos int", *_TERM_ROWS), "doc_id")


@query(f"SELECT DISTINCT doc_id, canonical FROM documents JOIN {_TERMS} ON contains(lower(text), variant) AND length(variant) >= 3")
def alias_mentions(t):
    return A.mentions(t.documents, t.rows("canonical string, variant string, pos int", *_TERM_ROWS), "doc_id")


@query(
    f"""
WITH m AS (SELECT lower(trim(variant)) AS v, arg_max(canonical, pos) AS c FROM {_NAMES} GROUP BY 1),
l AS (SELECT DISTINCT lower(n_name) || ['', 'x', 's y'][n_nationkey % 3 + 1] AS label FROM nation),
s AS (SELECT label, v, c, greatest(1 - levenshtein(label, v) / greatest(length(label), length(v)), (1 - levenshtein(array_to_string(list_sort(string_split(label, ' ')), ' '), array_to_string(list_sort(string_split(v, ' ')), ' ')) / greatest(length(label), length(v))) * 0.95::DOUBLE) AS score FROM l, m),
b AS (SELECT label, arg_min(c, (-score, v)) AS canonical, arg_min(v, (-score, v)) AS variant, max(score) AS score FROM s GROUP BY label HAVING max(score) >= 0.75)
SELECT label, canonical, variant, round(score, 4) AS score, round(score * 0.8::DOUBLE, 4) AS effective, CASE WHEN canonical = 'NATION_3' THEN 'manual_review' WHEN score >= 0.9 THEN 'high_confidence' ELSE 'quick_confirm' END AS bucket FROM b
"""
)
def alias_proposals(t):
    """The nearest alias of labels that none equals."""
    tail = F.element_at(F.array(*[F.lit(x) for x in ("", "x", "s y")]), (F.col("n_nationkey") % 3 + 1).cast("int"))
    labels = t.nation.select(F.concat(F.lower("n_name"), tail).alias("label"))
    rejected = t.nation.where("n_name = 'NATION_3'").select(F.concat(F.lower("n_name"), tail).alias("label"), F.col("n_name").alias("canonical"))
    return A.proposals(labels, _names(t), rejected, by_edits=True)


@query()
def weighted_alias_proposals(t):
    """The likest alias of labels of the kind that forms have, by the weighted ratio; its test holds it against plain definitions."""
    k = F.col("p_partkey")
    label = F.when(k % 3 == 0, F.concat("p_type", F.lit(" "), "p_name")).when(k % 3 == 1, F.concat("p_name", F.lit("s"))).otherwise(F.concat(F.lit("the "), F.upper("p_name"), F.lit(" of this paper")))
    names = t.part.select(F.lower("p_brand").alias("canonical"), F.col("p_name").alias("variant"), F.col("p_partkey").alias("pos"))
    return A.proposals(t.part.select(label.alias("label")), names, t.rows("label string, canonical string"))


@query("SELECT l_orderkey AS label, arg_min(l_linenumber, (-l_quantity, l_linenumber)) AS unit_pos, max(l_quantity) AS effective FROM lineitem GROUP BY 1")
def compound_labels(t):
    """The best match over the parts of a label; the first part wins ties."""
    return A.best_unit(t.lineitem.select(F.col("l_orderkey").alias("label"), F.col("l_linenumber").alias("unit_pos"), F.col("l_quantity").alias("effective")))


@query(
    """
SELECT p_partkey, CASE WHEN p_partkey % 7 = 6 THEN 'unknown_canonical' WHEN p_partkey % 5 = 0 THEN 'blocked_exact' WHEN p_partkey % 5 = 1 THEN 'blocked_pattern' WHEN p_partkey % 5 = 2 AND p_partkey % 7 = 0 THEN 'previously_rejected' WHEN p_partkey % 5 = 3 AND p_partkey % 7 <> 1 THEN 'alias_conflict' ELSE 'pass' END AS gate FROM part
"""
)
def alias_gates(t):
    """Why proposed aliases may not be merged."""
    k = F.col("p_partkey")
    label = F.element_at(F.array(*[F.lit(x) for x in ("N/A", "page 12", "Old Name", "Total", "Fresh")]), (k % 5 + 1).cast("int"))
    entries = t.part.select("p_partkey", label.alias("label"), F.concat(F.lit("c"), (k % 7).cast("string")).alias("canonical"))
    known = t.rows("canonical string", *[(f"c{i}",) for i in range(6)])
    out = A.merge_gate(entries, known, t.rows("label string, canonical string", ("old name ", "c0")), t.rows("canonical string, variant string", ("c1", "TOTAL")), ["n/a"], [r"page \d+"])
    return out.select("p_partkey", "gate")


@query(
    """
WITH a AS (SELECT p_brand AS c, lower(p_type) AS v FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_brand AS c, lower(p_type) AS v FROM part WHERE p_partkey % 3 <> 1)
SELECT 'added' AS change, c AS canonical, v AS variant FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'removed', c, v FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
"""
)
def alias_versions(t):
    """What one version of the aliases added and removed."""
    rows = lambda cond: t.part.where(cond).select(F.col("p_brand").alias("canonical"), F.upper("p_type").alias("variant"))
    return A.changed(rows("p_partkey % 3 <> 0"), rows("p_partkey % 3 <> 1"))


@query("SELECT key, CASE WHEN b THEN v END AS before, CASE WHEN a THEN w END AS after FROM (SELECT n_name AS key, n_nationkey AS v, n_nationkey + n_nationkey % 2 AS w, n_nationkey % 5 <> 0 AS b, n_nationkey % 7 <> 0 AS a FROM nation) WHERE (CASE WHEN b THEN v END) IS DISTINCT FROM (CASE WHEN a THEN w END)")
def threshold_diff(t):
    a = t.nation.where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("value"))
    b = t.nation.where("n_nationkey % 7 <> 0").select(F.col("n_name").alias("key"), (F.col("n_nationkey") + F.col("n_nationkey") % 2).alias("value"))
    return A.threshold_changes(a, b)


@query("WITH s AS (SELECT event_id, lower(trim(event_type)) AS label, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'v' || event_id END AS value, event_id AS seen_at, CASE WHEN event_id % 2 = 0 THEN 'pending' ELSE 'approved' END AS status FROM events) SELECT label, count(*) AS seen_count, min(seen_at) AS first_seen, max(seen_at) AS last_seen, arg_min(value, seen_at) FILTER (WHERE value <> '') AS value, arg_max(status, seen_at) AS status FROM s GROUP BY label")
def suggestion_log(t):
    """Unknown labels with counts, first and last time."""
    e = F.col("event_id")
    seen = t.events.select(F.concat(F.upper("event_type"), F.lit(" ")).alias("label"), F.when(e % 3 == 0, "").otherwise(F.concat(F.lit("v"), e.cast("string"))).alias("value"), e.alias("at"), F.when(e % 2 == 0, "pending").otherwise("approved").alias("status"))
    return A.suggestion_log(seen)


@query(f"WITH m AS (SELECT lower(trim(variant)) AS v, arg_max(canonical, pos) AS c FROM {_NAMES} GROUP BY 1) SELECT count(*) AS n, count(*) FILTER (WHERE c = gold) AS correct, round(count(*) FILTER (WHERE c = gold) / count(*), 4) AS precision FROM (SELECT lower(n_name) AS label, CASE WHEN n_nationkey % 4 = 0 THEN 'other' ELSE n_name END AS gold FROM nation) LEFT JOIN m ON label = v")
def alias_precision(t):
    gold = t.nation.select(F.upper("n_name").alias("label"), F.when(F.col("n_nationkey") % 4 == 0, "other").otherwise(F.col("n_name")).alias("canonical"))
    return A.precision(gold, _names(t))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE s = 0) AS approved, count(*) FILTER (WHERE s = 1) AS rejected, count(*) FILTER (WHERE s = 2) AS pending, round(count(*) FILTER (WHERE s = 0) * 100 / count(*), 1) AS coverage FROM (SELECT p_partkey % 3 AS s FROM part)")
def alias_coverage(t):
    names = F.array(F.lit("approved"), F.lit("rejected"), F.lit("pending"))
    return A.coverage(t.part.select(F.element_at(names, (F.col("p_partkey") % 3 + 1).cast("int")).alias("status")))


def _facts(t):
    n = F.col("l_linenumber")
    return t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("field"), F.when(n % 4 != 0, F.col("l_linestatus")).alias("value"), F.round(F.col("l_discount") * 10, 2).alias("confidence"), F.array(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("sources"), F.lit("regex").alias("method"), (n.cast("long") * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("pos"))


@query(
    """
WITH f AS (SELECT l_orderkey, l_returnflag AS field, CASE WHEN l_linenumber % 4 <> 0 THEN l_linestatus END AS value, round(l_discount * 10, 2) AS confidence, 's' || l_suppkey AS source, l_linenumber::BIGINT * 1000000000 + l_partkey * 10000 + l_suppkey AS pos FROM lineitem),
g AS (SELECT l_orderkey, field, count(*) AS n, count(value) AS p, count(DISTINCT value) AS d, arg_min(value, pos) AS v0, arg_min(confidence, pos) AS c0, arg_min(source, pos) AS s0,
 arg_max(value, (confidence, -pos)) FILTER (WHERE value IS NOT NULL) AS vb, arg_max(source, (confidence, -pos)) FILTER (WHERE value IS NOT NULL) AS sb, max(confidence) FILTER (WHERE value IS NOT NULL) AS top, string_agg(source, ',' ORDER BY pos) FILTER (WHERE value IS NOT NULL) AS al FROM f GROUP BY 1, 2)
SELECT l_orderkey, field, CASE WHEN n = 1 OR p = 0 THEN v0 ELSE vb END AS value, CASE WHEN n = 1 OR p = 0 THEN c0 WHEN d = 1 THEN least(1.0::DOUBLE, top) ELSE top * 0.8::DOUBLE END AS confidence,
 CASE WHEN n = 1 OR p = 0 THEN s0 WHEN d = 1 THEN al ELSE sb END AS sources, CASE WHEN n = 1 THEN 'single' WHEN p = 0 THEN 'empty' WHEN d = 1 THEN 'agree' ELSE 'conflict' END AS outcome FROM g
"""
)
def fact_merge(t):
    """One fact for each order and field of several."""
    return X.merged(_facts(t), "l_orderkey").select("l_orderkey", "field", "value", "confidence", F.array_join("sources", ",").alias("sources"), "outcome")


@query(
    """
WITH f AS (SELECT doc_id, 'lang' AS field, lang AS fact FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT doc_id, 'source', CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END FROM documents),
g AS (SELECT doc_id, 'lang' AS field, nullif(CASE WHEN quality = 1 THEN ' en ' ELSE '' END, '') AS gold FROM labels UNION ALL SELECT doc_id, 'toxic', toxic::VARCHAR FROM labels)
SELECT field, status, count(*) AS n FROM (SELECT coalesce(f.field, g.field) AS field, CASE WHEN fact IS NULL AND gold IS NULL THEN 'none' WHEN fact IS NULL THEN 'absent' WHEN gold IS NULL THEN 'extra' WHEN trim(fact) = trim(gold) THEN 'match' ELSE 'differ' END AS status FROM f FULL JOIN g ON f.doc_id = g.doc_id AND f.field = g.field) GROUP BY 1, 2
"""
)
def fact_vs_gold(t):
    """Facts against gold values, by status."""
    d = t.documents
    facts = d.where("doc_id % 3 <> 0").select("doc_id", F.lit("lang").alias("field"), F.col("lang").alias("value")).unionAll(d.select("doc_id", F.lit("source"), F.when(F.col("doc_id") % 5 != 0, F.col("source"))))
    gold = t.labels.select("doc_id", F.lit("lang").alias("field"), F.when(F.col("quality") == 1, " en ").otherwise(" ").alias("value")).unionAll(t.labels.select("doc_id", F.lit("toxic"), F.col("toxic").cast("string")))
    return X.compared(facts, gold, "doc_id").groupBy("field", "status").agg(F.count("*").alias("n"))


@query(
    """
WITH v AS (SELECT p_partkey AS doc_id, x.field, x.value, x.b FROM part, LATERAL (VALUES ('brand', p_brand, false), ('new', CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'maybe' END, p_size % 2 = 0), ('odd', 'z', false)) x(field, value, b) WHERE NOT (x.field = 'brand' AND p_size % 5 = 0)),
r AS (SELECT * FROM (VALUES ('brand', 'categorical'), ('new', 'boolean'), ('name', 'text')) r(field, kind)),
k AS (SELECT DISTINCT doc_id FROM v), w AS (SELECT * FROM k, r),
j AS (SELECT coalesce(v.doc_id, w.doc_id) AS doc_id, coalesce(v.field, w.field) AS field, CASE WHEN w.field IS NULL THEN 'not_in_registry' WHEN v.field IS NULL THEN 'missing' WHEN kind = 'categorical' AND value IS NOT NULL AND value NOT IN ('Brand#11', 'Brand#12', 'Brand#13') THEN 'outside_vocabulary' WHEN kind = 'boolean' AND value IS NOT NULL AND NOT b THEN 'not_boolean' END AS issue FROM v FULL JOIN w ON v.doc_id = w.doc_id AND v.field = w.field)
SELECT doc_id, field, issue, issue <> 'outside_vocabulary' AS hard FROM j WHERE issue IS NOT NULL
"""
)
def registry_issues(t):
    """Documents against the registry of their fields."""
    even = F.col("p_size") % 2 == 0
    values = F.array(F.struct(F.lit("brand").alias("field"), F.col("p_brand").alias("value"), F.lit(False).alias("is_bool")), F.struct(F.lit("new").alias("field"), F.when(even, "true").otherwise("maybe").alias("value"), even.alias("is_bool")), F.struct(F.lit("odd").alias("field"), F.lit("z").alias("value"), F.lit(False).alias("is_bool")))
    docs = t.part.select(F.col("p_partkey").alias("doc_id"), "p_size", F.explode(values).alias("x")).where("NOT (x.field = 'brand' AND p_size % 5 = 0)").select("doc_id", "x.*")
    registry = t.rows("field string, field_type string, allowed array<string>", ("brand", "categorical", ["Brand#11", "Brand#12", "Brand#13"]), ("new", "boolean", None), ("name", "text", None))
    return X.issues(docs, registry)


@query("SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN l_linenumber = 1 THEN 'no_source' END, CASE WHEN l_linenumber % 2 = 0 THEN 'model_value' END, CASE WHEN l_quantity > 25 THEN 'confidence' END], lambda x: x IS NOT NULL), ',') AS broken FROM lineitem")
def fact_violations(t):
    """Rules that facts break."""
    n = F.col("l_linenumber")
    sources = F.when(n == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("s")))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array_join(X.violations(F.lit("date"), F.col("l_linestatus"), F.col("l_quantity") / 25, sources, F.when(n % 2 == 0, "llm_extraction").otherwise("regex")), ",").alias("broken"))


def _classes(t):
    kind = F.element_at(F.array(*[F.lit(x) for x in U.RANK]), (F.col("p_size") % 3 + 1).cast("int"))
    client = F.element_at(F.array(*[F.lit(x) for x in ("", *U.CLIENT_TYPES)]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return t.part.select(F.col("p_brand").alias("field"), F.col("p_name").alias("slug"), client.alias("client_type"), kind.alias("class"), F.col("p_partkey").alias("pos"))


@query(
    """
WITH c AS (SELECT p_brand AS field, ['', 'NPO', 'Government', 'Tribal', 'For-Profit'][p_partkey % 5 + 1] AS client_type, p_size % 3 AS r, p_partkey AS pos, p_name AS slug FROM part),
a AS (SELECT field, client_type, max(r) AS r, arg_max(slug, (r, -pos)) AS slug FROM c GROUP BY 1, 2),
q AS (SELECT DISTINCT field, ct AS client_type FROM c, (VALUES ('NPO'), ('Tribal'), ('Elsewhere')) x(ct))
SELECT q.field, q.client_type, ['deficiency_eligible', 'fixed_administrative', 'informational_only'][coalesce(o.r, b.r) + 1] AS class FROM q LEFT JOIN a o ON o.field = q.field AND o.client_type = q.client_type AND o.client_type <> '' LEFT JOIN a b ON b.field = q.field AND b.client_type = ''
"""
)
def authority_resolution(t):
    """The class of a field for a client type, or its base class."""
    asked = _classes(t).select("field").distinct().join(F.broadcast(t.rows("client_type string", ("NPO",), ("Tribal",), ("Elsewhere",))))
    return U.for_client(asked, U.authority(_classes(t))).select("field", "client_type", "class")


_CITED = (
    ("a", 1, "AU-C 220"), ("a", 2, "au-c 220.08"), ("a", 3, "ET 1.200.001"), ("a", 4, "ET 1.200"), ("a", 5, "2 CFR 200.514"), ("a", 6, "2 CFR 200.514(a)"), ("a", 7, "Firm policy"),
    ("b", 1, "Government Auditing Standards Chapter 3"), ("b", 2, "Government Auditing Standards § 3-26"), ("b", 3, "AU-C 315"), ("b", 4, "AU-C 210.1"), ("b", 5, "AU-C 210.01"), ("b", 6, "firm POLICY"), ("b", 7, "Firm policy"),
)


@query("SELECT * FROM (VALUES ('a', 1, 'AU-C 220.08'), ('a', 2, 'ET 1.200.001'), ('a', 3, '2 CFR 200.514(a)'), ('a', 4, 'Firm policy'), ('b', 1, 'AU-C 210.01'), ('b', 2, 'AU-C 315'), ('b', 3, 'GAS §3.26'), ('b', 4, 'firm POLICY')) r(k, pos, display)")
def citation_order(t):
    """Citations with the deepest of each group, once each, in the order of their layers."""
    return U.resolved_citations(t.rows("k string, pos int, citation string", *_CITED), "k")


@query(
    """
SELECT field, ct AS client_type, g AS is_gagas, s AS has_single_audit, CASE WHEN field = 'x' THEN ct <> 'Tribal' ELSE false END AS allowed, field = 'x' AND ct = 'Tribal' AS locked, field = 'y' AS informational,
 CASE WHEN field = 'x' THEN concat_ws('; ', 'AU-C 210.10', CASE WHEN g THEN 'GAS §3.06' END, CASE WHEN s THEN '2 CFR 200.501' END) ELSE '' END AS citations
FROM (VALUES ('x'), ('y')) f(field), (VALUES ('NPO'), ('Government'), ('Tribal'), ('For-Profit')) c(ct), (VALUES (false), (true)) gg(g), (VALUES (false), (true)) ss(s)
"""
)
def procedure_table(t):
    """Every field for every client type and context, with its citations."""
    classes = t.rows("field string, slug string, client_type string, class string, pos int", ("x", "q1", "", "deficiency_eligible", 1), ("x", "q2", "Tribal", "fixed_administrative", 2), ("y", "q3", "", "informational_only", 3))
    fields = t.rows("field string, severity string, consequence string", ("x", "High", "c"), ("y", "Low", "d"))
    standards = t.rows("field string, family string, citation string, pos int", ("x", "base", "AU-C 210", 1), ("x", "base", "AU-C 210.10", 2), ("x", "gagas", "Government Auditing Standards §3.06", 1), ("x", "single_audit", "2 CFR 200.501", 1))
    out = U.compiled(fields, U.authority(classes), standards)
    return out.select("field", "client_type", "is_gagas", "has_single_audit", "allowed", "locked", "informational", F.array_join("citations", "; ").alias("citations"))


@query("SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN 'no_entry' WHEN p_size % 5 = 0 THEN 'zero_weight' WHEN p_size % 4 = 0 THEN CASE WHEN p_size % 8 = 0 THEN 'fixed_admin' ELSE 'client_override' END WHEN p_size % 3 = 0 THEN 'informational' WHEN p_size % 2 = 0 THEN 'no_entry' END AS reason FROM part")
def deficiency_exclusions(t):
    """Why fields can't be made deficient."""
    s = F.col("p_size")
    return t.part.select("p_partkey", U.exclusion(F.when(s % 5 == 0, 0.0).otherwise(0.7), s % 6 != 0, s % 4 == 0, s % 8 == 0, s % 3 == 0, s % 2 != 0).alias("reason"))


@query(
    """
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
s AS (SELECT *, pos % 3 = 1 AS h, sum((pos % 3 = 1)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM l WHERE trim(x) <> '')
SELECT doc_id, section::BIGINT AS section, md5(coalesce(max(x) FILTER (WHERE h), '')) AS heading, md5(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE NOT h), '')) AS content FROM s GROUP BY doc_id, section
"""
)
def heading_sections(t):
    """Lines gathered under the heading before them."""
    blocks = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).withColumn("is_heading", F.col("pos") % 3 == 1)
    return mining.sections(blocks).select("doc_id", "section", F.md5(F.coalesce("heading", F.lit(""))).alias("heading"), F.md5("content").alias("content"))


@query(
    """
SELECT l_orderkey AS doc_id, 'client_name' AS canonical, 'Acme ' || l_orderkey AS value, CASE WHEN l_orderkey % 2 = 0 THEN 'above' ELSE 'left' END AS method FROM (SELECT DISTINCT l_orderkey FROM lineitem)
UNION ALL SELECT l_orderkey, 'total_assets', (l_orderkey * 7)::VARCHAR, 'column' FROM (SELECT DISTINCT l_orderkey FROM lineitem)
"""
)
def cell_fields(t):
    """Values above, below a header of, and left of known labels."""
    k = F.col("o").cast("string")
    lit = F.lit
    above = F.array(F.array(F.concat(lit("Acme "), k), lit("")), F.array(lit("Organization"), lit("")))
    left = F.array(F.array(lit("Note"), F.concat(lit("Acme "), k), lit("organization")), F.array(lit("Note:"), lit(""), lit("")))
    names = t.rows("canonical string, variant string, pos int", ("client_name", "organization", 1), ("total_assets", "total assets", 2))
    base = t.lineitem.select(F.col("l_orderkey").alias("o")).distinct()
    first = base.select(F.col("o").alias("doc_id"), lit(0).alias("table"), F.array(lit("Form"), lit("Year")).alias("headers"), F.when(F.col("o") % 2 == 0, above).otherwise(left).alias("rows"))
    second = base.select(F.col("o").alias("doc_id"), lit(1).alias("table"), F.array(lit("Item"), lit("Total Assets")).alias("headers"), F.array(F.array(lit("x"), (F.col("o") * 7).cast("string"))).alias("rows"))
    return mining.cell_fields(first.unionByName(second), names)


def _ticked(t):
    """Orders as tables of questions, a line a row, ticked by what became of it."""
    yes = F.when(F.col("l_returnflag") == "A", "☒").when(F.col("l_returnflag") == "R", " X ").otherwise("")
    no = F.when(F.col("l_linestatus") == "F", "true").otherwise(" ")
    row = F.array(F.concat(F.lit("Is it "), "l_returnflag", F.lit("? (line "), F.col("l_linenumber").cast("string"), F.lit(")")), yes, no)
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("r")))).alias("x"))
    return rows.select("doc_id", F.lit(0).alias("table"), F.array(F.lit("Question"), F.lit("Yes"), F.lit("No")).alias("headers"), F.transform("x", lambda s: s["r"]).alias("rows"))


@query("SELECT l_orderkey AS doc_id, count(*) + 1 AS eligible, count(*) FILTER (WHERE l_returnflag IN ('A', 'R') OR l_linestatus = 'F') AS checked, count(*) + 1 >= 5 AND count(*) FILTER (WHERE l_returnflag IN ('A', 'R') OR l_linestatus = 'F') = 0 AS incomplete FROM lineitem GROUP BY 1")
def checkbox_forms(t):
    """Yes and No columns: how many questions, how many answered."""
    return mining.checkbox_completion(_ticked(t))


@query("WITH x AS (SELECT l_orderkey AS doc_id, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'new' END AS canonical, CASE WHEN l_returnflag IN ('A', 'R') THEN 'Yes' WHEN l_linestatus = 'F' THEN 'No' END AS answer, l_linenumber, l_partkey, l_suppkey FROM lineitem) SELECT doc_id, canonical, arg_min(answer, (l_linenumber, l_partkey, l_suppkey)) AS answer FROM x WHERE canonical IS NOT NULL AND answer IS NOT NULL GROUP BY 1, 2")
def checkbox_answers(t):
    """Answers of known questions by the ticked column."""
    return mining.checkbox_answers(_ticked(t), t.rows("canonical string, variant string, pos int", ("accepted", "is it a", 1), ("new", "is it n", 2)))
