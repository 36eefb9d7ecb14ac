"""Queries over training pairs: assembly, gates, redaction, findings, queues, forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import keys
from gleanery.operators import forms, mining, pairs, review
from gleanery.plans.registry import query

_ESC = lambda c: f"replace(replace(replace(replace(replace({c}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"


@query(f"SELECT conv_id, count(*) AS messages, sha256('[' || string_agg('{{\"content\": \"' || {_ESC("coalesce(text, '')")} || '\", \"role\": \"' || role || '\"}}', ', ' ORDER BY turn) || ']') AS pair_hash FROM conversations GROUP BY conv_id")
def pair_assembly(t):
    """Conversations as pairs with the hash of their canonical JSON."""
    return pairs.assembled(t.conversations).select("conv_id", F.size("messages").cast("long").alias("messages"), "pair_hash")


@query(
    """
WITH c AS (SELECT DISTINCT conv_id FROM conversations),
p AS (SELECT conv_id, 'npo' || conv_id % 3 AS client, CASE WHEN conv_id % 4 = 0 THEN 'unknown' ELSE 'deficient' END AS kind, CASE WHEN conv_id % 2 = 0 THEN 'client_name,ein' ELSE '' END AS missing, CASE WHEN conv_id % 5 = 0 THEN 'opinion' ELSE 'date,opinion' END AS present FROM c)
SELECT conv_id, substr(sha256('client_type:' || client || '|pair_type:' || kind || '|missing:' || missing || '|present:' || present), 1, 16) AS fingerprint FROM p
"""
)
def structural_fingerprint(t):
    """The structure of pairs in 16 digits."""
    k = F.col("conv_id")
    names = lambda *xs: F.array(*[F.lit(x) for x in xs])
    missing = F.when(k % 2 == 0, names(" EIN", "Client_Name"))
    present = F.when(k % 5 == 0, names("Opinion")).otherwise(names("opinion ", "date"))
    fp = keys.fingerprint(F.concat(F.lit(" NPO"), (k % 3).cast("string")), F.when(k % 4 != 0, "Deficient "), missing, present)
    return t.conversations.select("conv_id").distinct().select("conv_id", fp.alias("fingerprint"))


def _exports(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    k = F.col("doc_id")
    stage = F.element_at(F.array(*[F.lit(x) for x in ("stage2_domain", "stage3_firm", "stage9")]), (k % 3 + 1).cast("int"))
    return d.select("doc_id", F.sha2("text", 256).alias("pair_hash"), (k % 10 / 10).alias("extraction_confidence"), (k % 7 / F.lit(7.0)).alias("review_confidence"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("approved"), stage.alias("stage"), F.concat(F.lit("f"), (k % 50).cast("string")).alias("fingerprint"))


@query(
    """
WITH d AS (SELECT doc_id, sha256(text) AS h, doc_id % 10 / 10 AS e, doc_id % 7 / 7.0::DOUBLE AS r, coalesce(quality = 1, false) AS ok, doc_id % 3 AS s, 'f' || doc_id % 50 AS fp FROM documents LEFT JOIN labels USING (doc_id)),
w AS (SELECT DISTINCT h FROM d WHERE doc_id % 20 = 3), i AS (SELECT DISTINCT fp FROM d WHERE doc_id % 20 = 7)
SELECT doc_id, i.fp IS NOT NULL AS structural_duplicate, CASE WHEN e < 0.5 THEN 'extraction_gate' WHEN r < 0.7 THEN 'review_confidence' WHEN NOT ok THEN 'auditor_approved' WHEN w.h IS NOT NULL THEN 'no_duplicate' WHEN s = 2 THEN 'stage_isolation' ELSE 'ok' END AS gate FROM d LEFT JOIN w ON d.h = w.h LEFT JOIN i ON d.fp = i.fp
"""
)
def gate_first_failure(t):
    """The first gate that stops a pair, with duplicates of structure flagged."""
    rows = _exports(t)
    written = rows.where("doc_id % 20 = 3").select("pair_hash")
    index = rows.where("doc_id % 20 = 7").select("fingerprint", "pair_hash", F.col("doc_id").alias("pos"))
    return pairs.export_gate(rows, written, index).select("doc_id", "structural_duplicate", "gate")


_SAID = ("see SOP §Q12", "per the Yellow Book", "under 2 CFR 200.514", "as in ET 1.300 x", "Government Auditing Standards, chapter 3 § 2", "per GAS § 3.1", "fine")


@query(
    "WITH d AS (SELECT doc_id, text || ' ' || [" + ", ".join(f"'{x}'" for x in _SAID) + f"""][length(text) % {len(_SAID)} + 1] AS c, text, lang, source, n_chars FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL)
SELECT doc_id, CASE WHEN {" OR ".join(f"regexp_matches(c, '{p}')" for p in pairs.STALE)} THEN 'citation_valid' WHEN source = 'src3' THEN 'sop_authority' WHEN lang = 'en' AND (contains(lower(text), 'the th') OR contains(lower(text), 'on. an')) THEN 'evidence_consistent'
 WHEN (n_chars % 2 = 0 AND regexp_matches(c, '{pairs.GOVERNMENT}')) OR (n_chars % 3 <> 0 AND regexp_matches(c, '{pairs.FEDERAL}')) THEN 'context_consistent' ELSE 'ok' END AS gate FROM d
"""
)
def final_gate(t):
    """The first reason against a finished pair."""
    said = F.element_at(F.array(*[F.lit(x) for x in _SAID]), (F.length("text") % len(_SAID) + 1).cast("int"))
    bad = F.when(F.col("source") == "src3", F.array(F.lit("ein"))).otherwise(F.array().cast("array<string>"))
    kind = F.when(F.col("lang") == "en", "deficient").otherwise("clean")
    gate = pairs.final_gate(F.concat("text", F.lit(" "), said), F.col("text"), kind, bad, F.array(F.lit("the th"), F.lit("on. an")), F.col("n_chars") % 2 != 0, F.col("n_chars") % 3 == 0)
    return t.documents.where("text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL").select("doc_id", gate.alias("gate"))


@query(
    """
WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
m AS (SELECT *, contains(lower(x), 'of the') OR contains(lower(x), 'de la') AS hit FROM l), k AS (SELECT *, lag(hit) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM m)
SELECT doc_id, count(*) FILTER (WHERE hit)::INTEGER AS removed, md5(string_agg(CASE WHEN hit THEN '[NOT DOCUMENTED: client_name]' ELSE x END, chr(10) ORDER BY i) FILTER (WHERE NOT (hit AND coalesce(before, false)))) AS text FROM k GROUP BY doc_id
"""
)
def line_redaction(t):
    """Lines that hold an alias replaced, runs of them by one mark."""
    out = pairs.redacted(t.documents, "client_name", ["of the", "De La", "name"])
    return out.select("doc_id", "removed", F.md5("text").alias("text"))


@query("SELECT l_orderkey, string_agg(status, ',' ORDER BY l_linenumber, s, status) AS statuses FROM (SELECT l_orderkey, l_linenumber, l_suppkey AS s, CASE WHEN l_linenumber = 1 THEN 'UNANCHORED' WHEN l_partkey % 3 = 0 AND l_suppkey % 2 = 0 THEN 'UNANCHORED' WHEN l_partkey % 3 = 0 THEN 'MISANCHORED' WHEN l_partkey % 3 = 1 AND l_linenumber % 2 = 0 THEN 'HALLUCINATED' WHEN l_partkey % 3 = 1 THEN 'VALID' ELSE 'UNANCHORED' END AS status FROM lineitem) GROUP BY l_orderkey")
def claim_status(t):
    """What each numbered claim of a completion rests on."""
    li = t.lineitem.select(F.col("l_orderkey").alias("pair_id"), F.struct("l_linenumber", "l_suppkey", "l_partkey").alias("idx"), "l_linenumber", "l_partkey", "l_suppkey").dropDuplicates(["pair_id", "idx"])
    found = li.select("pair_id", "idx", F.lit("t").alias("text"), F.when(F.col("l_linenumber") % 2 == 0, F.lit(False)).alias("citation_grounded"))
    state = F.element_at(F.array(*[F.lit(x) for x in ("present", "missing", "other")]), (F.col("l_partkey") % 3 + 1).cast("int"))
    anchor = li.where("l_linenumber <> 1").select("pair_id", "idx", F.lit("f").alias("field"), state.alias("state"), (F.col("l_suppkey") % 2 == 0).alias("fixed"))
    out = pairs.claims(found, anchor).groupBy(F.col("pair_id").alias("l_orderkey")).agg(F.array_sort(F.collect_list(F.struct("idx.l_linenumber", "idx.l_suppkey", "status"))).alias("x"))
    return out.select("l_orderkey", F.array_join(F.transform("x", lambda x: x["status"]), ",").alias("statuses"))


@query(
    """
WITH c AS (SELECT DISTINCT l_orderkey AS pair_id, 'f' || l_partkey % 5 AS field, CASE WHEN l_partkey % 2 = 0 THEN 'VALID' ELSE 'MISANCHORED' END AS status FROM lineitem),
m AS (SELECT DISTINCT l_orderkey AS pair_id, 'f' || l_suppkey % 5 AS field, l_suppkey % 5 < 2 AS tier1 FROM lineitem WHERE l_orderkey % 3 <> 0),
g AS (SELECT pair_id, count(*) AS claims, count(*) FILTER (WHERE status = 'VALID') AS valid, 0::BIGINT AS hallucinated, count(*) FILTER (WHERE status = 'MISANCHORED') AS misanchored, 0::BIGINT AS unanchored FROM c GROUP BY 1),
n AS (SELECT m.pair_id, count(*) AS n, count(v.field) AS c, count(*) FILTER (WHERE tier1) AS t, count(*) FILTER (WHERE tier1 AND v.field IS NULL) AS u FROM m LEFT JOIN (SELECT DISTINCT pair_id, field FROM c WHERE status = 'VALID') v ON v.pair_id = m.pair_id AND v.field = m.field GROUP BY 1)
SELECT g.*, CASE WHEN coalesce(n, 0) = 0 THEN 1.0 ELSE round(c / n, 4) END::DOUBLE AS grounding, CASE WHEN coalesce(t, 0) = 0 THEN 0.0 ELSE round(u / t, 4) END::DOUBLE AS coverage_gap FROM g LEFT JOIN n USING (pair_id)
"""
)
def grounding_signals(t):
    """How far the claims of a completion cover what is missing."""
    li = t.lineitem
    claims = li.select(F.col("l_orderkey").alias("pair_id"), F.concat(F.lit("f"), (F.col("l_partkey") % 5).cast("string")).alias("field"), F.when(F.col("l_partkey") % 2 == 0, "VALID").otherwise("MISANCHORED").alias("status")).distinct()
    missing = li.where("l_orderkey % 3 <> 0").select(F.col("l_orderkey").alias("pair_id"), F.concat(F.lit("f"), (F.col("l_suppkey") % 5).cast("string")).alias("field"), (F.col("l_suppkey") % 5 < 2).alias("tier1")).distinct()
    return pairs.grounding(claims, missing)


@query(
    """
WITH s AS (SELECT l_orderkey AS doc_id, l_partkey % 4 AS f, max(l_quantity) / 50 AS score, bool_or(l_linenumber = 3) AS deficient, bool_or(l_linenumber = 5) AS flagged FROM lineitem GROUP BY 1, 2),
r AS (SELECT * FROM (VALUES (0, 1, 'High'), (1, 1, 'Low'), (2, 2, 'High')) r(f, tier, severity)),
a AS (SELECT DISTINCT doc_id FROM s),
x AS (SELECT a.doc_id, r.f, tier, severity, coalesce(score, 0) AS score, coalesce(deficient, false) AS d FROM a CROSS JOIN r LEFT JOIN s ON s.doc_id = a.doc_id AND s.f = r.f),
y AS (SELECT *, CASE WHEN d OR score = 0 THEN 'missing' WHEN score < 0.5 THEN 'low_confidence' END AS status FROM x)
SELECT doc_id, 'f' || f AS field, tier, status, CASE WHEN tier = 2 AND status = 'low_confidence' THEN 'Low' WHEN tier = 2 AND severity = 'High' THEN 'Medium' ELSE severity END AS severity FROM y WHERE status IS NOT NULL
UNION ALL SELECT s.doc_id, 'f' || s.f, CASE s.f WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END, 'llm_only', 'Informational' FROM s WHERE flagged AND score > 0 AND NOT deficient AND NOT EXISTS (SELECT 1 FROM y WHERE y.doc_id = s.doc_id AND y.f = s.f AND status IS NOT NULL)
"""
)
def record_findings(t):
    """What records lack, by tier."""
    s = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("f"), (F.col("l_partkey") % 4).cast("string")).alias("field")).agg((F.max("l_quantity") / 50).alias("score"), F.bool_or(F.col("l_linenumber") == 3).alias("deficient"), F.bool_or(F.col("l_linenumber") == 5).alias("flagged"))
    return pairs.findings(s, t.rows("field string, tier int", ("f0", 1), ("f1", 1), ("f2", 2), ("f3", 3)), t.rows("field string, severity string", ("f0", "High"), ("f1", "Low"), ("f2", "High"), ("f3", "High")))


@query("SELECT DISTINCT ON (h) h AS pair_hash FROM (SELECT sha256(text) AS h FROM documents WHERE doc_id % 2 = 0) WHERE h NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 1)")
def append_new_pairs(t):
    """Pairs that aren't in the written ones, each once."""
    h = t.documents.select("doc_id", F.sha2("text", 256).alias("pair_hash"))
    return pairs.appended(h.where("doc_id % 2 = 0").select("pair_hash"), h.where("doc_id % 2 = 1").select("pair_hash"))


@query(
    """
SELECT c_custkey, ct AS client_type, CASE WHEN ct IN ('Government', 'Tribal') THEN true WHEN ct = 'For-Profit' THEN false ELSE c_custkey % 3 = 1 END AS is_gagas, CASE WHEN ct = 'Tribal' THEN true WHEN ct = 'For-Profit' THEN false ELSE c_custkey % 3 = 2 END AS has_single_audit
FROM customer, (VALUES ('NPO'), ('Government'), ('Tribal'), ('For-Profit')) c(ct)
"""
)
def variant_flags(t):
    """Every record for every client type, with the flags of its engagement."""
    text = F.element_at(F.array(*[F.lit(x) for x in ("plain", "Per the YELLOW BOOK", "a Single Audit")]), (F.col("c_custkey") % 3 + 1).cast("int"))
    return pairs.variants(t.customer.select("c_custkey", text.alias("text")), ("NPO", "Government", "Tribal", "For-Profit")).select("c_custkey", "client_type", "is_gagas", "has_single_audit")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'absent' WHEN o_orderkey % 3 = 0 THEN 'present' WHEN o_orderkey % 3 = 1 AND o_orderkey % 10 >= 7 THEN 'absent' ELSE 'uncertain' END AS state, CASE WHEN o_orderkey % 2 = 0 THEN 'present' ELSE 'absent' END AS gagas FROM orders")
def reconciled_states(t):
    """A field's state from extraction and a model, and what follows from it."""
    k = F.col("o_orderkey")
    phase1 = F.element_at(F.array(*[F.lit(x) for x in ("present", "absent", "unknown")]), (k % 3 + 1).cast("int"))
    states = F.create_map(F.lit("includes_single_audit"), F.when(k % 2 == 0, "present").otherwise("absent"), F.lit("includes_gagas"), F.lit("absent"))
    return t.orders.select("o_orderkey", pairs.reconciled(phase1, F.lit("uncertain"), k % 10 / 10, k % 9 == 0).alias("state"), pairs.derived_state(states)["includes_gagas"].alias("gagas"))


_EVENTS = """
e AS (SELECT user_id AS pair_hash, event_id AS pos, ts AS seen_at, CASE WHEN event_type = 'view' OR event_id % 5 = 0 THEN 'enqueue' WHEN event_id % 5 = 1 THEN 'approve' WHEN event_id % 5 = 2 THEN 'conditional_approve' WHEN event_id % 5 = 3 THEN 'send_for_correction' ELSE 'reject' END AS action, CASE WHEN event_id % 2 = 0 THEN 'fix' ELSE ' ' END AS hint FROM events),
r AS (SELECT *, sum((action = 'enqueue')::INT) OVER (PARTITION BY pair_hash ORDER BY pos) AS rnd, action <> 'enqueue' AND NOT (action = 'send_for_correction' AND trim(hint) = '') AS ok FROM e),
g AS (SELECT pair_hash, rnd, arg_min(action, pos) FILTER (WHERE ok) AS action, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE action <> 'enqueue' AND NOT ok) AS n_bad FROM r GROUP BY 1, 2),
q AS (SELECT pair_hash, arg_max(CASE action WHEN 'approve' THEN 'approved' WHEN 'conditional_approve' THEN 'conditional' WHEN 'send_for_correction' THEN 'correction' WHEN 'reject' THEN 'rejected' ELSE 'pending' END, rnd) AS status, sum(CASE WHEN rnd = 0 THEN n_ok + n_bad ELSE greatest(n_ok - 1, 0) + n_bad END)::BIGINT AS refused FROM g GROUP BY 1 HAVING max(rnd) > 0)
"""


def _queue(t):
    n = F.col("event_id")
    action = F.when((F.col("event_type") == "view") | (n % 5 == 0), "enqueue").when(n % 5 == 1, "approve").when(n % 5 == 2, "conditional_approve").when(n % 5 == 3, "send_for_correction").otherwise("reject")
    log = t.events.select(F.col("user_id").alias("pair_hash"), n.alias("pos"), F.col("ts").alias("at"), action.alias("action"), F.lit("r").alias("reviewer"), F.lit("").alias("notes"), F.when(n % 2 == 0, "fix").otherwise(" ").alias("hint"))
    return review.states(log)


@query(f"WITH {_EVENTS} SELECT pair_hash, status, refused FROM q")
def queue_states(t):
    """The latest state of every queued pair."""
    return _queue(t).select("pair_hash", "status", "refused")


@query(f"WITH {_EVENTS} SELECT pair_hash % 3 AS stage, count(*) AS total, count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'approved') AS approved, count(*) FILTER (WHERE status = 'conditional') AS conditional, count(*) FILTER (WHERE status = 'correction') AS correction, count(*) FILTER (WHERE status = 'rejected') AS rejected FROM q GROUP BY 1")
def queue_stats(t):
    return review.stats(_queue(t).withColumn("stage", F.col("pair_hash") % 3), "stage")


@query("WITH q AS (SELECT p_brand AS file_hash, p_partkey AS pos, p_partkey % 3 = 0 AS done FROM part), n AS (SELECT file_hash, max(pos) AS pos FROM q WHERE NOT done AND file_hash < 'Brand#3' GROUP BY 1) SELECT q.file_hash, q.pos, done OR n.pos IS NOT NULL AS corrected FROM q LEFT JOIN n ON q.file_hash = n.file_hash AND q.pos = n.pos")
def corrected_records(t):
    """The newest open entry of each reviewed file is closed."""
    q = t.part.select(F.col("p_brand").alias("file_hash"), F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 3 == 0, "True").otherwise(" false").alias("corrected"), F.lit(None).cast("string").alias("reviewer"))
    fixes = q.where("file_hash < 'Brand#3'").select("file_hash").distinct().withColumn("reviewer", F.lit("me"))
    return review.marked_corrected(q, fixes).select("file_hash", "pos", (F.lower("corrected") == "true").alias("corrected"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE p_partkey % 3 = 0) AS corrected, count(*) FILTER (WHERE p_partkey % 3 <> 0) AS pending, round(avg(CASE WHEN p_partkey % 4 <> 0 THEN p_size / 50 END), 4) AS mean_confidence FROM part")
def record_queue_stats(t):
    q = t.part.select(F.when(F.col("p_partkey") % 3 == 0, " TRUE").otherwise("").alias("corrected"), F.when(F.col("p_partkey") % 4 != 0, (F.col("p_size") / 50).cast("string")).otherwise("n/a").alias("confidence"))
    return review.record_stats(q)


def _form(t):
    fields = t.rows(
        "field_id string, source string, fixed string, initial string, recurring string, target string, if_found string, if_not_found string",
        ("q1", "sop_fixed", "No", None, None, None, None, None),
        ("q2", "sop_fixed", None, "Yes", "N/A", None, None, None),
        ("q3", "py_audit_report_lookup", None, "No", None, "sefa", "Yes", "No"),
        ("q4", "auditor_yes_no_with_remark", None, None, None, None, None, None),
        ("q5_a", "auditor_selection", None, None, None, None, None, None),
        ("q6", "sop_fixed_plus_manual", None, None, None, None, None, None),
        ("q7", "sop_fixed_plus_lookup", None, None, None, "compliance", "page 3", "none"),
    )
    k, n, owed = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    answers = F.map_filter(F.create_map(F.lit("q4"), F.when(owed < 0, "Yes").otherwise("No"), F.lit("q5_a"), F.when(n < 4, "Yes").when(n < 8, ""), F.lit("q6"), F.when(owed > 5000, F.col("c_name"))), lambda _, v: v.isNotNull())
    inputs = t.customer.select(k.alias("engagement_id"), F.when(F.col("c_mktsegment") == "BUILDING", forms.INITIAL).otherwise(forms.RECURRING).alias("engagement_type"), answers.alias("answers"))
    sections = t.customer.where("c_nationkey % 4 = 0").select(k.alias("engagement_id"), F.lit("sefa").alias("target")).unionAll(t.customer.where("c_nationkey > 15").select(k, F.lit("compliance")))
    return forms.resolved(fields, inputs, sections)


_FORM = """
r AS (SELECT k, v.f, v.value, v.status FROM (SELECT *, c_custkey AS k, c_mktsegment = 'BUILDING' AS ini FROM customer), LATERAL (VALUES ('q1', 'No', 'resolved'), ('q2', CASE WHEN ini THEN 'Yes' ELSE 'N/A' END, CASE WHEN ini THEN 'resolved' ELSE 'na' END),
 ('q3', CASE WHEN ini THEN 'No' WHEN c_nationkey % 4 = 0 THEN 'Yes' ELSE 'No' END, 'resolved'), ('q4', CASE WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END, 'resolved'),
 ('q5_a', CASE WHEN c_nationkey < 4 THEN 'Yes' END, CASE WHEN c_nationkey < 4 THEN 'resolved' ELSE 'needs_input' END),
 ('q6', CASE WHEN NOT ini THEN 'N/A' WHEN c_acctbal > 5000 THEN 'Yes — ' || c_name ELSE 'Yes (remark required)' END, CASE WHEN NOT ini THEN 'na' WHEN c_acctbal > 5000 THEN 'resolved' ELSE 'needs_input' END),
 ('q7', CASE WHEN c_nationkey > 15 THEN 'Refer: page 3' ELSE 'Refer: none' END, 'resolved')) v(f, value, status))
"""


@query(f"WITH {_FORM} SELECT k AS engagement_id, f AS field_id, value, status FROM r")
def rule_engine(t):
    """Values of a form's fields by the kind of their rule."""
    return _form(t).select("engagement_id", "field_id", "value", "status")


@query("SELECT c_custkey AS engagement_id, CASE WHEN c_acctbal < 0 OR c_nationkey < 4 THEN 'DO NOT ACCEPT / CONTINUE' ELSE 'ACCEPT / CONTINUE' END AS value, CASE WHEN c_acctbal < 0 THEN 'q4' WHEN c_nationkey < 4 THEN 'q5_a' END AS blocker FROM customer")
def rule_decision(t):
    return forms.decision(_form(t))


@query(f"WITH {_FORM} SELECT f AS field_id, count(*) FILTER (WHERE status = 'resolved') AS resolved, count(*) FILTER (WHERE status = 'needs_input') AS needs_input, count(*) FILTER (WHERE status = 'na') AS na FROM r GROUP BY 1")
def rule_summary(t):
    return forms.summary(_form(t), "field_id")
