"""Queries over datasets of pairs: snapshots, drift, balance, coverage, rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.operators import finance, forms, mining, observe, pairs, scoring
from gleanery.plans.registry import query


def _pairs(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    k = F.col("doc_id")
    stage = F.when(k % 4 == 0, None).when(k % 4 == 1, "stage3_firm").otherwise("stage2_domain")
    missing = F.filter(F.array(*[F.when(k % m == 0, F.lit(n)) for m, n in ((2, "Ein"), (3, "opinion"), (101, "Date"))]), lambda x: x.isNotNull())
    return d.select("doc_id", F.col("lang").alias("client_type"), F.when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "deficient").alias("pair_type"), stage.alias("stage"), (k % 100 / 100).alias("extraction_confidence"), missing.alias("fields_missing"))


_PAIRS = """
p AS (SELECT doc_id, coalesce(lang, 'unknown') AS client_type, CASE quality WHEN 1 THEN 'clean' WHEN 0 THEN 'deficient' ELSE 'unknown' END AS pair_type, CASE WHEN doc_id % 4 = 0 THEN 'unknown' WHEN doc_id % 4 = 1 THEN 'stage3_firm' ELSE 'stage2_domain' END AS stage,
 CASE WHEN doc_id % 100 < 55 THEN '<0.55' WHEN doc_id % 100 < 65 THEN '0.55-0.65' WHEN doc_id % 100 < 75 THEN '0.65-0.75' WHEN doc_id % 100 < 85 THEN '0.75-0.85' ELSE '>=0.85' END AS confidence,
 list_filter([CASE WHEN doc_id % 2 = 0 THEN 'ein' END, CASE WHEN doc_id % 3 = 0 THEN 'opinion' END, CASE WHEN doc_id % 101 = 0 THEN 'date' END], lambda x: x IS NOT NULL) AS missing FROM documents LEFT JOIN labels USING (doc_id))
"""


@query(f"WITH {_PAIRS}, u AS (SELECT unnest(['client_type', 'pair_type', 'stage', 'confidence']) AS dimension, unnest([client_type, pair_type, stage, confidence]) AS value FROM p) SELECT dimension, value, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY dimension), 4) AS share FROM u GROUP BY 1, 2")
def dataset_snapshot(t):
    """Counts and shares of pairs by four dimensions."""
    return observe.snapshot(_pairs(t))


@query(f"WITH {_PAIRS} SELECT field, count(*) AS n FROM (SELECT unnest(missing) AS field FROM p) GROUP BY field")
def missing_fields(t):
    return observe.field_frequency(_pairs(t))


@query(f"WITH {_PAIRS} SELECT array_to_string(list_sort(missing), '|') AS combination, count(*) AS n FROM p WHERE len(missing) > 0 GROUP BY 1 HAVING count(*) < 200 ORDER BY n, combination LIMIT 10")
def rare_combinations(t):
    return observe.rare_combinations(_pairs(t), below=200)


@query(f"WITH {_PAIRS} SELECT f AS field FROM (VALUES ('ein'), ('client_name'), ('date')) x(f) WHERE f NOT IN (SELECT unnest(missing) FROM p)")
def never_missing(t):
    return observe.never_missing(_pairs(t), t.rows("field string", ("EIN",), ("client_name",), ("date",)))


@query("SELECT s AS severity, count(*) FILTER (WHERE o % 3 = i) AS n FROM (SELECT o_orderkey AS o FROM orders), (VALUES ('High', 0), ('Medium', 1), ('Low', 1), ('Informational', 9)) x(s, i) GROUP BY s, i")
def severities_used(t):
    text = F.element_at(F.array(*[F.lit(x) for x in ("Severity: high", "Severity:  Medium. severity: LOW", "none")]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return observe.severities_used(t.orders.select(text.alias("text")))


@query(
    """
WITH r AS (SELECT event_type AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200), a AS (SELECT event_type AS value, round(count(*) / sum(count(*)) OVER (), 4) AS overall FROM events GROUP BY 1), b AS (SELECT value, round(count(*) / sum(count(*)) OVER (), 4) AS recent FROM r GROUP BY 1)
SELECT value, coalesce(overall, 0.0) AS overall, coalesce(recent, 0.0) AS recent, round(coalesce(recent, 0.0) - coalesce(overall, 0.0), 4) AS delta FROM a FULL JOIN b USING (value)
"""
)
def drift_last_200(t):
    """Shares over all and over the last 200 entries."""
    return observe.drift(t.events, "event_type", "ts", "event_id", 200)


@query("WITH r AS (SELECT event_type AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200), a AS (SELECT event_type AS value, round(count(*) / sum(count(*)) OVER (), 4) AS o FROM events GROUP BY 1), b AS (SELECT value, round(count(*) / sum(count(*)) OVER (), 4) AS r FROM r GROUP BY 1), m AS (SELECT max(abs(round(coalesce(r, 0) - coalesce(o, 0), 4))) AS d FROM a FULL JOIN b USING (value)) SELECT (SELECT count(*) FROM events) AS total, CASE WHEN (SELECT count(*) FROM events) < 400 THEN 'insufficient_data' WHEN d > 0.2 THEN 'drifting' ELSE 'stable' END AS status FROM m")
def drift_status(t):
    return observe.drift_status(t.events, "event_type", "ts", "event_id", 200)


@query("SELECT value, n, round(n / sum(n) OVER (), 4) AS share, n / sum(n) OVER () > 0.4 AS over FROM (SELECT CASE WHEN conv_id % 6 = 0 THEN '(missing)' ELSE role END AS value, count(*) AS n FROM conversations GROUP BY 1)")
def task_balance(t):
    return observe.balance(t.conversations.withColumn("role", F.when(F.col("conv_id") % 6 != 0, F.col("role"))), "role")


@query(
    """
WITH c AS (SELECT 'f' || l_partkey % 12 AS field, count(*) AS n FROM lineitem WHERE l_partkey % 12 <> 7 AND (l_partkey % 12 <> 3 OR l_linenumber = 1) GROUP BY 1), m AS (SELECT avg(n) AS mean FROM c)
SELECT f.field, coalesce(n, 0)::BIGINT AS n, CASE WHEN coalesce(n, 0) < mean * 0.5 THEN 'under' WHEN coalesce(n, 0) > mean * 2 THEN 'over' ELSE 'even' END AS state FROM (SELECT 'f' || i AS field FROM range(12) r(i)) f LEFT JOIN c USING (field), m
"""
)
def coverage_over_under(t):
    """Fields that were drawn too seldom or too often."""
    drawn = t.lineitem.where("l_partkey % 12 <> 7 AND (l_partkey % 12 <> 3 OR l_linenumber = 1)").select(F.array(F.concat(F.lit("f"), (F.col("l_partkey") % 12).cast("string"))).alias("fields"))
    return observe.sampling_coverage(drawn, t.rows("field string", *[(f"f{i}",) for i in range(12)]))


@query("SELECT count(*) FILTER (WHERE p_size % 3 = 0) AS eligible, count(*) AS total, round(count(*) FILTER (WHERE p_size % 3 = 0) / count(*), 4) AS coverage FROM part")
def pool_coverage(t):
    return observe.pool_coverage(t.part.select((F.col("p_size") % 3 == 0).alias("eligible")))


@query(f"WITH {_PAIRS}, u AS (SELECT unnest(['client_type', 'pair_type']) AS dimension, unnest([client_type, pair_type]) AS value FROM p) SELECT dimension, value, count(*) AS n FROM u GROUP BY 1, 2")
def index_stats(t):
    return observe.index_stats(_pairs(t))


@query("SELECT lang, count(*) AS n, round(count(*) FILTER (WHERE quality = 1) / count(*), 4) AS sign_off, round(avg(doc_id % 11), 4) AS mean_score, round(count(*) FILTER (WHERE toxic = 1) / count(*), 4) AS hallucination FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def sign_off_rates(t):
    rows = t.documents.join(t.labels, "doc_id").select("lang", (F.col("quality") == 1).alias("approved"), (F.col("doc_id") % 11).alias("score"), (F.col("toxic") == 1).alias("hallucinated"))
    return observe.rates(rows, "lang")


@query("WITH e AS (SELECT epoch_ms(ts)::BIGINT // 86400000 AS day, value FROM events) SELECT strftime(make_timestamp((day - k) * 86400000000), '%Y-%m-%d') AS start, count(*) AS n, round(avg(value), 4) AS mean FROM e, range(7) r(k) GROUP BY 1")
def rolling_7d_rate(t):
    """Counts and means over sliding windows of seven days."""
    out = observe.rolling_rates(t.events, "ts")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("start"), "n", F.round("mean", 4).alias("mean"))


@query("SELECT value, round(coalesce(n / sum(n) OVER (), 0) - 0.25, 4) AS delta FROM (SELECT lang AS value, count(*) AS n FROM documents GROUP BY 1)")
def distribution_delta(t):
    counts = t.documents.groupBy(F.col("lang").alias("value")).agg(F.count("*").alias("n"))
    return observe.distribution_delta(counts, t.rows("value string, share double", *[(x, 0.25) for x in ("en", "fr", "de", "es")]))


@query("WITH w AS (SELECT o_orderkey % 300 AS doc_id, CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE o_orderkey % 101 END AS c FROM orders), a AS (SELECT doc_id, count(*) FILTER (WHERE c > 0) AS words, round(coalesce(avg(c) FILTER (WHERE c > 0), 0) / 100, 4) AS confidence FROM w GROUP BY 1) SELECT *, CASE WHEN confidence >= 0.7 THEN 'success' WHEN confidence >= 0.4 THEN 'partial' ELSE 'failed' END AS status FROM a")
def ocr_confidence(t):
    k = F.col("o_orderkey")
    return scoring.ocr_confidence(t.orders.select((k % 300).alias("doc_id"), F.when(k % 4 == 0, -1).otherwise(k % 101).alias("confidence")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Given' WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'GAGAS Audit / Single Audit' WHEN o_orderkey % 2 = 0 THEN 'GAGAS Audit' WHEN o_orderkey % 3 = 0 THEN 'Financial Statement Audit / Single Audit' ELSE 'Financial Statement Audit' END AS audit_type, CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'hybrid' ELSE 'llm_fallback' END WHEN o_orderkey % 5 = 0 THEN 'llm' ELSE 'pdf' END AS method, round(0.6::DOUBLE * (o_orderkey % 10) / 10 + 0.4::DOUBLE * (o_orderkey % 7) / 7, 4) AS blend FROM orders")
def record_labels(t):
    """Synthesised audit types, extraction methods and blended confidences."""
    k = F.col("o_orderkey")
    kind = scoring.audit_type(F.when(k % 5 == 0, "Given").otherwise(""), F.when(k % 2 == 0, "Yes").otherwise("no"), F.lit("TRUE"), F.when(k % 3 == 0, "true"))
    method = scoring.extraction_method(k % 3 == 0, k % 5 == 0, k % 2 == 0, F.lit("pdf"))
    return t.orders.select("o_orderkey", kind.alias("audit_type"), method.alias("method"), scoring.ocr_blend(k % 10 / 10, k % 7 / 7).alias("blend"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE p_size / 50 >= 0.65) AS extraction_passed, count(*) FILTER (WHERE p_partkey % 100 / 100 >= 0.75) AS review_passed, round(avg(p_size / 50), 4) AS extraction_mean, round(avg(p_partkey % 100 / 100), 4) AS review_mean FROM part")
def benchmark_summary(t):
    return scoring.benchmark_summary(t.part.select((F.col("p_size") / 50).alias("extraction"), (F.col("p_partkey") % 100 / 100).alias("review")))


@query("SELECT l_orderkey, l_linenumber, [1234.5, -45000, 750000, 2500000, NULL][(l_linenumber % 5) + 1]::DOUBLE AS amount, CASE WHEN l_linenumber % 7 = 0 THEN 'subtotal' WHEN l_linenumber % 3 = 1 THEN 'opening' WHEN l_quantity > 25 THEN 'addition' ELSE 'deduction' END AS kind, greatest(750000.0::DOUBLE, l_extendedprice * 1000 * 0.03::DOUBLE) AS type_a, least(abs(l_quantity - 25) / 10, 1.0) AS anomaly, CASE WHEN l_extendedprice > 10000 THEN 'ctr' WHEN l_extendedprice >= 5000 THEN 'sar' END AS report FROM lineitem")
def amounts_and_thresholds(t):
    """Amounts, kinds of rows, thresholds and anomaly scores."""
    n = F.col("l_linenumber")
    raw = F.element_at(F.array(*[F.lit(x) for x in ("$1,234.50", "(45,000)", "$750K", "2.5m", "n/a")]), (n % 5 + 1).cast("int"))
    kind = finance.row_kind(F.when(n % 3 == 1, " Balance per Bank 6/30").otherwise("Fees"), F.col("l_quantity") - 25.5, n % 7 == 0)
    return t.lineitem.select("l_orderkey", "l_linenumber", finance.amount(raw).alias("amount"), kind.alias("kind"), finance.type_a_threshold(F.col("l_extendedprice") * 1000).alias("type_a"), finance.anomaly(F.col("l_quantity") - 25, F.lit(10.0)).alias("anomaly"), finance.reportable(F.col("l_extendedprice")).alias("report"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0.9 WHEN doc_id % 3 = 1 THEN 0.7 ELSE 0.0 END::DOUBLE AS gagas, CASE WHEN doc_id % 3 = 2 THEN 0.8 ELSE 0.0 END::DOUBLE AS single_audit, CASE WHEN doc_id % 3 = 1 THEN 'GASB' WHEN doc_id % 3 = 2 THEN 'Special Purpose Framework' ELSE 'GAAP' END AS framework FROM documents")
def prose_flags(t):
    """Scopes and frameworks told in running text."""
    lead = F.element_at(F.array(*[F.lit(x) for x in ("GAGAS, the Yellow Book: Government Auditing Standards. ", "yellow book and GASB. ", "Uniform Guidance for federal awards, cash basis. ")]), (F.col("doc_id") % 3 + 1).cast("int"))
    flags = mining.prose_flags(F.concat(lead, "text"))
    get = lambda k: F.coalesce(F.try_element_at("f", F.lit(k)), F.lit(0.0))
    return t.documents.select("doc_id", flags.alias("f"), mining.framework(F.concat(lead, "text")).alias("framework")).select("doc_id", get("includes_gagas").alias("gagas"), get("includes_single_audit").alias("single_audit"), "framework")


@query(
    """
WITH a AS (SELECT event_id, event_id % 5 <> 0 AS whole, event_type = 'view' AS plain, CASE WHEN event_type = 'click' THEN ' ' || user_id ELSE '' END AS v, value > 50 AS sure, props FROM events)
SELECT event_id, CASE WHEN whole THEN json_extract_string(props, '$.k') END AS k, CASE WHEN whole THEN CASE WHEN plain THEN 'Acme' ELSE trim(v) END ELSE '' END AS value, whole AND (plain OR trim(v) <> '') AS found, whole AND NOT plain AND sure AS confident FROM a
"""
)
def model_answers(t):
    """Answers of a model around the properties of events: fenced, structured, plain or broken."""
    e = F.col("event_type")
    inner = F.to_json(F.struct(F.when(e == "click", F.concat(F.lit(" "), F.col("user_id").cast("string"))).otherwise("").alias("value"), (F.col("value") > 50).alias("confident"), F.lit("p1").alias("source_hint")))
    client = F.when(e == "view", F.lit('"Acme"')).otherwise(inner)
    body = F.concat(F.regexp_replace("props", r"\}$", ', "client": '), client, F.when(F.col("event_id") % 5 != 0, "}").otherwise(""))
    raw = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("Here: "), body, F.lit(" ok")))
    a = t.events.select("event_id", pairs.parsed_answer(raw).alias("a")).select("event_id", F.try_element_at("a", F.lit("k")).alias("k"), pairs.parsed_field(F.col("a"), "client").alias("c"))
    return a.select("event_id", "k", F.coalesce("c.value", F.lit("")).alias("value"), F.coalesce("c.found", F.lit(False)).alias("found"), F.coalesce("c.confident", F.lit(False)).alias("confident"))


@query("SELECT l_orderkey AS pair_id, count(*) AS n, string_agg(n || '. ' || label || sec || chr(10) || '   Severity: ' || sev, chr(10) || chr(10) ORDER BY n) AS findings FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY f) AS n, ['Ein Number', 'Opinion', 'Date Signed'][f + 1] AS label, ['', ' (§Q4(b))', ' (§3.1)'][f + 1] AS sec, ['High', 'Low', 'Medium'][f + 1] AS sev FROM (SELECT DISTINCT l_orderkey, l_partkey % 5 AS f FROM lineitem) WHERE f < 3) GROUP BY 1")
def rendered_findings(t):
    """Numbered findings for absent fields with their sections."""
    tiers = t.rows("field string, tier string, reason string", ("ein_number", "tier1", "no section"), ("opinion", "tier1", "x"), ("date_signed", "tier2", "per SOP §3.1"), ("fixed", "tier1", ""))
    classes = t.rows("field string, slug string, class string, severity string, label string, pos int", ("opinion", "q4b", "deficiency_eligible", "low", None, 1), ("opinion", "q9", "informational_only", None, None, 2), ("fixed", "q1", "fixed_administrative", None, None, 3))
    names = F.element_at(F.array(*[F.lit(x) for x in ("ein_number", "opinion", "date_signed", "fixed", "other")]), (F.col("f") + 1).cast("int"))
    absent = t.lineitem.select(F.col("l_orderkey").alias("pair_id"), (F.col("l_partkey") % 5).alias("f")).distinct().select("pair_id", F.col("f").alias("pos"), names.alias("field"))
    return pairs.rendered_findings(absent, pairs.procedure_map(tiers, classes))


@query("SELECT o_orderkey AS pair_id, i AS idx, 'item ' || i || ' of ' || o_orderkey AS text FROM orders, range(1, 3) r(i)")
def numbered_findings(t):
    """The numbered lines of completions."""
    k = F.col("o_orderkey").cast("string")
    line = lambda i: F.concat(F.lit(f"{i}. item {i} of "), k)
    body = F.concat_ws("\n", line(1), F.lit("   Severity: Low"), line(2))
    marked = F.concat(F.lit("0. intro\nFINDINGS: \n"), body, F.lit("\nRECOMMENDATION:\n3. act"))
    return pairs.numbered_findings(t.orders.select(F.col("o_orderkey").alias("pair_id"), F.when(F.col("o_orderkey") % 2 == 0, marked).otherwise(body).alias("text"))).withColumn("idx", F.col("idx").cast("long"))


@query("SELECT month, n, confused FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 <> c_nationkey % 3) AS confused FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)")
def framework_confusion(t):
    """Results by month that name another framework than the engagement's."""
    results = t.orders.select(F.col("o_custkey").alias("engagement_id"), F.col("o_orderdate").alias("at"), (F.col("o_orderkey") % 3).cast("string").alias("framework"))
    return observe.monthly_confusion(results, t.customer.select(F.col("c_custkey").alias("engagement_id"), (F.col("c_nationkey") % 3).cast("string").alias("framework")))


_PARTS = ("criteria", "condition", "cause", "effect", "recommendation", "compliant")


@query(
    "WITH a AS (SELECT p_partkey, p_type, " + ", ".join(f"CASE WHEN (p_size >> {i}) & 1 = 1 THEN {v} END AS {n}" for i, (n, v) in enumerate(zip(_PARTS, ("p_name", "''", "p_brand", "p_type", "p_name", "''")))) + """ FROM part)
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN concat_ws(',', CASE WHEN coalesce(compliant, '') = '' THEN 'compliant' END, CASE WHEN coalesce(recommendation, '') = '' THEN 'recommendation' END)
 ELSE concat_ws(',', """ + ", ".join(f"CASE WHEN coalesce({n}, '') = '' THEN '{n}' END" for n in _PARTS[:5]) + ") END AS missing FROM a"
)
def required_parts(t):
    """What answers lack."""
    values = (F.col("p_name"), F.lit(""), F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.lit(""))
    given = F.create_map(*[x for i, (n, v) in enumerate(zip(_PARTS, values)) for x in (F.lit(n), F.when(F.shiftright("p_size", i).bitwiseAND(F.lit(1)) == 1, v))])
    task = F.when(F.col("p_type") == "ECONOMY", "compliance_check").otherwise("finding_documentation")
    return t.part.select("p_partkey", F.array_join(forms.missing_required(task, given), ",").alias("missing"))
