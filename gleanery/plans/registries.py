"""Queries over registries, cells and forms: what the other modules leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import aliases, facts, finance, forms, mining, pairs, retrieval, review, scoring
from gleanery.plans.registry import query


def _pick(i, *xs):
    return F.element_at(F.array(*[F.lit(x) for x in xs]), (i % len(xs) + 1).cast("int"))


@query("SELECT p_partkey, p_name AS name, p_size % 4 = 0 AS blocked FROM part WHERE p_size % 4 <> 0 AND NOT (p_size % 3 = 0 AND p_partkey % 2 = 0)")
def pending_proposals(t):
    """Proposals that are neither noise nor pending."""
    p = t.part.select("p_partkey", F.col("p_name").alias("name"), (F.col("p_size") % 4 == 0).alias("blocked"), "p_size", F.concat(F.when(F.col("p_size") % 4 == 0, "page ").otherwise("label "), F.col("p_partkey").cast("string")).alias("label"), F.lit("c").alias("canonical"))
    have = p.where("p_size % 3 = 0 AND p_partkey % 2 = 0").select(F.upper("label").alias("label"), "canonical")
    return aliases.pending_proposals(p, have, [], [r"page \d+"]).select("p_partkey", "name", "blocked")


@query("WITH d AS (SELECT event_type AS label, arg_max(event_id % 2, event_id) AS yes FROM events WHERE event_type <> 'view' GROUP BY 1) SELECT e.label, coalesce(CASE WHEN yes = 1 THEN 'approved' WHEN yes = 0 THEN 'rejected' END, 'pending') AS status, yes IS NOT NULL AS decided FROM (SELECT DISTINCT event_type AS label FROM events) e LEFT JOIN d USING (label)")
def suggestion_decisions(t):
    """Suggestions with the latest decision on them."""
    log = t.events.select(F.col("event_type").alias("label")).distinct().withColumn("status", F.lit("pending"))
    made = t.events.where("event_type <> 'view'").select(F.upper("event_type").alias("label"), F.lit("c").alias("canonical"), F.when(F.col("event_id") % 2 == 1, "approved").otherwise("rejected").alias("decision"), F.lit("r").alias("reviewer"), F.col("event_id").alias("at"))
    return aliases.decided(log, made).select("label", "status", F.col("reviewer").isNotNull().alias("decided"))


@query("SELECT count(*) AS versions, count(*) FILTER (WHERE n_nationkey % 6 = 0) AS rollbacks, arg_max('1.' || n_nationkey, n_nationkey * 7 % 25) AS largest, count(*) FILTER (WHERE n_nationkey % 5 = 0) AS drops FROM nation")
def version_health(t):
    k = F.col("n_nationkey")
    changes = t.nation.select(F.concat(F.lit("1."), k.cast("string")).alias("version"), F.when(k % 6 == 0, "rollback").otherwise("merge").alias("action"), (k * 7 % 25).alias("added"), F.lit(0.9).alias("precision_before"), F.when(k % 5 == 0, 0.8).otherwise(0.95).alias("precision_after"))
    return aliases.version_health(changes)


@query("WITH h AS (SELECT '1.' || v AS version, v, n_name AS canonical, lower(n_name) AS variant FROM nation, (VALUES (2), (9), (10)) x(v) WHERE n_nationkey % v <> 1) SELECT '1.11' AS version, canonical, variant FROM h WHERE v = 9")
def alias_rollback(t):
    """An old version of the aliases as a new one."""
    h = t.nation.join(F.broadcast(t.rows("v int", (2,), (9,), (10,)))).where("n_nationkey % v <> 1").select(F.concat(F.lit("1."), F.col("v").cast("string")).alias("version"), F.col("n_name").alias("canonical"), F.lower("n_name").alias("variant"))
    return aliases.rolled_back(h, "1.9")


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (WHERE v) AS fields_present, coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (WHERE v AND c < 0.7), '') AS low FROM (SELECT l_orderkey, l_returnflag, true AS v, max(l_discount * 10) AS c FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def assembled_records(t):
    """Records assembled from facts by field, with those of low confidence."""
    f = t.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("field")).agg(F.max(F.col("l_discount") * 10).alias("confidence")).withColumn("value", F.lit("x")).withColumn("sources", F.array(F.lit("s"))).withColumn("method", F.lit("m"))
    out = facts.assembled(f, "l_orderkey")
    return out.select("l_orderkey", F.array_join("fields_present", ",").alias("fields_present"), F.array_join("low_confidence", ",").alias("low"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_size % 3 = 0 THEN 'g' ELSE 'g,s1' END ELSE 'g' END AS citations FROM part")
def linked_citations(t):
    """Sources of facts whose value is that of the gold form; booleans get none."""
    s = F.col("p_size")
    gold = t.part.select("p_partkey", F.lit("f").alias("field"), F.col("p_brand").alias("value"), (s % 3 == 0).alias("is_bool"), F.array(F.lit("g")).alias("citations"))
    found = t.part.select("p_partkey", F.lit("f").alias("field"), F.when(s % 2 == 0, F.concat(F.lit(" "), "p_brand")).otherwise("other").alias("value"), F.array(F.lit("s1"), F.lit("g")).alias("sources"))
    return facts.linked(gold, found, "p_partkey").select("p_partkey", F.array_join("citations", ",").alias("citations"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, ['boolean', 'text'][l_partkey % 3 + 1] AS field_type, CASE WHEN l_linenumber % 2 = 0 THEN 'llm_extraction' ELSE 'deterministic' END AS method, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS char_start FROM lineitem WHERE l_partkey % 3 < 2")
def typed_evidence(t):
    """Evidence of registered fields, typed; unknown fields are left out."""
    ev = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", _pick(F.col("l_partkey"), "a", "b", "zz").alias("field"), F.when(F.col("l_linenumber") % 2 == 0, "llm").otherwise("regex").alias("method"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).otherwise(-1).alias("char_start"))
    out = facts.typed(ev, t.rows("field string, field_type string", ("a", "boolean"), ("b", "text")), {"llm": "llm_extraction"})
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "field_type", "method", "char_start")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, 'f' || l_partkey % 4 AS field FROM lineitem WHERE l_partkey % 4 <> 1")
def model_fields(t):
    """Fields that a model may fill: those of numbers and dates are left out, unknown ones pass."""
    f = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.concat(F.lit("f"), (F.col("l_partkey") % 4).cast("string")).alias("field"))
    return facts.model_allowed(f, t.rows("field string, field_type string", ("f0", "text"), ("f1", "date"))).select("l_orderkey", "l_linenumber", "l_suppkey", "field")


@query("SELECT o_orderkey, o_orderkey % 3 < 2 AND o_orderkey % 5 <> 0 AS weak FROM orders WHERE o_orderkey % 3 < 2 AND o_orderkey % 5 <> 0")
def needs_model(t):
    """Fields on which the first two extractors don't agree."""
    k = F.col("o_orderkey")
    slots = t.orders.select("o_orderkey", F.when(k % 3 == 2, 3).when(k % 3 == 1, 2).otherwise(1).alias("tier"), F.col("o_orderstatus").alias("val_a"), F.when(k % 5 == 0, F.lower("o_orderstatus")).when(k % 5 == 1, None).otherwise("zz").alias("val_b"))
    return scoring.needs_model(slots).select("o_orderkey", F.lit(True).alias("weak"))


@query("SELECT doc_id, CASE WHEN p > 0 THEN p - 1 END::INTEGER AS char_start, CASE WHEN p > 0 THEN p - 1 + 4 END::INTEGER AS char_end FROM (SELECT doc_id, strpos(text, 'the ') AS p FROM documents)")
def located_values(t):
    """Where a value stands in a text."""
    at = mining.located(F.col("text"), F.lit("the "))
    return t.documents.select("doc_id", at["char_start"].alias("char_start"), at["char_end"].alias("char_end"))


@query("SELECT l_returnflag AS table_id, col::INTEGER AS col FROM (SELECT DISTINCT l_returnflag FROM lineitem), (VALUES (1), (2)) c(col)")
def numeric_columns(t):
    """Columns most of whose cells are numbers."""
    rows = t.lineitem.select(F.col("l_returnflag").alias("table_id"), F.array(F.col("l_linestatus"), F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)), F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("string")), F.when(F.col("l_linenumber") < 4, "1").otherwise("x")).alias("row"))
    return mining.numeric_columns(rows)


@query("SELECT n_name AS sheet, r::INTEGER AS row, c::INTEGER AS col, CASE WHEN r BETWEEN 1 AND 2 AND c BETWEEN 1 AND 3 THEN 'x11' ELSE 'x' || r || c END AS text FROM nation, range(1, 4) a(r), range(1, 5) b(c)")
def merged_rectangles(t):
    """Merged cells show their first one's text."""
    cells = t.nation.select(F.col("n_name").alias("sheet"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("row")).select("sheet", "row", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("col")).withColumn("text", F.concat(F.lit("x"), F.col("row").cast("string"), F.col("col").cast("string")))
    return mining.merged_cells(cells, t.nation.select(F.col("n_name").alias("sheet"), F.lit(1).alias("top"), F.lit(1).alias("left"), F.lit(2).alias("bottom"), F.lit(3).alias("right")))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'stage3_firm' ELSE 'stage2_domain' END AS stage, CASE WHEN p_size % 3 = 0 THEN 'b,c,flag' ELSE 'b,flag' END AS uncertain, p_size % 5 = 0 AS ready FROM part")
def pair_stages(t):
    """Stages, uncertain sections and readiness of records."""
    s = F.col("p_size")
    present = F.when(s % 2 == 0, F.array(F.lit("a"), F.lit("firm_code"))).otherwise(F.array(F.lit("a")))
    scores = F.create_map(F.lit("a"), F.lit(0.9), F.lit("b"), F.lit(0.5), F.lit("z"), F.lit(0.0))
    deficient = F.when(s % 3 == 0, F.array(F.lit("c"))).otherwise(F.array().cast("array<string>"))
    ready = pairs.training_ready({"status": F.lit("success"), "scrubbed": F.lit(True), "approved": s % 5 == 0, "confidence": F.lit(0.7), "text": F.lit("x"), "incomplete": F.lit(False)})
    return t.part.select("p_partkey", pairs.stage(present, ["firm_code"]).alias("stage"), F.array_join(pairs.uncertain_sections(F.array(F.lit("flag")), scores, deficient), ",").alias("uncertain"), ready.alias("ready"))


@query("SELECT p_partkey, '<s>[INST] ' || p_name || ' [/INST]' AS prompt, p_type || '</s>' AS completion, '{\"a\":\"' || p_brand || '\",\"b\":\"' || p_type || '\"}' AS fields FROM part")
def export_lines(t):
    """Prompts and completions in their envelope; fields as JSON in order."""
    prompt, completion = pairs.instruction(F.col("p_name"), F.col("p_type"))
    return t.part.select("p_partkey", prompt.alias("prompt"), completion.alias("completion"), pairs.ordered_json(F.create_map(F.lit("b"), F.col("p_type"), F.lit("a"), F.col("p_brand"))).alias("fields"))


@query("SELECT p_partkey, lower(p_name) AS form, CASE WHEN length(p_type || p_type || p_type) > 20 THEN left(p_type || p_type || p_type, 17) || '...' ELSE p_type || p_type || p_type END AS shown, 'header_' || p_size AS header FROM (SELECT p_partkey, regexp_replace(regexp_replace(lower(replace(p_name, '-', '')), '[^a-z0-9]+', ' ', 'g'), '^ | $', '', 'g') AS p_name, p_type, p_size FROM part)")
def display_forms(t):
    """Form texts, shortened values and header names."""
    return t.part.select("p_partkey", T.form_text(F.col("p_name")).alias("form"), T.shown(F.concat("p_type", "p_type", "p_type"), 20).alias("shown"), finance.header_name(F.concat(F.lit(" Header  #"), F.col("p_size").cast("string"), F.lit("! "))).alias("header"))


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 3 <> 0 UNION SELECT p_partkey FROM part WHERE p_partkey % 2 = 0")
def insert_if_absent(t):
    """Rows whose key isn't there yet are added."""
    rows = lambda cond: t.part.where(cond).select(F.col("p_partkey").alias("id"))
    return retrieval.inserted(rows("p_partkey % 3 <> 0"), rows("p_partkey % 2 = 0"), "id")


@query('SELECT round(avg(s), 4) AS "all", round(avg(s) FILTER (WHERE k % 3 < 2), 4) AS accepted, round(avg(s) FILTER (WHERE k % 3 = 2), 4) AS pending FROM (SELECT p_partkey AS k, p_size / 50 AS s FROM part)')
def review_means(t):
    """Mean review scores by state."""
    return review.score_means(t.part.select(_pick(F.col("p_partkey"), "approved", "conditional", "pending").alias("status"), (F.col("p_size") / 50).alias("score")))


@query("SELECT c_custkey, 'q1=' || CASE WHEN c_custkey % 2 = 0 THEN 'given' ELSE 'found' END || ',q2=found2' AS answers FROM customer")
def hint_merge(t):
    """Given answers in the place of those that were read."""
    lit = F.lit
    found = F.create_map(lit("q1"), lit("found"), lit("q2"), lit("found2"))
    given = F.create_map(lit("q1"), F.when(F.col("c_custkey") % 2 == 0, "given").otherwise(""))
    merged = F.array_sort(F.transform(F.map_entries(forms.merged_hints(found, given)), lambda e: F.concat(e["key"], lit("="), e["value"])))
    return t.customer.select("c_custkey", F.array_join(merged, ",").alias("answers"))
