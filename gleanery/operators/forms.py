"""Rule-driven forms: a field's value by the kind of its rule, the acceptance decision, section detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.sizes import blocks

# Kinds of engagement, fields that forbid acceptance when answered Yes, and the two decisions.
INITIAL, RECURRING = "Initial / 1st Year", "Recurring / 2nd Year or Subsequent"
BLOCKERS = ("q4", "q5_a", "q5_b", "q5_c", "q9", "q9_a", "q9_b", "q11")
ACCEPTED, REFUSED = "ACCEPT / CONTINUE", "DO NOT ACCEPT / CONTINUE"


def resolved(fields: DataFrame, inputs: DataFrame, sections: DataFrame, key: str = "engagement_id") -> DataFrame:
    """(key, field_id, source, value, status) of every field of a form for every engagement.

    fields(field_id, source, fixed, initial, recurring, target, if_found, if_not_found) is the form, a table of some
    dozen rows; inputs(key, engagement_type, answers map) has an engagement a row; sections(key, target) those that
    last year's report has.
    """
    found = sections.groupBy(key).agg(F.collect_set("target").alias("__found"))
    cells = inputs.join(found, key, "left").join(F.broadcast(fields))
    recurring = F.col("engagement_type") == RECURRING
    has = F.coalesce(F.array_contains("__found", F.col("target")), F.lit(False))
    answer = F.try_element_at("answers", "field_id")
    given = F.coalesce(answer, F.lit("")) != ""
    looked = F.when(~recurring & F.col("initial").isNotNull(), F.col("initial")).when(has, F.col("if_found")).otherwise(F.col("if_not_found"))
    s = F.col("source")
    by_time = F.col("recurring").isNotNull()
    value = (
        F.when((s == "sop_fixed") & by_time, F.when(recurring, F.col("recurring")).otherwise(F.col("initial")))
        .when(s == "sop_fixed", F.col("fixed"))
        .when(s == "py_audit_report_lookup", looked)
        .when(s == "sop_fixed_plus_lookup", F.concat(F.lit("Refer: "), looked))
        .when(s == "sop_fixed_plus_manual", F.when(recurring, "N/A").when(given, F.concat(F.lit("Yes — "), answer)).otherwise("Yes (remark required)"))
        .when(s.isin("auditor_selection", "manual_entry", "auditor_yes_no_with_remark") & given, answer)
    )
    status = (
        F.when((s == "sop_fixed") & by_time & recurring, "na")
        .when(s.isin("sop_fixed", "py_audit_report_lookup", "sop_fixed_plus_lookup"), "resolved")
        .when(s == "sop_fixed_plus_manual", F.when(recurring, "na").when(given, "resolved").otherwise("needs_input"))
        .when(s.isin("auditor_selection", "manual_entry", "auditor_yes_no_with_remark") & given, "resolved")
        .otherwise("needs_input")
    )
    return cells.select(key, "field_id", "source", value.alias("value"), status.alias("status"))


def decision(resolved_: DataFrame, key: str = "engagement_id") -> DataFrame:
    """(key, value, blocker): refused if a blocker is answered exactly Yes, the first of them named."""
    order = F.array_position(F.array(*[F.lit(b) for b in BLOCKERS]), F.col("field_id"))
    yes = F.col("field_id").isin(*BLOCKERS) & (F.col("value") == "Yes")
    first = F.min_by("field_id", F.when(yes, order))
    return resolved_.groupBy(key).agg(first.alias("blocker")).select(key, F.when(F.col("blocker").isNull(), ACCEPTED).otherwise(REFUSED).alias("value"), "blocker")


def summary(resolved_: DataFrame, *keys: str) -> DataFrame:
    return resolved_.groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("resolved", "needs_input", "na")])


def detected(pages: DataFrame, patterns: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, target, location, page): where a section is found first, in the contents (pages 1 to 5) before the body, by the order of patterns(target, pattern, pos), then the page. pages(key, page, text). Patterns meet all pages, in blocks."""
    text = F.lower(F.regexp_replace("text", r"\s+", " "))
    low = pages.select(key, "page", text.alias("__t"))
    hits = [low.join(part, F.instr(F.col("__t"), F.lower(F.col("pattern"))) > 0).drop("__t") for part in blocks(patterns, "pattern", 200)]
    hits = reduce(DataFrame.unionByName, hits)
    place = F.when(F.col("page") <= 5, 0).otherwise(1)
    best = F.min(F.struct(place.alias("place"), "pos", "page"))
    return hits.groupBy(key, "target").agg(best.alias("b")).select(key, "target", F.when(F.col("b.place") == 0, "toc").otherwise("body").alias("location"), "b.page")


def header_hint(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, hint): the first line in capitals among the first eight of pages 1 to 3."""
    lines = pages.where("page <= 3").select(key, "page", F.posexplode(F.slice(F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != ""), 1, 8)).alias("line", "s"))
    caps = lines.where((F.col("s") == F.upper("s")) & F.col("s").rlike("[A-Z]{3}"))
    return caps.groupBy(key).agg(F.min_by("s", F.struct("page", "line")).alias("hint"))


def prefix_rows(questions: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, question, row): each question takes the first row whose text begins with its prefix and that no earlier question took. questions(question, prefix, pos) is a form; the rows of one document are folded in order, within one array."""
    have = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("row", "text"))).alias("__rows"))
    ask = questions.agg(F.array_sort(F.collect_list(F.struct("pos", "question", "prefix"))).alias("__ask"))

    def step(acc, q):
        free = F.filter("__rows", lambda r: r["text"].startswith(q["prefix"]) & ~F.array_contains(F.transform(acc, lambda a: a["row"]), r["row"]))
        return F.when(F.size(free) > 0, F.concat(acc, F.array(F.struct(q["question"].alias("question"), free[0]["row"].alias("row"))))).otherwise(acc)

    zero = F.array().cast("array<struct<question:string,row:int>>")
    taken = F.aggregate("__ask", zero, step)
    return have.join(F.broadcast(ask)).select(key, F.explode(taken).alias("t")).select(key, "t.question", "t.row")


def marks(c: Column) -> Column:
    return F.when(c.isin("Yes", "true"), "yes").when(c.isin("No", "false"), "no").when(c == "N/A", "na")


def first_rows(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def merged_hints(found: Column, given: Column) -> Column:
    """Answers read from a document, with given ones in their place where they aren't empty."""
    filled = F.map_filter(given, lambda _, v: F.coalesce(v, F.lit("")) != "")
    return F.map_concat(F.map_filter(found, lambda k, _: ~F.map_contains_key(filled, k)), filled)


# What each kind of answer must hold.
REQUIRED = {
    "risk_classification": ("risk_level", "risk_factors", "recommendation"),
    "compliance_check": ("compliant", "recommendation"),
    "finding_documentation": ("criteria", "condition", "cause", "effect", "recommendation"),
    "summarization": ("summary", "workpaper_type"),
    "ner_extraction": ("entities", "entity_types_found", "pii_detected"),
}


def missing_required(task: Column, answer: Column) -> Column:
    """Names of the required parts that an answer (a map of text) lacks."""
    need = F.create_map(*[x for k, v in REQUIRED.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    return F.filter(F.try_element_at(need, task), lambda f: F.coalesce(F.try_element_at(answer, f), F.lit("")) == "")
