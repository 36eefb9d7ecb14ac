"""Typed facts with their sources: checks, merging, assembly, comparison with gold documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.operators.sizes import small

DISAGREEMENT = 0.8
LOW = 0.70
# Types of fields whose values a model must not invent.
NOT_FROM_MODEL = ("numeric", "date", "id")


def violations(field_type: Column, value: Column, confidence: Column, sources: Column, method: Column) -> Column:
    """Names of the broken rules of a fact: a value needs a source, numbers and dates must not come from a model, confidence lies in 0 to 1."""
    checks = [
        F.when(value.isNotNull() & (F.coalesce(F.size(sources), F.lit(0)) == 0), "no_source"),
        F.when(field_type.isin(*NOT_FROM_MODEL) & F.coalesce(method == "llm_extraction", F.lit(False)) & value.isNotNull(), "model_value"),
        F.when(confidence.isNull() | F.isnan(confidence) | (confidence < 0) | (confidence > 1), "confidence"),
    ]
    return F.array_compact(F.array(*checks))


def model_allowed(fields: DataFrame, registry: DataFrame) -> DataFrame:
    """fields(field, ...) without those of a type that is not for models; fields that the registry doesn't know pass."""
    return fields.join(small(registry.where(F.col("field_type").isin(*NOT_FROM_MODEL)).select("field")), "field", "left_anti")


def typed(evidence: DataFrame, registry: DataFrame, methods: dict[str, str], default: str = "deterministic") -> DataFrame:
    """Evidence rows (field, value, confidence, method, ...) of registered fields, with field_type and the mapped method; offsets of -1 become null."""
    mapping = F.create_map(*[x for k, v in methods.items() for x in (F.lit(k), F.lit(v))]) if methods else None
    out = evidence.join(small(registry.select("field", "field_type")), "field")
    out = out.withColumn("method", F.coalesce(F.try_element_at(mapping, F.col("method")), F.lit(default)) if mapping is not None else F.lit(default))
    for c in ("char_start", "char_end"):
        if c in out.columns:
            out = out.withColumn(c, F.when(F.col(c) >= 0, F.col(c)))
    return out


def merged(facts: DataFrame, *keys: str) -> DataFrame:
    """One fact for each key and field of facts(keys, field, value, confidence, sources, method, pos).

    A single fact stays as it is. Values that agree: the highest confidence, all sources in order. Values that differ:
    the value, method and sources of the most confident fact, the first among equals, its confidence times .8. Without
    any value: the first fact. `outcome` (single, agree, conflict, empty) says which.
    """
    present = F.col("value").isNotNull()
    row = F.struct("value", "confidence", "sources", "method")
    best = F.max_by(F.when(present, row), F.when(present, F.struct("confidence", F.negative("pos").alias("p"))))
    in_order = F.transform(F.array_sort(F.collect_list(F.when(present, F.struct("pos", "sources")))), lambda x: x["sources"])
    out = facts.groupBy(*keys, "field").agg(F.count("*").alias("n"), F.count("value").alias("n_present"), F.min("value").alias("least"), F.max("value").alias("most"), best.alias("best"), F.min_by(row, "pos").alias("first"), F.max(F.when(present, F.col("confidence"))).alias("top"), F.flatten(in_order).alias("all_sources"))
    outcome = F.when(F.col("n") == 1, "single").when(F.col("n_present") == 0, "empty").when(F.col("least") == F.col("most"), "agree").otherwise("conflict")
    out = out.withColumn("outcome", outcome)
    pick = lambda single, agree, conflict: F.when(F.col("outcome").isin("single", "empty"), single).when(F.col("outcome") == "agree", agree).otherwise(conflict)
    return out.select(
        *keys,
        "field",
        pick(F.col("first.value"), F.col("best.value"), F.col("best.value")).alias("value"),
        pick(F.col("first.confidence"), F.least(F.lit(1.0), F.col("top")), F.col("best.confidence") * DISAGREEMENT).alias("confidence"),
        pick(F.col("first.sources"), F.col("all_sources"), F.col("best.sources")).alias("sources"),
        pick(F.col("first.method"), F.lit("multi_extractor_agreement"), F.col("best.method")).alias("method"),
        "outcome",
    )


def assembled(facts: DataFrame, *keys: str) -> DataFrame:
    """(keys, facts, fields_present, low_confidence): a map of merged facts by field, with sorted names."""
    fact = F.struct("value", "confidence", "sources", "method")
    names = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("field"))))
    present = F.col("value").isNotNull()
    return facts.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", fact.alias("fact"))))).alias("facts"), names(present).alias("fields_present"), names(present & (F.col("confidence") < LOW)).alias("low_confidence"))


def missing(assembled_: DataFrame, registry: DataFrame) -> Column:
    """Registered fields that an assembled row has no value for; registry's names must be given as a sorted array column `registered`."""
    return F.array_except("registered", "fields_present")


def lost(relaxed: Column, strict: Column) -> Column:
    """Fields that a relaxed run finds and a strict one doesn't."""
    return F.array_except(relaxed, F.coalesce(strict, F.array().cast("array<string>")))


def issues(documents: DataFrame, registry: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, field, issue, hard) of documents(key, field, value, is_bool) against registry(field, field_type, allowed): unknown and missing fields and text in a boolean field are hard, values outside the vocabulary soft."""
    keys = documents.select(key).distinct()
    want = keys.join(F.broadcast(registry))  # every document against the registry's some dozen fields
    full = documents.withColumn("__have", F.lit(True)).join(want, [key, "field"], "full")
    outside = (F.col("field_type") == "categorical") & F.col("value").isNotNull() & ~F.coalesce(F.array_contains("allowed", F.col("value")), F.lit(False))
    issue = F.when(F.col("field_type").isNull(), "not_in_registry").when(F.col("__have").isNull(), "missing").when(outside, "outside_vocabulary").when((F.col("field_type") == "boolean") & F.col("value").isNotNull() & ~F.col("is_bool"), "not_boolean")
    return full.withColumn("issue", issue).where("issue IS NOT NULL").select(key, "field", "issue", (F.col("issue") != "outside_vocabulary").alias("hard"))


def same_value(gold: Column, fact: Column, boolean: Column) -> Column:
    """Booleans must be equal as they are, texts once trimmed; two nulls are equal."""
    return F.when(boolean, gold.eqNullSafe(fact)).otherwise(F.trim(gold).eqNullSafe(F.trim(fact)))


def compared(facts: DataFrame, gold: DataFrame, *keys: str) -> DataFrame:
    """(keys, field, fact, gold, status) over all fields of either side: match, differ, extra (only a fact), absent (only gold), none. An empty gold value is none."""
    g = gold.select(*keys, "field", F.when(F.trim("value") != "", F.col("value")).alias("gold"))
    f = facts.select(*keys, "field", F.col("value").alias("fact"))
    has_f, has_g = F.col("fact").isNotNull(), F.col("gold").isNotNull()
    status = F.when(~has_f & ~has_g, "none").when(~has_f, "absent").when(~has_g, "extra").when(F.trim("fact") == F.trim("gold"), "match").otherwise("differ")
    return f.join(g, [*keys, "field"], "full").withColumn("status", status)


def linked(gold: DataFrame, facts: DataFrame, *keys: str) -> DataFrame:
    """gold(keys, field, value, is_bool, citations) with the sources of facts of equal value added; booleans get none."""
    f = facts.select(*keys, "field", F.col("value").alias("__v"), F.col("sources").alias("__s"))
    same = F.coalesce(F.trim("value") == F.trim("__v"), F.lit(False)) & ~F.col("is_bool")
    out = gold.join(f, [*keys, "field"], "left")
    return out.withColumn("citations", F.when(same, F.array_distinct(F.concat("citations", "__s"))).otherwise(F.col("citations"))).drop("__v", "__s")


def summary(facts: DataFrame, *keys: str) -> DataFrame:
    """Present facts with the confidence to three places and at most three sources, quotes cut at 200."""
    return facts.where("value IS NOT NULL").select(*keys, "field", "value", F.round("confidence", 3).alias("confidence"), F.transform(F.slice("sources", 1, 3), lambda s: F.left(s, F.lit(200))).alias("sources"))
