"""From documents to gated training pairs: the operators of this library in a row.

normalise and redact -> mine and resolve fields -> score and gate records -> a variant for each client type, clean and
with fields made deficient -> findings and completion -> hashes, scores and the first gate that stops a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions import keys, redact
from gleanery.functions import text as T
from gleanery.operators import aliases, authority, mining, pairs, scoring

SYSTEM = "You review audit working papers and report what they fail to document."


@dataclass
class Dimensions:
    """Tables of some dozen rows: aliases(canonical, variant, pos); tiers(field, tier, exempt, reason); risks(field, severity); classes(field, slug, class, severity, label, pos)."""

    aliases: DataFrame
    tiers: DataFrame
    risks: DataFrame
    classes: DataFrame


def records(documents: DataFrame) -> DataFrame:
    """documents(doc_id, file_name, text) with the cleaned text, its category and the redactions."""
    clean = T.normalised(redact.scrubbed(F.col("text")))
    return documents.select("doc_id", "file_name", redact.redactions(F.col("text")).alias("redactions"), clean.alias("text")).withColumn("category", mining.category(F.col("file_name"), F.lit(""), F.col("text")))


def field_scores(recs: DataFrame, dims: Dimensions) -> DataFrame:
    """(doc_id, field, value, score): every tiered field of every record; one extractor, so a value scores .6 and none 0."""
    found = aliases.resolved(mining.line_fields(recs), dims.aliases).where("canonical IS NOT NULL").groupBy("doc_id", F.col("canonical").alias("field")).agg(F.max("value").alias("value"))
    cells = recs.select("doc_id").join(F.broadcast(dims.tiers.select("field")))
    nothing = F.lit(None).cast("string")
    out = cells.join(found, ["doc_id", "field"], "left")
    return out.withColumn("score", scoring.slot_score(F.coalesce("value", F.lit("")), nothing, nothing))


def review_pairs(documents: DataFrame, dims: Dimensions, client_types: tuple[str, ...] = authority.CLIENT_TYPES, variants: int = 2) -> DataFrame:
    """A row for each record, client type and set of fields made deficient: (pair_id, doc_id, file_name, client_type, pair_type, fields_missing, fields_present, extraction_confidence, review_confidence, messages, pair_hash, fingerprint, gate).

    Records below the extraction gate give one pair of the type low_confidence for each client type. A text is carried
    from its record to its pairs in one join on doc_id.
    """
    recs = records(documents)
    scores = field_scores(recs, dims)
    confidence = scoring.record_scores(scores, dims.tiers.select("field", "tier", "exempt")).select("doc_id", F.col("aggregate").alias("extraction_confidence"), "extraction_gate")
    lists = scoring.field_lists(scores)
    base = recs.join(confidence, "doc_id").join(lists, "doc_id").withColumn("client_type", F.explode(F.array(*[F.lit(c) for c in client_types])))

    weights = {t: {r["field"]: w for r in dims.tiers.where(F.col("tier") == t).collect()} for t, w in ((1, 0.7), (2, 0.3))}  # dimension rows
    drawn = pairs.deficiency_sets(base.where("extraction_gate").select("file_name", "client_type", F.col("present").alias("fields_present")), weights[1], weights[2], variants)
    drawn = drawn.select("file_name", "client_type", F.lit("deficient").alias("pair_type"), F.col("combination").alias("variant"), F.col("fields").alias("deficient"))
    plain = base.select("file_name", "client_type", F.when(F.col("extraction_gate"), "clean").otherwise("low_confidence").alias("pair_type"), F.lit(0).alias("variant"), F.array().cast("array<string>").alias("deficient"))
    every = base.join(plain.unionByName(drawn), ["file_name", "client_type"])
    every = every.withColumn("pair_id", F.concat_ws("|", F.col("doc_id").cast("string"), "client_type", "pair_type", F.col("variant").cast("string")))

    terms = aliases.alias_map(dims.aliases).where(F.size(F.split("variant", " ")) >= 2).groupBy("canonical").agg(F.array_sort(F.collect_list("variant")).alias("phrases"))
    terms = terms.agg(F.collect_list(F.struct(F.col("canonical").alias("field"), "phrases")).alias("__terms"))
    chosen = F.filter("__terms", lambda x: F.array_contains("deficient", x["field"]))
    every = every.join(F.broadcast(terms))  # one row
    text, failed = pairs.without_evidence(F.col("text"), chosen)
    every = every.withColumn("evidence", chosen).withColumn("failed", failed).withColumn("text", text)
    missing = F.array_sort(F.array_union("missing", "deficient"))
    every = every.withColumn("fields_missing", missing).withColumn("fields_present", F.array_except("present", "deficient"))

    table = pairs.procedure_map(dims.tiers.select("field", F.concat(F.lit("tier"), F.col("tier").cast("string")).alias("tier"), "reason"), dims.classes)
    absent = every.select("pair_id", F.posexplode("fields_missing").alias("pos", "field"))
    found = pairs.rendered_findings(absent, table)
    gagas, single = pairs.engagement_flags(F.col("client_type"), F.col("text"))
    out = every.join(found, "pair_id", "left").withColumn("is_gagas", gagas).withColumn("has_single_audit", single)
    n = F.coalesce("n", F.lit(0))
    advice = F.when(n > 0, F.concat(F.lit("Management of this "), "client_type", F.lit(" engagement should document the "), n.cast("string"), F.lit(" missing items."))).otherwise(F.concat(F.lit("The "), "client_type", F.lit(" engagement form appears complete.")))
    completion = F.concat(F.lit("ENGAGEMENT TYPE: "), "client_type", F.lit("\n\nFINDINGS:\n"), F.coalesce("findings", F.lit("No deficiencies identified.")), F.lit("\n\nRECOMMENDATION:\n"), advice)
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    out = out.withColumn("completion", completion).withColumn("messages", F.array(message("system", F.lit(SYSTEM)), message("user", pairs.user_prompt(F.col("file_name"), F.col("text"))), message("assistant", F.col("completion"))))
    out = out.withColumn("review_confidence", scoring.rubric(F.col("completion"), n, F.col("client_type"))).withColumn("pair_hash", keys.pair_hash(F.col("messages")))
    out = pairs.with_fingerprint(out)
    final = pairs.final_gate(F.col("completion"), F.col("text"), F.col("pair_type"), F.array().cast("array<string>"), F.flatten(F.transform("evidence", lambda e: e["phrases"])), F.col("is_gagas"), F.col("has_single_audit"))
    gate = F.when(~F.col("extraction_gate"), "extraction_gate").when(F.size("failed") > 0, "evidence_not_found").when(F.col("review_confidence") < pairs.REVIEW, "review_confidence").otherwise(final)
    return out.withColumn("gate", gate).select("pair_id", "doc_id", "file_name", "client_type", "pair_type", "fields_missing", "fields_present", "extraction_confidence", "review_confidence", "is_gagas", "has_single_audit", "messages", "pair_hash", "fingerprint", "gate")
