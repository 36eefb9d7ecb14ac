"""Agreement scores of several extractors, record scores by tier, calibration, completion scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import comparable, is_empty

# Weights of the tiers, and the least record score by the number of tier-1 fields found.
TIER_WEIGHTS = (0.70, 0.30)
FLOORS = ((8, 0.82), (7, 0.75), (5, 0.65), (3, 0.55))
EXTRACTION_GATE, QUALITY_GATE = 0.50, 0.70


def slot_score(a: Column, b: Column, c: Column) -> Column:
    """Agreement of up to three extractors on one value; null: it did not run, empty: it found nothing."""
    slots = [(x.isNotNull(), comparable(x), is_empty(x)) for x in (a, b, c)]
    ran = sum((r.cast("int") for r, _, _ in slots[1:]), slots[0][0].cast("int"))
    (ra, na, ea), (rb, nb, eb), (rc, nc, ec) = slots
    all_empty = (~ra | ea) & (~rb | eb) & (~rc | ec)
    equal_two = F.when(~ra, nb == nc).when(~rb, na == nc).otherwise(na == nb)
    equal_some = (na == nb) | (nb == nc) | (na == nc)
    return (
        F.when((ran == 0) | all_empty, 0.0)
        .when(ran == 1, 0.6)
        .when(ran == 2, F.when(equal_two, 0.9).otherwise(0.3))
        .when((na == nb) & (nb == nc), 1.0)
        .when(equal_some, 0.7)
        .otherwise(0.2)
    )


def record_scores(scores: DataFrame, tiers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, aggregate, t1_found, t2_found, floor_found, extraction_gate, quality_gate) from scores(key, field, score) and tiers(field, tier, exempt).

    An exempt field counts 1 where its score is 0 or missing. Records come from scores; a field outside the tiers
    plays no part. tiers is a table of some dozen rows and is broadcast.
    """
    named = scores.join(F.broadcast(tiers), "field", "left")
    effective = F.when(F.col("exempt") & (F.col("score") == 0), 1.0).otherwise(F.col("score"))
    per = named.withColumn("e", effective)
    aggs = [F.count("*").alias("rows")]
    for t in (1, 2):
        own = F.col("tier") == t
        aggs += [F.coalesce(F.sum(F.when(own, F.col("e"))), F.lit(0.0)).alias(f"sum{t}"), F.count_if(own & (F.col("e") > 0)).alias(f"found{t}"), F.count_if(own & F.col("exempt")).alias(f"seen{t}")]
    per = per.groupBy(key).agg(*aggs)
    totals = tiers.agg(*[F.count_if(F.col("tier") == t).alias(f"n{t}") for t in (1, 2)], *[F.count_if((F.col("tier") == t) & F.col("exempt")).alias(f"x{t}") for t in (1, 2)])
    out = per.join(F.broadcast(totals))  # totals is one row
    for t in (1, 2):  # exempt fields without a row count as found
        out = out.withColumn(f"sum{t}", F.col(f"sum{t}") + F.col(f"x{t}") - F.col(f"seen{t}")).withColumn(f"found{t}", F.col(f"found{t}") + F.col(f"x{t}") - F.col(f"seen{t}"))
    part = lambda t: F.when(F.col(f"n{t}") > 0, F.col(f"sum{t}") / F.col(f"n{t}") * TIER_WEIGHTS[t - 1]).otherwise(0.0)
    floor = F.lit(0.0)
    for n, value in reversed(FLOORS):
        floor = F.when(F.col("found1") >= n, value).otherwise(floor)
    aggregate = F.round(F.least(F.greatest(part(1) + part(2), floor), F.lit(1.0)), 4)
    return out.withColumn("aggregate", aggregate).select(key, "aggregate", F.col("found1").alias("t1_found"), F.col("found2").alias("t2_found"), floor.alias("floor"), (F.col("aggregate") >= EXTRACTION_GATE).alias("extraction_gate"), (F.col("aggregate") >= QUALITY_GATE).alias("quality_gate"))


def field_lists(scores: DataFrame, key: str = "doc_id", low: float = QUALITY_GATE) -> DataFrame:
    """(key, present, missing, low): sorted names of the fields with a score, without one, and with one below `low`."""
    named = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("field"))))
    s = F.col("score")
    return scores.groupBy(key).agg(named(s > 0).alias("present"), named(s == 0).alias("missing"), named((s > 0) & (s < low)).alias("low"))


def calibrated(score: Column, a: Column, b: Column, llm: Column, found: Column, confident: Column, tier1: Column) -> tuple[Column, Column]:
    """(score, contradicts) of a field that a model filled: alone .65, or with a value of the deterministic slots .85, .05 more if it is confident; alone in tier 1 at most .72; against them the score stays and it is flagged."""
    na, nb, nl = comparable(a), comparable(b), comparable(llm)
    some = (na != "") | (nb != "")
    agrees = llm.isNotNull() & (((na != "") & (nl == na)) | ((nb != "") & (nl == nb)))
    bonus = F.when(confident, 0.05).otherwise(0.0)
    alone = F.lit(0.65) + bonus
    alone = F.when(tier1, F.least(alone, F.lit(0.72))).otherwise(alone)
    value = F.when(~found, score).when(~some, F.round(alone, 4)).when(agrees, F.round(F.lit(0.85) + bonus, 4)).otherwise(score)
    return value, found & some & ~agrees


def flagged_fields(slots: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, flagged): sorted names of the fields that only a model filled, are of tier 1 below .70, or went to a model. slots: (key, field, val_a, val_b, val_c, score, tier, asked_model)."""
    only = F.col("val_a").isNull() & F.col("val_b").isNull() & F.col("val_c").isNotNull()
    weak = (F.col("tier") == 1) & (F.coalesce("score", F.lit(0.0)) < 0.70)
    return slots.groupBy(key).agg(F.array_sort(F.collect_set(F.when(only | weak | F.col("asked_model"), F.col("field")))).alias("flagged"))


def needs_model(slots: DataFrame) -> DataFrame:
    """The rows of tier 1 and 2 on which the two deterministic slots agree to less than .70."""
    return slots.where(F.col("tier").isin(1, 2) & (slot_score(F.col("val_a"), F.col("val_b"), F.lit(None).cast("string")) < 0.70))


def ocr_blend(aggregate: Column, ocr: Column) -> Column:
    return F.round(F.lit(0.6) * aggregate + F.lit(0.4) * ocr, 4)


def confidence_bucket(c: Column) -> Column:
    return F.when(c < 0.55, "<0.55").when(c < 0.65, "0.55-0.65").when(c < 0.75, "0.65-0.75").when(c < 0.85, "0.75-0.85").otherwise(">=0.85")


def prose_confidence(hits: Column) -> Column:
    return F.when(hits >= 3, 0.9).when(hits == 2, 0.8).when(hits == 1, 0.7).otherwise(0.0)


# What a completion's rubric weighs, and the sections that it must have.
RUBRIC = {"sections": 0.30, "citations": 0.20, "severity": 0.20, "client": 0.20, "clean": 0.10}
SECTIONS = ("ENGAGEMENT TYPE:", "FINDINGS:", "RECOMMENDATION:")
PLACEHOLDERS = r"(?i)§X\.X|\[Finding label\]|REQUIRES MANUAL COMPLETION|\[add more findings|field X missing|ensure field completed"
CITATION = r"(?i)(?:SOP[\w-]*\s+)?§\s*[A-Za-z0-9]+(?:[.\-][A-Za-z0-9]+)*(?:\([^)]*\))?"


def rubric(completion: Column, findings: Column, client_type: Column) -> Column:
    """0 to 1 from counts over the completion's text; without numbered lines citations and severities count only if no finding was expected."""
    lines = F.regexp_count(completion, F.lit(r"(?m)^\s*\d+\.\s+.+"))
    sections = sum((completion.contains(s).cast("int") for s in SECTIONS[1:]), completion.contains(SECTIONS[0]).cast("int"))
    share = lambda n: F.when(lines > 0, F.least(n / lines, F.lit(1.0))).when(findings == 0, 1.0).otherwise(0.0)
    advice = F.trim(F.regexp_extract(completion, r"(?is)RECOMMENDATION:\s*(.+)\z", 1))
    client = F.when((client_type != "") & (F.instr(F.lower(advice), F.lower(client_type)) > 0), 1.0).when(advice != "", 0.5).otherwise(0.0)
    total = RUBRIC["sections"] * sections / len(SECTIONS) + RUBRIC["citations"] * share(F.regexp_count(completion, F.lit(CITATION)))
    total = total + RUBRIC["severity"] * share(F.regexp_count(completion, F.lit(r"(?i)Severity:\s*(High|Medium|Low|Informational)"))) + RUBRIC["client"] * client
    total = total + F.when(completion.rlike(PLACEHOLDERS), 0.0).otherwise(RUBRIC["clean"])
    return F.round(F.least(total, F.lit(1.0)), 4)


def completion_score(rubric_: Column, grounding: Column, hallucinated: Column, misanchored: Column, fixed_admin: Column, coverage_gap: Column, tier1_missing: Column, least: float = 0.70, span: float = 0.30, penalties: tuple[float, float, float, float] = (0.15, 0.10, 0.03, 0.08), most: float = 0.20) -> Column:
    """The rubric times its grounding, less penalties for claims and gaps, which take at most the fraction `most` of it."""
    grounded = rubric_ * (least + grounding * span)
    taken = hallucinated * penalties[0] + misanchored * penalties[1] + fixed_admin * penalties[2] + coverage_gap * tier1_missing * penalties[3]
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), grounded - F.least(taken, grounded * most))), 4)


def classified_score(rubric_: Column, tier1_uncertain: Column, tier2_uncertain: Column, rejection_rate: Column, valid: Column, floor: float = 0.35) -> Column:
    """The rubric less .05 for each uncertain tier-2 field, up to .15 for rejected labels and .20 for a broken structure; any uncertain tier-1 field makes it `floor`."""
    taken = tier2_uncertain * 0.05 + F.least(rejection_rate * 0.10, F.lit(0.15)) + F.when(valid, 0.0).otherwise(0.20)
    return F.when(tier1_uncertain > 0, floor).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), rubric_ - taken)), 4))


def rated(ratings: DataFrame) -> DataFrame:
    """Agreement of two raters: (n, agreement, kappa, pearson) of ratings(a, b)."""
    pairs = ratings.groupBy("a", "b").count()
    n = F.sum("count")
    base = pairs.agg(n.alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("count")).otherwise(0)).alias("same"))
    left, right = pairs.groupBy(F.col("a").alias("v")).agg(n.alias("l")), pairs.groupBy(F.col("b").alias("v")).agg(n.alias("r"))
    chance = left.join(right, "v").agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("chance"))
    po, pe = F.col("same") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    kappa = F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(1.0)
    return base.join(F.broadcast(chance)).join(F.broadcast(ratings.agg(F.corr("a", "b").alias("pearson")))).select("n", F.round(po, 4).alias("agreement"), F.round(kappa, 4).alias("kappa"), F.round("pearson", 4).alias("pearson"))


def ocr_confidence(words: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, words, confidence, status): the mean of words(key, confidence 0 to 100) with a confidence above 0, as a share; success from .70, partial from .40."""
    mean = F.avg(F.when(F.col("confidence") > 0, F.col("confidence"))) / 100
    out = words.groupBy(key).agg(F.count_if(F.col("confidence") > 0).alias("words"), F.round(F.coalesce(mean, F.lit(0.0)), 4).alias("confidence"))
    return out.withColumn("status", F.when(F.col("confidence") >= 0.70, "success").when(F.col("confidence") >= 0.40, "partial").otherwise("failed"))


def audit_type(given: Column, gagas: Column, gaas: Column, single: Column) -> Column:
    """The given type, or one made from the scopes that are ticked; null without any."""
    yes = lambda c: F.lower(c).isin("yes", "true")
    parts = F.array_compact(F.array(F.when(yes(gagas), "GAGAS Audit").when(yes(gaas), "Financial Statement Audit"), F.when(yes(single), F.lit("Single Audit"))))
    return F.coalesce(F.when(given != "", given), F.when(F.size(parts) > 0, F.array_join(parts, " / ")))


def extraction_method(secondary: Column, tiebreaker: Column, fallback: Column, primary: Column) -> Column:
    return F.when(fallback, F.when(secondary | tiebreaker, "hybrid").otherwise("llm_fallback")).when(tiebreaker, "llm").otherwise(primary)


def benchmark_summary(results: DataFrame, extraction: float = 0.65, review: float = 0.75) -> DataFrame:
    """(n, extraction_passed, review_passed, extraction_mean, review_mean) of results(extraction, review) against targets."""
    e, r = F.col("extraction"), F.col("review")
    return results.agg(F.count("*").alias("n"), F.count_if(e >= extraction).alias("extraction_passed"), F.count_if(r >= review).alias("review_passed"), F.round(F.avg(e), 4).alias("extraction_mean"), F.round(F.avg(r), 4).alias("review_mean"))
