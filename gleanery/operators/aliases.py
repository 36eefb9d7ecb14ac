"""Aliases of field names: resolution, proposals, blocked labels, versions, merge gates, suggestion log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.keys import next_version, version_key
from gleanery.functions.likeness import weighted
from gleanery.operators.sizes import blocks, listed, small
from gleanery.shipping import ship


def alias_map(aliases: DataFrame) -> DataFrame:
    """(variant, canonical) from aliases(canonical, variant, pos): lower-cased and trimmed, the last of equal variants."""
    return aliases.groupBy(F.lower(F.trim("variant")).alias("variant")).agg(F.max_by("canonical", "pos").alias("canonical"))


def resolved(labels: DataFrame, aliases: DataFrame, label: str = "label") -> DataFrame:
    """labels with `canonical` (null if unknown) and `field`, which is the label itself then. aliases are broadcast while they are few."""
    names = alias_map(aliases).withColumnRenamed("variant", "__v")
    out = labels.join(small(names), F.lower(F.trim(F.col(label))) == F.col("__v"), "left").drop("__v")
    return out.withColumn("field", F.coalesce("canonical", label))


def longest_contained(texts: DataFrame, aliases: DataFrame, key: str, text: str = "text", least: int = 3) -> DataFrame:
    """(key, canonical, variant): the longest variant of `least` letters or more that a text contains, the first by name among equals; texts without one left out. Each text is held against an array of all variants, so the texts are neither joined nor shuffled; of more variants than one array may hold, the best of several arrays are shuffled by key."""
    names = alias_map(aliases).where(F.length("variant") >= least)
    found = [_longest_in(texts, part, key, text) for part in listed(names, "variant", F.struct((-F.length("variant")).alias("l"), "variant", "canonical"), "__a")]
    if len(found) == 1:
        return found[0]
    best = F.min_by(F.struct("canonical", "variant"), F.struct((-F.length("variant")).alias("l"), "variant"))
    return reduce(DataFrame.unionByName, found).groupBy(key).agg(best.alias("b")).select(key, "b.canonical", "b.variant")


def _longest_in(texts: DataFrame, variants: DataFrame, key: str, text: str) -> DataFrame:
    hit = F.filter("__a", lambda a: F.instr(F.col("__low"), a["variant"]) > 0)[0]
    held = texts.withColumn("__low", F.lower(text)).join(variants).withColumn("__hit", F.when(F.exists("__a", lambda a: F.instr(F.col("__low"), a["variant"]) > 0), hit))  # variants is one row
    return held.where("__hit IS NOT NULL").select(key, F.col("__hit.canonical").alias("canonical"), F.col("__hit.variant").alias("variant"))


def mentions(texts: DataFrame, aliases: DataFrame, key: str, text: str = "text", least: int = 3) -> DataFrame:
    """(key, canonical) for each field of which a text has any alias."""
    names = alias_map(aliases).where(F.length("variant") >= least)
    found = F.array_distinct(F.transform(F.filter("__a", lambda a: F.instr(F.col("__low"), a["variant"]) > 0), lambda a: a["canonical"]))
    hits = [texts.withColumn("__low", F.lower(text)).join(part).select(key, F.explode(found).alias("canonical")) for part in listed(names, "variant", F.struct("variant", "canonical"), "__a")]
    return hits[0] if len(hits) == 1 else reduce(DataFrame.unionByName, hits).distinct()


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def token_sorted(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(c), r"\s+")), " ")


def proposals(labels: DataFrame, aliases: DataFrame, rejected: DataFrame, label: str = "label", auto: float = 0.90, floor: float = 0.75, weight: float = 0.80, by_edits: bool = False) -> DataFrame:
    """(label, canonical, variant, score, effective, bucket): the likest variant of each distinct label, from `floor` on; the first variant by name wins ties. Rejected pairs (label, canonical) are for manual review; a proposal never renames a field.

    The score is the weighted ratio of `functions/likeness.py`; labels meet all variants then, in blocks. by_edits takes
    the better of the plain and the word-sorted edit similarity instead, which stays in the JVM and meets only variants
    of a length near the label's.
    """
    names = alias_map(aliases)
    own = labels.select(F.col(label).alias("label")).distinct().withColumn("__l", F.lower(F.trim("label")))
    if by_edits:
        score = F.greatest(similarity(F.col("__l"), F.col("variant")), similarity(token_sorted(F.col("__l")), token_sorted(F.col("variant"))) * 0.95)
        lengths = F.sequence(F.ceil(F.length("__l") * floor).cast("int"), F.floor(F.length("__l") / floor).cast("int"))  # those beyond differ by too many letters
        met = own.withColumn("__n", F.explode(lengths)).join(small(names.withColumn("__n", F.length("variant"))), "__n").withColumn("score", score)
    else:
        ship(labels.sparkSession)
        met = reduce(DataFrame.unionByName, [own.join(part) for part in blocks(names, "variant", 200)]).withColumn("score", weighted(F.col("__l"), F.col("variant")))
    best = F.min_by(F.struct("canonical", "variant", "score"), F.struct(F.negative("score").alias("s"), "variant"))
    found = met.where(F.col("score") >= floor).groupBy("label", "__l").agg(best.alias("b")).select("label", "__l", "b.canonical", "b.variant", "b.score")
    known = rejected.select(F.lower(F.trim("label")).alias("__l"), "canonical", F.lit(True).alias("__no")).distinct()
    out = found.join(small(known), ["__l", "canonical"], "left")
    bucket = F.when(F.col("__no"), "manual_review").when(F.col("score") >= auto, "high_confidence").otherwise("quick_confirm")
    return out.select("label", "canonical", "variant", F.round("score", 4).alias("score"), F.round(F.col("score") * weight, 4).alias("effective"), bucket.alias("bucket"))


def best_unit(matches: DataFrame) -> DataFrame:
    """The best match of each label over its units (label, unit_pos, effective, ...): the first of the highest."""
    w = Window.partitionBy("label").orderBy(F.desc("effective"), "unit_pos")
    return matches.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def is_blocked(label: Column, exact: list[str], patterns: list[str]) -> Column:
    """Whether a label is noise: one of `exact`, or wholly matched by a pattern."""
    out = label.isin(*exact) if exact else F.lit(False)
    for p in patterns:
        out = out | label.rlike(rf"\A(?:{p})\z")
    return out


def merge_gate(entries: DataFrame, known: DataFrame, rejected: DataFrame, aliases: DataFrame, exact: list[str], patterns: list[str]) -> DataFrame:
    """entries(label, canonical, ...) with `gate`, the first that stops it or `pass`: unknown field, blocked label, mapping rejected before, label already an alias of another field."""
    low = F.lower(F.trim("label"))
    out = entries.withColumn("__l", low)
    out = out.join(small(known.select("canonical", F.lit(True).alias("__k")).distinct()), "canonical", "left")
    out = out.join(small(rejected.select(F.lower(F.trim("label")).alias("__l"), "canonical", F.lit(True).alias("__r")).distinct()), ["__l", "canonical"], "left")
    others = aliases.select(F.lower(F.trim("variant")).alias("__l"), F.col("canonical").alias("__c")).distinct().groupBy("__l").agg(F.collect_set("__c").alias("__cs"))
    out = out.join(small(others), "__l", "left")
    blocked_exact = F.col("__l").isin(*exact) if exact else F.lit(False)
    conflict = F.coalesce(F.size(F.array_except("__cs", F.array("canonical"))) > 0, F.lit(False))
    gate = (
        F.when(F.col("__k").isNull(), "unknown_canonical")
        .when(blocked_exact, "blocked_exact")
        .when(is_blocked(F.col("__l"), [], patterns), "blocked_pattern")
        .when(F.col("__r"), "previously_rejected")
        .when(conflict, "alias_conflict")
        .otherwise("pass")
    )
    return out.withColumn("gate", gate).drop("__l", "__k", "__r", "__cs")


def precision(gold: DataFrame, aliases: DataFrame) -> DataFrame:
    """(n, correct, precision) of gold(label, canonical); 1 if there is none."""
    names = alias_map(aliases).select(F.col("variant").alias("__v"), F.col("canonical").alias("__c"))
    joined = gold.join(small(names), F.lower(F.trim("label")) == F.col("__v"), "left")
    n, ok = F.count("*"), F.count_if(F.col("__c") == F.col("canonical"))
    return joined.agg(n.alias("n"), ok.alias("correct"), F.when(n == 0, 1.0).otherwise(F.round(ok / n, 4)).alias("precision"))


def merged(aliases: DataFrame, pending: DataFrame, gate: DataFrame, most: int = 50) -> DataFrame:
    """aliases with the first `most` pending entries that pass all gates, each (canonical, variant) once without regard to case. gate is merge_gate() of pending, with pos."""
    new = gate.where("gate = 'pass'").orderBy("pos").limit(most).select("canonical", F.col("label").alias("variant"), "pos")
    have = aliases.select("canonical", F.lower(F.trim("variant")).alias("__l"))
    fresh = new.withColumn("__l", F.lower(F.trim("variant"))).join(have, ["canonical", "__l"], "left_anti").dropDuplicates(["canonical", "__l"]).drop("__l")
    return aliases.select("canonical", "variant", "pos").unionByName(fresh)


def merge_allowed(before: float, after: float, floor: float = 0.85, override: bool = False) -> bool:
    """A merge is stopped only if the precision after it is below the floor and below that before it, without an override."""
    return override or not (after < floor and after < before)


def changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """(change, canonical, variant): what version b added to a and removed from it."""
    pair = lambda df: df.select("canonical", F.lower("variant").alias("variant"))
    added, removed = pair(b).exceptAll(pair(a)).distinct().join(pair(a).distinct(), ["canonical", "variant"], "left_anti"), pair(a).distinct().join(pair(b).distinct(), ["canonical", "variant"], "left_anti")
    return added.select(F.lit("added").alias("change"), "canonical", "variant").unionAll(removed.select(F.lit("removed").alias("change"), "canonical", "variant"))


def threshold_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(key, before, after) of the settings (key, value) that differ."""
    both = a.select("key", F.col("value").alias("before")).join(b.select("key", F.col("value").alias("after")), "key", "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def versions(log: DataFrame) -> DataFrame:
    """log(version, ...) in the order of versions as numbers, with `next`, the minor version after each."""
    return log.orderBy(version_key(F.col("version"))).withColumn("next", next_version(F.col("version")))


def rolled_back(history: DataFrame, target: str) -> DataFrame:
    """The rows of version `target` as a new version after the last of history(version, canonical, variant, pos); nothing is overwritten."""
    newest = history.agg(F.max_by("version", version_key(F.col("version"))).alias("v")).select(next_version(F.col("v")).alias("__v"))
    return history.where(F.col("version") == target).join(F.broadcast(newest)).withColumn("version", F.col("__v")).drop("__v")


def suggestion_log(seen: DataFrame) -> DataFrame:
    """(label, seen_count, first_seen, last_seen, value, status): unknown labels from seen(label, value, at, status), without regard to case; the first value that isn't empty; the latest status."""
    key = F.lower(F.trim("label"))
    return seen.groupBy(key.alias("label")).agg(F.count("*").alias("seen_count"), F.min("at").alias("first_seen"), F.max("at").alias("last_seen"), F.min_by("value", F.when(F.coalesce(F.col("value"), F.lit("")) != "", F.col("at"))).alias("value"), F.max_by("status", "at").alias("status"))


def coverage(log: DataFrame) -> DataFrame:
    """(total, approved, rejected, pending, coverage): the approved share in percent."""
    n = F.count("*")
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return log.agg(n.alias("total"), count("approved"), count("rejected"), count("pending"), F.when(n == 0, 0.0).otherwise(F.round(F.count_if(F.col("status") == "approved") * 100 / n, 1)).alias("coverage"))


def version_health(changes: DataFrame) -> DataFrame:
    """(versions, rollbacks, largest, drops) from changes(version, action, added, precision_before, precision_after)."""
    return changes.agg(F.count("*").alias("versions"), F.count_if(F.col("action") == "rollback").alias("rollbacks"), F.max_by("version", F.struct(F.col("added"), F.transform(version_key(F.col("version")), lambda x: -x))).alias("largest"), F.count_if(F.col("precision_after") < F.col("precision_before")).alias("drops"))


def decided(log: DataFrame, decisions: DataFrame) -> DataFrame:
    """A suggestion log with the latest of decisions(label, canonical, decision, reviewer, at) for each label: status, canonical and reviewer."""
    last = decisions.groupBy(F.lower(F.trim("label")).alias("label")).agg(F.max_by(F.struct("canonical", "decision", "reviewer"), "at").alias("d"))
    out = log.join(last, "label", "left")
    return out.withColumn("status", F.coalesce("d.decision", "status")).withColumn("canonical", F.col("d.canonical")).withColumn("reviewer", F.col("d.reviewer")).drop("d")


def pending_proposals(found: DataFrame, pending: DataFrame, exact: list[str], patterns: list[str]) -> DataFrame:
    """Proposals (label, canonical, ...) to be queued: not blocked, each label and field once, not pending yet."""
    fresh = found.where(~is_blocked(F.lower(F.trim("label")), exact, patterns)).withColumn("__l", F.lower(F.trim("label"))).dropDuplicates(["__l", "canonical"])
    return fresh.join(pending.select(F.lower(F.trim("label")).alias("__l"), "canonical"), ["__l", "canonical"], "left_anti").drop("__l")
