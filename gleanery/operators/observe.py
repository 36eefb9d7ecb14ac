"""Reports over pair datasets: snapshots, drift, balance, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.scoring import confidence_bucket


def snapshot(pairs: DataFrame) -> DataFrame:
    """(dimension, value, n, share): counts by client type, pair type, stage and confidence bucket in one pass, by grouping sets."""
    rows = pairs.select(*[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in ("client_type", "pair_type", "stage")], confidence_bucket(F.coalesce("extraction_confidence", F.lit(0.0))).alias("confidence"))
    dims = ("client_type", "pair_type", "stage", "confidence")
    sets = rows.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    which = F.element_at(F.array(*[F.lit(d) for d in dims]), (F.lit(4) - F.bit_count(F.lit(0)) - F.floor(F.log2(F.lit(15) - F.col("g")))).cast("int"))
    out = sets.select(which.alias("dimension"), F.coalesce(*dims).alias("value"), "n")
    return out.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("dimension")), 4))


def field_frequency(pairs: DataFrame, missing: str = "fields_missing") -> DataFrame:
    """(field, n): in how many pairs a field is missing, without regard to case."""
    return pairs.select(F.explode(missing).alias("field")).groupBy(F.lower("field").alias("field")).agg(F.count("*").alias("n"))


def rare_combinations(pairs: DataFrame, below: int = 3, most: int = 10, missing: str = "fields_missing") -> DataFrame:
    """The rarest sets of missing fields, seen fewer than `below` times."""
    combo = F.array_join(F.array_sort(F.transform(missing, F.lower)), "|")
    return pairs.where(F.size(missing) > 0).groupBy(combo.alias("combination")).agg(F.count("*").alias("n")).where(F.col("n") < below).orderBy("n", "combination").limit(most)


def never_missing(pairs: DataFrame, tier1: DataFrame, least: int = 1, missing: str = "fields_missing") -> DataFrame:
    """Tier-1 fields that are missing in fewer than `least` pairs."""
    seen = field_frequency(pairs, missing)
    return tier1.select(F.lower("field").alias("field")).join(seen, "field", "left").where(F.coalesce("n", F.lit(0)) < least).select("field")


def severities_used(completions: DataFrame, text: str = "text") -> DataFrame:
    """(severity, n): completions that name each severity, those never named with 0."""
    names = ("High", "Medium", "Low", "Informational")
    hit = lambda s: F.count_if(F.col(text).rlike(rf"(?i)Severity:\s*{s}")).alias(s)
    return completions.agg(*[hit(s) for s in names]).select(F.explode(F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s).alias("n")) for s in names])).alias("x")).select("x.*")


def distribution_delta(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """(value, delta): actual less expected share of expected(value, share); counts(value, n)."""
    total = counts.agg(F.sum("n").alias("t"))
    return expected.join(counts, "value", "left").join(F.broadcast(total)).select("value", F.round(F.coalesce(F.col("n") / F.col("t"), F.lit(0.0)) - F.col("share"), 4).alias("delta"))


def _numbered(entries: DataFrame, at: str, pos: str, last: int) -> DataFrame:
    """The last entries by time: a top-k, so that no task sorts all."""
    return entries.orderBy(F.desc(at), F.desc(pos)).limit(last)


def drift(entries: DataFrame, by: str, at: str = "added_at", pos: str = "pos", window: int = 20) -> DataFrame:
    """(value, overall, recent, delta): the share of each value over all and over the last `window` entries."""
    share = lambda df, name: df.groupBy(F.coalesce(F.col(by), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n")).withColumn(name, F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4)).drop("n")
    both = share(entries, "overall").join(share(_numbered(entries, at, pos, window), "recent"), "value", "full")
    both = both.select("value", F.coalesce("overall", F.lit(0.0)).alias("overall"), F.coalesce("recent", F.lit(0.0)).alias("recent"))
    return both.withColumn("delta", F.round(F.col("recent") - F.col("overall"), 4))


def drift_status(entries: DataFrame, by: str, at: str = "added_at", pos: str = "pos", window: int = 20, most: float = 0.20) -> DataFrame:
    """(total, status): insufficient_data below two windows of entries, drifting if a share moved by more than `most`, else stable."""
    d = drift(entries, by, at, pos, window).agg(F.coalesce(F.max(F.abs("delta")), F.lit(0.0)).alias("d"))
    total = entries.agg(F.count("*").alias("total"))
    status = F.when(F.col("total") < 2 * window, "insufficient_data").when(F.col("d") > most, "drifting").otherwise("stable")
    return total.join(F.broadcast(d)).select("total", status.alias("status"))


def balance(rows: DataFrame, by: str, most: float = 0.40) -> DataFrame:
    """(value, n, share, over): over where a value has more than `most` of the rows."""
    out = rows.groupBy(F.coalesce(F.col(by), F.lit("(missing)")).alias("value")).agg(F.count("*").alias("n"))
    out = out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return out.select("value", "n", F.round("share", 4).alias("share"), (F.col("share") > most).alias("over"))


def sampling_coverage(combinations: DataFrame, fields: DataFrame, col: str = "fields") -> DataFrame:
    """(field, n, state): how often each field of fields(field) was drawn; under below half the mean of the drawn ones, over beyond twice."""
    counts = combinations.select(F.explode(col).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    mean = counts.agg(F.avg("n").alias("mean"))
    out = fields.select("field").join(counts, "field", "left").withColumn("n", F.coalesce("n", F.lit(0))).join(F.broadcast(mean))
    state = F.when(F.col("n") < F.col("mean") * 0.5, "under").when(F.col("n") > F.col("mean") * 2, "over").otherwise("even")
    return out.select("field", "n", state.alias("state"))


def pool_coverage(fields: DataFrame) -> DataFrame:
    """(eligible, total, coverage) of fields(eligible boolean)."""
    n = F.count("*")
    return fields.agg(F.count_if("eligible").alias("eligible"), n.alias("total"), F.when(n > 0, F.round(F.count_if("eligible") / n, 4)).otherwise(0.0).alias("coverage"))


def index_stats(index: DataFrame) -> DataFrame:
    """(dimension, value, n) of a fingerprint index by client type and pair type."""
    x = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d), F.lit("unknown")).alias("value")) for d in ("client_type", "pair_type")])).alias("x")
    return index.select(x).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def rates(reviews: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, sign_off, mean_score, hallucination) of reviews(keys, approved, score, hallucinated)."""
    n = F.count("*")
    return reviews.groupBy(*keys).agg(n.alias("n"), F.round(F.count_if("approved") / n, 4).alias("sign_off"), F.round(F.avg("score"), 4).alias("mean_score"), F.round(F.count_if("hallucinated") / n, 4).alias("hallucination"))


def rolling_rates(events: DataFrame, at: str, days: int = 7, slide: int = 1) -> DataFrame:
    """(start, n, mean) of events(at, value) over sliding windows of days."""
    return events.groupBy(F.window(at, f"{days} days", f"{slide} days").alias("w")).agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").alias("start"), "n", "mean")


def monthly_confusion(results: DataFrame, engagements: DataFrame, key: str = "engagement_id", at: str = "at") -> DataFrame:
    """(month, n, confused) of results(key, at, framework): how many name a framework that isn't the engagement's."""
    e = engagements.select(key, F.col("framework").alias("__f"))
    joined = results.join(e, key)
    return joined.groupBy(F.date_format(F.date_trunc("month", at), "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(F.col("framework") != F.col("__f")).alias("confused"))
