"""Review queues as logs of events: latest states, transitions, statistics. Nothing is rewritten; the state is a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# States of a queued pair.
STATUSES = ("pending", "approved", "conditional", "correction", "rejected")
ACTIONS = {"approve": "approved", "conditional_approve": "conditional", "send_for_correction": "correction", "reject": "rejected"}


def states(events: DataFrame, key: str = "pair_hash") -> DataFrame:
    """(key, status, reviewer, notes, hint, queued_at, reviewed_at, refused) from events(key, pos, at, action, reviewer, notes, hint).

    `enqueue` makes an entry pending; only a pending entry takes a decision, so the first valid one after each enqueue
    counts, and a correction without a hint is no valid one. refused counts events that had no effect.
    """
    w = Window.partitionBy(key).orderBy("pos")
    valid = F.col("action").isin(*ACTIONS) & ~((F.col("action") == "send_for_correction") & (F.coalesce(F.trim("hint"), F.lit("")) == ""))
    rounds = events.withColumn("__r", F.sum((F.col("action") == "enqueue").cast("int")).over(w)).withColumn("__ok", valid)
    per = rounds.groupBy(key, "__r").agg(F.min_by("at", "pos").alias("queued_at"), F.min_by(F.struct("action", "reviewer", "notes", "hint", "at"), F.when(F.col("__ok"), F.col("pos"))).alias("d"), F.count_if("__ok").alias("n_ok"), F.count_if((F.col("action") != "enqueue") & ~F.col("__ok")).alias("n_bad"))
    status = F.when(F.col("d").isNull(), "pending")
    for a, s in ACTIONS.items():
        status = status.when(F.col("d.action") == a, s)
    refused = F.when(F.col("__r") == 0, F.col("n_ok") + F.col("n_bad")).otherwise(F.greatest(F.col("n_ok") - 1, F.lit(0)) + F.col("n_bad"))
    per = per.withColumn("status", status).withColumn("refused", refused)
    last = F.max_by(F.struct("status", "d", "queued_at"), "__r")
    out = per.groupBy(key).agg(last.alias("l"), F.sum("refused").alias("refused"), F.max("__r").alias("__m")).where("__m > 0")
    return out.select(key, "l.status", "l.d.reviewer", "l.d.notes", "l.d.hint", "l.queued_at", F.col("l.d.at").alias("reviewed_at"), "refused")


def pending(queue: DataFrame) -> DataFrame:
    return queue.where("status = 'pending'")


def edited(queue: DataFrame, edits: DataFrame, key: str = "pair_hash") -> DataFrame:
    """queue with the latest completion of edits(key, pos, completion), and whether there is one. Hashes stay as they were queued."""
    last = edits.groupBy(key).agg(F.max_by("completion", "pos").alias("__c"), F.lit(True).alias("__e"))
    out = queue.join(last, key, "left")
    return out.withColumn("completion", F.coalesce("__c", "completion")).withColumn("edited", F.coalesce("__e", F.lit(False))).drop("__c", "__e")


def chosen(fields: DataFrame, **wanted: list[str]) -> DataFrame:
    """The rows whose columns hold one of the wanted values each; an empty list lets all through."""
    for column, values in wanted.items():
        if values:
            fields = fields.where(F.col(column).isin(*values))
    return fields


def exportable(queue: DataFrame, statuses: tuple[str, ...] = ("approved",)) -> DataFrame:
    return queue.where(F.col("status").isin(*statuses))


def stats(queue: DataFrame, *by: str) -> DataFrame:
    """A row for each value of `by`, a column for each status, in one pass."""
    return queue.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def record_stats(queue: DataFrame) -> DataFrame:
    """(total, corrected, pending, mean_confidence) of a text-typed queue(corrected, confidence); confidences that don't parse are left out of the mean."""
    done = F.lower(F.trim("corrected")) == "true"
    return queue.agg(F.count("*").alias("total"), F.count_if(done).alias("corrected"), F.count_if(~F.coalesce(done, F.lit(False))).alias("pending"), F.round(F.avg(F.col("confidence").try_cast("double")), 4).alias("mean_confidence"))


def marked_corrected(queue: DataFrame, fixes: DataFrame, key: str = "file_hash", pos: str = "pos") -> DataFrame:
    """queue with the newest uncorrected row of each key in fixes(key, reviewer) marked corrected."""
    w = Window.partitionBy(key).orderBy(F.desc(pos))
    open_ = F.lower(F.trim("corrected")) != "true"
    newest = queue.where(open_).withColumn("__n", F.row_number().over(w)).where("__n = 1").join(fixes.select(key, F.col("reviewer").alias("__by")), key).select(key, pos, "__by")
    out = queue.join(newest, [key, pos], "left")
    return out.withColumn("corrected", F.when(F.col("__by").isNotNull(), "true").otherwise(F.col("corrected"))).withColumn("reviewer", F.coalesce("__by", "reviewer")).drop("__by")


def score_means(queue: DataFrame) -> DataFrame:
    """Mean review score of all, of approved and conditional, and of pending entries."""
    mean = lambda cond, name: F.round(F.avg(F.when(cond, F.col("score"))), 4).alias(name)
    return queue.agg(mean(F.lit(True), "all"), mean(F.col("status").isin("approved", "conditional"), "accepted"), mean(F.col("status") == "pending", "pending"))
