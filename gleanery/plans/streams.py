"""Queries that run streams over files in the shared folder to their end, twice where a second run must go on from the first."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanery.plans.registry import query
from gleanery.shipping import ship
from gleanery.sources import scratch
from gleanery.streaming import intake


def _run(rows, path: str, mode: str = "append"):
    """Runs to the end and returns what was written."""
    done = intake.run_available(rows, f"{path}/out", f"{path}/state", mode=mode)
    done.awaitTermination()
    if done.exception():
        raise done.exception()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/out")


@query("SELECT CASE WHEN e THEN 'first' ELSE 'second' END AS run, count(*) AS n FROM (SELECT sha256(text) AS h, bool_or(doc_id % 2 = 0) AS e FROM documents WHERE text IS NOT NULL GROUP BY 1) GROUP BY 1")
def stream_intake(t):
    """Texts that come in two loads: each counts once, in the first load that has it."""
    path, spark = scratch.folder(t.spark, "intake"), t.spark
    h = t.documents.where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    for n, rest in ((1, 0), (2, 1)):
        h.where(F.col("doc_id") % 2 == rest).select("file_hash").write.mode("append").parquet(f"{path}/in")
        seen = _run(intake.once_each(intake.stream(spark, f"{path}/in", "file_hash string"), "file_hash"), path)
        if n == 1:
            first = seen.count()
    return seen.agg(F.count("*").alias("all")).select(F.explode(F.array(F.struct(F.lit("first").alias("run"), F.lit(first).cast("long").alias("n")), F.struct(F.lit("second").alias("run"), (F.col("all") - first).alias("n")))).alias("x")).select("x.*").where("n > 0")


@query("SELECT lower(trim(event_type)) AS label, count(*) AS seen_count, min(event_id) AS first_seen, max(event_id) AS last_seen FROM events GROUP BY 1")
def stream_label_counts(t):
    """Labels of a stream, counted as they come."""
    path = scratch.folder(t.spark, "labels")
    rows = t.events.select(F.concat(F.upper("event_type"), F.lit(" ")).alias("label"), F.col("event_id").alias("at"))
    rows.write.parquet(f"{path}/in")
    counts = intake.label_counts(intake.stream(t.spark, f"{path}/in", rows.schema, files_per_batch=2))

    def merge(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{path}/out")  # a log; the newest row of a label holds

    intake.into_table(counts, merge, f"{path}/state").awaitTermination()
    log = t.spark.read.parquet(f"{path}/out")
    newest = F.max_by(F.struct("seen_count", "first_seen", "last_seen"), "batch").alias("x")
    return log.groupBy("label").agg(newest).select("label", "x.*")


@query("SELECT user_id::VARCHAR AS user_id, string_agg(event_id, ',' ORDER BY ts, event_id) AS last FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, lpad(event_id::VARCHAR, 12, '0') DESC) AS n FROM events WHERE user_id IS NOT NULL) WHERE n <= 3 GROUP BY 1")
def stream_last_entries(t):
    """The last three events of each user, as state of a stream."""
    ship(t.spark)
    path = scratch.folder(t.spark, "last")
    rows = t.events.where("user_id IS NOT NULL").select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("value"))
    rows.write.parquet(f"{path}/in")
    held = intake.last_entries(t.spark, intake.stream(t.spark, f"{path}/in", rows.schema, files_per_batch=2), "user_id", "at", 3)

    def merge(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{path}/out")

    intake.into_table(held, merge, f"{path}/state").awaitTermination()
    log = t.spark.read.parquet(f"{path}/out")
    newest = log.groupBy("user_id").agg(F.max("batch").alias("batch"))
    kept = log.join(newest, ["user_id", "batch"]).join(rows.select("user_id", "value", "at"), ["user_id", "value"])
    order = F.array_sort(F.collect_list(F.struct("at", "value")))  # three rows a user
    return kept.groupBy("user_id").agg(F.array_join(F.transform(order, lambda x: x["value"].cast("long").cast("string")), ",").alias("last"))
