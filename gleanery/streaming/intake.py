"""Streams: intake of new files once each, rolling rates, label counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def once_each(rows: DataFrame, key: str, at: str | None = None, late: str = "7 days") -> DataFrame:
    """Rows with a key that wasn't seen before; with an event time the keys are forgotten after `late`."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key]) if at else rows.dropDuplicates([key])


def rolling(events: DataFrame, at: str, value: str, days: int = 7, slide: int = 1, late: str = "1 day") -> DataFrame:
    """(start, n, mean) over sliding windows of days; rows later than `late` are dropped."""
    w = F.window(at, f"{days} days", f"{slide} days").alias("w")
    return events.withWatermark(at, late).groupBy(w).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.col("w.start").alias("start"), "n", "mean")


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    return events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def label_counts(labels: DataFrame, label: str = "label", at: str = "at") -> DataFrame:
    """(label, seen_count, first_seen, last_seen), kept up to date (update mode)."""
    return labels.groupBy(F.lower(F.trim(label)).alias("label")).agg(F.count("*").alias("seen_count"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))


def run_available(rows: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> StreamingQuery:
    """Processes what is there and ends; the next call goes on from the checkpoint, so each file counts once."""
    return rows.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)


def into_table(rows: DataFrame, merge, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Hands each micro-batch to merge(batch, id), as for queues and logs that are kept by key."""
    return rows.writeStream.foreachBatch(merge).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def last_entries(spark: SparkSession, rows: DataFrame, key: str, at: str, n: int) -> DataFrame:
    """The last n entries by time of each key, as state that holds n rows a key and no more. rows(key, at, value)."""
    def step(k, frames, state):
        import pandas as pd

        held = list(zip(*state.get)) if state.exists else []
        for f in frames:
            held += list(zip(f[at].astype("int64"), f["value"]))
        held = sorted(held)[-n:]
        state.update(([int(h[0]) for h in held], [str(h[1]) for h in held]))
        yield pd.DataFrame({key: [k[0]] * len(held), "value": [h[1] for h in held]})

    return rows.groupBy(key).applyInPandasWithState(step, f"{key} string, value string", "t array<long>, v array<string>", "update", "NoTimeout")
