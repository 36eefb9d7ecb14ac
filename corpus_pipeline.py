"""The corpus pipeline: quality classifier, line deduplication, near-duplicate removal, source mixing and packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet to the shared folder,
rereads it for the next, and deletes what is past. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import line_dedup, mixing, packing, shingles, weak_quality
from gleanery.llm.common import drop_path, scratch_path, swept, table


#: Words that a packing worker remembers; fewer than by default, as its executor has served four stages before.
CACHE_WORDS = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return weak_quality.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go from the texts; documents stay, even when nothing is left of them."""
    return line_dedup.deduplicated_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, Jaccard similarity of .8 or more) the document with the smallest doc_id stays."""
    return shingles.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, packing.public_tokenizer(), cache_words=CACHE_WORDS)


STAGES = [("quality classifier", quality), ("line dedup", dedup_lines), ("near-dedup", near_dedup), ("mixing", mix), ("packing", pack)]

#: No stage but the mixing can be told in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, past = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        with swept(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if past:
            drop_path(spark, past)
        docs, past = spark.read.schema(out.schema).parquet(path), path
    return docs
