"""SimHash near-duplicates by covering locality-sensitive hashing.

Every document gets a 64-bit fingerprint of its word shingles. A map m gives each bit position a non-zero vector of
radius + 1 bits; for each non-zero v of as many bits, table v keeps the positions i where the parity of m(i) & v is 1.
Two fingerprints that differ in at most `radius` positions leave at most `radius` equations for v over GF(2), which
have a non-zero solution: in that table they collide. So all linked pairs meet in one of 2 ** (radius + 1) - 1 tables.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, bounded, prepare, table, tidy
from gleanery.llm.graph import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Larger buckets are dealt out once more by another covering, and so on; each covering fixes about half of the bits that were free.
BUCKET = 20_000
COVERINGS = 5
_SPACE = re.compile(rb"[\t-\r ]")


def word_blocks(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, block by block, so that a very long text needs no list of all its words."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > block:
            found = _SPACE.search(data, at + block)
            end = found.start() if found else end
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) word shingles, as a signed 64-bit integer; zero without words."""
    import xxhash

    digest = xxhash.xxh64_digest
    counts, total, words = np.zeros(64, np.int64), 0, []
    for new in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words += new
        if len(words) >= width:
            joined, ends = b" ".join(words), list(accumulate([len(w) + 1 for w in words]))
            hashes = b"".join([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[width - 1 :])])
            bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
            counts += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
            total += len(bits)
            words = words[len(words) - width + 1 :]
    if not total and words:
        counts += np.unpackbits(np.frombuffer(digest(b" ".join(words), SEED), np.uint8))
        total = 1
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row. A null text has no words."""

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([fingerprint(t, width) for t in b.column(1).to_pylist()], pa.int64())], ["doc_id", "fp"])

    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


def covering_masks(radius: int, seed: int, width: int = 64) -> list[int]:
    """Signed 64-bit masks of the tables, for fingerprints of width bits."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(width)]
    random.Random(seed).shuffle(vectors)
    masks = [sum(1 << i for i in range(width) if (vectors[i] & v).bit_count() & 1) for v in range(1, 2 ** (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spanning(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) of each component among a bucket's distinct fingerprints; exact, and at most one edge a member."""
    left = np.sort(values)
    out = []
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= radius
            if near.any():
                found = left[near]
                queue.extend(found)
                out += [(int(x), int(root)) for x in found]
                left = left[~near]
    return out


def links(fps: DataFrame, scratch: Scratch, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) between distinct fingerprints fps(fp), with the same components as all pairs within the radius.

    A bucket is known by the bits that it fixes and their values. One over `bucket` is dealt out again by another
    covering, whose tables fix more bits: a pair within the radius agrees on all bits of some table of each covering,
    so none is lost. After the last covering some two bits are free, which bounds a bucket whatever the fingerprints.
    """

    def dealt(df: DataFrame, covering: int) -> DataFrame:
        base = F.explode(F.array(*[F.col("base").bitwiseOR(F.lit(m).cast("long")) for m in covering_masks(radius, covering)]))
        return df.select("fp", base.alias("base")).distinct() if covering > 1 else df.select("fp", base.alias("base"))

    key = F.col("fp").bitwiseAND(F.col("base")).alias("key")
    now, small, written = dealt(fps.select("fp", F.lit(0).cast("long").alias("base")), 1), None, []
    for covering in range(2, COVERINGS + 1):
        hot = scratch.keep(now.groupBy("base", key).count().where(F.col("count") > bucket).select("base", "key"), "hot")
        n = hot.count()
        written.append(hot)
        if not n:
            break
        large, keyed = bounded(hot, n), now.select("fp", "base", key)
        rest = keyed.join(large, ["base", "key"], "left_anti")
        small = small.unionAll(rest) if small else rest
        now = scratch.keep(dealt(keyed.join(large, ["base", "key"], "left_semi"), covering), "dealt")
        written.append(now)
    groups = now.select("fp", "base", key)
    groups = small.select("fp", "base", "key").unionAll(groups) if small else groups

    def run(batches):
        for b in batches:
            found = [e for values in b.column(0) for e in spanning(values.values.to_numpy(zero_copy_only=False), radius)]
            yield pa.record_batch([pa.array([e[0] for e in found], pa.int64()), pa.array([e[1] for e in found], pa.int64())], ["a", "b"])

    lists = groups.groupBy("base", "key").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")
    out = scratch.keep(lists.mapInArrow(tidy(run), "a long, b long").distinct(), "links")
    scratch.drop(*written)
    return out


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of docs.

    component_id is the smallest doc_id reachable over links of at most `radius` differing bits. A row without doc_id
    belongs to its component but doesn't name it (null if no row of it has an id). Repeated rows stay; an empty table
    gives an empty result; other columns are ignored. Copies share a fingerprint and meet as one node, so a large
    group of copies costs one node, not its pairs.
    """
    found = _grouped(docs, radius, id_col, text_col, width, Scratch(docs.sparkSession))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, radius: int, id_col: str, text_col: str, width: int, scratch: Scratch) -> DataFrame:
    """(doc_id, fp, root, component_id): root is the smallest fingerprint of the component."""
    fps = scratch.keep(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = scratch.keep(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    near = links(classes.select("fp"), scratch, radius)
    roots = components(near, scratch)
    scratch.drop(near)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """docs without the near-duplicates of a document with a smaller doc_id; see one_of_each()."""
    scratch = Scratch(docs.sparkSession)
    return one_of_each(docs, _grouped(docs, radius, "doc_id", "text", width, scratch), lambda t: fingerprint(t, width), scratch)


def one_of_each(docs: DataFrame, grouped: DataFrame, name, scratch: Scratch) -> DataFrame:
    """One row of docs for each component of grouped(doc_id, fp, root, component_id), where name gives the fp of a text: of the rows with the component's smallest doc_id one stays; where no row of a component has an id, one of those with the smallest fp. Columns and their order are those of docs; an empty table stays empty. Texts are shuffled only where the ids to drop are too many to broadcast, and for rows that share an id or have none."""
    found = scratch.keep(grouped, "found")
    named = found.where("doc_id IS NOT NULL")
    gone = scratch.keep(named.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    more = scratch.keep(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "more")
    n_more, columns = more.count(), docs.columns
    out = docs.where("doc_id IS NOT NULL")
    if n_more:
        out = out.join(bounded(more, n_more), "doc_id", "left_anti")
    out = out.join(bounded(gone, gone.count()), "doc_id", "left_anti").select(columns)
    fp = F.arrow_udf(lambda texts: pa.array([name(t) for t in texts.to_pylist()], pa.int64()), "long")
    if n_more:
        roots = named.join(more, "doc_id", "left_semi").where("doc_id = component_id").select("doc_id", F.col("fp").alias("__fp"), F.col("root").alias("__root")).distinct()
        several = docs.join(bounded(more, n_more), "doc_id", "left_semi").withColumn("__fp", fp("text")).join(roots, ["doc_id", "__fp"]).dropDuplicates(["doc_id", "__root"])
        out = out.unionAll(several.select(columns))
    if not found.where("doc_id IS NULL").isEmpty():
        roots = found.where("component_id IS NULL AND fp = root").select(F.col("fp").alias("__fp")).distinct()
        nameless = docs.where("doc_id IS NULL").withColumn("__fp", fp("text")).join(roots, "__fp", "left_semi").dropDuplicates(["__fp"])
        out = out.unionAll(nameless.select(columns))
    return out


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
