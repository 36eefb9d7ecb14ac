"""Line deduplication with a suffix array over line ids, built by distributed prefix doubling.

The sequence is the lines with a word of all documents, in the order of (doc_id, line); a run never crosses documents.
Round 0 ranks suffixes by their first line: repeated lines get ids in sorted order. Round k ranks them by their first
2 ** k lines: the ranks of round k - 1 at a position and 2 ** (k - 1) lines on make a pair, and repeated pairs are
ranked in sorted order. A suffix whose rank is unique is placed and drops out, so only repeated text goes on.

An interval of the suffix array with a longest common prefix of m lines is a set of positions with equal ranks of round
k = floor(log2 m) at the start and at m - 2 ** k. A run counts once it has min_words words. Each position has one
shortest run of that size to the right and one to the left; both depend on the lines alone. Every maximal repeated run
of min_words words is a union of such shortest runs, and each of them is repeated: so the intervals at their depth show
all maximal runs. As a line has at least one word, rounds end at log2(min_words).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch, prepare, table, tidy, word_count

#: A repeated run counts from so many words on.
MIN_WORDS = 50
LAST = (1 << 63) - 1
#: The numbers of the lines that go are sent to all executors up to so many bytes, which spares the texts a shuffle.
BROADCAST_BYTES = 16 << 20
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with __o (doc_id, null last) and __t (hash of the text): equal rows are one document."""
    return docs.withColumn("__o", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("__t", F.xxhash64("text"))


def lines(docs: DataFrame) -> DataFrame:
    """(o, t, n, i, words, h1, h2) of every line with a word: n counts all lines of the text, i those with a word; h1, h2 are 128 bits of hash."""
    found = _keyed(docs).where("text IS NOT NULL").select(F.col("__o").alias("o"), F.col("__t").alias("t"), F.posexplode(F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("n"), x.alias("line"))), lambda s: s["line"].rlike(_HAS_WORD))).alias("i", "s"))
    line = F.col("s.line")
    return found.select("o", "t", F.col("s.n").alias("n"), "i", word_count(line).alias("words"), F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"))


def _ranked(groups: DataFrame, by: list[str], scratch: Scratch) -> DataFrame:
    """by + rank: numbers in the sorted order of by, which is unique. The sort is by range, so no task holds all."""
    return scratch.keep(groups.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def suffix_ranks(found: DataFrame, rounds: int, scratch: Scratch) -> list[DataFrame]:
    """For each round k: (o, t, n, i, words, rank) of the positions whose first 2 ** k lines are repeated; rank orders them."""
    repeated = _ranked(found.groupBy("h1", "h2").count().where("count > 1"), ["h1", "h2"], scratch)
    now = scratch.keep(found.join(repeated, ["h1", "h2"]).select("o", "t", "n", "i", "words", "rank").dropDuplicates(["o", "t", "i"]), "round")
    scratch.drop(repeated)
    out = [now]
    for k in range(1, rounds):
        step = 1 << (k - 1)
        ahead = Window.partitionBy("o", "t").orderBy("i").rangeBetween(step, step)
        pairs = scratch.keep(now.withColumn("next", F.min("rank").over(ahead)).where("next IS NOT NULL").withColumnRenamed("rank", "first"), "pairs")
        repeated = _ranked(pairs.groupBy("first", "next").count().where("count > 1"), ["first", "next"], scratch)
        now = scratch.keep(pairs.join(repeated, ["first", "next"]).select("o", "t", "n", "i", "words", "rank"), "round")
        scratch.drop(pairs, repeated)
        out.append(now)
        if now.isEmpty():
            break
    return out


def shortest_runs(i: np.ndarray, words: np.ndarray, min_words: int) -> np.ndarray:
    """(first line, lines) of the shortest runs of min_words words to the right of each line and to the left; lines that don't follow one another end a run."""
    out = []
    for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i) != 1) + 1):
        total = np.concatenate([[0], np.cumsum(words[part])])
        right = np.searchsorted(total, total[:-1] + min_words)  # total[right] is the first with enough
        ok = right < len(total)
        out.append(np.stack([i[part][ok], (right - np.arange(len(part)))[ok]], 1))
        left = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        ok = left >= 0
        out.append(np.stack([i[part][left[ok]], (np.arange(1, len(total)) - left)[ok]], 1))
    return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)


def _runs(levels: list[DataFrame], min_words: int) -> DataFrame:
    """(o, t, i, m, k, a, b): the shortest runs whose lines are all repeated, m lines from i, with the ranks of round k at their start and 2 ** k lines before their end. A document's repeated lines are one row here, as its text is."""
    rows = levels[0].select("o", "t", "i", "words", F.lit(0).alias("k"), "rank")
    for k, level in enumerate(levels[1:], 1):
        rows = rows.unionAll(level.select("o", "t", "i", "words", F.lit(k).alias("k"), "rank"))
    grouped = rows.groupBy("o", "t").agg(F.collect_list(F.struct("k", "i", "words", "rank")).alias("x")).select("o", "t", *[F.col("x")[c].alias(c) for c in ("k", "i", "words", "rank")])

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(7)]
            for o, t, *lists in zip(*(batch.column(c) for c in range(6))):
                k, i, words, rank = (np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64) for x in lists)
                at = {}
                for level in range(int(k.max()) + 1):
                    here = np.flatnonzero(k == level)
                    order = here[np.argsort(i[here])]
                    at[level] = (i[order], rank[order])
                base = np.flatnonzero(k == 0)
                base = base[np.argsort(i[base])]
                found = shortest_runs(i[base], words[base], min_words)
                depth = np.array([int(m).bit_length() - 1 for m in found[:, 1]], np.int64)
                for level in np.unique(depth):
                    if level not in at or not len(at[level][0]):
                        continue
                    where, value = at[level]
                    f = found[depth == level]
                    ends = f[:, 0] + f[:, 1] - (1 << int(level))
                    x, y = (np.minimum(np.searchsorted(where, v), len(where) - 1) for v in (f[:, 0], ends))
                    ok = (where[x] == f[:, 0]) & (where[y] == ends)
                    for c, v in zip(cols, (np.full(ok.sum(), o.as_py()), np.full(ok.sum(), t.as_py()), f[ok, 0], f[ok, 1], np.full(ok.sum(), level), value[x[ok]], value[y[ok]])):
                        c.append(v)
            yield pa.record_batch([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in cols], ["o", "t", "i", "m", "k", "a", "b"])

    return grouped.mapInArrow(tidy(run), "o long, t long, i long, m long, k long, a long, b long")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(o, t, gone): for each document with a later copy of a run, the numbers of its lines that go, sorted. See deduplicated()."""
    scratch = Scratch(docs.sparkSession)
    prepare(docs.sparkSession)
    found = lines(docs)
    levels = suffix_ranks(found, min_words.bit_length(), scratch)
    runs = scratch.keep(_runs(levels, min_words), "runs")
    place = F.struct("o", "t", "i")
    # written, so that the join has an exchange of its own on either side and a very common run can be split
    first = scratch.keep(runs.groupBy("k", "m", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"), "first")
    later = runs.join(first, ["k", "m", "a", "b"]).where(place > F.col("first")).select("o", "t", F.explode(F.sequence("i", F.col("i") + F.col("m") - 1)).alias("i")).distinct()
    gone = later.join(levels[0].select("o", "t", F.col("i").cast("long").alias("i"), "n"), ["o", "t", "i"]).groupBy("o", "t").agg(F.array_sort(F.collect_set("n")).alias("gone"))
    out = scratch.keep(gone, "gone")
    scratch.drop(runs, first, *levels)
    return out


def _without(text, gone):
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept, "\n"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the text of each row less the lines that an earlier document or place has, all other columns as they are, with __gone, the numbers of those lines (null: none), and __lines, how many there were.

    A line goes if it lies in a run of consecutive lines, of min_words words or more together, that also begins at an
    earlier line; earlier is in the order of (doc_id, null last; line). Runs may overlap. Lines without a word play no
    part: they don't part a run, and they stay. So every run's first copy stays whole. Null and empty texts stay as
    they are. Rows equal in doc_id and text are one document and lose the same lines; an empty table stays empty.
    """
    gone = repeated_lines(docs.select("doc_id", "text"), min_words).select(F.col("o").alias("__go"), F.col("t").alias("__gt"), F.col("gone").alias("__gone"))
    size = gone.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("__gone")), F.lit(0)).alias("lines")).first()
    if 48 * size["rows"] + 4 * size["lines"] <= BROADCAST_BYTES:  # else the texts are shuffled
        gone = F.broadcast(gone)
    keyed = _keyed(docs)
    out = keyed.join(gone, (F.col("__o") == F.col("__go")) & (F.col("__t") == F.col("__gt")), "left").drop("__go", "__gt", "__o", "__t")
    return out.withColumn("__lines", F.size(F.split("text", "\n", -1))).withColumn("text", _without(F.col("text"), F.col("__gone")))


def deduplicated_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    return deduplicated(docs, min_words).select(docs.columns)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, lines_removed, words_kept, text_sha256) of every document; the hash is that of the text that is left."""
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.coalesce(F.size("__gone"), F.lit(0))
    return out.select("doc_id", F.coalesce("__lines", F.lit(0)).cast("long").alias("n_lines"), removed.cast("long").alias("lines_removed"), word_count("text").alias("words_kept"), F.sha2("text", 256).alias("text_sha256"))
