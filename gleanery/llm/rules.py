"""Quality rules as a bitmask ledger: every rule is evaluated once, its failure stored as a bit beside the measurements;
versioned policies and their ablations are then bit operations on that ledger, without another look at a text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import prepare, table, tidy

#: name -> condition of failure, over the measurements. The position is the bit; add new rules at the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "upper_case": "2 * n_upper_words > n_words",
    "duplicate_lines": "n_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "digits": "10 * n_digits > 3 * word_chars",
    "exclamations": "2 * n_exclamations > n_words",
}
BASE = ("few_words", "repeated_words")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_digits", "n_exclamations")
_SPACES = " \t\n\x0b\x0c\r"


def bits(*names: str) -> int:
    order = list(RULES)
    return sum(1 << order.index(n) for n in names)


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails more than `allowed` of the rules in `mask`, or any in `always`."""

    version: str
    mask: int
    always: int = 0
    allowed: int = 0

    def kept(self, failed: Column) -> Column:
        return (F.bit_count(failed.bitwiseAND(F.lit(self.mask).cast("long"))) <= self.allowed) & (failed.bitwiseAND(F.lit(self.always).cast("long")) == 0)


POLICIES = {
    "base": Policy("base", bits(*BASE)),
    "v1": Policy("v1", bits(*RULES)),
    "lenient": Policy("lenient", bits(*RULES), bits(*BASE), 1),
}


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that are found twice or more."""
    if len(ids) < 4 or distinct == len(ids):
        return 0
    if distinct < 1 << 20:
        key = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:
        _, two = np.unique(ids[:-2] * distinct + ids[1:-1], return_inverse=True)
        key = two * distinct + ids[2:]
    order = np.sort(key)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    found, cover = n[at] > 1, np.zeros(len(ids), bool)
    for k in range(3):
        cover[k : k + len(found)] |= found
    return int(cover.sum())


def word_ids(text: str) -> tuple[np.ndarray, dict, int]:
    """Ids of the words in order, the ids by word, and the words in capitals; block by block, so that of a very long text only the distinct words are held."""
    from gleanery.llm.simhash import word_blocks

    seen, parts, upper = defaultdict(count().__next__), [], 0
    for words in word_blocks(text.encode()):
        upper += sum(map(bytes.isupper, words))
        parts.append(np.array(list(map(seen.__getitem__, words)), np.int64))
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), seen, upper


def measure(text: str | None) -> tuple[int, ...]:
    """The MEASURES of a text; a null text has no words and no lines."""
    text = text or ""
    ids, seen, upper = word_ids(text)
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    chars = len(text) - sum(map(text.count, _SPACES))
    return len(ids), chars, sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), repeat_words(ids, len(seen)), len(lines), upper, sum(map(text.count, "0123456789")), text.count("!")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, failed, MEASURES) of every row: failed has a bit for each of RULES. Ids may be null or repeated; an empty table gives an empty ledger; other columns are ignored."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(zip(*map(measure, b.column(1).to_pylist()))) or [()] * len(MEASURES)
            yield pa.record_batch([b.column(0), *[pa.array(c, pa.int64()) for c in cols]], ["doc_id", *MEASURES])

    prepare(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    failed = " + ".join(f"CASE WHEN {rule} THEN {1 << i}L ELSE 0L END" for i, rule in enumerate(RULES.values()))
    return found.select("doc_id", F.expr(failed).alias("failed"), *MEASURES)


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    return rows.withColumn("kept", policy.kept(F.col("failed")))


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: how many documents fail it, fail it alone, and would be kept without it. One pass sums documents by mask; the rest runs on those few sums."""
    sums = rows.groupBy("failed").count()
    names = [n for i, n in enumerate(RULES) if policy.mask >> i & 1]
    per = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(bits(n)).cast("long").alias("bit")) for n in names])).alias("r")
    mask = F.lit(policy.mask).cast("long")
    rest = F.col("failed").bitwiseAND(mask).bitwiseAND(F.bitwise_not(F.col("r.bit")))
    without = F.bit_count(rest) <= policy.allowed
    fails = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).cast("long")
    return sums.select("failed", "count", per).groupBy(F.col("r.rule").alias("rule")).agg(total(fails).alias("failing"), total(fails & (rest == 0)).alias("failing_alone"), total(without & (F.col("failed").bitwiseAND(F.lit(policy.always & ~0).cast("long")).bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0)).alias("kept_without"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")), POLICIES["v1"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (F.col("failed").bitwiseAND(F.lit(bits(*BASE)).cast("long")) != 0).alias("base_failed"), "kept", "failed")


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v1 does to all documents."""
    return ablations(ledger(table(spark, sf_dir, "documents")), POLICIES["v1"])


_W = r"[^\x20\x09-\x0D]"
OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_W}+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + j) AS n FROM h, (VALUES (0), (1), (2)) AS o(j) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(p.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_upper_words,
  len(regexp_extract_all(t, '[0-9]'))::BIGINT AS n_digits, len(regexp_extract_all(t, '!'))::BIGINT AS n_exclamations FROM w LEFT JOIN p USING (r)),
f AS (SELECT *, ({" + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(RULES.values()))})::BIGINT AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {bits(*BASE)} <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""

ABLATIONS_SQL = f"""
WITH f AS ({OP6_SQL}), r AS (SELECT unnest([{", ".join(f"'{n}'" for n in RULES)}]) AS rule, unnest([{", ".join(str(bits(n)) for n in RULES)}]) AS bit)
SELECT rule, count(*) FILTER (WHERE failed & bit <> 0) AS failing, count(*) FILTER (WHERE failed = bit) AS failing_alone, count(*) FILTER (WHERE failed & ~bit = 0) AS kept_without FROM f, r GROUP BY rule
"""
