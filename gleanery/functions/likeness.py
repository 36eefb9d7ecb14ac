"""Likeness of short texts from 0 to 1 in the terms of fuzzy matchers: shared subsequences of whole texts, of their best parts, and of their words.

Plain functions of two texts; `weighted` is their Arrow form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the parts of the weighted ratio, and the ratios of lengths at which they change.
WORDS_WEIGHT, PART_WEIGHT, SMALL_PART_WEIGHT = 0.95, 0.9, 0.6
PART_FROM, SMALL_PART_FROM = 1.5, 8.0


def common(a: str, b: str) -> int:
    """The length of the longest common subsequence, by a row of bits for each letter of a."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & at.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence by both lengths; two empty texts are alike."""
    total = len(a) + len(b)
    return 2 * common(a, b) / total if total else 1.0


def part_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text and any part of the longer one that is as long, or that a margin cuts off."""
    if not a or not b:
        return float(a == b)
    short, long = sorted((a, b), key=len)
    parts = {long[max(0, i) : i + len(short)] for i in range(1 - len(short), len(long))}
    best = max(ratio(short, p) for p in parts)
    return max(best, max(ratio(long, short[max(0, i) : i + len(long)]) for i in range(1 - len(long), len(short)))) if len(a) == len(b) else best


def words_ratio(a: str, b: str) -> float:
    """The better of the ratio of both texts with their words in order, and that of their common words with and without the others. 1 where all words of one are in the other."""
    u, v = set(a.split()), set(b.split())
    in_order = ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    if not u or not v:
        return in_order
    both = sorted(u & v)
    if both and (u <= v or v <= u):
        return 1.0
    shared, left, right = (" ".join(x) for x in (both, both + sorted(u - v), both + sorted(v - u)))
    return max(in_order, ratio(left, right), *([ratio(shared, left), ratio(shared, right)] if both else []))


def part_words_ratio(a: str, b: str) -> float:
    """As part_ratio(), of the words in order; 1 where the texts share a word."""
    u, v = set(a.split()), set(b.split())
    if u & v:
        return 1.0
    in_order = part_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return max(in_order, part_ratio(" ".join(sorted(u)), " ".join(sorted(v))))


def weighted_ratio(a: str | None, b: str | None) -> float:
    """The best of the ratios above, those of words and of parts weighing less, and parts counted only where one text is much longer. 0 for an empty text or null."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < PART_FROM:
        return max(ratio(a, b), words_ratio(a, b) * WORDS_WEIGHT)
    weight = PART_WEIGHT if longer <= SMALL_PART_FROM else SMALL_PART_WEIGHT
    return max(ratio(a, b), part_ratio(a, b) * weight, part_words_ratio(a, b) * WORDS_WEIGHT * weight)


def weighted(a: Column, b: Column) -> Column:
    """weighted_ratio() of two columns, in Arrow batches."""
    @F.pandas_udf("double")
    def score(x, y):
        import pandas as pd

        return pd.Series([weighted_ratio(p, q) for p, q in zip(x, y)], dtype="float64")

    return score(a, b)
