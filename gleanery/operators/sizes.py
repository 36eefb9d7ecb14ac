"""Sides of joins by their counted size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side of a join on equal keys is broadcast up to so many rows of a few dozen bytes, and shuffled beyond.
ROWS = 100_000
#: Bytes of vectors or rows that are broadcast at once where a side meets all rows.
BYTES = 16 << 20


def small(df: DataFrame, most: int = ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows; counting stops there. Otherwise Spark shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def blocks(df: DataFrame, key: str, row_bytes: int, most_rows: int = ROWS, most_bytes: int = BYTES) -> list[DataFrame]:
    """df in parts that may each be broadcast to meet all rows: at most about most_rows rows and most_bytes bytes, by a hash of key."""
    n = max(1, -(-df.count() // max(1, min(most_rows, most_bytes // max(1, row_bytes)))))
    return [F.broadcast(df if n == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(n)) == b)) for b in range(n)]


def listed(df: DataFrame, key: str, row: Column, name: str, row_bytes: int = 200) -> list[DataFrame]:
    """The rows of df as sorted arrays in tables of one row, each small enough to be broadcast: one for all while they are few, more beyond."""
    return [F.broadcast(part.agg(F.array_sort(F.collect_list(row)).alias(name))) for part in blocks(df, key, row_bytes)]
