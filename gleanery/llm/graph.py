"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
    return row["n"], row["x"]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges run from a to a smaller b. Large: every larger neighbour of a node moves to the node's smallest neighbour. Small: the same for a node and its smaller neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the component's smallest node. Nulls and loops are no edges. Every step is written, so a lost executor costs one step."""
    now = scratch.keep(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        then = scratch.keep(_star(_star(now, True), False), "edges")
        scratch.drop(now)
        now, before, mark = then, mark, _mark(then)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
