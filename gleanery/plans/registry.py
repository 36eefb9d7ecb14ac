"""Registration of queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")

    def rows(self, schema: str, *rows: tuple) -> DataFrame:
        """An inline dimension table."""
        return self.spark.createDataFrame(list(rows), schema)


def query(sql: str | None = None):
    """Registers f(tables) under its own name; sql is the DuckDB counterpart."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
