"""Named queries, each with the DuckDB SQL of the same result if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder: ``t.orders`` and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers a function of Tables."""

    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return function

    return register
