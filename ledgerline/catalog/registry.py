"""Registration of queries and of the SQL text they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def mart(df: DataFrame, label: str) -> DataFrame:
    """Write an upstream mart down before it is used several times, as a nightly run would."""
    return materialize(df, f"mart-{label}")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register
