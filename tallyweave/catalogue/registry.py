"""Registry of the queries over the driver tables, each with its comparison SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


class Tables:
    """Driver tables by attribute, read on use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, *names: str, **frames: DataFrame) -> DataFrame:
        """Run SQL whose ``{name}`` parts stand for tables or given frames."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in names}, **frames)


QUERIES: dict[str, Query] = {}


def query(ids: str, sql: str | None = None):
    """Register ``function(tables)`` under its name; ``ids`` names the operators it covers."""

    def register(function):
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, ids, lambda spark, folder: function(Tables(spark, folder)), sql)
        return function

    return register
