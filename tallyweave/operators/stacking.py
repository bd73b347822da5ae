"""Stacking of period tables and reports on how their columns differ."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stack(frames: Mapping[str, DataFrame] | list[DataFrame], as_text: bool = False) -> DataFrame:
    """One table with the columns of all; a column a frame lacks is null there."""
    parts = list(frames.values()) if isinstance(frames, Mapping) else list(frames)
    if as_text:
        parts = [p.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def column_drift(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """(column, present_in, missing_from) of columns that some frame lacks."""
    names = list(dict.fromkeys(c for df in frames.values() for c in df.columns))
    rows = []
    for name in names:
        missing = [t for t, df in frames.items() if name not in df.columns]
        if missing:
            rows.append((name, [t for t in frames if t not in missing], missing))
    return spark.createDataFrame(rows, "column string, present_in array<string>, missing_from array<string>")


def shape_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns, surplus): surplus = columns of the stacked table beyond this one."""
    union = {c for df in frames.values() for c in df.columns}
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"),
            "rows",
            F.lit(len(df.columns)).alias("columns"),
            F.lit(len(union) - len(df.columns)).alias("surplus"),
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)
