"""Control records: the latest user input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_control(df: DataFrame, sequence: str) -> DataFrame:
    """One row: the record with the highest ``sequence`` (time stamp or number)."""
    return df.agg(F.max_by(F.struct(*df.columns), F.col(sequence)).alias("r")).select("r.*")


def clean_control(df: DataFrame, *columns: str) -> DataFrame:
    """Missing values become 0 and the columns become integers."""
    names = columns or tuple(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in names})
