"""Quality tables: frequencies, uniqueness, nulls, lengths, discrepancies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def length_audit(df: DataFrame, column: str) -> DataFrame:
    """Rows per text length; a sound ID has one length."""
    return df.groupBy(F.length(_c(column).cast("string")).alias("length")).agg(F.count(F.lit(1)).alias("rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return df.filter(_c(column).isNotNull()).groupBy(_c(column).alias(column)).agg(F.count(F.lit(1)).alias("rows"))


def uniqueness_audit(df: DataFrame, column: str, above: int = 1) -> DataFrame:
    """Values that occur more than ``above`` times."""
    return value_counts(df, column).filter(F.col("rows") > above)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(_c(column)).distinct()


def presence_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value."""
    return df.groupBy(_c(column).isNotNull().alias("present")).agg(F.count(F.lit(1)).alias("rows"))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, nulls) in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(_c(n).isNull()).alias(f"n{i}") for i, n in enumerate(names)])
    entries = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column"), F.col("rows"), F.col(f"n{i}").alias("nulls")) for i, n in enumerate(names)])
    )
    return counted.select(entries.alias("e")).select("e.*")


def all_null_rows(df: DataFrame) -> DataFrame:
    """Rows without any value."""
    return df.filter(reduce(lambda a, b: a & b, [_c(c).isNull() for c in df.columns]))


def discrepancies(df: DataFrame, column: str) -> DataFrame:
    """Rows whose check is not zero; a missing check counts as one."""
    return df.filter(~_c(column).eqNullSafe(F.lit(0).cast(df.schema[column].dataType)))


def sole_value(df: DataFrame, column: str):
    """The one value of a column that must be constant, as the period of a template."""
    low, high = df.agg(F.min(_c(column)), F.max(_c(column))).first()
    if low != high:
        raise ValueError(f"{column} holds more than one value: {low!r}, {high!r}")
    return low


def sole_row(df: DataFrame, column: str) -> DataFrame:
    """:func:`sole_value` as one row of a plan: running it fails if the column holds two values."""
    low, high = F.min(_c(column)), F.max(_c(column))
    message = F.concat(F.lit(f"{column} holds more than one value: "), F.concat_ws(", ", low.cast("string"), high.cast("string")))
    return df.agg(F.when(low.eqNullSafe(high), low).otherwise(F.raise_error(message)).alias(column))


def sole_values(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """The one value of each group (``value``), null where it has ``several`` or none; nulls count as no value."""
    low, high = F.min(_c(column)), F.max(_c(column))
    several = F.coalesce(low != high, F.lit(False))
    return df.groupBy(*[_c(k) for k in by]).agg(F.when(~several, low).alias("value"), several.alias("several"))


def reconcile(df: DataFrame, derived: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column, derived_sum, input_sum, matches) for each derived total, in one pass.

    ``derived`` names the inputs that make up each derived column.
    """
    used = list(dict.fromkeys([*derived, *(c for parts in derived.values() for c in parts)]))
    place = {c: f"s{i}" for i, c in enumerate(used)}
    sums = df.agg(*[F.coalesce(F.sum(_c(c)), F.lit(0)).alias(place[c]) for c in used])

    def entry(name, parts):
        total = reduce(lambda a, b: a + b, [F.col(place[p]) for p in parts], F.lit(0))
        mine = F.col(place[name])
        return F.struct(
            F.lit(name).alias("column"),
            mine.cast("double").alias("derived_sum"),
            total.cast("double").alias("input_sum"),
            (mine == total).alias("matches"),
        )

    return sums.select(F.explode(F.array(*[entry(n, p) for n, p in derived.items()])).alias("e")).select("e.*")
