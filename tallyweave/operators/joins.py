"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    """``a <=> b`` for every pair; Spark still joins on these by hash or sort."""
    return reduce(lambda a, b: a & b, [F.col(f"`{x}`").eqNullSafe(F.col(f"`{y}`")) for x, y in pairs])


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], null_matches: bool = False) -> DataFrame:
    """Left join that keeps ``df``'s columns first; null keys match only on request.

    No broadcast is forced. Spark broadcasts a table whose files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
    where adaptive execution splits a hot key of ``df`` over several tasks.
    Stage an aggregated ``table`` first: only then is its size known, and only
    then is its side of the join a plain shuffle, which the splitting needs.
    """
    if not null_matches:
        return df.join(table, list(on), "left").select(
            *[f"`{c}`" for c in df.columns], *[f"`{c}`" for c in table.columns if c not in on]
        )
    renamed = table.withColumnsRenamed({c: f"_r_{c}" for c in on})
    joined = df.join(renamed, null_safe([(c, f"_r_{c}") for c in on]), "left")
    return joined.drop(*[f"_r_{c}" for c in on])


def repeated_keys(table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Complete keys that stand in more than one row, and how often."""
    keyed = table.select(*[F.col(f"`{c}`") for c in on]).dropna("any")
    return keyed.groupBy(*[F.col(f"`{c}`") for c in on]).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def unique_keys(table: DataFrame, on: Sequence[str], label: str) -> DataFrame:
    """``table`` itself, if no key repeats; a repeated key would multiply the rows it is joined to."""
    repeated = repeated_keys(table, on).orderBy(*[F.col(f"`{c}`") for c in on]).first()
    if repeated:
        key = ", ".join(f"{c}={repeated[c]}" for c in on)
        raise ValueError(f"{label} has {repeated['rows']} rows with {key}")
    return table
