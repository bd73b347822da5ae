"""Rule checks: predicates over rows, error rows, counts per rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_errors(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add ``ERRORS`` (names of the rules a row breaks) and ``IND_STATUS`` (1 with errors, else 0).

    A rule is an SQL predicate that holds for a faulty row; unknown counts as no fault.
    """
    hits = F.array(*[F.when(F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    flagged = df.withColumn("ERRORS", F.array_compact(hits))
    return flagged.withColumn("IND_STATUS", F.when(F.size("ERRORS") > 0, 1).otherwise(0).cast("int"))


def split_errors(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows)."""
    good = flagged.filter("IND_STATUS = 0").drop("ERRORS")
    return good, flagged.filter("IND_STATUS = 1")


def rule_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, errors, rows) in one pass, rules without hits included."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(rule)).alias(f"r{i}") for i, rule in enumerate(rules.values())]
    )
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("errors"), F.col("rows")) for i, name in enumerate(rules)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def drop_variable(long: DataFrame, column: str = "variable", value: str = "Z") -> DataFrame:
    """Remove the rows of one variable of a long table."""
    return long.filter(~F.col(column).eqNullSafe(F.lit(value)))
