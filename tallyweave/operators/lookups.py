"""Reference lookups of the establishment survey."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.numbers import to_int
from tallyweave.operators.joins import lookup
from tallyweave.session import stage


def lookup_section(
    df: DataFrame, industries: DataFrame, targets: Mapping[str, str], *, code: str = "without '0'", section: str = "SECTION"
) -> DataFrame:
    """Fill each section column from its industry code; rows without a hit keep null.

    ``targets`` maps code column to section column. Codes compare as numbers on
    both sides, the columns keep their places, every raw row stays. A code listed
    with several sections takes the first of them in alphabetical order.
    """
    names = df.columns
    table = industries.select(to_int(f"`{code}`", None).alias("_code"), F.col(section).alias("_section"))
    table = table.filter("_code is not null").groupBy("_code").agg(F.min("_section").alias("_section"))
    table = stage(table, "sections")
    out = df
    for source, target in targets.items():
        side = table.withColumnRenamed("_section", f"_{target}")
        joined = out.withColumn("_code", to_int(source, None))
        joined = joined.join(side, "_code", "left").drop("_code")
        out = joined.drop(target).withColumnRenamed(f"_{target}", target)
    return out.select(*[f"`{c}`" for c in dict.fromkeys([*names, *targets.values()])])


def lookup_sample(
    df: DataFrame, sample: DataFrame, key: str = "NEWSSID", columns: Sequence[str] = ("REGISTERED_NAME", "TRADING_NAME")
) -> DataFrame:
    """Names from the sample frame by key; a name already present is kept if the frame has none.

    All names of a key come from one frame row: the one with the fewest missing
    names, the first in alphabetical order among those. The frame is cut to that
    row and staged, so that it joins by broadcast if small and as a plain shuffle
    otherwise.
    """
    missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    best = F.min(F.struct(missing.alias("missing"), *columns))
    found = sample.groupBy(key).agg(best.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(f"_{c}") for c in columns])
    joined = lookup(df, stage(found, "sample_frame"), [key])
    filled = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) if c in df.columns else F.col(f"_{c}") for c in columns}
    return joined.withColumns(filled).drop(*[f"_{c}" for c in columns])
