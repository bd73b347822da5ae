"""Counts and cells: responding households, sample cells, population cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.functions.bands import label_code
from tallyweave.functions.fields import strip_commas
from tallyweave.functions.numbers import exact_sum
from tallyweave.operators.classify import region_of
from tallyweave.operators.dedupe import key_summary
from tallyweave.operators.headers import order_by_number, pivot_groups

STRATUM = ["NG", "RIN_STRATA"]
CELL = ["NG", "CIT_NONCIT", "KU_5", "J", "GRP"]


def responding_counts(
    df: DataFrame, keys: Sequence[str] = config.RESPONSE_FIELDS, by: Sequence[str] = STRATUM
) -> DataFrame:
    """Distinct response keys and repeat records per stratum.

    Equals counting first markers when the stratum follows from the key. Rows
    of one key combine before the shuffle.
    """
    return count_keys(key_summary(df, keys, None, by), by)


def count_keys(summary: DataFrame, by: Sequence[str] = STRATUM) -> DataFrame:
    """Responding keys and repeat records per stratum from one row per key."""
    return summary.groupBy(*by).agg(
        F.count(F.lit(1)).alias("responding"), F.sum(F.col("_rows") - 1).alias("repeats")
    )


def weighted_cells(
    df: DataFrame, keys: Sequence[str], weight: str, digits: int = 2, name: str = "SAMPLE"
) -> DataFrame:
    """Sum of weights per cell; rows with a null key belong to no cell."""
    return df.dropna("any", subset=list(keys)).groupBy(*keys).agg(exact_sum(weight, digits).alias(name))


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, weight: str, digits: int = 2) -> DataFrame:
    """Weighted cells with one column per value of ``column``; absent cells are null."""
    known = df.dropna("any", subset=[*keys, column])
    return known.groupBy(*keys).pivot(column, list(values)).agg(exact_sum(weight, digits))


def unpivot_values(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def _literal_map(pairs: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def population_cells(
    template: DataFrame, columns: Mapping[str, tuple[int, str]] = config.POPULATION_COLUMNS
) -> DataFrame:
    """Population template to one row per state, band, sex and group, of the state's own region."""
    present = {c: v for c, v in columns.items() if c in template.columns}
    state = "KOD_NEGERI" if "KOD_NEGERI" in template.columns else "NG"
    keyed = template.select(
        F.col(state).try_cast("long").alias("NG"),
        F.col("KU_5").try_cast("int").alias("KU_5"),
        label_code("GENDER", {"MALE": 1, "FEMALE": 2}).cast("long").alias("J"),
        *[strip_commas(f"`{c}`").alias(c) for c in present],
    )
    long = keyed.unpivot(["NG", "KU_5", "J"], [f"`{c}`" for c in present], "_column", "POPULATION")
    group = F.element_at(_literal_map({c: g for c, (g, _) in present.items()}), F.col("_column"))
    region = F.element_at(_literal_map({c: r for c, (_, r) in present.items()}), F.col("_column"))
    return (
        long.filter(region_of(F.col("NG")) == region)
        .withColumn("GRP", group.cast("int"))
        .select("NG", F.when(F.col("GRP") == 0, 2).otherwise(1).cast("int").alias("CIT_NONCIT"), "KU_5", "J", "GRP", "POPULATION")
    )


def region_table(cells: DataFrame, region: str, value: str) -> DataFrame:
    """Wide quality table of one region: a column per sex and group, non-citizens as group 0."""
    top = 5 if region == "SEM" else 7
    mine = cells.filter(region_of(F.col("NG")) == region)
    return pivot_groups(mine, ["NG", "KU_5"], value, [1, 2], range(top + 1))


def region_master(factors: DataFrame, region: str) -> DataFrame:
    """Sample cells next to their population cells, one row per state and band of a region.

    ``sex_group`` holds the sample, ``sex_group_region`` the population; group BW is non-citizens.
    """
    groups = [*[str(g) for g in range(1, 6 if region == "SEM" else 8)], "BW"]
    names = [f"{j}_{g}" for j in (1, 2) for g in groups]
    group = F.when(F.col("GRP") == 0, "BW").otherwise(F.col("GRP").cast("string"))
    named = factors.filter(region_of(F.col("NG")) == region).withColumn("_name", F.concat_ws("_", F.col("J").cast("string"), group))
    wide = named.groupBy("NG", "KU_5").pivot("_name", names).agg(F.first("SAMPLE").alias("s"), F.first("POPULATION").alias("p"))
    renamed = {f"{n}_s": n for n in names} | {f"{n}_p": f"{n}_{region}" for n in names}
    return order_by_number(wide.withColumnsRenamed(renamed), region)


def factor_columns(factors: DataFrame, value: str = "POPFAC") -> DataFrame:
    """Factors as Male, Female and Non Citizen columns per state, band, group block; missing is 0."""
    block = F.when(F.col("GRP") == 0, F.col("J")).otherwise(F.col("GRP")).cast("int").alias("block")
    column = F.when(F.col("GRP") == 0, "Non Citizen").when(F.col("J") == 1, "Male").otherwise("Female")
    named = factors.withColumns({"block": block, "_column": column})
    wide = named.groupBy("NG", "block", "KU_5").pivot("_column", ["Male", "Female", "Non Citizen"]).agg(F.max(value))
    return wide.na.fill(0.0, ["Male", "Female"])
