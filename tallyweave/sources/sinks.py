"""Sinks: published tables, period partitions, quality tables, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweave.operators.headers import sanitize_columns

# Names of the published tables.
TABLE_NAMES = {
    "household_monthly": "JR4M{month}Y{year}_FC",
    "household_quarterly": "JR4Q{quarter}Y{year}_FC",
    "household_halfyear": "JR4HY{halfyear}Y{year}_FC",
    "household_annual": "JR4AY{year}_FC",
    "individual_monthly": "JR5M{month}Y{year}",
    "establishment_quarterly": "FRDQ{quarter}Y{year}",
}


def table_name(job: str, **period: int) -> str:
    return TABLE_NAMES[job].format(**period)


def publish(df: DataFrame, name: str, database: str | None = None, partition_by: tuple[str, ...] = ()) -> str:
    """Replace table ``name`` with ``df`` under sink-safe column names."""
    full = f"`{database}`.`{name}`" if database else f"`{name}`"
    writer = sanitize_columns(df).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(full)
    return full


def replace_period(df: DataFrame, path: str, *period: str) -> None:
    """Overwrite only the partitions that ``df`` holds; other periods stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*period)
        .parquet(path)
    )


def write_quality_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write a quality table as Parquet, e.g. the cells and factors by state."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
