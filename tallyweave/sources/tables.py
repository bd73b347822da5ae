"""Catalog tables and tables found by period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, name: str, **jdbc_options: str) -> DataFrame:
    """A catalog table, or a database table when JDBC options are given."""
    if jdbc_options:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc_options).load()
    return spark.table(name)


def read_period(df: DataFrame, **period: int) -> DataFrame:
    """Rows of one period; on a table partitioned by these columns only its files are read."""
    for name, value in period.items():
        df = df.filter(F.col(name) == value)
    return df


def find_period_tables(spark: SparkSession, database: str, **period: int) -> list[str]:
    """Names of the tables that carry all period columns and hold the period.

    Tables partitioned by all of them are answered from the catalogue, without a
    job. The others are searched by one job for all: each branch reads the period
    columns alone, skips row groups whose statistics exclude the period, and
    stops at its first row. Only table names pass through the driver.
    """
    found, searched = [], []
    tables = [t.tableName for t in spark.sql(f"SHOW TABLES IN `{database}`").collect() if not t.isTemporary]
    for name in sorted(tables):
        full = f"`{database}`.`{name}`"
        lines = [r.col_name for r in spark.sql(f"DESCRIBE TABLE {full}").collect()]
        cut = lines.index("# Partition Information") if "# Partition Information" in lines else len(lines)
        if not set(period) <= set(lines[:cut]):
            continue
        if set(period) <= set(lines[cut:]):
            wanted = ", ".join(f"`{c}` = {int(v)}" for c, v in period.items())
            if spark.sql(f"SHOW PARTITIONS {full} PARTITION ({wanted})").take(1):
                found.append(name)
        else:
            searched.append(read_period(spark.table(full).select(*period), **period).limit(1).select(F.lit(name).alias("name")))
    if searched:
        found += [r.name for r in reduce(DataFrame.union, searched).collect()]
    return sorted(found)
