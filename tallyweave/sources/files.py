"""Files: newest file, and final data whose period stands in the file name."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.periods import half_of_quarter, quarter_of_month
from tallyweave.sources.delimited import read_delimited

# Period patterns in the names of final-data files.
MONTHLY_NAME = r"M(\d{2})Y(\d{4})"
QUARTERLY_NAME = r"Q(\d)Y(\d{4})"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, bytes) of every matching file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    )


def latest_file(spark: SparkSession, path: str) -> str:
    """Path of the file changed last; the later name wins a tie."""
    newest = list_files(spark, path).agg(F.max_by("path", F.struct("modified", "path")).alias("path")).first()
    if newest is None or newest.path is None:
        raise FileNotFoundError(path)
    return newest.path


def period_of_name(name: Column | str, kind: str = "monthly") -> dict[str, Column]:
    """Period columns read from a file name; a bad month or quarter fails the job."""
    c = F.col(name) if isinstance(name, str) else name
    pattern = {"monthly": MONTHLY_NAME, "quarterly": QUARTERLY_NAME}[kind]
    part = F.regexp_extract(c, pattern, 1).try_cast("int")
    year = F.regexp_extract(c, pattern, 2).try_cast("int")
    if kind == "monthly":
        return {"MONTHS": part, "YEARS": year, "QUARTER": quarter_of_month(part)}
    return {"QUARTER": part, "YEARS": year, "HALFYEAR": half_of_quarter(part)}


def ingest_finals(
    spark: SparkSession, folder: str, kind: str = "monthly", *, encoding: str | None = "UTF-8", keep_order: bool = False
) -> dict[str, DataFrame]:
    """Read the final data of ``folder`` and add the period columns of each name.

    A final is a ``.csv`` file, or a ``.csv`` folder of part files as Spark
    writes them. Returns one all-text table per period, keyed by the period name
    that starts the file name; files of one period are stacked by column name.
    """
    pattern = re.compile({"monthly": MONTHLY_NAME, "quarterly": QUARTERLY_NAME}[kind])
    limit = 12 if kind == "monthly" else 4
    paths: dict[str, list[str]] = {}
    periods: dict[str, str] = {}
    for row in list_files(spark, f"{folder.rstrip('/')}/*.csv").select("path").orderBy("path").collect():
        name = next((p for p in reversed(row.path.split("/")) if p.endswith(".csv") and pattern.search(p)), None)
        if name is None:
            raise ValueError(f"no period in file name {row.path.rsplit('/', 1)[-1]}")
        found = pattern.search(name)
        if not 1 <= int(found.group(1)) <= limit:
            raise ValueError(f"period {int(found.group(1))} in {name} lies outside 1-{limit}")
        paths.setdefault(name[: found.end()], []).append(row.path)
        periods[name[: found.end()]] = name
    return {
        key: read_delimited(spark, files, encoding=encoding, keep_order=keep_order).withColumns(period_of_name(F.lit(periods[key]), kind))
        for key, files in paths.items()
    }
