"""History of quality tables: one snapshot a run, never overwritten, and the difference of two runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.sources.sinks import write_quality_table


def _folder(path: str, run: str) -> str:
    if not run or any(c in run for c in "/=*?[]{}"):
        raise ValueError(f"{run!r} does not name a run")
    return f"{path.rstrip('/')}/run={run}"


def write_snapshot(df: DataFrame, path: str, run: str, *partition_by: str) -> None:
    """Add the snapshot of a run; a run that is there already is an error."""
    folder = _folder(path, run)
    try:
        df.sparkSession.read.parquet(folder)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    else:
        raise FileExistsError(f"run {run} is in {path} already")
    write_quality_table(df, folder, *partition_by)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots with their run; a column that some lack is null there."""
    found = spark.read.option("basePath", path.rstrip("/")).option("mergeSchema", True).parquet(f"{path.rstrip('/')}/run=*")
    return found.withColumn("run", F.col("run").cast("string"))


def compare_runs(spark: SparkSession, path: str, before: str, after: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Cells that differ between two runs: keys, measure, value before and after, change and status.

    ``status`` is added, removed or changed; ``change`` is null unless both
    values are there. Null keys count as equal; rows of one key add up. Only the
    folders of the two runs are read.
    """
    sides = []
    for name, run in (("before", before), ("after", after)):
        one = spark.read.parquet(_folder(path, run))
        sums = one.groupBy(*keys).agg(*[F.sum(m).cast("double").alias(f"{name}_{m}") for m in measures])
        sides.append(sums.withColumn(f"in_{name}", F.lit(True)).withColumnsRenamed({k: f"{name}_{k}" for k in keys}))
    match = reduce(lambda a, b: a & b, [F.col(f"before_{k}").eqNullSafe(F.col(f"after_{k}")) for k in keys])
    both = sides[0].join(sides[1], match, "full_outer")
    status = F.when(F.col("in_before").isNull(), "added").when(F.col("in_after").isNull(), "removed").otherwise("changed")
    entries = [F.struct(F.lit(m).alias("measure"), F.col(f"before_{m}").alias("before"), F.col(f"after_{m}").alias("after")) for m in measures]
    named = [F.coalesce(f"before_{k}", f"after_{k}").alias(k) for k in keys]
    long = both.select(*named, status.alias("status"), F.explode(F.array(*entries)).alias("e"))
    differs = (F.col("status") != "changed") | ~F.col("e.before").eqNullSafe(F.col("e.after"))
    shown = long.filter(differs).select(*keys, "e.measure", "e.before", "e.after", (F.col("e.after") - F.col("e.before")).alias("change"), "status")
    return shown
