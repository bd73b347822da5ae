"""Incremental file intake: each file is read once, then archived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyweave.sources.delimited import drop_empty_rows


def intake_files(
    spark: SparkSession,
    folder: str,
    table_path: str,
    state_path: str,
    columns: Sequence[str],
    *,
    archive: str | None = None,
    max_files: int | None = None,
    timeout: int | None = None,
) -> None:
    """Append the rows of all new CSV files in ``folder`` to ``table_path`` and stop.

    ``state_path`` remembers what was read, so a restarted job neither skips nor
    repeats a file. With ``archive`` consumed files move there; the source
    cleans up behind itself, one trigger later.
    """
    reader = (
        spark.readStream.schema(StructType([StructField(c, StringType()) for c in columns]))
        .option("header", True)
        .option("enforceSchema", False)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.csv(folder).select("*", F.col("_metadata.file_name").alias("source_file"))
    query = (
        drop_empty_rows(rows, ignore=["source_file"])
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", state_path)
        .trigger(availableNow=True)
        .start()
    )
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"intake of {folder} still running after {timeout} s")
