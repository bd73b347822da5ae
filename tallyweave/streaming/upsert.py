"""Intake by content: new files update the periods they hold, replays and copies change nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyweave.session import stage
from tallyweave.sources.delimited import drop_empty_rows
from tallyweave.sources.store import PeriodStore, content_digest

_LEDGER = "digest string, file string, batch long"


def applied_files(spark: SparkSession, ledger: str) -> DataFrame:
    """Digest, name and batch of every file applied so far; empty before the first one."""
    try:
        return spark.read.schema(_LEDGER).parquet(ledger)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _LEDGER)


def upsert(rows: DataFrame, store: PeriodStore, keys: Sequence[str], order: Sequence[str]) -> list[dict]:
    """Put ``rows`` in place of the stored rows of equal ``keys`` in their period, and add the others.

    Of several new rows of one key the last by ``order`` counts. Only the periods
    that ``rows`` touch are read, and only those whose content changes are written.
    """
    place = F.struct(*order)
    columns = [c for c in rows.columns if c not in order]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    by = [*store.periods, *[k for k in keys if k not in store.periods]]
    # A grouped maximum combines before the shuffle, so a hot key is no hot task.
    newest = rows.groupBy(*by).agg(F.max_by(row, place).alias("row")).select("row.*")
    newest = stage(newest.withColumns({p: F.col(p).cast("long") for p in store.periods}), "newest")
    touched = {tuple(r) for r in newest.select(*store.periods).distinct().collect()}  # one row a period
    held = {tuple(r) for r in store.manifest().filter("state = 'accepted'").select(*store.periods).collect()}
    whole = newest
    if both := sorted(touched & held):
        named = store.spark.createDataFrame(both, ", ".join(f"`{p}` long" for p in store.periods))
        old = store.current().join(F.broadcast(named), store.periods, "left_semi")
        whole = newest.unionByName(old.join(newest.select(*by), by, "left_anti"), allowMissingColumns=True)
    return store.write_back(whole)


def upsert_files(
    spark: SparkSession,
    folder: str,
    store: PeriodStore,
    ledger: str,
    state_path: str,
    columns: Sequence[str],
    keys: Sequence[str],
    periods: Mapping[str, Column],
    *,
    timeout: int | None = None,
) -> None:
    """Apply all new CSV files of ``folder`` to the periods of ``store`` and stop.

    A file whose content was applied before (a replay, or a copy under another
    name) changes nothing: the ``ledger`` holds the digest of every applied
    file. A batch that failed half way is applied again as a whole, which leads
    to the same content. ``periods`` gives each period column from the others.
    """

    def apply(batch: DataFrame, number: int) -> None:
        rows = stage(drop_empty_rows(batch, ignore=["_file", "_time"]), "batch")
        found = rows.groupBy("_file").agg(content_digest(columns).alias("digest"))
        # Of equal files in one batch the first by name counts.
        found = found.groupBy("digest").agg(F.min("_file").alias("file"))
        # What this batch wrote before it failed does not count as applied.
        before = applied_files(spark, ledger).filter(F.col("batch") != number)
        fresh = stage(found.join(before, "digest", "left_anti"), "fresh")
        new = rows.join(fresh.select(F.col("file").alias("_file")), "_file", "left_semi")
        upsert(new.withColumns(dict(periods)), store, keys, ["_time", "_file"])
        entries = fresh.select("digest", "file", F.lit(number).cast("long").alias("batch"))
        entries.write.mode("overwrite").parquet(f"{ledger}/of={number}")

    reader = spark.readStream.schema(StructType([StructField(c, StringType()) for c in columns]))
    raw = reader.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True).csv(folder)
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"))
    query = raw.writeStream.foreachBatch(apply).option("checkpointLocation", state_path).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"intake of {folder} still running after {timeout} s")
