"""First occurrences, repeats and running positions.

A window partitioned by the key would hold a hot key's rows in one task. Here
the first position of each key is a grouped minimum, which combines before the
shuffle, and rows find it again by a join on key *and* position. That pair is
unique, so the join spreads evenly whatever the key distribution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.joins import null_safe


def _order(order: str | Sequence[str]) -> Column:
    return F.col(order) if isinstance(order, str) else F.struct(*order)


def key_summary(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] | None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per key: the carried columns, the first position and the number of rows.

    ``carry`` names columns that follow from the key. The key itself is left
    out, so the table is narrow; counts per stratum and first marks both start
    from it.
    """
    measured = [F.count(F.lit(1)).alias("_rows")]
    if order is not None:
        measured.append(F.min(_order(order)).alias("_first"))
    grouped = df.groupBy(*dict.fromkeys([*carry, *keys])).agg(*measured)
    return grouped.select(*carry, "_rows", *(["_first"] if order is not None else []))


def _firsts(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], order_is_unique: bool):
    grouped = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(_order(order)).alias("_first"))
    if order_is_unique:
        return grouped.select("_first"), []
    return grouped, [(k, f"_k{i}") for i, k in enumerate(keys)]


def _join_firsts(df, keys, order, order_is_unique, how):
    firsts, pairs = _firsts(df, keys, order, order_is_unique)
    placed = df.withColumn("_place", _order(order))
    match = F.col("_place") == F.col("_first")
    if pairs:
        match = match & null_safe(pairs)
    return placed.join(firsts, match, how)


def _marked(joined: DataFrame, columns: Sequence[str], name: str, first: int, repeat: int) -> DataFrame:
    mark = F.when(F.col("_first").isNotNull(), first).otherwise(repeat).cast("int").alias(name)
    return joined.select(*[f"`{c}`" for c in columns if c != name], mark)


def mark_positions(
    df: DataFrame, summary: DataFrame, order: str, *, name: str = "PF_OUTPUT", first: int = 1, repeat: int = 2
) -> DataFrame:
    """First marks from a :func:`key_summary` whose ``order`` tells all rows apart."""
    joined = df.join(summary.select("_first"), F.col(order) == F.col("_first"), "left")
    return _marked(joined, df.columns, name, first, repeat)


def mark_first(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    *,
    name: str = "PF_OUTPUT",
    first: int = 1,
    repeat: int = 2,
    order_is_unique: bool = False,
) -> DataFrame:
    """Mark the first row of each key and its repeats. Null keys count as equal.

    ``order`` must tell the rows of one key apart; set ``order_is_unique`` when
    it tells all rows apart (a source position), which narrows the join.
    """
    joined = _join_firsts(df, keys, order, order_is_unique, "left")
    return _marked(joined, df.columns, name, first, repeat)


def repeat_rows(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[str], *, order_is_unique: bool = False
) -> DataFrame:
    """Second and later rows of each key.

    Rows equal in key and order are told apart by their other columns; of rows
    equal in all columns, one can be the first and the rest are repeats.
    """
    if order_is_unique:
        return _join_firsts(df, keys, order, True, "left_anti").drop("_place")
    names = [f"`{c}`" for c in df.columns]
    place = F.struct(_order(order).alias("order"), F.struct(*names).alias("row"))
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_whole", place)
    joined = _join_firsts(counted, keys, "_whole", False, "left")
    left = F.col("_copies") - F.when(F.col("_first").isNotNull(), 1).otherwise(0)
    spread = joined.withColumn("_left", left).filter("_left > 0")
    return spread.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left")))).select(*names)


def first_rows(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key with the values of its first row, nulls included."""
    return df.groupBy(*keys).agg(*[F.min_by(v, _order(order)).alias(v) for v in values])


def order_ties(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Positions held by more than one row of a key; empty when ``order`` is fit for use."""
    names = [order] if isinstance(order, str) else list(order)
    return df.groupBy(*dict.fromkeys([*keys, *names])).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def running_position(
    df: DataFrame, keys: Sequence[str], order: str, *, name: str = "position", slice_width: int = 1_000_000
) -> DataFrame:
    """1-based position of each row within its key, by an integer ``order`` unique within the key.

    The order range is cut into slices of ``slice_width`` values, so a task
    sorts at most that many rows of a key. Counts of the earlier slices give
    the offset.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(order) / slice_width))
    by = [*keys, "_slice"]
    sizes = sliced.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in by})
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    joined = local.join(offsets, null_safe([(c, f"_o_{c}") for c in by]))
    return joined.select(*[f"`{c}`" for c in df.columns], (F.col("_offset") + F.col("_local")).alias(name))


def block_position(df: DataFrame, keys: Sequence[str], order: str, size: int = 18, **options) -> DataFrame:
    """Block number and position within blocks of ``size`` rows, both from 1."""
    placed = running_position(df, keys, order, name="_position", **options)
    return placed.select(
        *[f"`{c}`" for c in df.columns],
        (F.floor((F.col("_position") - 1) / size) + 1).cast("long").alias("block"),
        ((F.col("_position") - 1) % size + 1).cast("long").alias("position"),
    )
