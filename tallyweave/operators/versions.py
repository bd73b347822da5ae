"""Versions and time series of period tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import stage


def retain_periods(
    df: DataFrame, period: str = "period", version: str = "version", newest: int | None = None
) -> DataFrame:
    """Rows of the latest version of each period, of the ``newest`` periods only if given.

    Versions are found on one row per period; that table is staged, so the data
    are filtered by a broadcast join and not shuffled on a handful of periods.
    """
    latest = df.groupBy(period).agg(F.max(version).alias("_latest"))
    if newest is not None:
        latest = latest.orderBy(F.col(period).desc()).limit(newest)
    joined = df.join(stage(latest, "latest"), period)
    return joined.filter(F.col(version) == F.col("_latest")).select(*[f"`{c}`" for c in df.columns])


def to_time_series(
    df: DataFrame, keys: Sequence[str], period: str, periods: Sequence | None, value: str, how=F.sum
) -> DataFrame:
    """Long to wide: one column per period, null where a key has none.

    Without a list the periods are those of the data, in order; one row per
    period reaches the driver. A given list must hold all of them, since rows of
    another period would have no column.
    """
    found = [r[0] for r in df.select(period).distinct().dropna().orderBy(period).collect()]
    if periods is not None and (unlisted := [p for p in found if p not in set(periods)]):
        raise ValueError(f"periods without a column: {unlisted}")
    return df.groupBy(*keys).pivot(period, list(found if periods is None else periods)).agg(how(value))


def from_time_series(df: DataFrame, keys: Sequence[str], period: str, value: str, keep_null: bool = False) -> DataFrame:
    """Wide to long: one row per key and period; periods without value drop out unless asked for."""
    columns = [c for c in df.columns if c not in keys]
    long = df.unpivot(list(keys), [f"`{c}`" for c in columns], period, value)
    return long if keep_null else long.filter(F.col(value).isNotNull())
