"""Period arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _checked(c: Column, low: int, high: int, what: str) -> Column:
    message = F.concat(F.lit(f"{what} must lie between {low} and {high}, got "), c.cast("string"))
    return F.when(c.between(low, high), c).when(c.isNotNull(), F.raise_error(message).cast("int"))


def quarter_of_month(month: Column | str) -> Column:
    """1-4; a month outside 1-12 fails the job."""
    return F.ceil(_checked(_col(month), 1, 12, "month") / 3).cast("int")


def half_of_quarter(quarter: Column | str) -> Column:
    """1-2; a quarter outside 1-4 fails the job."""
    return F.ceil(_checked(_col(quarter), 1, 4, "quarter") / 2).cast("int")


def half_of_month(month: Column | str) -> Column:
    return half_of_quarter(quarter_of_month(month))


def stamp(df: DataFrame, **period: int) -> DataFrame:
    """Add constant period columns, e.g. ``stamp(df, MONTHS=3, YEARS=2021)``."""
    return df.withColumns({name: F.lit(value) for name, value in period.items()})


def quarter_range(year: int, quarter: int) -> tuple[Column, Column]:
    """First moment of a quarter and of the next: as a range on a date column it reaches the scan's filters."""
    after = year * 4 + quarter
    begin = f"{year:04d}-{3 * quarter - 2:02d}-01"
    end = f"{after // 4:04d}-{3 * (after % 4) + 1:02d}-01"
    return F.lit(begin).cast("timestamp"), F.lit(end).cast("timestamp")
