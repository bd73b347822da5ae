"""Wide repeated measures: row totals, category totals, reshape.

Column names read: letter of the variable, two-digit year, quarter, two-digit
month, further text, category. A category ending in 1-9 is a part, 0 the total.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

from tallyweave import config
from tallyweave.functions.numbers import to_int

_NAME = re.compile(r"^(?P<letter>[A-Z])(?P<period>\d{5})(?P<rest>.*)(?P<digit>\d)$")


class Measure(NamedTuple):
    name: str
    variable: str
    period: str
    digit: str


def parse_measures(columns: Sequence[str], start: int = 0) -> list[Measure]:
    """Measures among the columns from position ``start`` on, in order."""
    found = []
    for name in columns[start:]:
        m = _NAME.match(name)
        if m:
            found.append(Measure(name, m["letter"], m["period"], m["digit"]))
    return found


def measure_start(columns: Sequence[str], marker: str = "F0101") -> int:
    """Position of the first column whose name contains ``marker``; 0 without one."""
    return next((i for i, c in enumerate(columns) if marker in c), 0)


def measure_groups(columns: Sequence[str], start: int = 0) -> dict[str, list[str]]:
    """Period -> measure prefixes, periods ascending, prefixes by length and letter."""
    groups: dict[str, list[str]] = defaultdict(list)
    for prefix in sorted({m.variable + m.period for m in parse_measures(columns, start)}, key=lambda p: (len(p), p)):
        groups[prefix[-2:]].append(prefix)
    return dict(sorted(groups.items()))


def _whole(df: DataFrame, name: str) -> Column:
    """Missing or bad values are 0, decimals are cut."""
    column = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, IntegralType):
        return F.coalesce(column.cast("long"), F.lit(0).cast("long"))
    if isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return F.coalesce(column.try_cast("long"), F.lit(0).cast("long"))
    return to_int(column)


def _add(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) if columns else F.lit(0).cast("long")


def row_total_parts(measures: Sequence[Measure], parts: Sequence[str], total: str) -> dict[str, list[str]]:
    """Total column -> its parts: same period and category digit, variables in ``parts``."""
    by_place: dict[tuple[str, str], list[str]] = defaultdict(list)
    for m in measures:
        if m.variable in parts:
            by_place[m.period, m.digit].append(m.name)
    return {m.name: by_place[m.period, m.digit] for m in measures if m.variable == total}


def category_total_parts(
    measures: Sequence[Measure], variables: Sequence[str] = config.CATEGORY_VARIABLES
) -> dict[str, list[str]]:
    """Category-total column -> its categories 1-9 of the same variable and period."""
    by_place: dict[tuple[str, str], list[str]] = defaultdict(list)
    for m in measures:
        if m.digit != "0":
            by_place[m.variable, m.period].append(m.name)
    return {m.name: by_place[m.variable, m.period] for m in measures if m.digit == "0" and m.variable in variables}


def add_totals(df: DataFrame, totals: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each total column by the sum of its parts; parts become whole numbers.

    Two projections, no shuffle: one reads the numbers, one adds them up.
    Columns keep their places.
    """
    parts = {p for names in totals.values() for p in names}
    read = df.select(*[_whole(df, c).alias(c) if c in parts else F.col(f"`{c}`") for c in df.columns])
    return read.select(
        *[
            _add([F.col(f"`{p}`") for p in totals[c]]).alias(c) if c in totals else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def establishment_totals(
    df: DataFrame, start: int = 0, semantics: str = config.DOCUMENTED
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Pay and separation totals, then category totals, and what each total is made of.

    ``literal`` leaves the category totals of variable R untouched.
    """
    measures = parse_measures(df.columns, start)
    literal = config.check_semantics(semantics) == config.LITERAL
    variables = [v for v in config.CATEGORY_VARIABLES if not (literal and v == "R")]
    rows = {
        **row_total_parts(measures, config.PAY_PARTS, config.PAY_TOTAL),
        **row_total_parts(measures, config.SEPARATION_PARTS, config.SEPARATION_TOTAL),
    }
    categories = category_total_parts(measures, variables)
    out = add_totals(add_totals(df, rows), categories)
    return out, {**{c: p for c, p in rows.items() if c not in categories}, **categories}


def to_long(df: DataFrame, ids: Sequence[str], start: int = 0) -> DataFrame:
    """(ids, variable, period, category, measure, value) rows of all measures."""
    measures = parse_measures(df.columns, start)
    read = df.select(*ids, *[_whole(df, m.name).alias(m.name) for m in measures])
    entries = [
        F.struct(
            F.lit(m.variable).alias("variable"),
            F.lit(m.period).alias("period"),
            F.lit(m.digit).alias("category"),
            F.lit(m.name).alias("measure"),
            F.col(f"`{m.name}`").alias("value"),
        )
        for m in measures
    ]
    return read.select(*ids, F.inline(F.array(*entries)))


def long_row_total(long: DataFrame, ids: Sequence[str], parts: Sequence[str], total: str) -> DataFrame:
    """Row total in long form: sum over variables per id, period and category."""
    summed = long.filter(F.col("variable").isin(list(parts))).groupBy(*ids, "period", "category").agg(F.sum("value").alias("value"))
    return summed.select(*ids, F.lit(total).alias("variable"), "period", "category", "value")


def long_category_total(long: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Category total in long form: sum over categories 1-9 per id, variable and period."""
    parts = long.filter(F.col("category") != "0").groupBy(*ids, "variable", "period").agg(F.sum("value").alias("value"))
    return parts.select(*ids, "variable", "period", F.lit("0").alias("category"), "value")


def _summed_in_row(df: DataFrame, ids: Sequence[str], groups: dict[tuple, list[str]], labels: Sequence[str]) -> DataFrame:
    """Sums over ids and labels: one wide row of sums per id is grouped and shuffled, its labels become rows afterwards."""
    entries = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(labels, values, strict=True)], F.sum(_add([_whole(df, m) for m in names])).alias("value"))
        for values, names in groups.items()
    ]
    # Without ids a constant key keeps an empty table from yielding a row of nulls.
    wide = df.groupBy(*(ids or [F.lit("all")])).agg(F.array(*entries).alias("value"))
    return wide.select(*ids, F.inline("value"))


def row_total_long(df: DataFrame, ids: Sequence[str], parts: Sequence[str], total: str, start: int = 0) -> DataFrame:
    """:func:`long_row_total` straight from the wide records: only the parts' columns are read."""
    groups: dict[tuple, list[str]] = {}
    for m in parse_measures(df.columns, start):
        if m.variable in parts:
            groups.setdefault((m.period, m.digit), []).append(m.name)
    summed = _summed_in_row(df, ids, groups, ["period", "category"])
    return summed.select(*ids, F.lit(total).alias("variable"), "period", "category", "value")


def category_total_long(df: DataFrame, ids: Sequence[str], start: int = 0) -> DataFrame:
    """:func:`long_category_total` straight from the wide records: total columns are not read."""
    groups: dict[tuple, list[str]] = {}
    for m in parse_measures(df.columns, start):
        if m.digit != "0":
            groups.setdefault((m.variable, m.period), []).append(m.name)
    summed = _summed_in_row(df, ids, groups, ["variable", "period"])
    return summed.select(*ids, "variable", "period", F.lit("0").alias("category"), "value")


def to_wide(long: DataFrame, ids: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Long measures back to one column each, in the listed order."""
    return long.groupBy(*ids).pivot("measure", list(measures)).agg(F.first("value"))
