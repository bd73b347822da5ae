"""Period roll-ups: stack monthly or quarterly finals, then weight them."""

from __future__ import annotations

from collections.abc import Mapping

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.operators.headers import plain_headers
from tallyweave.operators.stacking import column_drift, shape_report, stack
from tallyweave.plans.household import ORDER, HouseholdWeights, weight_household

# Number of tables each roll-up stacks.
EXPECTED_TABLES = {"quarterly": 3, "halfyear": 2, "annual": 12}

# Columns that a weighting adds, under plain headers.
DERIVED = frozenset(
    "NOID38 KU5 G2 G3 G4 G5 CITNONCIT RINSTRATA PFINPUT PFOUTPUT ADJUSTEDWEIGHT POPFAC PEMBERAT1 ANGGARANSAMPELSTB "
    "ANGGARANPENDUDUKBPPD WEIGHTPOP PEMBERATFINAL IDPOP BULAN TAHUN KUARTER SRCFILE SRCBLOCK SRCROW".split()
)


def raw_records(stacked: DataFrame) -> DataFrame:
    """Stacked finals as raw records: without what an earlier weighting derived.

    Rows that hold a control domain alone have no person fields and are left
    out: they would count as a responding household of their state.
    """
    kept = stacked.drop(*[c for c in stacked.columns if c in DERIVED])
    fields = [c for c in (*config.ID_WIDTHS, "U", "KW") if c != "NG" and c in kept.columns]
    return kept.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in fields])) if fields else kept


def stack_finals(frames: Mapping[str, DataFrame], order: str | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Stack final tables under plain headers, all text, with drift and shape reports.

    Rows are ordered by year, period and the table's own ``order`` column, so
    that "first" does not depend on how the catalog lists its tables.
    """
    spark = next(iter(frames.values())).sparkSession
    plain = {name: plain_headers(df.drop(order) if order else df) for name, df in frames.items()}
    reports = {"drift": column_drift(spark, plain), "shapes": shape_report(plain)}
    parts = []
    for name, df in frames.items():
        part = plain_headers(df.withColumnRenamed(order, "ORDERINTABLE")) if order else plain[name]
        text = part.select(*[F.col(c).cast("string").alias(c) for c in plain[name].columns])
        if order:
            place = F.struct(*[F.col(c).try_cast("int").alias(c) for c in ("YEARS", "QUARTER", "MONTHS") if c in part.columns],
                             F.lit(name).alias("table"), F.col("ORDERINTABLE").alias("row"))
            text = part.select(*[F.col(c).cast("string").alias(c) for c in plain[name].columns], place.alias(ORDER))
        parts.append(text)
    return stack(parts), reports


def roll_up(
    frames: Mapping[str, DataFrame],
    households: DataFrame,
    population: DataFrame,
    controls: DataFrame,
    crosswalk: DataFrame,
    *,
    kind: str = "quarterly",
    order: str | None = None,
    **options,
) -> HouseholdWeights:
    """Stack the finals of one period and weight them; any number of tables goes.

    Finals may be raw-like or outputs of a weighting, whose results are left out
    and worked out anew. The quality table ``tables`` compares their number with the expected one.
    """
    stacked, reports = stack_finals(frames, order)
    done = weight_household(
        raw_records(stacked), households, population, controls, crosswalk, order=ORDER if order else None, **options
    )
    count = stacked.sparkSession.createDataFrame(
        [(kind, len(frames), EXPECTED_TABLES[kind])], "kind string, tables int, expected int"
    )
    return HouseholdWeights(done.microdata, done.quality.with_tables(**reports, tables=count))
