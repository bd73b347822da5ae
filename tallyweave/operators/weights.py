"""Design weights, population factors, first and final weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.functions.fields import strip_commas
from tallyweave.functions.numbers import exact_sum, factor_or_one, round_half_even, safe_ratio
from tallyweave.operators.cells import CELL
from tallyweave.operators.joins import lookup, unique_keys
from tallyweave.session import stage


def design_weight(
    frame: DataFrame,
    counts: DataFrame,
    *,
    by: Sequence[str] = ("NG", "RIN_STRATA"),
    state: str = "NG",
    households: str = "BIL_ISI_RUMAH",
) -> DataFrame:
    """Households in the frame over responding households, per stratum, to two decimals.

    States without any response are left out; a stratum without response in
    a responding state has none (null weight, listed by the quality report). A
    stratum that the frame lists twice is an error.
    """
    unique_keys(frame, by, "the households template")
    both = frame.withColumn("_framed", F.lit(True)).join(counts.select(*by, "responding"), list(by), "full_outer")
    # A state has a handful of strata, so this window is over small groups of a small table.
    in_state = F.max("responding").over(Window.partitionBy(state))
    joined = both.withColumn("_in_state", in_state).filter("_framed and _in_state is not null").drop("_framed", "_in_state")
    responding = F.coalesce(F.col("responding"), F.lit(0)).cast("long")
    total = F.coalesce(strip_commas(households), F.lit(0.0))
    return joined.withColumns(
        {
            households: total,
            "responding": responding,
            "ADJUSTED_WEIGHT": round_half_even(safe_ratio(total, responding), 2),
        }
    )


def weight_check(weights: DataFrame, supplied: str = "ADJUSTED_WEIGHT_BMP") -> DataFrame:
    """Difference between the weight and the supplied one, to two decimals."""
    given = F.coalesce(strip_commas(supplied), F.lit(0.0))
    return weights.withColumn("SEMAKAN_AW_BMP", round_half_even(F.col("ADJUSTED_WEIGHT") - given, 2))


def spread_weight(weights: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """One weight row per state, stratum and stratum digit; a repeated crosswalk row is an error."""
    digits = crosswalk.select(*[F.col(c).try_cast("long").alias(c) for c in ("NG", "RIN_STRATA", "ST")])
    unique_keys(digits, ["NG", "RIN_STRATA", "ST"], "the crosswalk")
    return lookup(weights, digits, ["NG", "RIN_STRATA"]).select("NG", "RIN_STRATA", "ST", "ADJUSTED_WEIGHT")


def attach_weight(df: DataFrame, weights: DataFrame, on: Sequence[str] = ("NG", "RIN_STRATA", "ST")) -> DataFrame:
    """Left join; rows without a weight keep null."""
    return lookup(df, weights, on)


def population_factor(
    population: DataFrame, sample: DataFrame, on: Sequence[str] = CELL, missing: float | None = 0.0
) -> DataFrame:
    """Population over sample per cell, to two decimals.

    Cells without sample get ``missing``: 0 as coded, or ``None`` to leave them
    out of the table as documented.
    """
    joined = lookup(population, sample, on)
    factor = round_half_even(safe_ratio("POPULATION", "SAMPLE"), 2)
    if missing is not None:
        return joined.withColumn("POPFAC", F.coalesce(factor, F.lit(missing)))
    return joined.withColumn("POPFAC", factor).filter("POPFAC is not null")


def factor_keys(factors: DataFrame, semantics: str = config.DOCUMENTED) -> DataFrame:
    """Factor table keyed by cell. ``literal`` gives non-citizen rows their sex as group."""
    group = F.col("GRP")
    if config.check_semantics(semantics) == config.LITERAL:
        group = F.when(F.col("CIT_NONCIT") == 2, F.col("J")).otherwise(group).cast("int")
    return factors.select("NG", "CIT_NONCIT", "KU_5", "J", group.alias("GRP"), "POPFAC")


def attach_factor(df: DataFrame, factors: DataFrame, on: Sequence[str] = CELL) -> DataFrame:
    """Left join on the cell; rows outside every cell get 1, a factor of 0 stays 0."""
    joined = lookup(df, factors, on)
    return joined.withColumn("POPFAC", factor_or_one("POPFAC"))


def first_weight(df: DataFrame) -> DataFrame:
    return df.withColumn("PEMBERAT_1", F.col("ADJUSTED_WEIGHT") * F.col("POPFAC"))


def control_ratios(
    estimates: DataFrame,
    controls: DataFrame,
    by: Sequence[str],
    *,
    estimate: str = "ANGGARAN_SAMPEL_STB",
    control: str = "ANGGARAN_PENDUDUK(BPPD)",
) -> DataFrame:
    """Control over estimate per domain; domains of either side are kept.

    ``in_sample`` tells domains with microdata from those of the control alone.
    A domain that the controls list twice is an error.
    """
    unique_keys(controls, by, "the controls")
    given = controls.select(*by, strip_commas(f"`{control}`").alias(control))
    found = estimates.select(*by, estimate, F.lit(True).alias("in_sample"))
    both = found.join(given, list(by), "full_outer")
    return both.withColumns(
        {
            "in_sample": F.coalesce("in_sample", F.lit(False)),
            "WEIGHT_POP": safe_ratio(f"`{control}`", estimate),
        }
    )


def apply_ratios(
    df: DataFrame, ratios: DataFrame, by: Sequence[str], *, weight: str, final: str, keep_unmatched_controls: bool
) -> DataFrame:
    """Final weight = ratio x weight; control-only domains follow as rows without microdata.

    A full outer join would shuffle the microdata on a handful of keys. The
    ratio table has one row per domain and joins by broadcast; its unmatched
    rows are appended.
    """
    weighed = lookup(df, ratios.drop("in_sample"), by).withColumn(final, F.col("WEIGHT_POP") * F.col(weight))
    if not keep_unmatched_controls:
        return weighed
    return weighed.unionByName(ratios.filter("not in_sample").drop("in_sample"), allowMissingColumns=True)


def calibrate(
    df: DataFrame,
    controls: DataFrame,
    by: Sequence[str],
    *,
    weight: str = "PEMBERAT_1",
    final: str = "PEMBERAT_FINAL",
    control: str = "ANGGARAN_PENDUDUK(BPPD)",
    digits: int = 9,
    keep_unmatched_controls: bool = True,
) -> DataFrame:
    """Scale ``weight`` so that its sum per domain equals the control total.

    Adds the estimate, the control, the ratio ``WEIGHT_POP`` and ``final``. The
    ratio table is staged, so the microdata are summed once and read once more.
    Weights are summed exactly to ``digits`` decimals; later ones are rounded off.
    """
    estimates = df.dropna("any", subset=list(by)).groupBy(*by).agg(exact_sum(weight, digits).alias("ANGGARAN_SAMPEL_STB"))
    ratios = stage(control_ratios(estimates, controls, by, control=control), "ratios")
    return apply_ratios(
        df, ratios, by, weight=weight, final=final, keep_unmatched_controls=keep_unmatched_controls
    )


def redistribute_blank(
    cells: DataFrame, within: Sequence[str] = ("NG", "J", "KU_5"), population: str = "POPULATION", sample: str = "SAMPLE"
) -> DataFrame:
    """Share the population of cells without sample among the sampled cells of the same block.

    With a = population of blank cells, b = population of the block: where
    100 a / b reaches 1, sampled cells get pop + pop / (b - a) * a, rounded;
    otherwise nothing changes. ``within`` names a block of few group cells.
    """
    block = Window.partitionBy(*within)
    pop = F.col(population)
    blank = F.col(sample).isNull()
    a = F.coalesce(F.sum(F.when(blank, pop)).over(block), F.lit(0.0))
    b = F.sum(pop).over(block)
    share = F.rint(pop + safe_ratio(pop, b - a) * a)
    moved = ~blank & (safe_ratio(100 * a, b) >= 1)
    return cells.withColumn("POPULATION_ADJUSTED", F.when(moved, share).otherwise(pop))
