"""Household weighting, from raw records to calibrated microdata.

All weights depend on a record only through its state, strata and cell. So the
job counts records per such combination once, works out design weights,
factors, estimates and ratios on that small table, and joins the result back:
one narrow aggregation and one output pass over the microdata.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.functions.fields import fixed_width
from tallyweave.functions.numbers import exact_sum, factor_or_one
from tallyweave.functions.periods import stamp
from tallyweave.operators import audits, cells, classify, dedupe, weights
from tallyweave.operators.headers import upper_headers
from tallyweave.operators.joins import lookup, unique_keys
from tallyweave.session import stage
from tallyweave.sources.delimited import position_columns

ORDER = "_ord"
COMBINATION = ["NG", "RIN_STRATA", "ST", "CIT_NONCIT", "KU_5", "J", "GRP"]
DOMAIN = ["NG", "CIT_NONCIT"]


class QualityTables(Mapping):
    """Quality tables by name, each planned when it is asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def with_tables(self, **tables: DataFrame) -> QualityTables:
        return QualityTables(self._makers | {name: lambda df=df: df for name, df in tables.items()})


@dataclass
class HouseholdWeights:
    """Weighted microdata and the quality tables."""

    microdata: DataFrame
    quality: QualityTables


def prepare_household(raw: DataFrame) -> DataFrame:
    """Header clean-up, ID and classes. ``raw`` may carry ``_ord``."""
    if ORDER in raw.columns:
        named = upper_headers(raw.withColumnRenamed(ORDER, "_ORD")).withColumnRenamed("_ORD", ORDER)
    else:
        named = upper_headers(raw)
    return classify.classify(classify.build_id(named))


def with_cell_group(people: DataFrame, semantics: str = config.DOCUMENTED) -> DataFrame:
    """Add ``GRP``, the ethnic part of the cell key."""
    return people.withColumn("GRP", classify.cell_group(semantics))


def response_key() -> Column:
    """Response key as text, from the fields in their ID widths."""
    return F.concat(*[F.coalesce(fixed_width(c, config.ID_WIDTHS[c]), F.lit("")) for c in config.RESPONSE_FIELDS])


def weight_household(
    raw: DataFrame,
    households: DataFrame,
    population: DataFrame,
    controls: DataFrame,
    crosswalk: DataFrame,
    *,
    semantics: str = config.DOCUMENTED,
    keep_unmatched_controls: bool = True,
    share_blank_cells: bool = False,
    record_id: str | None = None,
    order: str | None = ORDER,
    period: dict[str, int] | None = None,
    keep_position: bool = False,
) -> HouseholdWeights:
    """Weight household records.

    ``households``, ``population`` and ``controls`` are the three templates,
    ``crosswalk`` maps strata to stratum digits. ``order`` names the source
    position for the first-occurrence mark; ``None`` leaves the mark out.
    ``share_blank_cells`` moves the population of blank cells first. Records
    without ``record_id`` (by default the first column) count towards the sample
    but get no final weight; the quality tables list how many there are.
    ``keep_position`` keeps a source position as plain columns, so that later jobs
    still know which record came first. Templates with a repeated key are an error.
    """
    config.check_semantics(semantics)
    # Keys that follow from other columns are left out of the stage: it is smaller
    # for it, and its projection stays within what the JVM compiles.
    people = with_cell_group(stage(prepare_household(raw), "people"), semantics)

    # One shuffle on the response key serves the counts and the first marks.
    responses = stage(dedupe.key_summary(people, config.RESPONSE_FIELDS, order, cells.STRATUM), "responses")
    record_id = record_id or next(c for c in people.columns if c != ORDER)
    grouped = combination_counts(people, record_id)
    weighed = weigh_combinations(
        responses, grouped, households, population, controls, crosswalk, semantics=semantics, share_blank_cells=share_blank_cells
    )
    out = people.filter(F.col(f"`{record_id}`").isNotNull())
    out = weighted_records(out, weighed, responses, order, keep_unmatched_controls)
    if keep_position:
        out = position_columns(out)
    out = out.drop("GRP", ORDER)
    if period:
        out = stamp(out, **period)

    quality = {
        "null_classes": lambda: audits.null_audit(people, classify.CLASSES),
        "id_lengths": lambda: audits.length_audit(people, "NOID_38"),
        "imputed": lambda: classify.imputation_audit(upper_headers(raw.drop(ORDER))),
    }
    return HouseholdWeights(out, QualityTables(quality | weighed.quality()))


def combination_counts(people: DataFrame, record_id: str) -> DataFrame:
    """Records, and records with an ID, of each combination that a weight depends on."""
    return people.groupBy(*COMBINATION).agg(
        F.count(F.lit(1)).alias("records"), F.count(f"`{record_id}`").alias("identified")
    )


@dataclass
class CombinationWeights:
    """Weights of every combination, and the tables they come from."""

    design: DataFrame
    factors: DataFrame
    weighed: DataFrame
    ratios: DataFrame
    table: DataFrame

    def quality(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "design_weights": lambda: self.design,
            "weight_discrepancies": lambda: audits.discrepancies(self.design, "SEMAKAN_AW_BMP"),
            "unidentified": lambda: self.weighed.agg(F.sum(F.col("records") - F.col("identified")).alias("records")),
            "strata_without_weight": lambda: self.weighed.filter("ADJUSTED_WEIGHT is null")
            .groupBy("NG", "RIN_STRATA", "ST")
            .agg(F.sum("records").alias("records")),
            "factors": lambda: self.factors,
            "factor_columns": lambda: cells.factor_columns(self.factors),
            "master_sem": lambda: cells.region_master(self.factors, "SEM"),
            "master_sab": lambda: cells.region_master(self.factors, "SAB"),
            "master_sar": lambda: cells.region_master(self.factors, "SAR"),
            "ratios": lambda: self.ratios,
        }


def weigh_combinations(
    responses: DataFrame,
    grouped: DataFrame,
    households: DataFrame,
    population: DataFrame,
    controls: DataFrame,
    crosswalk: DataFrame,
    *,
    semantics: str = config.DOCUMENTED,
    share_blank_cells: bool = False,
) -> CombinationWeights:
    """All weights, from one row per response key and the counts per combination."""
    counts = cells.count_keys(responses)
    frame = households.select(
        F.col("KOD_NEGERI").try_cast("long").alias("NG"),
        F.col("RIN_STRATA").try_cast("int").alias("RIN_STRATA"),
        "BIL_ISI_RUMAH",
        "ADJUSTED_WEIGHT_BMP",
    )
    design = stage(weights.weight_check(weights.design_weight(frame, counts)), "design")
    spread = weights.spread_weight(design, crosswalk)

    combos = lookup(stage(grouped, "combinations"), spread, ["NG", "RIN_STRATA", "ST"])
    combos = combos.withColumn("_sum", F.col("records") * F.col("ADJUSTED_WEIGHT"))

    sample = cells.weighted_cells(combos, cells.CELL, "_sum")
    target = unique_keys(cells.population_cells(population), cells.CELL, "the population template")
    factors = _factors(sample, target, semantics, share_blank_cells)
    keyed = weights.factor_keys(factors, semantics)

    weighed = weights.first_weight(
        lookup(combos, keyed, cells.CELL).withColumn("POPFAC", factor_or_one("POPFAC"))
    )
    weighed = stage(weighed.drop("_sum"), "weights")
    estimates = weighed.withColumn("_sum", F.col("identified") * F.col("PEMBERAT_1")).groupBy(*DOMAIN).agg(
        exact_sum("_sum", 4).alias("ANGGARAN_SAMPEL_STB"), F.sum("identified").alias("identified")
    )
    estimates = estimates.filter("identified > 0").drop("identified")
    ratios = stage(weights.control_ratios(estimates, _controls(controls), DOMAIN), "ratios")
    table = stage(lookup(weighed.drop("records", "identified"), ratios.drop("in_sample"), DOMAIN), "applied")
    return CombinationWeights(design, factors, weighed, ratios, table)


def weighted_records(
    people: DataFrame, weighed: CombinationWeights, responses: DataFrame, order: str | None, keep_unmatched_controls: bool
) -> DataFrame:
    """Records with first marks and final weights; domains of the controls alone follow."""
    out = people.withColumn("PF_INPUT", response_key())
    if order is not None:
        out = dedupe.mark_positions(out, responses, order)
    out = lookup(out, weighed.table, COMBINATION, null_matches=True)
    out = out.withColumn("PEMBERAT_FINAL", F.col("WEIGHT_POP") * F.col("PEMBERAT_1"))
    if keep_unmatched_controls:
        out = out.unionByName(weighed.ratios.filter("not in_sample").drop("in_sample"), allowMissingColumns=True)
    return out.withColumn("ID_POP", F.concat(F.col("NG").cast("string"), F.col("CIT_NONCIT").cast("string")))


def _controls(controls: DataFrame) -> DataFrame:
    return controls.withColumns({"NG": F.col("NG").try_cast("long"), "CIT_NONCIT": F.col("CIT_NONCIT").try_cast("int")})


def _factors(sample: DataFrame, target: DataFrame, semantics: str, share_blank_cells: bool) -> DataFrame:
    if semantics == config.LITERAL:
        keys = [c for c in cells.CELL if c != "GRP"]
        citizens = sample.filter("CIT_NONCIT = 1")
        strangers = sample.filter("CIT_NONCIT = 2").groupBy(*keys).agg(exact_sum("SAMPLE", 2).alias("SAMPLE"))
        # As coded, non-citizen cells hang on the citizen cells of the same state and band.
        strangers = strangers.join(citizens.select("NG", "KU_5").distinct(), ["NG", "KU_5"], "left_semi")
        sample = citizens.unionByName(strangers.withColumn("GRP", F.lit(0)))
    if not share_blank_cells:
        return weights.population_factor(target, sample)
    joined = lookup(target, sample, cells.CELL)
    moved = weights.redistribute_blank(joined, ["NG", "CIT_NONCIT", "J", "KU_5"])
    moved = moved.drop("SAMPLE", "POPULATION").withColumnRenamed("POPULATION_ADJUSTED", "POPULATION")
    return weights.population_factor(moved, sample)
