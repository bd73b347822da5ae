"""The jobs from files and tables to published tables.

Each run reads its inputs, takes the period from them or from the control
record, and publishes under the period's table name. Quality tables go to
``quality_path`` if given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.functions.periods import half_of_quarter
from tallyweave.operators.audits import sole_value
from tallyweave.plans.establishments import clean_establishments
from tallyweave.plans.household import HouseholdWeights, weight_household
from tallyweave.plans.individuals import transfer_individual_weights
from tallyweave.plans.partials import BUCKETS, build_state, drop_state, has_state, load_state, merge_states, save_state, weigh_state
from tallyweave.plans.rollup import roll_up
from tallyweave.sources.control import clean_control, latest_control
from tallyweave.sources.delimited import ORDER, infer_integers, kept_order, position_columns, read_delimited, read_with_offset
from tallyweave.sources.files import ingest_finals, latest_file
from tallyweave.sources.sinks import publish, table_name, write_quality_table
from tallyweave.sources.snapshots import write_snapshot
from tallyweave.sources.store import PeriodStore
from tallyweave.sources.tables import find_period_tables

# Period columns of the finals that each roll-up takes.
PERIOD_COLUMNS = {
    "quarterly": {"QUARTER": "quarter", "YEARS": "year"},
    "halfyear": {"HALFYEAR": "halfyear", "YEARS": "year"},
    "annual": {"YEARS": "year"},
}


def _template(spark: SparkSession, path: str) -> DataFrame:
    return infer_integers(read_delimited(spark, path, encoding=None))


# Quality tables that are kept by state.
BY_STATE = {"factors", "factor_columns", "master_sem", "master_sab", "master_sar"}


def _write_quality(quality: Mapping[str, DataFrame], path: str | None, run: str | None = None) -> None:
    """Quality tables under ``path``; with a ``run`` they are added to what earlier runs wrote, those of states by state."""
    if not path:
        return
    for name, df in quality.items():
        place = f"{path.rstrip('/')}/{name}"
        if run is None:
            write_quality_table(df, place)
        else:
            write_snapshot(df, place, run, *(["NG"] if name in BY_STATE else []))


def control_period(control: DataFrame, sequence: str) -> dict[str, int]:
    """Period fields of the latest control record, missing ones as 0."""
    fields = [c for c in ("year", "quarter", "halfyear", "month") if c in control.columns]
    row = clean_control(latest_control(control.select(*dict.fromkeys([*fields, sequence])), sequence), *fields).first()
    return {c: row[c] for c in fields}


def _templates(spark, households, population, controls, crosswalk):
    return tuple(_template(spark, p) for p in (households, population, controls, crosswalk))


def run_monthly(
    spark: SparkSession,
    raw_path: str,
    *,
    households: str,
    population: str,
    controls: str,
    crosswalk: str,
    database: str | None = None,
    quality_path: str | None = None,
    quality_run: str | None = None,
    **options,
) -> str:
    """Weight one month of household records; the month stands in the households template."""
    templates = _templates(spark, households, population, controls, crosswalk)
    month, year, quarter = (int(sole_value(templates[0], c)) for c in ("BULAN", "TAHUN", "QUARTER"))
    raw = read_delimited(spark, raw_path, encoding=None, keep_order=True)
    period = {"BULAN": month, "TAHUN": year, "KUARTER": quarter}
    done = weight_household(raw, *templates, period=period, keep_position=True, **options)
    _write_quality(done.quality, quality_path, quality_run)
    return publish(done.microdata, table_name("household_monthly", month=month, year=year), database)


def run_ingest(spark: SparkSession, folder: str, kind: str = "monthly", *, database: str | None = None, encoding: str | None = None) -> list[str]:
    """Publish the final data of ``folder``, one table for each period, with period columns and source positions."""
    finals = ingest_finals(spark, folder, kind, encoding=encoding, keep_order=True)
    return [publish(position_columns(df), name, database) for name, df in finals.items()]


def run_roll_up(
    spark: SparkSession,
    kind: str,
    *,
    finals: str,
    period: Mapping[str, int],
    households: str,
    population: str,
    controls: str,
    crosswalk: str,
    database: str | None = None,
    quality_path: str | None = None,
    quality_run: str | None = None,
    **options,
) -> str:
    """Weight a quarter, half-year or year from the final tables of database ``finals``.

    ``period`` is as :func:`control_period` returns it.
    """
    names = _period_finals(spark, kind, finals, period)
    frames = {n: kept_order(spark.table(f"`{finals}`.`{n}`"), "position") for n in names}
    templates = _roll_up_templates(spark, kind, households, population, controls, crosswalk)
    done: HouseholdWeights = roll_up(frames, *templates, kind=kind, order="position", **options)
    _write_quality(done.quality, quality_path, quality_run)
    return publish(done.microdata, table_name(f"household_{kind}", **period), database)


def _period_finals(spark: SparkSession, kind: str, finals: str, period: Mapping[str, int]) -> list[str]:
    wanted = {column: period[name] for column, name in PERIOD_COLUMNS[kind].items()}
    names = find_period_tables(spark, finals, **wanted)
    if not names:
        raise ValueError(f"no table of {finals} holds {wanted}")
    return names


def _roll_up_templates(spark: SparkSession, kind: str, *paths: str) -> tuple[DataFrame, ...]:
    templates = _templates(spark, *paths)
    if kind == "halfyear" and "QUARTER" in templates[0].columns:
        half = half_of_quarter(F.col("QUARTER").try_cast("int"))
        templates = (templates[0].withColumn("HALFYEAR", half), *templates[1:])
    return templates


def run_running_roll_up(
    spark: SparkSession,
    kind: str,
    *,
    finals: str,
    states: str,
    period: Mapping[str, int],
    households: str,
    population: str,
    controls: str,
    crosswalk: str,
    revised: Sequence[str] = (),
    database: str | None = None,
    quality_path: str | None = None,
    quality_run: str | None = None,
    record_id: str | None = None,
    semantics: str = config.DOCUMENTED,
    buckets: int = BUCKETS,
    **options,
) -> str:
    """:func:`run_roll_up` from the partial states in database ``states``.

    Finals of the period that have no state yet get one, and each is merged into
    the stored state of the period so far, so a further month costs its own
    records and one join of states. ``revised`` names finals whose rows changed:
    their states are built anew and the period is merged from the states of its
    finals again, since what a state holds of one final cannot be taken out. All
    states of a database share one number of ``buckets``.
    """
    names = _period_finals(spark, kind, finals, period)
    changed = {n.lower() for n in revised}  # catalogues may keep names in lower case
    built = {"record_id": record_id, "semantics": semantics}
    running = f"{kind}_" + "_".join(str(period[n]) for n in PERIOD_COLUMNS[kind].values())
    for name in names:
        if name.lower() in changed or not has_state(spark, states, name):
            build_state(kept_order(spark.table(f"`{finals}`.`{name}`"), "position"), name, states, order="position", buckets=buckets, **built)
    stored = [n for n in range(2, len(names) + 1) if has_state(spark, states, f"{running}_{n}")]
    state = load_state(spark, states, f"{running}_{stored[-1]}") if stored else None
    if state is None or changed & {p.lower() for p in state.parts} or not set(state.parts) <= set(names):
        state = load_state(spark, states, names[0])
    for name in names:
        if name not in state.parts:
            merged = merge_states([state, load_state(spark, states, name)])
            state = save_state(merged, f"{running}_{len(merged.parts)}", states, buckets)
    for number in range(2, len(names)):
        drop_state(spark, states, f"{running}_{number}")
    templates = _roll_up_templates(spark, kind, households, population, controls, crosswalk)
    done = weigh_state(state, *templates, **built, **options)
    _write_quality(done.quality, quality_path, quality_run)
    return publish(done.microdata, table_name(f"household_{kind}", **period), database)


def run_individual(
    spark: SparkSession,
    raw_path: str,
    *,
    finals: str,
    period: Mapping[str, int],
    database: str | None = None,
    quality_path: str | None = None,
) -> str:
    """Take final weights over to the individual records of a month."""
    names = find_period_tables(spark, finals, MONTHS=period["month"], YEARS=period["year"])
    if not names:
        raise ValueError(f"no table of {finals} holds {dict(period)}")
    # All tables of the month, in the order of their names, then of their rows.
    tables = [kept_order(spark.table(f"`{finals}`.`{n}`")) for n in sorted(names)]
    tables = [t.withColumn(ORDER, F.struct(F.lit(i).alias("table"), F.col(ORDER).alias("row"))) for i, t in enumerate(tables)]
    donors = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    target = read_delimited(spark, raw_path, encoding=None, keep_order=True)
    done, quality = transfer_individual_weights(target, donors, month=period["month"], year=period["year"])
    _write_quality(quality, quality_path)
    return publish(done, table_name("individual_monthly", month=period["month"], year=period["year"]), database)


def run_establishments(
    spark: SparkSession,
    raw_path: str,
    *,
    mapping: str,
    industries: str,
    sample: str | None = None,
    header_line: int = 2,
    mapping_header_line: int = 5,
    database: str | None = None,
    quality_path: str | None = None,
    semantics: str = config.DOCUMENTED,
    store: PeriodStore | None = None,
) -> str | list[dict]:
    """Clean one quarter of establishment records; ``mapping`` and ``sample`` may be globs, the newest file counts.

    With a ``store`` (periods ``YEAR``, ``QUARTER``) the quarter is not published
    but proposed there as a new version, to be accepted or rejected; returned
    are the versions proposed.
    """
    headers = read_with_offset(spark, latest_file(spark, mapping), mapping_header_line, encoding=None)
    frame = read_delimited(spark, latest_file(spark, sample), encoding=None) if sample else None
    raw = read_with_offset(spark, raw_path, header_line, encoding=None)
    done, quality = clean_establishments(raw, headers, read_delimited(spark, industries, encoding=None), frame, semantics=semantics)
    _write_quality(quality, quality_path)
    if store is not None:
        return store.propose(done)
    quarter, year = (sole_value(done, c) for c in ("QUARTER", "YEAR"))
    return publish(done, table_name("establishment_quarterly", quarter=quarter, year=year), database)
