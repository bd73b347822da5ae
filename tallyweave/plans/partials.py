"""Roll-ups from stored partial states instead of restacked finals.

What a weighting needs to know of a period is one row per response key (first
position, number of records) and the record counts of each combination. Both
merge associatively, so a year is the merge of its months' states, in any
grouping. A state is built once a period, with one shuffle of that period's
records by response key, and stored in buckets of that key: merging two stored
states joins bucket to bucket without a shuffle, however many periods they hold.
So a running year is stored (:func:`save_state`) and each month merged into it;
a longer chain of unstored merges is right as well, but shuffles what it merged.

States lie in tables of a database: ``<name>_people`` (classified records),
``<name>_responses`` (with the names of its periods) and ``<name>_combinations``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.operators import cells
from tallyweave.plans.household import COMBINATION, ORDER, HouseholdWeights, QualityTables, combination_counts, prepare_household, weigh_combinations, weighted_records, with_cell_group
from tallyweave.plans.rollup import raw_records, stack_finals

BUCKETS = 64
_SUMMARY = [*cells.STRATUM, "_rows", "_first"]


@dataclass
class PartialState:
    """The state of one or more periods; ``parts`` names them."""

    parts: list[str]
    people: DataFrame
    responses: DataFrame
    combinations: DataFrame


def _key() -> Column:
    """The response key as one text, in which fields and nulls stay apart."""
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in config.RESPONSE_FIELDS])


def _save(df: DataFrame, database: str, name: str, buckets: int | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "key")
    writer.saveAsTable(f"`{database}`.`{name}`")


def _name_parts(spark: SparkSession, database: str, name: str, parts: Sequence[str]) -> None:
    text = json.dumps(sorted(parts)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE `{database}`.`{name}_responses` SET TBLPROPERTIES ('periods' = '{text}')")


def build_state(
    final: DataFrame,
    name: str,
    database: str,
    *,
    order: str,
    record_id: str | None = None,
    semantics: str = config.DOCUMENTED,
    buckets: int = BUCKETS,
) -> PartialState:
    """Build and store the state of one period's final; ``order`` is its source position."""
    spark = final.sparkSession
    stacked, _ = stack_finals({name: final}, order)
    _save(prepare_household(raw_records(stacked)), database, f"{name}_people")
    people = with_cell_group(spark.table(f"`{database}`.`{name}_people`"), semantics)
    record_id = record_id or next(c for c in people.columns if c != ORDER)
    summary = people.withColumn("key", _key()).groupBy("key", *cells.STRATUM)
    summary = summary.agg(F.count(F.lit(1)).alias("_rows"), F.min(ORDER).alias("_first"))
    _save(summary.repartition(buckets, "key"), database, f"{name}_responses", buckets)
    _name_parts(spark, database, name, [name])
    _save(combination_counts(people, record_id), database, f"{name}_combinations")
    return load_state(spark, database, name)


def load_state(spark: SparkSession, database: str, name: str) -> PartialState:
    """A stored state; the records of its periods are read from their own tables."""
    table = lambda suffix, of=name: spark.table(f"`{database}`.`{of}_{suffix}`")
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{name}_responses`").collect()}
    parts = sorted(json.loads(properties["periods"]))
    people = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [table("people", p) for p in parts])
    return PartialState(parts, people, table("responses"), table("combinations"))


def has_state(spark: SparkSession, database: str, name: str) -> bool:
    """Whether a whole state is stored; its combinations are written last."""
    return spark.catalog.tableExists(f"`{database}`.`{name}_combinations`")


def drop_state(spark: SparkSession, database: str, name: str) -> None:
    """Remove a stored state; the records of its periods stay with their own states."""
    for suffix in ("combinations", "responses"):
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}_{suffix}`")


def merge_responses(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per response key of either side: the earlier first position, the records of both."""
    if dict(left.dtypes)["_first"] != dict(right.dtypes)["_first"]:
        raise ValueError("states with different positions do not merge")
    sides = [df.select("key", *[F.col(c).alias(f"{s}{c}") for c in _SUMMARY]) for s, df in (("l", left), ("r", right))]
    both = sides[0].join(sides[1], "key", "full_outer")
    return both.select(
        "key",
        *[F.coalesce(f"l{c}", f"r{c}").alias(c) for c in cells.STRATUM],
        (F.coalesce("l_rows", F.lit(0)) + F.coalesce("r_rows", F.lit(0))).alias("_rows"),
        F.least("l_first", "r_first").alias("_first"),
    )


def merge_combinations(left: DataFrame, right: DataFrame) -> DataFrame:
    """Record counts of both sides, by combination."""
    both = left.unionByName(right)
    return both.groupBy(*COMBINATION).agg(F.sum("records").alias("records"), F.sum("identified").alias("identified"))


def merge_states(states: Sequence[PartialState]) -> PartialState:
    """The state of all periods together; a period that two states hold is an error."""
    parts = [p for s in states for p in s.parts]
    if repeated := sorted({p for p in parts if parts.count(p) > 1}):
        raise ValueError(f"periods in more than one state: {repeated}")
    return PartialState(
        sorted(parts),
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.people for s in states]),
        reduce(merge_responses, [s.responses for s in states]),
        reduce(merge_combinations, [s.combinations for s in states]),
    )


def save_state(state: PartialState, name: str, database: str, buckets: int = BUCKETS) -> PartialState:
    """Store a merged state, so that further periods are merged with it alone."""
    if name in state.parts:
        raise ValueError(f"{name} is one of the periods")
    spark = state.people.sparkSession
    _save(state.responses, database, f"{name}_responses", buckets)
    _name_parts(spark, database, name, state.parts)
    _save(state.combinations, database, f"{name}_combinations")
    return load_state(spark, database, name)


def weigh_state(
    state: PartialState,
    households: DataFrame,
    population: DataFrame,
    controls: DataFrame,
    crosswalk: DataFrame,
    *,
    record_id: str | None = None,
    semantics: str = config.DOCUMENTED,
    keep_unmatched_controls: bool = True,
    share_blank_cells: bool = False,
) -> HouseholdWeights:
    """Weight the periods of a state; ``semantics`` and ``record_id`` are those it was built with."""
    people = with_cell_group(state.people, semantics)
    record_id = record_id or next(c for c in people.columns if c != ORDER)
    weighed = weigh_combinations(
        state.responses, state.combinations, households, population, controls, crosswalk, semantics=semantics, share_blank_cells=share_blank_cells
    )
    named = people.filter(F.col(f"`{record_id}`").isNotNull())
    out = weighted_records(named, weighed, state.responses, ORDER, keep_unmatched_controls)
    return HouseholdWeights(out.drop("GRP", ORDER), QualityTables(weighed.quality()))
