"""Weight transfer from a donor table: by ID, else by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.dedupe import first_rows
from tallyweave.session import stage


def first_donors(donors: DataFrame, key: str, weight: str, order: str | Sequence[str]) -> DataFrame:
    """The weight of the first donor row per key; keyless rows give none."""
    return first_rows(donors.filter(F.col(key).isNotNull()), [key], order, [weight])


def transfer_weight(
    target: DataFrame,
    donors: DataFrame,
    *,
    id_column: str = "ID_38",
    name_column: str = "NAMA",
    weight: str = "PEMBERATFINAL",
    order: str | Sequence[str] = "_ord",
) -> DataFrame:
    """Give each target row the weight of its donor and tell how it matched.

    ``MATCH`` is ``id``, ``name`` or ``none``. A matching ID decides even if its
    weight is null. Unmatched rows keep the weight they had.

    Donors are cut to one row per key and staged. Small donor tables then join
    by broadcast; large ones meet the target as two plain shuffles, the shape in
    which adaptive execution splits a hot key of the target over many tasks. The
    result of the ID join is staged: hits are done, and misses alone go by name.
    """
    by_id = first_donors(donors, id_column, weight, order).select(
        F.col(id_column).alias("_id"), F.col(weight).alias("_id_weight"), F.lit(True).alias("_id_hit")
    )
    by_name = first_donors(donors, name_column, weight, order).select(
        F.col(name_column).alias("_name"), F.col(weight).alias("_name_weight"), F.lit(True).alias("_name_hit")
    )
    by_id, by_name = stage(by_id, "donors_by_id"), stage(by_name, "donors_by_name")
    # Rows without an ID cannot match one, and only rows that missed by ID look for a name.
    keyed, blank = target.filter(F.col(id_column).isNotNull()), target.filter(F.col(id_column).isNull())
    found = keyed.join(by_id, F.col(id_column) == F.col("_id"), "left")
    found = stage(found.unionByName(blank, allowMissingColumns=True), "matched_by_id")
    hits, misses = found.filter("_id_hit"), found.filter("_id_hit is null")
    named, nameless = misses.filter(F.col(name_column).isNotNull()), misses.filter(F.col(name_column).isNull())
    joined = named.join(by_name, F.col(name_column) == F.col("_name"), "left")
    joined = joined.unionByName(hits, allowMissingColumns=True).unionByName(nameless, allowMissingColumns=True)
    weight_type = donors.schema[weight].dataType
    existing = F.col(weight).cast(weight_type) if weight in target.columns else F.lit(None).cast(weight_type)
    taken = (
        F.when(F.col("_id_hit"), F.col("_id_weight")).when(F.col("_name_hit"), F.col("_name_weight")).otherwise(existing)
    )
    match = F.when(F.col("_id_hit"), "id").when(F.col("_name_hit"), "name").otherwise("none")
    return joined.select(*[f"`{c}`" for c in target.columns if c != weight], taken.alias(weight), match.alias("MATCH"))


def unmatched_report(transferred: DataFrame, columns: Sequence[str] = ("YEARS", "MONTHS", "NAMA", "ID_38")) -> DataFrame:
    """Rows that found no donor."""
    return transferred.filter(F.col("MATCH") == "none").select(*columns)
