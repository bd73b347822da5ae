"""Individual income survey: final weights taken over from the household survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.fields import upper_trim, with_trimmed_text
from tallyweave.functions.periods import stamp
from tallyweave.operators import audits, dedupe
from tallyweave.operators.classify import build_id
from tallyweave.operators.headers import compact_headers
from tallyweave.operators.transfer import transfer_weight, unmatched_report
from tallyweave.session import stage

ORDER = "_ord"


def prepare_individuals(df: DataFrame) -> DataFrame:
    """Compact headers, 38-character ID, upper-case trimmed names, trimmed text."""
    named = compact_headers(df.drop(ORDER)) if ORDER not in df.columns else _keeping_order(df)
    with_id = build_id(named, name="ID_38")
    return with_trimmed_text(with_id.withColumn("NAMA", upper_trim("NAMA")))


def _keeping_order(df: DataFrame) -> DataFrame:
    renamed = compact_headers(df.withColumnRenamed(ORDER, "ORDERINTABLE"))
    return renamed.withColumnRenamed("ORDERINTABLE", ORDER)


def transfer_individual_weights(
    target: DataFrame, donors: DataFrame, *, month: int, year: int, repeats_above: int = 1
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Weighted individual records and quality tables. Both inputs carry ``_ord``."""
    people, givers = prepare_individuals(target), prepare_individuals(donors)
    # The report tables and the caller read the result again: join once.
    done = stage(stamp(transfer_weight(people, givers), MONTHS=month, YEARS=year), "transferred")
    quality = {
        "unmatched": unmatched_report(done),
        "target_repeated_ids": audits.uniqueness_audit(people, "ID_38", repeats_above),
        "donor_repeated_ids": audits.uniqueness_audit(givers, "ID_38", repeats_above),
        "donor_np": audits.value_counts(givers, "NP"),
        "duplicates": dedupe.repeat_rows(people, ["ID_38"], ORDER, order_is_unique=True).drop(ORDER),
        "matches": done.groupBy("MATCH").agg(F.count(F.lit(1)).alias("rows")),
    }
    return done.drop(ORDER), quality
