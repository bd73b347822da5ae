"""Quarterly establishment survey: headers, sections, strata, codes, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyweave import config
from tallyweave.functions.bands import size_stratum
from tallyweave.functions.fields import id_text, pad_code
from tallyweave.functions.numbers import to_number
from tallyweave.operators.audits import reconcile
from tallyweave.operators.headers import header_mapping, pick_columns, remap_columns, verify_headers
from tallyweave.operators.lookups import lookup_sample, lookup_section
from tallyweave.operators.measures import establishment_totals, measure_start
from tallyweave.session import stage

SECTIONS = {"MSIC2008": "SECTION", "MSIC2008_SMPL": "SECTION_SMPL"}


def clean_codes(df: DataFrame, semantics: str = config.DOCUMENTED) -> DataFrame:
    """Code columns as text, zero-padded to their length."""
    widths = config.CODE_WIDTHS_LITERAL if semantics == config.LITERAL else config.CODE_WIDTHS
    return df.withColumns(
        {
            c: pad_code(id_text(c, semantics, isinstance(df.schema[c].dataType, StringType)), w)
            for c, w in widths.items()
            if c in df.columns
        }
    )


def add_size_stratum(df: DataFrame, semantics: str = config.DOCUMENTED) -> DataFrame:
    """``STRATA_EMPL`` from the first employee column."""
    employees = pick_columns(df, contains="F1310")[0]
    stratum = size_stratum("SECTION_SMPL", to_number(f"`{employees}`"), semantics=semantics)
    return df.withColumn("STRATA_EMPL", stratum)


def clean_establishments(
    raw: DataFrame,
    mapping: DataFrame,
    industries: DataFrame,
    sample: DataFrame | None = None,
    *,
    semantics: str = config.DOCUMENTED,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Clean establishment records and reconcile every derived total."""
    config.check_semantics(semantics)
    pairs = header_mapping(mapping)
    df = remap_columns(raw, pairs)
    df = lookup_section(df, industries, SECTIONS)
    df = add_size_stratum(df, semantics)
    df = clean_codes(df, semantics)
    if sample is not None:
        frame = sample.withColumn("NEWSSID", pad_code(id_text("NEWSSID"), config.CODE_WIDTHS["NEWSSID"]))
        df = lookup_sample(df, frame)
    df, made_of = establishment_totals(df, measure_start(df.columns), semantics)
    df = stage(df, "establishments")  # the quality tables and the caller read it again
    quality = {
        "headers": verify_headers(raw.sparkSession, raw.columns, pairs),
        "totals": reconcile(df, made_of),
        "strata": df.groupBy("STRATA_EMPL").agg(F.count(F.lit(1)).alias("rows")),
    }
    return df, quality
