"""Person IDs and the derived classes of the household survey."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.functions.bands import age_band_5, age_band_10, binary_code, code_group, urban_rural
from tallyweave.functions.fields import fixed_width, strip_dots
from tallyweave.functions.numbers import to_int, to_number

CLASSES = ["KU_5", "G2", "G3", "G4", "G5", "CIT_NONCIT", "RIN_STRATA"]
IMPUTED = ["U", "KET", "KW", "ST"]


def build_id(df: DataFrame, widths: Mapping[str, int] = config.ID_WIDTHS, name: str = "NOID_38") -> DataFrame:
    """Bring the ID fields to their widths and add the concatenated ID; null fields give a null ID."""
    padded = df.withColumns({c: fixed_width(c, w) for c, w in widths.items()})
    return padded.withColumn(name, F.concat(*widths))


def region_of(state: Column) -> Column:
    """SEM, SAB or SAR."""
    return (
        F.when(state.isin(config.PENINSULAR), "SEM")
        .when(state.isin(config.SABAH), "SAB")
        .when(state.isin(config.SARAWAK), "SAR")
    )


def routed_group(state: str = "NG") -> Column:
    """Ethnic group by the grouping of the state's region."""
    region = region_of(F.col(state))
    return F.when(region == "SEM", F.col("G3")).when(region == "SAB", F.col("G4")).when(region == "SAR", F.col("G5"))


def cell_group(semantics: str = config.DOCUMENTED) -> Column:
    """Group part of the cell key: the routed group; non-citizens share group 0.

    ``literal`` keeps the routed group for non-citizens as well.
    """
    if config.check_semantics(semantics) == config.LITERAL:
        return routed_group()
    return F.when(F.col("CIT_NONCIT") == 1, routed_group()).otherwise(F.lit(0)).cast("int")


def classify(df: DataFrame) -> DataFrame:
    """Add age bands, ethnic groups, citizenship and strata.

    Missing or bad ages, ethnic and citizenship codes and strata digits read as
    0 and are counted by :func:`imputation_audit`.
    """
    coerced = df.withColumns({c: to_int(c) for c in IMPUTED})
    return coerced.withColumns(
        {
            "KU_5": age_band_5("U"),
            "G2": age_band_10("U"),
            "G3": code_group("KET", config.GROUPS_PENINSULAR),
            "G4": code_group("KET", config.GROUPS_SABAH),
            "G5": code_group("KET", config.GROUPS_SARAWAK),
            "CIT_NONCIT": binary_code("KW"),
            "RIN_STRATA": urban_rural("ST"),
            "NG": strip_dots("NG"),
            "J": to_int("J", None),
        }
    )


def imputation_audit(df: DataFrame) -> DataFrame:
    """(column, imputed) rows: values of the raw table that read as 0 for want of a number."""
    counted = df.agg(*[F.count_if(to_number(c).isNull()).alias(c) for c in IMPUTED])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("imputed")) for c in IMPUTED]
    return counted.select(F.explode(F.array(*pairs)).alias("e")).select("e.*")
