"""Text fields: fixed widths, composite IDs, code padding, clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyweave.config import DOCUMENTED, LITERAL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_width(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width`` and keep the first ``width`` characters; null stays null."""
    return F.lpad(_col(c).cast("string"), width, "0")


def composite_id(widths: Mapping[str, int]) -> Column:
    """Concatenate fixed-width fields; null if any field is null."""
    return F.concat(*[fixed_width(name, width) for name, width in widths.items()])


def pair_key(left: Column | str, right: Column | str) -> Column:
    """Two codes written side by side, without trailing ``.0``."""
    return F.concat(strip_point_zero(left), strip_point_zero(right))


def strip_dots(c: Column | str) -> Column:
    """Remove every dot and read the rest as an integer code."""
    return F.regexp_replace(_col(c).cast("string"), r"\.", "").try_cast("long")


def strip_commas(c: Column | str) -> Column:
    """Remove thousands separators and read the rest as a number."""
    return F.regexp_replace(F.trim(_col(c).cast("string")), ",", "").try_cast("double")


def strip_point_zero(c: Column | str) -> Column:
    """Drop one trailing ``.0``."""
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def upper_trim(c: Column | str) -> Column:
    return F.trim(F.upper(_col(c).cast("string")))


def with_trimmed_text(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.select(
        *[
            F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def id_text(c: Column | str, semantics: str = DOCUMENTED, is_text: bool = True) -> Column:
    """Numeric ID as text without decimals; null becomes ``''``.

    Text that is no number is kept. ``literal`` blanks every value that arrives as text.
    """
    col = _col(c)
    if semantics == LITERAL and is_text:
        return F.lit("")
    text = F.trim(col.cast("string"))
    whole = F.regexp_extract(text, r"^([+-]?\d+)(\.\d*)?$", 1)
    if not is_text:
        return F.coalesce(col.try_cast("long").cast("string"), F.lit(""))
    return F.coalesce(F.when(whole != "", F.coalesce(whole.try_cast("long").cast("string"), whole)), text, F.lit(""))


def pad_code(c: Column | str, width: int) -> Column:
    """Left-pad codes with zeros; blank, ``'0'`` and longer codes stay as they are."""
    col = _col(c)
    return F.when(col.isin("", "0") | (F.length(col) > width), col).otherwise(F.lpad(col, width, "0"))


def first_present(*cols: Column | str) -> Column:
    """First non-null of columns of which at most one is filled."""
    return F.coalesce(*[_col(c) for c in cols])


def name_part(c: Column | str, start: int, length: int) -> Column:
    return F.substring(_col(c), start, length)


def digit_runs(c: Column | str) -> Column:
    """All runs of digits in a name, as an array of integers."""
    return F.transform(F.regexp_extract_all(_col(c), F.lit(r"(\d+)"), 1), lambda x: x.try_cast("long"))


def null_words(df: DataFrame, words: Sequence[str]) -> DataFrame:
    """Turn look-alikes of null (``''``, ``'nan'``, ...) in string columns into null."""
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(list(words)), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
