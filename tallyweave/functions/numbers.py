"""Numbers: coercion, half-even rounding, zero-safe ratios, exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Number from text; anything else becomes null."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_int(c: Column | str, default: int | None = 0) -> Column:
    """Integer from text, cutting decimals; bad or missing values become ``default``.

    Text goes through a decimal, which takes plain numbers only, at a fraction
    of the generated code that :func:`to_number` needs.
    """
    value = _col(c).cast("string").try_cast("decimal(38,18)").try_cast("long")
    return value if default is None else F.coalesce(value, F.lit(default).cast("long"))


def is_whole_number(c: Column | str) -> Column:
    """True for non-null text made of digits only; false otherwise, null included."""
    return F.coalesce(_col(c).cast("string").rlike(_WHOLE), F.lit(False))


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    """Round the double, ties to even, the way array libraries do: scale, rint, unscale.

    Adding zero turns a negative zero into plain zero.
    """
    scale = float(10**digits)
    return F.rint(_col(c).cast("double") * scale) / scale + F.lit(0.0)


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """Ratio that is null where the divisor is zero or null."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def exact_sum(c: Column | str, digits: int) -> Column:
    """Sum of values with ``digits`` decimals, independent of row order.

    Adds decimals, so that partial sums give the same result however rows are
    spread over tasks, and room for 28 digits is left in a group. Values are
    rounded to ``digits`` decimals, ties to even.
    """
    scaled = F.rint(_col(c).cast("double") * float(10**digits)).cast("decimal(28,0)")
    return F.sum(scaled).cast("double") / float(10**digits)


def factor_or_one(c: Column | str) -> Column:
    """Blank or missing factor becomes 1, zero stays zero."""
    return F.coalesce(F.nullif(F.trim(_col(c).cast("string")), F.lit("")).try_cast("double"), F.lit(1.0))
