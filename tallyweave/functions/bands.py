"""Bands and code sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweave.config import (
    CITIZEN_CODE,
    DOCUMENTED,
    EMPLOYMENT_BANDS_C,
    EMPLOYMENT_BANDS_OTHER,
    LITERAL,
    check_semantics,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_band_5(age: Column | str) -> Column:
    """Five-year band 1-17, 18 from age 85; negative ages have none."""
    a = _col(age)
    return F.when(a >= 85, 18).when(a >= 0, F.floor(a / 5) + 1).cast("int")


def age_band_10(age: Column | str) -> Column:
    """Ten-year band 1-13 up to age 129; none outside."""
    a = _col(age)
    return F.when((a >= 0) & (a < 130), F.floor(a / 10) + 1).cast("int")


def code_group(code: Column | str, groups: Mapping[int, Sequence[int | str]]) -> Column:
    """Number of the first code set holding ``code``; none if no set does."""
    c = _col(code)
    chain = F
    for number, codes in groups.items():
        chain = chain.when(c.isin(list(codes)), number)
    return chain.cast("int")


def label_code(label: Column | str, codes: Mapping[str, int]) -> Column:
    c = _col(label)
    chain = F
    for name, number in codes.items():
        chain = chain.when(c == name, number)
    return chain.cast("int")


def binary_code(code: Column | str, yes: int = CITIZEN_CODE) -> Column:
    """1 where the code equals ``yes``, else 2 (missing included)."""
    return F.when(_col(code) == yes, 1).otherwise(2).cast("int")


def urban_rural(st: Column | str) -> Column:
    """Stratum digit 1-2 urban (1), 0 and 3-9 rural (2), none outside."""
    s = _col(st)
    return F.when(s.isin(1, 2), 1).when((s == 0) | ((s >= 3) & (s <= 9)), 2).cast("int")


def size_stratum(
    section: Column | str, employees: Column | str, section_c: str = "C", semantics: str = DOCUMENTED
) -> Column:
    """Employment-size stratum, 1 large to 4 micro.

    Bands differ for section C. Whole numbers only, save below 5 and above the
    top bound. ``literal`` leaves section C without a stratum.
    """
    n = _col(employees)
    in_c = _col(section).eqNullSafe(F.lit(section_c))

    def bands(rows):
        chain = F.when(n < 5, 4)
        for low, high, stratum in rows:
            inside = n >= low if high is None else (n >= low) & (n <= high) & (n == F.floor(n))
            chain = chain.when(inside, stratum)
        return chain

    other = F.when(~in_c, bands(EMPLOYMENT_BANDS_OTHER))
    if check_semantics(semantics) == LITERAL:
        return other.cast("int")
    return F.when(in_c, bands(EMPLOYMENT_BANDS_C)).otherwise(other).cast("int")
