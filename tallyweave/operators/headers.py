"""Column names: clean-up, mapping-driven remapping, order, verification, drift."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.numbers import to_int


def _rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    twice = [name for name, n in Counter(names).items() if n > 1]
    if twice:
        raise ValueError(f"column names collide after clean-up: {twice}")
    return df.toDF(*names)


def upper_headers(df: DataFrame) -> DataFrame:
    """Upper case, without spaces."""
    return _rename(df, [c.upper().replace(" ", "") for c in df.columns])


def compact_headers(df: DataFrame, keep_underscore: bool = False) -> DataFrame:
    """Trimmed and upper case; spaces and underscores dropped, or spaces turned into underscores."""
    if keep_underscore:
        return _rename(df, [c.strip().replace(" ", "_").upper() for c in df.columns])
    return _rename(df, [c.strip().replace(" ", "").replace("_", "").upper() for c in df.columns])


def plain_headers(df: DataFrame) -> DataFrame:
    """Upper case letters and digits only."""
    return _rename(df, [re.sub(r"[\W_]+", "", c.upper()) for c in df.columns])


def sanitize_name(name: str) -> str:
    """Name safe for a table sink: word characters, no leading digits, no first underscore."""
    return re.sub(r"^\d+", "", re.sub(r"\W+", "", name)).removeprefix("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return _rename(df, [sanitize_name(c) for c in df.columns])


def header_mapping(
    mapping: DataFrame,
    order: str = "NEW_ORDER BY VAR",
    old: str = "ORI_EJOB HEADER",
    new: str = "NEW_DATASET HEADER",
    max_columns: int = 100_000,
) -> list[tuple[str, str]]:
    """(old, new) names in target order. A mapping longer than any table can be wide is refused."""
    rows = (
        mapping.select(to_int(f"`{order}`", None).alias("o"), F.col(f"`{old}`").alias("a"), F.col(f"`{new}`").alias("b"))
        .orderBy("o")
        .head(max_columns + 1)
    )
    if len(rows) > max_columns:
        raise ValueError(f"header mapping has more than {max_columns} rows")
    return [(r.a, r.b) for r in rows]


def remap_columns(df: DataFrame, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename old to new and keep exactly the mapped columns in order; missing ones are null."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(f"`{old}`").alias(new)
            if old in have
            else F.col(f"`{new}`")
            if new in have and new not in {o for o, _ in mapping}
            else F.lit(None).cast("string").alias(new)
            for old, new in mapping
        ]
    )


def verify_headers(spark: SparkSession, before: Sequence[str], mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Report per header: mapped, missing from the input, or extra in the input."""
    have, old = set(before), {o for o, _ in mapping}
    rows = [(o, n, "mapped" if o in have else "missing") for o, n in mapping]
    rows += [(c, None, "extra") for c in before if c not in old]
    return spark.createDataFrame(rows, "source string, target string, status string")


def header_rows_report(given: DataFrame, mapping: Sequence[tuple[str, str]], file: str = "file") -> DataFrame:
    """Headers of files, one row each (``file``, ``header``), against a mapping of old to new names.

    Every mapped name is looked for in every file: (file, source, target, status)
    with status mapped, missing or extra. Repeated headers of a file are reported once.
    """
    names = given.select(F.col(file).alias("_file"), F.col("header")).distinct()
    wanted = F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("target")) for a, b in dict.fromkeys(mapping)])
    held = names.groupBy("_file").agg(F.collect_set("header").alias("_have"))
    found = held.select(F.col("_file").alias(file), "_have", F.explode(wanted).alias("w"))
    status = F.when(F.array_contains("_have", F.col("w.source")), "mapped").otherwise("missing")
    out = found.select(file, "w.source", "w.target", status.alias("status"))
    extra = names.filter(~F.col("header").isin([a for a, _ in mapping]))
    return out.union(extra.select(F.col("_file"), "header", F.lit(None).cast("string"), F.lit("extra")))


def move_columns(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Take the named columns out, then insert each at its position, in the given order."""
    names = [c for c in df.columns if c not in positions]
    for name, position in positions.items():
        names.insert(position, name)
    return df.select(*[f"`{c}`" for c in names])


def prefix_after(df: DataFrame, anchor: str, prefix: str) -> DataFrame:
    """Prefix every column that stands after ``anchor``."""
    cut = df.columns.index(anchor) + 1
    return _rename(df, df.columns[:cut] + [f"{prefix}_{c}" for c in df.columns[cut:]])


def column_slice(df: DataFrame, start: str, end: str, keep: int = 2) -> DataFrame:
    """The first ``keep`` columns and those from ``start`` through ``end``."""
    names = df.columns
    wanted = names[:keep] + names[names.index(start) : names.index(end) + 1]
    return df.select(*[f"`{c}`" for c in wanted])


def order_by_number(df: DataFrame, suffix: str, drop: Sequence[str] = ("CIT_NONCIT",)) -> DataFrame:
    """Sort columns by the first number in their name, each followed by its ``_suffix`` partner."""
    names = [c for c in df.columns if c not in drop]

    def rank(name: str):
        base = name.removesuffix(f"_{suffix}")
        number = re.search(r"\d+", base)
        keyed = bool(re.match(r"\d", base))
        return (0 if keyed else 1, int(number.group()) if keyed else 0, base if keyed else "", name != base)

    return df.select(*[f"`{c}`" for c in sorted(names, key=rank)])


def pick_columns(
    df: DataFrame,
    contains: str | None = None,
    letters: Sequence[str] | None = None,
    pattern: str | None = None,
    start: int = 0,
) -> list[str]:
    """Column names from position ``start`` on that pass every given test."""
    return [
        c
        for c in df.columns[start:]
        if (contains is None or contains in c)
        and (letters is None or c[:1] in letters)
        and (pattern is None or re.search(pattern, c))
    ]


def pivot_groups(df: DataFrame, keys: Sequence[str], value: str, sexes: Sequence[int], groups: Sequence[int]) -> DataFrame:
    """Long cells to one column per sex and group, named ``sex_group``; absent cells are null."""
    names = [f"{j}_{g}" for j in sexes for g in groups]
    named = df.withColumn("_name", F.concat_ws("_", F.col("J").cast("int"), F.col("GRP").cast("int")))
    return named.groupBy(*keys).pivot("_name", names).agg(F.first(value, ignorenulls=True))
