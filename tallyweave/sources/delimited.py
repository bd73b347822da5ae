"""Delimited text: all-string reads, empty rows, integer columns, header offset."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyweave.config import NULL_WORDS
from tallyweave.functions.fields import null_words
from tallyweave.functions.numbers import is_whole_number

ORDER = "_ord"
#: Columns that keep the source position in published tables.
POSITION = {"SRCFILE": "string", "SRCBLOCK": "long", "SRCROW": "long"}


def drop_empty_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop rows in which every column (outside ``ignore``) is null."""
    return df.dropna("all", subset=[c for c in df.columns if c not in ignore])


def with_source_order(df: DataFrame, name: str = ORDER) -> DataFrame:
    """Add the source position (file, block, row) as one comparable column.

    Rows of one block are read in file order by one task, so the running ID
    orders them; file and block order the rest. Add it directly after reading.
    """
    position = F.struct(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", position.alias(name))


def position_columns(df: DataFrame, order: str = ORDER) -> DataFrame:
    """The source position as plain columns, which tables and text files can keep; kept ones win."""
    if set(POSITION) <= set(df.columns):
        return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in POSITION.items()}).drop(order)
    parts = dict(zip(POSITION, ("file", "block", "row"), strict=True))
    return df.withColumns({c: F.col(f"{order}.{part}").cast(POSITION[c]) for c, part in parts.items()}).drop(order)


def kept_order(df: DataFrame, name: str = ORDER) -> DataFrame:
    """The position that :func:`position_columns` kept, or that of the rows as they are read."""
    if not set(POSITION) <= set(df.columns):
        return with_source_order(df, name)
    parts = [F.col(c).try_cast(kind).alias(part) for (c, kind), part in zip(POSITION.items(), ("file", "block", "row"), strict=True)]
    return df.withColumn(name, F.struct(*parts)).drop(*POSITION)


def _strings(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _names(header: str, separator: str) -> list[str]:
    """Column names of a header line; blank and repeated names get their place."""
    cells = next(csv.reader([header.lstrip("\ufeff")], delimiter=separator), [])
    seen = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if seen.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as read, with file, block and a number that rises within a block."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _decoded(value: Column, encoding: str) -> Column:
    """Line text from its bytes; the text source itself takes every file for UTF-8."""
    return value if encoding.upper().replace("-", "") == "UTF8" else F.decode(value.cast("binary"), encoding)


@dataclass(frozen=True)
class FileFacts:
    """What one file's bytes tell: encoding and header line."""

    path: str
    encoding: str
    header: str


def file_facts(spark: SparkSession, path: str | list[str], encoding: str | None, header_line: int = 0) -> list[FileFacts]:
    """Facts of every file with at least ``header_line`` + 1 lines, in one pass over the lines.

    Without ``encoding`` a file counts as UTF-8 if all its lines are, else as
    ISO-8859-1. One row per file reaches the driver.
    """
    lines = _lines(spark, path)
    own = F.when(F.col("block") == 0, F.col("row"))
    found = lines.groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"),
        F.min(own).alias("first_row"),
        F.min_by("value", own).alias("header"),
    )
    if header_line:
        at = F.col("l.row") == F.col("f.first_row") + header_line
        headers = lines.alias("l").join(found.alias("f"), (F.col("l.file") == F.col("f.file")) & (F.col("l.block") == 0) & at)
        found = headers.select("f.file", "f.valid", "f.first_row", F.col("l.value").alias("header"))
    latin = F.decode(F.col("header").cast("binary"), encoding or "ISO-8859-1").alias("latin")
    rows = found.where("first_row is not null").select("file", "valid", "header", latin).orderBy("file").collect()
    out = []
    for r in rows:
        charset = encoding or ("UTF-8" if r.valid else "ISO-8859-1")
        header = r.header if charset.upper().replace("-", "") == "UTF8" else r.latin
        out.append(FileFacts(r.file, charset, header))
    return out


def _alike(facts: list[FileFacts]) -> dict[tuple[str, str], list[FileFacts]]:
    """Files with the same encoding and header line."""
    groups: dict[tuple[str, str], list[FileFacts]] = {}
    for fact in facts:
        groups.setdefault((fact.encoding, fact.header), []).append(fact)
    return groups


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    columns: Sequence[str] | None = None,
    encoding: str | None = "UTF-8",
    separator: str = ",",
    keep_order: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Read headed text files as strings, without blank lines and empty rows.

    Look-alikes of null become null. Files may differ in their headers: each is
    read by its own, and the tables are joined by name. ``columns`` declares the
    header of all files and saves the look at them. ``encoding=None`` reads
    each file as UTF-8 if it is, else as ISO-8859-1. ``keep_order`` adds
    ``_ord``. ``multi_line`` allows line breaks in quoted fields.
    """
    options = {"header": True, "sep": separator, "multiLine": multi_line}

    def read(paths: str | list[str], names: Sequence[str], charset: str, enforce: bool) -> DataFrame:
        reader = spark.read.options(**options, encoding=charset, enforceSchema=enforce)
        raw = reader.schema(_strings(names)).csv(paths)
        return with_source_order(raw) if keep_order else raw

    if columns is not None and encoding is not None:
        parts = [read(path, columns, encoding, enforce=False)]
    else:
        facts = file_facts(spark, path, encoding)
        if not facts:
            raise ValueError(f"no header in {path}")
        # The header was read from the files themselves, so it is not checked once more.
        parts = [
            read([f.path for f in group], columns or _names(header, separator), charset, enforce=columns is None)
            for (charset, header), group in _alike(facts).items()
        ]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if keep_order:
        raw = raw.select(*[f"`{c}`" for c in raw.columns if c != ORDER], ORDER)
    return drop_empty_rows(null_words(raw, NULL_WORDS), ignore=[ORDER] if keep_order else [])


def read_with_offset(
    spark: SparkSession, path: str | list[str], header_line: int, *, separator: str = ",", encoding: str | None = "UTF-8"
) -> DataFrame:
    """Read text whose header stands on line ``header_line`` (0-based) of each file.

    The lines up to the header are found by their position in each file's first
    block, so equal lines further down are kept. Each file is read by its own
    header and, with ``encoding=None``, in its own encoding.
    """
    facts = file_facts(spark, path, encoding, header_line)
    if not facts:
        raise ValueError(f"{path} ends before line {header_line}")
    parts = []
    for (charset, header), group in _alike(facts).items():
        lines = _lines(spark, [f.path for f in group])
        # Running numbers depend on the files read together, so they are taken from this group.
        starts = lines.filter("block = 0").groupBy("file").agg(F.min("row").alias("first_row"))
        body = lines.join(starts, "file", "left").filter((F.col("block") != 0) | (F.col("row") > F.col("first_row") + header_line))
        text = _decoded(F.col("value"), charset)
        schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in _names(header, separator))
        fields = F.from_csv(text, schema, {"sep": separator})
        parts.append(body.filter(F.trim(text) != "").select(fields.alias("r")).select("r.*"))
    parsed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return drop_empty_rows(null_words(parsed, NULL_WORDS))


def integer_columns(df: DataFrame) -> DataFrame:
    """One row: per column, whether every value is non-null text of digits only."""
    return df.agg(*[F.coalesce(F.bool_and(is_whole_number(f"`{c}`")), F.lit(True)).alias(c) for c in df.columns])


def infer_integers(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Cast the columns that :func:`integer_columns` finds to long; one pass over the data.

    An empty table has no whole numbers to show and stays text. Numbers that a
    long cannot hold make the column decimal(38,0), of whatever length.
    """
    names = [c for c in df.columns if c not in ignore]
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.bool_and(is_whole_number(f"`{c}`")).alias(f"w{i}") for i, c in enumerate(names)],
        *[F.bool_and(F.col(f"`{c}`").try_cast("long").isNotNull()).alias(f"l{i}") for i, c in enumerate(names)],
    ).first()
    kinds = {c: "long" if found[f"l{i}"] else "decimal(38,0)" for i, c in enumerate(names) if found["rows"] and found[f"w{i}"]}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])
