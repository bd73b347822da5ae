"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the share of an *item's* shingles
that a document holds is what counts, and sketches of whole documents would miss
it. Items are put into classes by their number of shingles (powers of two). The
sketch of an item in the class up to u shingles is the (1 - t) u + 1 least of its
shingle hashes: a document that holds the share t of the item lacks too few to
lack all of these. Documents are probed with those of their shingles that are no
larger than the largest value in any sketch, and every document that meets a
sketch is compared with the items on all shingles. Only DataFrame functions; the
join sides are stored tables, so Spark broadcasts the items only while they are
small.

Words are runs of letters and digits in small letters. Items with fewer words
than a shingle are one shingle of their own length, and documents are searched
for windows of that length as well. Null or empty texts hold nothing and are
never found. Rows are told apart by id and text: a null id can be found like any
other, repeated rows give one result. Empty tables give empty results; extra
columns are dropped by ``leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import stage


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def _windows(words: str, length: int) -> Column:
    """Hashes of all runs of ``length`` words; none in shorter texts."""
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.lit(length), *[F.get(F.col(words), i + k) for k in range(length)]))


def _items(benchmark: DataFrame, size: int, percent: int) -> DataFrame:
    """item_id, item (hash of the text), length of its shingles, sorted hashes, and the sketch, for items with words."""
    frame = benchmark.select("item_id", F.xxhash64("text").alias("item"), _words("text").alias("words")).where("size(words) > 0").distinct()
    length = F.least(F.size("words"), F.lit(size))
    hashes = F.coalesce(*[F.when(length == k, _windows("words", k)) for k in range(1, size + 1)])
    frame = frame.select("item_id", "item", length.alias("length"), F.sort_array(F.array_distinct(hashes)).alias("hashes"))
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.size("hashes"))))
    least = F.floor(upper * (100 - percent) / 100) + 1
    return frame.withColumn("sketch", F.slice("hashes", F.lit(1), F.least(least, F.size("hashes")).cast("int")))


def _document_hashes(documents: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, doc (hash of the text) and all window hashes of the given lengths."""
    frame = documents.select("doc_id", F.xxhash64("text").alias("doc"), _words("text").alias("words"))
    return frame.select("doc_id", "doc", F.concat(*[_windows("words", k) for k in lengths]).alias("hashes"))


def leaks(documents: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, doc, item_id, n_shared, n_shingles and containment of each item found in each document."""
    items = stage(_items(benchmark, size, percent), "items")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # at most ``size`` numbers
    sketch = stage(items.select(F.explode("sketch").alias("h")).distinct(), "sketch")
    shingles = stage(items.select("item_id", "item", F.size("hashes").alias("n_shingles"), F.explode("hashes").alias("h")), "shingles")
    largest = sketch.agg(F.max("h")).first()[0]
    hashed = _document_hashes(documents, lengths or [size])
    bound = F.lit(largest if largest is not None else -(1 << 63)).cast("long")
    probes = hashed.select("doc_id", "doc", F.explode(F.filter("hashes", lambda h: h <= bound)).alias("h"))
    met = stage(probes.join(sketch, "h", "left_semi").select("doc_id", "doc").distinct(), "met")
    again = documents.withColumn("_doc", F.xxhash64("text")).alias("d")
    again = again.join(met.alias("m"), (F.col("d._doc") == F.col("m.doc")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")), "left_semi")
    held = _document_hashes(again, lengths or [size]).select("doc_id", "doc", F.explode(F.array_distinct("hashes")).alias("h"))
    # A repeated document row must not count its shingles twice.
    shared = held.join(shingles, "h").distinct().groupBy("doc_id", "doc", "item_id", "item", "n_shingles").agg(F.count("*").alias("n_shared"))
    found = shared.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
    return found.select("doc_id", "doc", "item_id", "n_shared", F.col("n_shingles").cast("long").alias("n_shingles"), F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment"))


def drop_leaks(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that hold no test item, with all their columns."""
    found = stage(leaks(documents, benchmark, **options).select("doc_id", "doc").distinct(), "leaks")
    hit = (F.xxhash64("d.text") == F.col("l.doc")) & F.col("d.doc_id").eqNullSafe(F.col("l.doc_id"))
    return documents.alias("d").join(found.alias("l"), hit, "left_anti")
