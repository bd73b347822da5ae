"""Connected components of a link table, by repeated joins on stored tables.

Each round links every node to the smallest node it has seen (large star), then
its smaller neighbours to the smallest of them (small star). The number of
rounds grows with the logarithm of the longest path. Links stay in tables in the
shared folder; nothing but a change flag reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of every node ``a`` to the smallest of them and itself: larger ones only, or smaller ones and itself."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = links.join(least, "a")
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Loops and repeated links change nothing, links with a null end are left
    out, and an empty table gives an empty one.
    """
    pairs = links.select("a", "b").where("a is not null and b is not null and a <> b")
    current = stage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours of a node go to its least neighbour; a node keeps its own link to that.
        grown = stage(_star(both, large=True), "large")
        changed = stage(_star(grown, large=False), "small")
        sums = [
            t.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
            for t in (current, changed)
        ]
        current = changed
        if sums[0] == sums[1]:
            break
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select(F.col("b"), F.col("b"))).distinct()
