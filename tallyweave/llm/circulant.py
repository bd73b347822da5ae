"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its word shingles. One permutation scatters the
shingles over a ring of positions, a second one gives the values on the ring,
and coordinate k of a signature is the least value met when the ring is turned
by k: two permutations in all, whatever the number of coordinates. Equal sets
are folded first. Bands of coordinates form buckets, and every pair of different
sets in a bucket is compared on its full sets, block by block, so that a large
group of near copies neither meets in one task nor appears as all its pairs:
a block pair returns no more links than it has sets. Links become components.

Nulls: a null text has the empty set and is linked with nothing; a row with a
null id is returned with a null component and kept. Texts with fewer words than
a shingle are one shingle. Repeated ids are one node. Empty tables give empty
results; extra columns are dropped by ``near_groups`` and kept by ``drop_near``.

A pair at the threshold misses all bands with a chance of
(1 - 0.85^4)^24 = 2e-8 at the default sizes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import bytetext
from tallyweave.llm.components import components
from tallyweave.session import stage

BANDS = 24
ROWS = 4
RING_BITS = 22
#: Shingles of the sets compared at once; more make more block pairs, not larger ones.
BLOCK_SHINGLES = 200_000


@lru_cache(maxsize=1)
def ring(coordinates: int, bits: int = RING_BITS) -> np.ndarray:
    """Rows of ``coordinates`` neighbouring values of a fixed random permutation, one row per ring position."""
    values = np.random.default_rng(20240229).permutation(1 << bits).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[: coordinates - 1]]), coordinates)


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of one non-empty set of 64-bit shingle hashes."""
    turns = ring(coordinates)
    at = bytetext.mix(hashes, 101) >> np.uint64(64 - RING_BITS)
    least = turns[at[:4096]].min(axis=0)
    for begin in range(4096, len(at), 4096):
        np.minimum(least, turns[at[begin : begin + 4096]].min(axis=0), out=least)
    return least


def _sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each text's distinct shingle hashes, and the hashes."""
    data, offsets = bytetext.utf8(bytetext.text_array(batch))
    owners, hashes = bytetext.shingles(bytetext.lower_ascii(data), offsets, size)
    return np.searchsorted(owners, np.arange(batch.num_rows + 1)), hashes


def sketches(documents: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit hashes of the set, and the band keys (null for empty sets)."""
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            bounds, hashes = _sets(batch, size)
            counts = np.diff(bounds)
            full = np.flatnonzero(counts)
            whole = np.zeros((2, batch.num_rows), np.uint64)
            keys = np.zeros((batch.num_rows, bands), np.uint64)
            if len(full):
                for k in (0, 1):
                    whole[k, full] = np.add.reduceat(bytetext.mix(hashes, 7 + k), bounds[full])
                least = np.stack([signature(hashes[bounds[i] : bounds[i + 1]], bands * rows) for i in full]).astype(np.uint64)
                key = np.zeros((len(full), bands), np.uint64)
                for k in range(rows):
                    key = bytetext.mix(key + least[:, k::rows], 50 + k)
                keys[full] = key
            lists = pa.ListArray.from_arrays(
                pa.array((np.arange(batch.num_rows + 1) * bands).astype(np.int32)), pa.array(keys.view(np.int64).ravel())
            )
            arrays = [batch.column(0), pa.array(counts), pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "h1", "h2", "bands"])

    return frame.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def _set_rows(documents: DataFrame, size: int) -> DataFrame:
    """doc_id and the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            bounds, hashes = _sets(batch, size)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((8 * bounds).astype(np.int32)), pa.py_buffer(hashes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "hashes"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, hashes binary")


def linked_pairs(sets: list[np.ndarray], sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that join all sets with 100 * intersection >= percent * union, one less than the sets at most.

    With ``sides`` only pairs from different sides are compared. Shingles that
    one set alone has cannot be shared; the others become columns of a 0/1
    matrix, and products of its row blocks count the shared ones.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    values, column, times = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes[order])
    shared = times[column] > 1
    row, column = row[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    width = int((times > 1).sum())
    sizes = sizes[order]
    group = np.arange(len(sets))
    links: list[tuple[int, int]] = []
    if not width:
        return links
    step = max(1, min(len(sets), 4_000_000 // width))
    bounds = np.searchsorted(row, np.arange(len(sets) + 1))

    def rows(begin: int, end: int) -> np.ndarray:
        block = np.zeros((end - begin, width), np.float32)
        part = slice(bounds[begin], bounds[end])
        block[row[part] - begin, column[part]] = 1
        return block

    for begin in range(0, len(sets), step):
        left = rows(begin, min(begin + step, len(sets)))
        for other in range(begin, len(sets), step):
            # Sizes rise: once the least size here is too large for all of the left block, so are all that follow.
            if 100 * sizes[begin + len(left) - 1] < percent * sizes[other]:
                break
            right = left if other == begin else rows(other, min(other + step, len(sets)))
            both = np.rint(left @ right.T).astype(np.int64)
            union = sizes[begin : begin + len(left), None] + sizes[None, other : other + len(right)] - both
            a, b = np.nonzero(100 * both >= percent * union)
            a, b = a + begin, b + other
            near = a < b
            if sides is not None:
                near &= sides[order[a]] != sides[order[b]]
            for i, j in zip(a[near].tolist(), b[near].tolist(), strict=True):
                x, y = _root(group, i), _root(group, j)
                if x != y:
                    group[y] = x
                    links.append((int(order[i]), int(order[j])))
    return links


def _root(group: np.ndarray, i: int) -> int:
    while group[i] != i:
        group[i] = group[group[i]]
        i = group[i]
    return i


def _verify(percent: int):
    """Links of every (bucket, block pair) in a stream sorted by them."""

    def compare(nodes: list[int], packed: list[bytes], sides: list[int]) -> tuple[list[int], list[int]]:
        sets = [np.frombuffer(p, np.int64) for p in packed]
        if len(sets) == 2:
            both = len(np.intersect1d(*sets, assume_unique=True)) if sides[0] != sides[1] or sides[0] < 0 else 0
            near = 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both)
            return ([nodes[0]], [nodes[1]]) if near else ([], [])
        found = linked_pairs(sets, None if sides[0] < 0 else np.array(sides), percent)
        return [nodes[i] for i, _ in found], [nodes[j] for _, j in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        nodes, packed, sides = [], [], []
        out = ([], [])

        def close() -> None:
            if len(nodes) > 1:
                for have, more in zip(out, compare(nodes, packed, sides), strict=True):
                    have.extend(more)

        for batch in batches:
            cells = [batch.column(i).to_pylist() for i in range(4)]
            for i, key in enumerate(zip(cells[0], cells[1], strict=True)):
                if key != held:
                    close()
                    held, nodes, packed, sides = key, [], [], []
                nodes.append(cells[2][i])
                sides.append(cells[3][i])
                packed.append(batch.column(4)[i].as_py())
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])
                out = ([], [])
        close()
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])

    return run


def near_links(documents: DataFrame, sketch: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between documents of different sets: enough of them to join all that are near."""
    reps = sketch.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    keys = reps.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = (
        keys.groupBy("band", "key")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s"))
        .where("n > 1")
    )
    # Bands that put the same documents together need one comparison.
    once = buckets.groupBy("n", "x", "s", "weight").agg(F.min(F.struct("band", "key")).alias("k"))
    once = stage(once.select("k.band", "k.key", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int").alias("blocks")), "buckets")
    members = keys.join(once, ["band", "key"]).select("node", "band", "key", "blocks")
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    # Block pair (i, j) meets in one group: block b takes part in (0, b) .. (b, blocks - 1).
    pairs = F.when(
        F.col("blocks") > 1,
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, block).alias("i"), F.greatest(o, block).alias("j"))),
    ).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
    members = members.withColumn("block", block).groupBy("node").agg(F.collect_list(F.struct("band", "key", "block", pairs.alias("pairs"))).alias("buckets"))
    members = stage(members, "members")
    # Any row of a node will do: where ids repeat, each of its sets is compared.
    # Members grow with the documents, so both sides are shuffled at every size (large inputs get a Bloom filter from Spark).
    wanted = members.select(F.col("node").alias("doc_id")).hint("merge")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = _set_rows(rows, size).join(members.hint("merge"), F.col("doc_id") == F.col("node"))
    dealt = sets.select("node", "hashes", F.explode("buckets").alias("m")).select("node", "hashes", "m.*")
    dealt = dealt.select("node", "hashes", "block", F.xxhash64("band", "key").alias("bucket"), F.explode("pairs").alias("pair"))
    dealt = dealt.select(
        "bucket",
        (F.col("pair.i").cast("long") * (1 << 31) + F.col("pair.j")).alias("pair"),
        "node",
        F.when(F.col("pair.i") == F.col("pair.j"), -1).otherwise(F.col("block")).alias("side"),
        "hashes",
    )
    spread = dealt.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    return spread.mapInArrow(_verify(percent), "a long, b long")


def near_groups(documents: DataFrame, size: int = 5, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest document reachable over links) and kept, one row per document."""
    sketch = stage(sketches(documents, size, bands, rows), "sketches")
    links = stage(near_links(documents, sketch, size, percent), "links")
    groups = components(links)
    nodes = sketch.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("node"))
    nodes = stage(nodes.join(groups, "node", "left").select("n_shingles", "h1", "h2", F.coalesce("component", "node").alias("component")), "nodes")
    found = sketch.drop("bands").join(nodes, ["n_shingles", "h1", "h2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    out = found.select("doc_id", "n_shingles", own)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near(documents: DataFrame, **options) -> DataFrame:
    """Documents without all but the first of each near-duplicate group; repeated ids stay once."""
    kept = stage(near_groups(documents, **options).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct(), "kept")
    named = documents.where("doc_id is not null")
    left = named.join(kept, named["doc_id"].cast("long") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return left.unionByName(documents.where("doc_id is null"))
