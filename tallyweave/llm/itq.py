"""Near-duplicate vectors by iterative quantisation, multi-index Hamming tables and exact cosine.

Rotations learned on a bounded sample turn unit vectors into balanced binary
codes. A code is cut into substrings, one for each table; two vectors of one
label meet wherever a substring is equal, so pairs whose codes differ in fewer
bits than there are tables always meet. Every meeting pair is ranked by the
cosine of the original vectors in double precision. A pair that meets in several
tables counts in the first of them only, so counts can be added without the
pairs ever being listed: tasks return counts for each vector and at most one
link less than they have vectors.

Equal vectors are folded first. Dense groups of near copies are covered by
cores: the mean of a code shared by many vectors is a centre, and all vectors
within half the threshold angle of a centre are linked with each other by the
triangle inequality, so they are counted without being compared. What is left
of a large bucket is compared in pairs of blocks of bounded size.

A vector is a row. Rows with a null id, a null label, a null, empty or zero
vector, or a component that is null or not finite are linked with nothing; so
are vectors of different lengths. Repeated rows are equal vectors and linked.
Ties do not occur: the smallest id names a component. Empty tables give empty
results, extra columns are dropped. Work grows with the square of what is left
outside the cores in one bucket: groups whose members lie further than half the
threshold angle from their mean are compared pair by pair, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.session import stage

TABLES = 12
BITS = 16
#: Vectors the rotations are learned from, taken by a hash of their id.
SAMPLE = 20_000
ROUNDS = 40
#: Vectors compared at once with as many others.
BLOCK = 1024
#: Codes shared by this part of all vectors (and by ``CORE_LEAST`` at least) give centres: never more than its inverse.
CORE_SHARE, CORE_LEAST = 1e-4, 64
#: Radians that keep the triangle inequality safe from rounding.
SLACK = 1e-7


@dataclass
class Codes:
    """Projections and thresholds of the code bits, for each length of vectors."""

    planes: dict[int, tuple[np.ndarray, np.ndarray]]
    tables: int
    bits: int

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """Substrings of each unit vector's code, one column a table."""
        size = unit.shape[1]
        directions, least = self.planes[size] if size in self.planes else _planes(np.zeros((0, size)), self.tables * self.bits)
        on = (unit @ directions >= least).reshape(len(unit), self.tables, self.bits)
        return on @ (1 << np.arange(self.bits))


def _rotation(values: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """The rotation that brings ``values`` nearest to the corners of a cube, alternating codes and rotation."""
    turn = np.linalg.qr(rng.standard_normal((values.shape[1],) * 2))[0]
    for _ in range(rounds if len(values) else 0):
        left, _, right = np.linalg.svd(np.where(values @ turn >= 0, 1.0, -1.0).T @ values)
        turn = (left @ right).T
    return turn


def _planes(unit: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and medians of ``bits`` code bits: rotations of the principal components until there are enough."""
    rng, size = np.random.default_rng(7), unit.shape[1]
    mean = unit.mean(axis=0) if len(unit) else np.zeros(size)
    axes = np.linalg.eigh((unit - mean).T @ (unit - mean))[1][:, ::-1][:, : min(size, bits)]
    values = (unit - mean) @ axes
    turns = [axes @ _rotation(values, ROUNDS, rng) for _ in range(-(-bits // axes.shape[1]))]
    directions = np.concatenate(turns, axis=1)[:, :bits]
    return directions, np.median(unit @ directions, axis=0) if len(unit) else np.zeros(bits)


def _units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of a list column, one pair for each length."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)
        yield at, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit(vectors: DataFrame, tables: int = TABLES, bits: int = BITS, sample: int = SAMPLE) -> Codes:
    """Code bits learned from at most ``sample`` vectors (column ``vector``)."""
    taken = vectors.select("vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(sample).select("vector").toArrow()
    column = taken["vector"].combine_chunks()
    found = {unit.shape[1]: _planes(unit, tables * bits) for _, unit in _units(column)} if len(column) else {}
    return Codes(found, tables, bits)


def _usable() -> Column:
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return F.coalesce(whole, F.lit(False))


def _frame(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("vector"))


def _coded(reps: DataFrame, codes: Codes) -> DataFrame:
    label = dict(reps.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            for at, unit in _units(vectors):
                parts = codes.encode(unit)
                offsets = lambda width, n=len(at): pa.array(np.arange(n + 1) * width, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets(x.shape[1]), pa.array(x.ravel(), kind)) for x, kind in ((unit, pa.float64()), (parts, pa.int32()))]
                size = pa.array(np.full(len(at), unit.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(at)) for i in range(3)), size, *lists], names=["rep", "weight", "label", "size", "unit", "codes"])

    return reps.select("rep", "weight", "label", "vector").mapInArrow(run, f"rep long, weight long, label {label}, size int, unit array<double>, codes array<int>")


def _centres(coded: DataFrame) -> list[tuple[object, np.ndarray]]:
    """Label and direction of the mean of every widely shared code, the most shared first."""
    total = coded.count()
    least = max(CORE_LEAST, CORE_SHARE * total)
    code = [F.col("codes")[i].alias(f"c{i}") for i in range(4)]
    cells = coded.select("label", "size", "unit", *code)
    keys = ["label", "size", *(f"c{i}" for i in range(4))]
    heavy = stage(cells.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least), "codes")
    sums = cells.join(heavy, keys).select(*keys, "n", F.posexplode("unit")).groupBy(*keys, "n", "pos").agg(F.sum("col").alias("sum"))
    means = sums.groupBy(*keys, "n").agg(F.sort_array(F.collect_list(F.struct("pos", "sum"))).alias("mean"))
    out = []
    for row in means.orderBy(F.desc("n"), *keys).collect():  # at most 1 / CORE_SHARE rows
        mean = np.array([x["sum"] for x in row["mean"]])
        if np.linalg.norm(mean) > 0:
            out.append((row["label"], mean / np.linalg.norm(mean)))
    return out


def _with_cores(coded: DataFrame, centres: list[tuple[object, np.ndarray]], cosine: float) -> DataFrame:
    """The first centre of its label within half the threshold angle of each vector, -1 where there is none."""
    reach = np.cos(max(0.0, np.arccos(cosine) / 2 - SLACK))
    by: dict[tuple[object, int], tuple[list[int], list[np.ndarray]]] = {}
    for number, (label, centre) in enumerate(centres):
        numbers, rows = by.setdefault((label, len(centre)), ([], []))
        numbers.append(number)
        rows.append(centre)
    known = coded.sparkSession.sparkContext.broadcast({k: (np.array(n), np.array(c)) for k, (n, c) in by.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = np.full(batch.num_rows, -1, np.int64)
            sizes = batch.column(3).to_numpy(zero_copy_only=False)
            labels = batch.column(2).to_pylist()
            where: dict[tuple[object, int], list[int]] = {}
            for i, key in enumerate(zip(labels, sizes.tolist(), strict=True)):
                if key in known.value:
                    where.setdefault(key, []).append(i)
            for key, at in where.items():
                numbers, rows = known.value[key]
                unit = batch.column(4).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), key[1])
                near = unit @ rows.T >= reach
                core[at] = np.where(near.any(axis=1), numbers[near.argmax(axis=1)], -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(core)], names=[*batch.schema.names, "core"])

    kind = ", ".join(f"{n} {t}" for n, t in coded.dtypes)
    return coded.mapInArrow(run, f"{kind}, core long")


def forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all that a symmetric hit matrix joins, one less than the rows at most."""
    open_, links = hit.any(axis=1), []
    while open_.any():
        todo = [int(open_.argmax())]
        open_[todo[0]] = False
        while todo:
            x = todo.pop()
            new = np.flatnonzero(hit[x] & open_).tolist()
            open_[new] = False
            links += [(x, y) for y in new]
            todo += new
    return links


def compare(unit: np.ndarray, weight: np.ndarray, codes: np.ndarray, core: np.ndarray, side: np.ndarray, table: int, cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weight linked with each row and joining links, of pairs that meet in ``table`` first, lie in no common core and, where sides are given, on two sides."""
    hit = unit @ unit.T >= cosine
    np.fill_diagonal(hit, False)
    hit &= (core[:, None] != core) | (core[:, None] < 0)
    hit &= (side[:, None] != side) | (side[:, None] < 0)
    hit &= hit.T
    a, b = np.nonzero(hit)
    for begin in range(0, len(a), 1 << 20):
        x, y = a[begin : begin + (1 << 20)], b[begin : begin + (1 << 20)]
        later = (codes[x, :table] == codes[y, :table]).any(axis=1)
        hit[x[later], y[later]] = False
    return hit @ weight, forest(hit)


def _compared(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def close() -> pa.RecordBatch | None:
            table = pa.Table.from_batches(held)
            if table.num_rows < 2:
                return None
            column = lambda name: table[name].to_numpy()
            flat = lambda name: table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
            rep = column("rep")
            counts, links = compare(flat("unit"), column("weight"), flat("codes"), column("core"), column("side"), int(column("table")[0]), cosine)
            some = np.flatnonzero(counts)
            if not len(some):
                return None
            pairs = rep[np.array(links, np.int64).reshape(-1, 2)]
            a = np.concatenate([rep[some], pairs[:, 0]])
            b = pa.array(np.concatenate([np.zeros(len(some), np.int64), pairs[:, 1]]), mask=np.arange(len(a)) < len(some))
            n = np.concatenate([counts[some], np.zeros(len(pairs), np.int64)])
            return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])

        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            starts = [0, *(np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1).tolist(), batch.num_rows]
            for begin, end in zip(starts, starts[1:], strict=False):
                if end == begin:
                    continue
                if (k1[begin], k2[begin]) != key:
                    if held and (out := close()) is not None:
                        yield out
                    held, key = [], (k1[begin], k2[begin])
                held.append(batch.slice(begin, end - begin))
        if held and (out := close()) is not None:
            yield out

    return run


def _dealt(coded: DataFrame) -> DataFrame:
    """Vectors sent to every comparison they take part in, with the number of the comparison (k1, k2) and their side."""
    bucket = ["label", "size", "table", "key"]
    keys = coded.select("label", "size", "rep", "core", F.posexplode("codes").alias("table", "key"))
    units = stage(keys.groupBy(*bucket, "core").agg(F.count("*").alias("n")), "units")
    sums = units.groupBy(*bucket).agg(F.sum("n").alias("total"), F.count("*").alias("units"), F.max("core").alias("most"))
    # A bucket of one vector, or of one core alone, needs no comparison.
    sums = stage(sums.where("total > 1 and not (units = 1 and most >= 0)"), "buckets")
    small = sums.where(F.col("total") <= BLOCK).select(*bucket)
    parts = units.join(sums.where(F.col("total") > BLOCK).select(*bucket), bucket)
    parts = parts.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    blocks = stage(parts.select(*bucket, "core", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")), "blocks")
    # Blocks of one bucket meet two by two, but not those of one core.
    left, right = (blocks.select(*bucket, F.col("core").alias(f"{s}core"), F.col("block").alias(f"{s}block")) for s in "lr")
    order = F.struct("lcore", "lblock") <= F.struct("rcore", "rblock")
    pairs = left.join(right, bucket).where(order & ((F.col("lcore") != F.col("rcore")) | (F.col("lcore") < 0)))
    own = (F.col("lcore") == F.col("rcore")) & (F.col("lblock") == F.col("rblock"))
    ends = [(F.when(own, -1).otherwise(0), "l", F.lit(True)), (F.lit(1), "r", ~own)]
    names = [*bucket, "lcore", "lblock", "rcore", "rblock"]
    ids = [F.xxhash64(*names).alias("k1"), F.xxhash64(F.lit(1), *names).alias("k2")]
    sides = None
    for side, s, which in ends:
        one = pairs.where(which).select(*bucket, F.col(f"{s}core").alias("core"), F.col(f"{s}block").alias("block"), *ids, side.alias("side"))
        sides = one if sides is None else sides.union(one)
    columns = ["rep", "weight", "core", "unit", "codes"]
    rows = coded.select("label", "size", *columns, F.posexplode("codes").alias("table", "key"))
    alone = rows.join(small.hint("merge"), bucket).select(F.xxhash64(*bucket).alias("k1"), F.xxhash64(F.lit(1), *bucket).alias("k2"), F.lit(-1).alias("side"), "table", *columns)
    known = parts.select(*bucket, "core", "blocks")
    cut = rows.join(known, [*bucket, "core"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    many = cut.join(sides, [*bucket, "core", "block"]).select("k1", "k2", "side", "table", *columns)
    return alone.union(many)


def near_vectors(embeddings: DataFrame, cosine: float = 0.98, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """vec_id, n_links (rows linked directly), component_id (smallest id reachable) and kept, one row per vector."""
    rows = stage(_frame(embeddings).where(_usable()), "vectors")
    reps = rows.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    reps = stage(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    coded = stage(_coded(reps, fit(reps, tables, bits)), "coded")
    coded = stage(_with_cores(coded, _centres(coded), cosine), "cores")
    spread = _dealt(coded).repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    found = stage(spread.mapInArrow(_compared(cosine), "a long, b long, n long"), "found")
    cores = stage(coded.where("core >= 0").groupBy("core").agg(F.min("rep").alias("hub"), F.sum("weight").alias("all")), "hubs")
    inner = coded.where("core >= 0").join(cores, "core")
    links = found.where("b is not null").select("a", "b").union(inner.select("rep", "hub"))
    groups = components(links)
    counts = found.where("b is null").select("a", "n").union(inner.select("rep", F.col("all") - F.col("weight")))
    counts = counts.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    known = reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    known = stage(known.join(counts, "rep", "left").select("label", "vector", "node", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "known")
    least = known.groupBy("component").agg(F.min("node").alias("component_id"))
    named = known.join(least, "component").select("label", "vector", "n_links", "component_id")
    linked = rows.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    rest = _frame(embeddings).where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
