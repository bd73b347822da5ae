"""Hard negatives by angular triangle filtering: angles to reference directions bound every inner product.

Reference directions are the means of a spherical clustering of a bounded
sample. For each row the angles to all of them are stored. By the triangle
inequality the angle between two rows lies between the difference and the sum of
their angles to a reference, so every reference gives a cosine interval; the
narrowest one, times both norms and widened by a slack that covers rounding,
bounds the integer score. Rows lie in bins by their nearest reference and their
angle to it, small bins side by side in one block, large ones dealt over several
blocks of bounded size. An anchor goes to the blocks whose interval overlaps the
scores it looks for, and inside a block only to the window of rows, sorted by
angle, that can reach them; these alone are scored, exactly.

First each anchor is scored in its own block, which gives a lower bound for its
fifth positive; then positives are searched wherever that can be exceeded, then
negatives wherever scores can lie between the least and the largest bound.

Rows with a null id, label or vector, or with a component that is null or not
finite take no part; nor do rows whose integers do not fit 31 bits or whose norm
exceeds 2^30, as their scores need not fit 64 bits. Vectors of different lengths
are not compared, an empty vector takes no part. Repeated rows count once; rows
that share an anchor's id are never its positives or negatives. Equal scores are
ordered by the smaller id. Empty tables give empty results; extra columns are
dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import stage

REFERENCES = 8
#: Rows that the reference directions are learned from, taken by a hash of the row.
SAMPLE = 5_000
#: Width of a bin of angles in radians, rows of a block, anchors scored at once.
BIN, BLOCK, ANCHORS = np.pi / 90, 16_384, 64
#: Radians added to every window, and the part of both norms added to every score bound, against rounding.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-6


def quantised(embeddings: DataFrame, scale: int = 256, shift_every: int | None = 7, labels: int = 10) -> DataFrame:
    """vec_id, label and integers q of all rows that take part; every ``shift_every``-th label becomes the next of ``labels``."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * scale)
    frame = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", scaled.alias("x"))
    fits = F.size("x") > 0
    fits &= F.forall("x", lambda x: F.coalesce((x >= -(2.0**31)) & (x < 2.0**31), F.lit(False)))
    frame = frame.where(F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fits, F.lit(False)))
    label = F.col("label")
    if shift_every:
        label = F.when(F.col("vec_id") % shift_every == 0, (label + 1) % labels).otherwise(label)
    q = F.transform("x", lambda x: F.floor(x).try_cast("int"))  # filters may be evaluated in any order
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return frame.select("vec_id", label.alias("label"), q.alias("q")).withColumn("norm", F.sqrt(square)).where(F.col("norm") <= 2.0**30)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference directions for each length of vectors, from at most ``sample`` rows."""
    taken = rows.where("norm > 0").select("q", F.xxhash64("vec_id", "q").alias("h")).orderBy("h").limit(sample).select("q").toArrow()["q"].combine_chunks()
    out = {}
    sizes = taken.value_lengths().to_numpy(zero_copy_only=False) if len(taken) else np.zeros(0)
    for size in np.unique(sizes):
        x = _matrix(taken.take(pa.array(np.flatnonzero(sizes == size))), size).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        centres = x[np.linspace(0, len(x) - 1, min(count, len(x))).astype(int)]
        for _ in range(10):
            near = (x @ centres.T).argmax(axis=1)
            sums = np.stack([x[near == k].sum(axis=0) for k in range(len(centres))])
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
        out[int(size)] = centres
    return out


def _located(rows: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """Rows with their angles to all references, the nearest one and the bin of the angle to it."""
    label = dict(rows.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, norm = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False)
            sizes = q.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                directions = known.get(int(size), np.eye(1, int(size)))
                x = _matrix(q.take(pa.array(at)), size) / np.maximum(norm[at], 1e-300)[:, None]
                angles = np.arccos(np.clip(x @ directions.T, -1, 1))
                near = angles.argmin(axis=1)
                offsets = pa.array(np.arange(len(at) + 1) * angles.shape[1], pa.int32())
                columns = [batch.column(i).take(pa.array(at)) for i in range(4)]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())), pa.array(np.full(len(at), size), pa.int32()), pa.array(near.astype(np.int32))]
                beta = angles[np.arange(len(at)), near]
                columns += [pa.array(beta), pa.array((beta / BIN).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "q", "norm", "angles", "size", "ref", "beta", "bin"])

    schema = f"vec_id long, label {label}, q array<int>, norm double, angles array<double>, size int, ref int, beta double, bin int"
    return rows.select("vec_id", "label", "q", "norm").mapInArrow(run, schema)


class Layout:
    """Bins put together to cells of about one block, with the angles and norms each cell holds.

    There are at most as many cells as bins: lengths times references times the
    bins of half a turn, whatever the number of rows.
    """

    def __init__(self, located: DataFrame, block: int):
        bins = located.groupBy("size", "ref", "bin").agg(
            F.count("*").alias("n"),
            F.min("norm").alias("least"),
            F.max("norm").alias("most"),
            *(F.min(F.get("angles", F.lit(k))).alias(f"lo{k}") for k in range(REFERENCES)),
            *(F.max(F.get("angles", F.lit(k))).alias(f"hi{k}") for k in range(REFERENCES)),
        )
        self.cell: dict[tuple[int, int, int], int] = {}
        cells: list[list] = []
        for row in sorted(bins.collect(), key=lambda r: (r["size"], r["ref"], r["bin"])):
            key = (row["size"], row["ref"])
            if not cells or cells[-1][0] != key or cells[-1][1] + row["n"] > block:
                cells.append([key, 0, []])
            cells[-1][1] += row["n"]
            cells[-1][2].append(row)
            self.cell[*key, row["bin"]] = len(cells) - 1
        self.size = np.array([c[0][0] for c in cells])
        self.blocks = np.array([-(-c[1] // block) for c in cells], np.int64)
        self.first = np.cumsum(self.blocks) - self.blocks
        fold = lambda f, name, none: np.array([f(none if r[name] is None else r[name] for r in c[2]) for c in cells])
        self.least, self.most = fold(min, "least", 0.0), fold(max, "most", 0.0)
        self.lo = np.array([fold(min, f"lo{k}", 0.0) for k in range(REFERENCES)])  # a missing reference bounds nothing
        self.hi = np.array([fold(max, f"hi{k}", np.pi) for k in range(REFERENCES)])

    def reachable(self, size: int, angles: np.ndarray, norm: float, low: float, high: float) -> np.ndarray:
        """Numbers of the blocks with rows whose score bounds overlap low to high."""
        apart, total = np.zeros(len(self.size)), np.full(len(self.size), np.pi)
        for k, angle in enumerate(angles):
            apart = np.maximum(apart, np.maximum(angle - self.hi[k], self.lo[k] - angle))
            total = np.minimum(total, angle + self.hi[k])
        up, down = np.cos(np.clip(apart - ANGLE_SLACK, 0, np.pi)), np.cos(np.clip(total + ANGLE_SLACK, 0, np.pi))
        upper = norm * np.where(up >= 0, self.most, self.least) * up + SCORE_SLACK * (1 + norm * self.most)
        lower = norm * np.where(down >= 0, self.least, self.most) * down - SCORE_SLACK * (1 + norm * self.most)
        cells = np.flatnonzero((self.size == size) & (upper >= low) & (lower <= high))
        return np.concatenate([np.arange(self.first[c], self.first[c] + self.blocks[c]) for c in cells]) if len(cells) else np.zeros(0, np.int64)


def _in_blocks(located: DataFrame, layout: Layout) -> DataFrame:
    """Rows with the number of their block; a cell of several blocks deals its rows by a hash."""
    cells = [(*key, int(layout.first[c]), int(layout.blocks[c])) for key, c in layout.cell.items()]
    table = located.sparkSession.createDataFrame(cells, "size int, ref int, bin int, first long, blocks long")
    joined = located.join(F.broadcast(table), ["size", "ref", "bin"])  # one row a bin
    block = F.col("first") + F.pmod(F.xxhash64("vec_id", "q"), F.col("blocks"))
    return joined.withColumn("block", block).drop("first", "blocks", "bin")


def _routed(anchors: DataFrame, layout: Layout) -> DataFrame:
    """Anchors (akey, size, norm, angles, low, high) with each block they have to visit."""
    known = anchors.sparkSession.sparkContext.broadcast(layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for akey, size, norm, angles, low, high in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                blocks = known.value.reachable(size, np.array(angles), norm, low, high)
                if len(blocks):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), akey)), pa.array(blocks)], names=["akey", "block"])

    routes = anchors.select("akey", "size", "norm", "angles", "low", "high").mapInArrow(run, "akey long, block long")
    return routes.join(anchors, "akey")


def best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest allowed scores of each row, equal ones by smaller id, in order."""
    low = np.iinfo(np.int64).min
    held = np.where(allowed, scores, low)
    if held.shape[1] > k:
        least = np.partition(held, -k, axis=1)[:, -k]
        allowed = allowed & (held >= least[:, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort((ids[c], -held[r, c], r))
    r, c = r[order], c[order]
    start = np.searchsorted(r, r)
    keep = np.arange(len(r)) - start < k
    return r[keep], c[keep]


def _scored(k: int, negatives: bool):
    """Best rows of every anchor in each block of a stream: rows first, then the anchors, a block at a time.

    Positives: same label, another id. Negatives, for each positive of the
    anchor: another label, a score from 0.8 times to once the positive's.
    """
    names = ["akey", "positive", "id", "score"]

    def slices(rows: dict[str, np.ndarray], anchors: list[dict]) -> Iterator[tuple[list[dict], slice]]:
        """Anchors in the order of their angle, with the window of rows they can have."""
        most = float(rows["norm"].max())
        for anchor in anchors:
            low, size = anchor["low"], anchor["norm"] * most
            ratio = low / size if size > 0 else -1.0
            reach = np.pi if ratio <= -1 else np.arccos(min(1.0, ratio - SCORE_SLACK))
            middle = anchor["angles"][rows["ref"]]
            window = np.searchsorted(rows["beta"], [middle - reach - ANGLE_SLACK, middle + reach + ANGLE_SLACK])
            anchor["window"] = (int(window[0]), int(window[1]))
        anchors = sorted((a for a in anchors if a["window"][0] < a["window"][1]), key=lambda a: a["window"])
        for begin in range(0, len(anchors), ANCHORS):
            some = anchors[begin : begin + ANCHORS]
            yield some, slice(min(a["window"][0] for a in some), max(a["window"][1] for a in some))

    def score(rows: dict, anchors: list[dict]) -> Iterator[pa.RecordBatch]:
        for some, window in slices(rows, anchors):
            q, ids, labels = rows["q"][window], rows["vec_id"][window], rows["label"][window]
            own = np.array([a["q"] for a in some], np.int64)
            exact = max(a["norm"] for a in some) * float(rows["norm"].max()) < 2.0**52
            scores = np.rint(own.astype(np.float64) @ rows["q_float"][window].T).astype(np.int64) if exact else own @ q.T
            same = np.array([a["label"] for a in some], labels.dtype)[:, None] == labels
            if not negatives:
                r, c = best(scores, same & (ids != np.array([a["vec_id"] for a in some])[:, None]), ids, k)
                positive = np.zeros(len(r), np.int64)
            else:
                parts = []
                for j in range(max(len(a["scores"]) for a in some)):
                    have = np.array([len(a["scores"]) > j for a in some])
                    top = np.array([a["scores"][j] if h else 0 for a, h in zip(some, have, strict=True)], np.int64)[:, None]
                    fit = ~same & (ids != np.array([a["vec_id"] for a in some])[:, None]) & have[:, None]
                    # 80 p <= 100 n without products that leave 64 bits
                    fit &= (scores <= top) & (scores >= top - top // 5)
                    parts.append((*best(scores, fit, ids, k), j))
                r, c = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                positive = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
            if len(r):
                akey = np.array([a["akey"] for a in some])[r]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (akey, positive.astype(np.int64), ids[c], scores[r, c])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, rows = None, [], None
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for begin, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                if begin == end:
                    continue
                piece = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, parts, rows = blocks[begin], [], None
                if kinds[begin] == 0:
                    parts.append(piece)
                    continue
                if not parts:
                    continue
                if rows is None:
                    table = pa.Table.from_batches(parts)
                    rows = {n: table[n].combine_chunks().to_numpy(zero_copy_only=False) for n in ("vec_id", "label", "norm", "beta")}
                    rows["q"] = _matrix(table["q"].combine_chunks(), table["size"][0].as_py()).astype(np.int64)
                    rows["q_float"] = rows["q"].astype(np.float64)
                    rows["ref"] = table["ref"][0].as_py()
                anchors = piece.to_pylist()
                for begin_ in range(0, len(anchors), 1024):
                    yield from score(rows, anchors[begin_ : begin_ + 1024])

    return run


def _searched(rows: DataFrame, anchors: DataFrame, k: int, negatives: bool) -> DataFrame:
    """The k best of every anchor (and positive) over all blocks it visits: akey, positive, id, score, rank."""
    shared = ["block", "kind", "beta", "vec_id", "label", "q", "norm", "size", "ref"]
    more = {"akey": "long", "angles": "array<double>", "low": "double", "scores": "array<long>"}
    left = rows.withColumn("kind", F.lit(0)).select(*shared, *(F.lit(None).cast(t).alias(n) for n, t in more.items()))
    right = anchors.withColumn("kind", F.lit(1))
    if "scores" not in anchors.columns:
        right = right.withColumn("scores", F.lit(None).cast("array<long>"))
    stream = left.union(right.select(*shared, *more)).repartition("block").sortWithinPartitions("block", "kind", "beta")
    found = stream.mapInArrow(_scored(k, negatives), "akey long, positive long, id long, score long")
    order = Window.partitionBy("akey", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, block: int = BLOCK, **options) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, for anchors whose id is divisible by ``every``."""
    rows = stage(quantised(embeddings, **options).distinct(), "rows")
    located = stage(_located(rows, references(rows)), "located")
    layout = Layout(located, block)
    rows = stage(_in_blocks(located, layout), "blocks")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("akey", F.monotonically_increasing_id())
    anchors = stage(anchors.withColumn("low", F.lit(float("-inf"))).withColumn("high", F.lit(float("inf"))), "anchors")
    # The own block gives a lower bound for the last positive looked for.
    seeds = _searched(rows, anchors, positives, False).where(F.col("rank") == positives).select("akey", F.col("score").alias("seed"))
    seeded = anchors.drop("block").join(seeds, "akey", "left").withColumn("low", F.coalesce(F.col("seed").cast("double"), "low")).drop("seed")
    seeded = stage(seeded, "seeded")
    near = stage(_searched(rows, _routed(seeded, layout), positives, False), "positives")
    sought = near.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # a few entries each
    sought = seeded.drop("low", "high").join(sought, "akey").withColumn("scores", F.col("p.score")).withColumn("ids", F.col("p.id"))
    # Of a negative score, 0.8 times is more than once: no window.
    sought = sought.withColumn("high", F.array_max("scores").cast("double")).where("high >= 0")
    sought = stage(sought.withColumn("low", 0.8 * F.array_max(F.array(F.lit(0.0), F.array_min("scores").cast("double")))).drop("p"), "sought")
    hard = _searched(rows, _routed(sought.drop("ids"), layout), negatives, True)
    names = sought.select("akey", F.col("vec_id").alias("anchor_id"), F.posexplode(F.arrays_zip("ids", "scores")).alias("positive", "p"))
    names = names.select("akey", "anchor_id", F.col("positive").cast("long").alias("positive"), F.col("p.ids").alias("positive_id"), F.col("p.scores").alias("positive_score"))
    out = hard.join(names, ["akey", "positive"])
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
