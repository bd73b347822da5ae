"""Quality classifier: cumulative-link (ordinal logistic) regression on graded ratings.

A text is a sparse vector of hashed tokens: its words, the shapes of its words
(runs of small letters, capitals, digits and each sign), words that repeat the
word before, repeated lines, and its length class. One weight vector is shared
by all grades, and rising thresholds cut its score into grades:
P(grade >= k) = logistic(w x - threshold_k). That gives an expected grade and,
for selection, the tail probability of reaching a grade.

Nulls: a null text counts as empty (all its weight is on the token of its
length class); ratings that are null, or differ for one document, are left
out. With fewer than two grades among the ratings nothing can be learned, and
every text gets the one grade (0 without ratings). Ties at the cut-off are kept.
Repeated rows give repeated results; extra columns are dropped by ``score`` and
kept by ``select``. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import bytetext

BITS = 18
#: Rated texts to fit (by hash of the id), fitting rounds, weight penalty.
SAMPLE_ROWS, ROUNDS, PENALTY = 6_000, 250, 2e-4
#: Share of a text's weight given to its words, and to their shapes and repeats.
WORD_SHARE = 0.25

# Byte classes of word shapes; every sign of ASCII is a class of its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")


def vectors(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, token numbers below 2^BITS and values; sorted, one entry for each token of a text."""
    data, offsets = bytetext.utf8(array)
    count = len(array)
    starts, ends, owner = bytetext.word_spans(data, offsets)
    words = bytetext.SpanHashes(bytetext.lower_ascii(data)).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    total = np.bincount(owner, minlength=count)
    # Shapes: runs of one class within a word count once.
    classes = _CLASS[data]
    edge = np.ones(len(data), bool)
    edge[1:] = classes[1:] != classes[:-1]
    edge[starts] = True
    place = np.concatenate([[0], np.cumsum(edge)])
    shapes = bytetext.SpanHashes(classes[edge]).of(place[starts], place[ends]) if len(starts) else words
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    # Lines: runs between line feeds, by text.
    is_feed = data == 10
    line_starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(is_feed) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = np.append(line_starts[1:], len(data))
    lines = bytetext.SpanHashes(data).of(line_starts, line_ends) if len(line_starts) else np.zeros(0, np.uint64)
    order = np.lexsort((lines, line_owner))
    same = np.zeros(len(lines), bool)
    same[1:] = (lines[order][1:] == lines[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    line_again = np.bincount(line_owner[order][same], minlength=count) / np.maximum(np.bincount(line_owner, minlength=count), 1)
    size = np.log2(total + 1).astype(np.int64)

    share = 1.0 / np.maximum(total, 1)
    every = np.arange(count)

    def token(values: np.ndarray, kind: int) -> np.ndarray:
        return bytetext.mix(values.astype(np.uint64), 300 + kind) >> np.uint64(64 - BITS)

    owners = np.concatenate([owner, owner, owner[again], every, every])
    tokens = np.concatenate([token(words, 1), token(shapes, 2), token(np.zeros(int(again.sum())), 3), token(np.zeros(count), 4), token(size, 5)])
    weights = np.concatenate([share[owner] * WORD_SHARE, share[owner], share[owner[again]], line_again, np.full(count, 0.25)])
    keys, at = np.unique(owners * (1 << BITS) + tokens.astype(np.int64), return_inverse=True)
    values = np.sqrt(np.bincount(at, weights, minlength=len(keys)))
    return keys >> BITS, keys & ((1 << BITS) - 1), values


@dataclass
class OrdinalModel:
    """Shared weights, and a threshold below each grade but the lowest."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, array: pa.Array) -> np.ndarray:
        """P(grade >= k) for every text and every grade above the lowest."""
        owner, token, value = vectors(array)
        sums = np.bincount(owner, self.weights[token] * value, minlength=len(array))
        return _logistic(sums[:, None] - self.thresholds[None, :])

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(self.grades) if len(self.grades) > 1 else np.full(len(tails), float(self.grades[0]))

    def tail(self, tails: np.ndarray, grade: int) -> np.ndarray:
        """P(grade >= ``grade``)."""
        above = [i for i, g in enumerate(self.grades) if g >= grade]
        if not above:
            return np.zeros(len(tails))
        return np.ones(len(tails)) if above[0] == 0 else tails[:, above[0] - 1]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_rows(owner: np.ndarray, token: np.ndarray, value: np.ndarray, grade: np.ndarray, rounds: int = ROUNDS) -> OrdinalModel:
    """Maximum likelihood of sparse rows by accelerated gradient steps.

    The thresholds are a first one and positive steps (exponentials), so they
    stay in order.
    """
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return OrdinalModel([int(g) for g in grades] or [0], np.zeros(1 << BITS), np.zeros(0))
    level = np.searchsorted(grades, grade)
    n = len(level)
    used, column = np.unique(token, return_inverse=True)
    cuts = np.log(np.array([(level < k).sum() for k in range(1, len(grades))]) / np.array([(level >= k).sum() for k in range(1, len(grades))]))
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])  # first threshold, logs of the steps
    point = np.concatenate([np.zeros(len(used)), free])
    speed, scale = np.zeros(len(point)), np.zeros(len(point))
    for step in range(1, rounds + 1):
        weights, free = point[: len(used)], point[len(used) :]
        thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        sums = np.bincount(owner, weights[column] * value, minlength=n)
        tails = np.hstack([np.ones((n, 1)), _logistic(sums[:, None] - thresholds), np.zeros((n, 1))])
        slope = tails * (1 - tails)
        every = np.arange(n)
        chance = np.maximum(tails[every, level] - tails[every, level + 1], 1e-12)
        # d(-log P)/d(sum) and by the two thresholds around the grade
        low, high = slope[every, level] / chance, slope[every, level + 1] / chance
        by_sum = (high - low) / n
        by_cut = np.zeros(len(thresholds) + 2)
        np.add.at(by_cut, level, low / n)
        np.add.at(by_cut, level + 1, -high / n)
        by_cut = by_cut[1:-1]
        by_free = np.concatenate([[by_cut.sum()], np.exp(free[1:]) * np.cumsum(by_cut[::-1])[::-1][1:]])
        gradient = np.concatenate([np.bincount(column, by_sum[owner] * value, minlength=len(used)) + PENALTY * weights, by_free])
        speed = 0.9 * speed + 0.1 * gradient
        scale = 0.99 * scale + 0.01 * gradient**2
        point = point - 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-7)
    weights = np.zeros(1 << BITS)
    weights[used] = point[: len(used)]
    free = point[len(used) :]
    return OrdinalModel([int(g) for g in grades], weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))]))


def fit(documents: DataFrame, ratings: DataFrame) -> OrdinalModel:
    """Model from rated documents; ``ratings`` has doc_id and grade (whole numbers, higher is better)."""
    clear = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"), F.max("grade").alias("other"))
    clear = clear.where("grade = other").select("doc_id", F.col("grade").cast("long").alias("grade"))
    clear = clear.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)  # a bounded sample
    sample = documents.select("doc_id", "text").join(F.broadcast(clear), "doc_id").select("text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            owner, token, value = vectors(bytetext.text_array(batch))
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (token.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(1), *lists], names=["grade", "tokens", "values"])

    rows = sample.mapInArrow(run, "grade long, tokens array<int>, values array<float>").toArrow()
    lists = [rows.column(k).combine_chunks() for k in (1, 2)]
    grade = rows.column(0).to_numpy()
    lengths = np.diff(lists[0].offsets.to_numpy()) if len(rows) else np.zeros(0, np.int64)
    token, value = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
    # The order in which tasks end must not change the sums: sort rows by content.
    owner = np.repeat(np.arange(len(rows)), lengths)
    check = np.bincount(owner, np.sin(token + 1.0) * value, minlength=len(rows))
    order = np.lexsort((check, lengths, grade))
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    owner = rank[owner]
    by_row = np.argsort(owner, kind="stable")
    return fit_rows(owner[by_row], token[by_row], value[by_row].astype(float), grade[order])


def score(documents: DataFrame, model: OrdinalModel, grade: int, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, tail_probability of ``grade`` or better, and kept (tail probability >= ``least``)."""
    frame = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            tails = model.tails(bytetext.text_array(batch))
            arrays = [batch.column(0), pa.array(model.expected(tails)), pa.array(model.tail(tails, grade))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "expected_grade", "tail_probability"])

    found = frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, expected_grade double, tail_probability double")
    return found.withColumn("kept", F.col("tail_probability") >= least)


def select(documents: DataFrame, model: OrdinalModel, grade: int, least: float = 0.5) -> DataFrame:
    """Documents whose tail probability of ``grade`` is at least ``least``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            tails = model.tails(bytetext.text_array(batch))
            yield batch.filter(pa.array(model.tail(tails, grade) >= least))

    return documents.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in documents.dtypes))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 poor, 1 readable but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return labels.select("doc_id", grade.alias("grade"))
