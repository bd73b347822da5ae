"""Toxicity by noisy-channel deobfuscation and a linear score of the restored text.

1. ``letter_model`` counts pairs of letters over all texts: the language model.
2. ``restore`` finds spans that look disguised: digits or signs inside words,
   signs at either end of a word, letters three times in a row, letters set
   apart by spaces, line feeds or points. Every
   character of such a span stands for one of several letters, for itself or for
   nothing, at a channel cost; the best path through this lattice under the
   language model (Viterbi, all spans of a chunk at once) replaces the span.
3. ``fit`` counts words and word beginnings of restored labelled texts, keeps
   those that mark toxic ones, and fits a logistic regression to them.
4. ``score`` restores and scores every whole text.

Scores depend on the text alone. Null texts count as empty and get the score of
a text without marks, as do texts without letters. Labels that are null, or
differ for one document, are left out. Without toxic or without clean labelled
rows nothing can be learned: the score is then 0 or, if all are toxic, 1.
Repeated rows give repeated results; extra columns are dropped by ``score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import bytetext

# Signs that are used for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
#: Signs that may be put between letters.
BETWEEN = " .-_*'~,\n"

#: Channel costs in nats: a sign read as a letter, a repeated letter or a sign between letters dropped, a sign kept.
SIGN_COST, REPEAT_COST, BETWEEN_COST, KEEP_COST = 1.0, 0.7, 0.3, 6.0

#: Letters at the beginning of words that are features of their own, besides whole words.
BEGINNINGS = (3, 4, 5, 6)
#: Labelled texts for counting and fitting (by hash of the id), features and fitting rounds.
SAMPLE_ROWS, MAX_FEATURES, ROUNDS = 40_000, 4_000, 300
#: A feature must occur in so many toxic texts, and be so much more frequent there than in clean ones.
LEAST_TOXIC, LEAST_ODDS = 3, 4.0
PENALTY = 0.02

_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_SYMBOL = {c: i + 1 for i, c in enumerate(_LETTERS)}  # 0: between words
_SIZE = len(_LETTERS) + 1
_L = "a-zß-öø-ÿ"
_SIGNS = re.escape("".join(LEET))
_FOLD = {c: c + 32 for c in (*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF))}

#: Between letters set apart: a sign, or several white spaces and signs with white space around them.
_APART = rf"(?:[ .\-_*~,'\n]|[ \n]{{1,3}}[.\-_*~,'][ \n]{{1,3}}|[ \n]{{2,3}}|[.\-_*~,']{{2,3}})"
#: A disguised word: a sign among or beside letters, a letter three times, or single letters set apart by one kind of gap.
_SPAN = re.compile(
    rf"(?<![{_L}0-9])(?:"
    rf"[{_L}](?:(?P<gap>{_APART})[{_L}{_SIGNS}](?![{_L}0-9])(?:(?P=gap)[{_L}{_SIGNS}](?![{_L}0-9]))+)"
    rf"|[{_SIGNS}]?(?=[{_L}{_SIGNS}]*(?:[{_L}][{_SIGNS}]+[{_L}]|([{_L}])\2\2|[{_SIGNS}][{_L}]|[{_L}][0-9@$]))[{_L}{_SIGNS}]*[{_L}0-9@$]"
    rf")(?![{_L}0-9])"
)
#: Cheap test whether a text can hold a span.
_HINT = re.compile(rf"[{_L}][{_SIGNS}]+[{_L}]|([{_L}])\1\1|[{_SIGNS}][{_L}]|[{_L}][0-9@$]|(?<![{_L}0-9])[{_L}](?P<gap>{_APART})[{_L}{_SIGNS}](?P=gap)[{_L}{_SIGNS}](?![{_L}0-9])")


def _symbols(data: np.ndarray) -> np.ndarray:
    """Letter numbers of UTF-8 bytes, case folded; 0 for all others, 255 for the lead byte of a two-byte letter."""
    low = np.zeros(256, np.uint8)
    for c, i in _SYMBOL.items():
        if ord(c) < 128:
            low[ord(c)] = low[ord(c) - 32] = i
    out = low[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    second = np.zeros(256, np.uint8)
    for code in range(0xC0, 0x100):
        second[code - 0xC0 + 0x80] = _SYMBOL.get(chr(_FOLD.get(code, code)), 0)
    out[lead + 1] = second[data[lead + 1]]
    out[lead] = 255
    return out


def letter_model(texts: DataFrame) -> np.ndarray:
    """Log probability of each letter after each other, from all texts; at most 59 x 59 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE * _SIZE, np.int64)
        for batch in bytetext.chunks(batches):
            data, offsets = bytetext.utf8(bytetext.text_array(batch))
            found = _symbols(np.insert(data, offsets[:-1], 32))
            found = found[found != 255].astype(np.int64)
            total += np.bincount(found[:-1] * _SIZE + found[1:], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["pair", "n"])

    counts = np.zeros(_SIZE * _SIZE)
    for row in texts.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[row.pair] = row.n
    counts = counts.reshape(_SIZE, _SIZE) + 0.5
    counts[0, 0] = 0.5  # white space and signs in a row say nothing about words
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _options(span: str) -> list[list[tuple[int, float, str]]]:
    """For every character: (letter number or -1 for nothing, cost, text) of what it may stand for."""
    out = []
    for i, c in enumerate(span):
        here: list[tuple[int, float, str]] = []
        if c in _SYMBOL:
            here.append((_SYMBOL[c], 0.0, c))
            if i and span[i - 1] == c:
                here.append((-1, REPEAT_COST, ""))
        else:
            here.append((0, 0.0 if c in BETWEEN else KEEP_COST, c))
            here += [(_SYMBOL[x], SIGN_COST, x) for x in LEET.get(c, "")]
            if c in BETWEEN:
                here.append((-1, BETWEEN_COST, ""))
        out.append(here)
    return out


def decode(spans: list[str], model: np.ndarray) -> list[str]:
    """The most likely plain form of each span, by one Viterbi pass over all of them."""
    lattices = [_options(s) for s in spans]
    if not lattices:
        return []
    length = max(map(len, lattices))
    width = max(len(o) for x in lattices for o in x)
    count = len(lattices)
    letter = np.full((count, length, width), -2, np.int64)  # -2: no such option
    cost = np.zeros((count, length, width))
    for i, lattice in enumerate(lattices):
        for t, options in enumerate(lattice):
            for k, (x, c, _) in enumerate(options):
                letter[i, t, k], cost[i, t, k] = x, c
    best = np.full((count, _SIZE), -np.inf)
    best[:, 0] = 0
    came = np.zeros((count, length, _SIZE), np.int16)  # option * size + letter before
    every = np.arange(count)
    sizes = np.array([len(x) for x in lattices])
    for t in range(length):
        new = np.full((count, _SIZE), -np.inf)
        for k in range(width):
            x = letter[:, t, k]
            some = every[x >= 0]
            if len(some):
                reach = best[some] + model[:, x[some]].T
                before = reach.argmax(axis=1)
                value = reach[np.arange(len(some)), before] - cost[some, t, k]
                better = value > new[some, x[some]]
                at, to = some[better], x[some][better]
                new[at, to] = value[better]
                came[at, t, to] = k * _SIZE + before[better]
            gone = every[x == -1]
            if len(gone):
                value = best[gone] - cost[gone, t, k][:, None]
                rows, to = np.nonzero(value > new[gone])
                new[gone[rows], to] = value[rows, to]
                came[gone[rows], t, to] = k * _SIZE + to
        over = sizes <= t
        new[over] = best[over]
        best = new
    last = (best + model[:, 0]).argmax(axis=1)
    out = []
    for i, lattice in enumerate(lattices):
        state, text = int(last[i]), []
        for t in range(len(lattice) - 1, -1, -1):
            k, before = divmod(int(came[i, t, state]), _SIZE)
            text.append(lattice[t][k][2])
            state = before
        out.append("".join(reversed(text)))
    return out


#: Spans decoded at once, and the longest span of one lattice; a longer one is cut where it stands.
SPANS_AT_ONCE, SPAN_LENGTH = 4_000, 48


def restore(texts: list[str], model: np.ndarray, known: dict[str, str] | None = None) -> list[str]:
    """Texts in small letters with disguised spans in plain form. ``known`` keeps decoded spans."""
    known = {} if known is None else known
    if len(known) > 200_000:
        known.clear()
    low = [t.translate(_FOLD) for t in texts]
    hinted = [i for i, t in enumerate(low) if _HINT.search(t)]
    parts: set[str] = set()
    for i in hinted:
        for match in _SPAN.finditer(low[i]):
            span = match.group()
            parts.update(span[k : k + SPAN_LENGTH] for k in range(0, len(span), SPAN_LENGTH))
    new = sorted(parts.difference(known), key=len)
    for k in range(0, len(new), SPANS_AT_ONCE):
        some = new[k : k + SPANS_AT_ONCE]
        known.update(zip(some, decode(some, model), strict=True))

    def plain(match: re.Match) -> str:
        span = match.group()
        return "".join(known[span[k : k + SPAN_LENGTH]] for k in range(0, len(span), SPAN_LENGTH))

    for i in hinted:
        low[i] = _SPAN.sub(plain, low[i])
    return low


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and 64-bit hashes of all words and word beginnings; repeats included."""
    array = pa.array(texts, pa.large_string())
    data, offsets = bytetext.utf8(array)
    inside = _symbols(data) != 0
    spaced = np.where(inside, data, np.uint8(32))
    starts, ends, owner = bytetext.word_spans(spaced, offsets)
    hashes = bytetext.SpanHashes(data)
    owners, found = [owner], [hashes.of(starts, ends)]
    for k in BEGINNINGS:
        long = ends - starts > k
        owners.append(owner[long])
        found.append(bytetext.mix(hashes.of(starts[long], starts[long] + k), k))
    return np.concatenate(owners), np.concatenate(found)


@dataclass
class ToxicityModel:
    """Letter model, and weights of the features that mark toxic texts."""

    letters: np.ndarray
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def marks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text number, feature number) pairs of restored texts."""
        owner, found = features(texts)
        if not len(self.hashes) or not len(found):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        hit = self.hashes[at] == found
        pairs = np.unique(owner[hit] * len(self.hashes) + at[hit])
        return np.divmod(pairs, len(self.hashes))

    def scores(self, texts: list[str]) -> np.ndarray:
        owner, number = self.marks(texts)
        sums = self.bias + np.bincount(owner, self.weights[number], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _logistic(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a penalised logistic regression on 0/1 features, by accelerated gradient steps."""
    share = target.mean()
    weights, bias = np.zeros(width), float(np.log(share / (1 - share)))
    speed, bias_speed, scale, bias_scale = np.zeros(width), 0.0, np.full(width, 1e-8), 1e-8
    for _ in range(ROUNDS):
        sums = bias + np.bincount(rows, weights[columns], minlength=len(target))
        error = (1 / (1 + np.exp(-sums)) - target) / len(target)
        slope = np.bincount(columns, error[rows], minlength=width) + PENALTY * weights / len(target)
        scale = 0.99 * scale + 0.01 * slope**2
        speed = 0.9 * speed + 0.1 * slope / np.sqrt(scale)
        bias_scale = 0.99 * bias_scale + 0.01 * error.sum() ** 2
        bias_speed = 0.9 * bias_speed + 0.1 * error.sum() / np.sqrt(bias_scale)
        weights, bias = weights - 0.1 * speed, bias - 0.1 * bias_speed
    return weights, float(bias)


def fit(documents: DataFrame, labels: DataFrame, letters: np.ndarray | None = None) -> ToxicityModel:
    """Model from labelled documents that are not held out, at most ``SAMPLE_ROWS`` of them."""
    letters = letter_model(documents) if letters is None else letters
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    marked = marked.where("toxic = other").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    sample = documents.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("text", F.col("toxic").cast("long").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in bytetext.chunks(batches, limit=4 << 20):
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            owner, found = features(restore(bytetext.text_array(batch).to_pylist(), letters, known))
            order = np.lexsort((found, owner))
            owner, found = owner[order], found[order]
            new = np.ones(len(found), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
            names, at = np.unique(found[new], return_inverse=True)
            ones = np.bincount(at, toxic[owner[new]], minlength=len(names)).astype(np.int64)
            total = np.bincount(at, minlength=len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(ones), pa.array(total - ones)], names=["f", "toxic", "clean"])

    sizes = sample.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    none = ToxicityModel(letters, np.zeros(0, np.uint64), np.zeros(0), 0.0)
    if not sizes.toxic or sizes.toxic == sizes.n:
        none.bias = -500.0 if not sizes.toxic else 500.0
        return none
    odds = F.log((F.col("toxic") + 0.5) / F.lit(sizes.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(sizes.n - sizes.toxic + 1.0))
    sums = sample.mapInArrow(count, "f long, toxic long, clean long").groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    chosen = sums.withColumn("odds", odds).where((F.col("toxic") >= LEAST_TOXIC) & (F.col("odds") >= LEAST_ODDS))
    chosen = chosen.orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "f").limit(MAX_FEATURES).collect()
    if not chosen:
        none.bias = float(np.log(sizes.toxic / (sizes.n - sizes.toxic)))
        return none
    hashes = np.sort(np.array([r.f for r in chosen], np.int64).view(np.uint64))
    model = ToxicityModel(letters, hashes, np.zeros(len(hashes)), 0.0)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in bytetext.chunks(batches):
            owner, number = model.marks(restore(bytetext.text_array(batch).to_pylist(), letters, known))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            marks = pa.ListArray.from_arrays(pa.array(ends), pa.array(number.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1), marks], names=["toxic", "marks"])

    rows = sample.mapInArrow(mark, "toxic long, marks array<int>")
    # Equal texts of marks count together, so that the driver gets few rows.
    rows = rows.groupBy("toxic", "marks").agg(F.count("*").alias("n")).orderBy("toxic", "marks").collect()
    target = np.repeat([r.toxic for r in rows], [r.n for r in rows]).astype(float)
    lists = [np.array(r.marks, np.int64) for r in rows for _ in range(r.n)]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    model.weights, model.bias = _logistic(owner, np.concatenate([*lists, np.zeros(0, np.int64)]), target, len(hashes))
    return model


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    frame = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in bytetext.chunks(batches):
            scores = model.scores(restore(bytetext.text_array(batch).to_pylist(), model.letters, known))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    found = frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns; the model is fitted to ``documents``."""
    model = fit(documents, labels)
    kinds = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in bytetext.chunks(batches):
            texts = bytetext.text_array(batch).to_pylist()
            yield batch.filter(pa.array(model.scores(restore(texts, model.letters, known)) < 0.5))

    assert place >= 0
    return documents.mapInArrow(run, kinds)
