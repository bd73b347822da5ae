"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

``encode`` turns texts into ids with a tokenizer file, ``write`` ranks the ids
by how often the corpus uses them and writes the documents in ascending id
order, ``read`` reads the files back. A file is a Parquet file whose rows are
blocks of about ``BLOCK_IDS`` ids: the document ids and their lengths, one
control byte for every four ids of a document (two bits each: bytes of the value
less one), and apart from them the bytes of the values, lowest first. Frequent ids have
small ranks and take one byte. Decoding looks the four lengths of each control
byte up in a table. Spark's writer commits the files, so a lost executor
repeats its tasks and leaves no part of a file behind.

Null texts count as empty: they hold the end id alone. A null document id sorts
first. Rows that share an id are ordered by the bytes of their ids, and each keeps its
place. Empty tables give empty files and results; extra columns are dropped.
"""

from __future__ import annotations

import gc
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import bytetext
from tallyweave.session import run_folder

#: Ids of one block; a longer document makes a longer block.
BLOCK_IDS = 1 << 18
#: Words and letter runs whose ids a worker keeps (about 150 bytes each); beyond it the store starts anew.
STORE_LIMIT = 1_000_000
#: New words given to the tokenizer in one call.
WORDS_A_CALL = 200

#: Bytes of the four values that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, value bytes and the value bytes of each sequence, for sequences of values below 2^32 in a row.

    Each sequence begins with a control byte of its own; its last one may
    describe fewer than four values.
    """
    values = values.astype(np.int64)
    size = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    ends = np.cumsum(counts)
    groups = -(-counts // 4)
    place = np.arange(len(values)) + np.repeat(4 * (np.cumsum(groups) - groups) - (ends - counts), counts)
    codes = np.zeros(4 * int(groups.sum()), np.uint8)
    codes[place] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    stops = np.cumsum(size)
    starts = stops - size
    data = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint8)
    data[starts] = values & 0xFF
    for k in (1, 2, 3):
        there = np.flatnonzero(size > k)
        data[starts[there] + k] = values[there] >> (8 * k) & 0xFF
    bounds = np.concatenate([[0], stops])[np.concatenate([[0], ends])]
    return control, data, np.diff(bounds)


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The values that ``pack`` wrote, in a row."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    groups = -(-counts // 4)
    size = size[np.arange(int(counts.sum())) + np.repeat(4 * (np.cumsum(groups) - groups) - (np.cumsum(counts) - counts), counts)]
    starts = np.cumsum(size) - size
    stream = np.frombuffer(data, np.uint8)
    values = stream[starts].astype(np.int64)
    for k in (1, 2, 3):
        there = np.flatnonzero(size > k)
        values[there] |= stream[starts[there] + k].astype(np.int64) << (8 * k)
    return values


class WordEncoder:
    """A tokenizer of the tokenizers library that encodes each distinct word once.

    Only for tokenizers that drop white space and case and mark the ends of
    words with ``word_end``: there the ids of a text are those of its words in
    a row. Words of plain letters, with or without a full stop or comma, share
    the ids of their lower-case letters; all others go to the tokenizer as they
    stand.
    """

    def __init__(self, path: str, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith(word_end)]] = True
        # ASCII signs that the tokenizer sets apart from letters on either side, and that no added token needs.
        added = {c for token in self.tokenizer.get_added_tokens_decoder().values() for c in token.content}
        signs = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in added and self._sets_apart(c)]
        apart = f"[{re.escape(''.join(signs))}]*" if signs else ""
        self.shape = re.compile(f"({apart})([{_LETTERS}]+)({apart})").fullmatch
        self.forget()

    def _sets_apart(self, sign: str) -> bool:
        pieces = [p for x in ascii_lowercase for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"{x}{sign}{x}")]
        return pieces == [p for x in ascii_lowercase for p in (x, sign, x)]

    def forget(self) -> None:
        # Slot 0 is the empty word. The arrays grow by doubling; ``held`` and ``count`` say how far they are filled.
        self.slots = {"": 0}
        self.parts = {"": 0}
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.held, self.count = 0, 1

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Append spans to the store; the slot of the first."""
        first, held, count = self.count, self.held + len(ids), self.count + len(lengths)
        self.ids, self.starts, self.lengths = _room(self.ids, held), _room(self.starts, count), _room(self.lengths, count)
        self.ids[self.held : held] = ids
        self.lengths[first:count] = lengths
        self.starts[first:count] = self.held + np.cumsum(lengths) - lengths
        self.held, self.count = held, count
        return first

    def _spans(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slots ``used`` in a row, and how many each has."""
        size = self.lengths[used]
        ends = np.cumsum(size)
        return self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[used] - (ends - size), size)], size

    def _plain(self, words: list[str]) -> None:
        """Keep the ids of words of lower-case letters, many given in one text."""
        calls = [words[i : i + WORDS_A_CALL] for i in range(0, len(words), WORDS_A_CALL)]
        for call, found in zip(calls, self.tokenizer.encode_batch_fast([" ".join(c) for c in calls], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.int32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(call):
                first = self._keep(ids, np.diff(ends, prepend=0))
                self.parts.update(zip(call, range(first, self.count), strict=True))
            else:
                self._any(call, self.parts)

    def _any(self, words: list[str], into: dict[str, int]) -> None:
        """Keep the ids of words that are given to the tokenizer one by one."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        first = self._keep(np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths)
        into.update(zip(words, range(first, self.count), strict=True))

    def _learn(self, words: list[str]) -> None:
        shapes = [(word, self.shape(word)) for word in words]
        self._any([word for word, shape in shapes if shape is None], self.slots)
        whole = [word for word, shape in shapes if shape is not None]
        thirds = [shape.groups() for _, shape in shapes if shape is not None]
        thirds = [(before, letters.lower(), after) for before, letters, after in thirds]
        self._any(list({x for before, _, after in thirds for x in (before, after)}.difference(self.parts)), self.parts)
        self._plain(list({letters for _, letters, _ in thirds}.difference(self.parts)))
        used = np.fromiter(map(self.parts.__getitem__, chain.from_iterable(thirds)), np.int64, 3 * len(thirds))
        ids, lengths = self._spans(used)
        first = self._keep(ids, lengths.reshape(-1, 3).sum(axis=1))
        self.slots.update(zip(whole, range(first, self.count), strict=True))

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if self.count > STORE_LIMIT:
            self.forget()
        words = [t.replace("\n", " ").split(" ") for t in texts]
        new = set(chain.from_iterable(words)).difference(self.slots)
        if new:
            self._learn(list(new))
        counts = np.fromiter(map(len, words), np.int64, len(words))
        used = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        ids, lengths = self._spans(used)
        bounds = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)


_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with place for ``size``."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    """The tokenizer of a file, once per worker."""
    return WordEncoder(path)


def id_type(path: str, end_id: int) -> str:
    """The narrowest type that holds all ids of a tokenizer: 16 or 32 bits, lowest byte first."""
    return "<u2" if max(len(load(path).ends_word) - 1, end_id) < 1 << 16 else "<u4"


def encode(documents: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id and token ids (bytes of :func:`id_type`) of every document, the end id last."""
    kind = id_type(path, end_id)
    width = np.dtype(kind).itemsize
    frame = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        collecting = gc.isenabled()
        gc.disable()  # millions of small strings and no cycles among them
        try:
            yield from _encoded(coder, batches)
        finally:
            if collecting:
                gc.enable()

    def _encoded(coder: WordEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches, limit=2 << 20):
            ids, counts = coder.encode_batch(bytetext.text_array(batch).to_pylist())
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype(kind).tobytes()
            ends = ends + np.arange(1, len(ends) + 1)
            bounds = (width * np.concatenate([[0], ends])).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "ids"])

    return frame.mapInArrow(run, "doc_id long, ids binary")


def frequency_order(encoded: DataFrame, kind: str) -> np.ndarray:
    """Ids of the corpus by falling frequency, then by id; at most one entry for each vocabulary id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, _ = bytetext.utf8(batch.column(0).cast(pa.large_binary()))
            found = np.bincount(data.view(kind))
            if len(found) > len(total):
                found, total = total, found
            total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return np.array([r.id for r in counts.orderBy(F.desc("n"), "id").collect()], np.int64)


def write(encoded: DataFrame, path: str, kind: str, partitions: int | None = None) -> None:
    """Write encoded documents to ``path/ids`` in ascending document order and the ranked ids to ``path/order``.

    ``encoded`` is read three times, so give a stored table. ``partitions`` is
    the number of files, by default the session's shuffle partitions.
    """
    spark = encoded.sparkSession
    order = frequency_order(encoded, kind)
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id long").coalesce(1).write.parquet(f"{path}/order")
    ranks = np.zeros(int(order.max()) + 1 if len(order) else 0, np.int64)
    ranks[order] = np.arange(len(order))

    BLOCK = pa.schema(  # noqa: N806
        [("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows: list[tuple] = []
        held, before, number = 0, 0, 0

        def block() -> pa.RecordBatch:
            docs, sequences = zip(*rows, strict=True)
            counts = np.array([len(x) // width for x in sequences], np.int64)
            control, data, _ = pack(ranks[np.frombuffer(b"".join(sequences), kind)], counts)
            arrays = [[part], [number], [before], [held], [docs], [counts], [control.tobytes()], [data.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, BLOCK, strict=True)], schema=BLOCK)

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append(row)
                held += len(row[1]) // width
                if held >= BLOCK_IDS:
                    yield block()
                    rows, held, before, number = [], 0, before + held, number + 1
        if rows:
            yield block()

    width = np.dtype(kind).itemsize
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = encoded.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "ids")
    schema = "part int, block int, before long, n_ids long, doc_ids array<long>, lengths array<long>, control binary, data binary"
    dealt.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(f"{path}/ids")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ids (or ids_crc32 with ``digest``) from files."""
    order = np.array([r.id for r in spark.read.parquet(f"{path}/order").orderBy("rank").collect()], np.int64)
    blocks = spark.read.parquet(f"{path}/ids")
    # One number for each written file.
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    firsts = dict(zip([r.part for r in sums], np.cumsum([0] + [r.n for r in sums])[:-1].tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, before, docs, lengths, control, data = (batch.column(c)[i] for c in range(6))
                size = lengths.values.to_numpy()
                ids = order[unpack(control.as_py(), data.as_py(), size)]
                ends = np.cumsum(size)
                start = firsts[part.as_py()] + before.as_py() + ends - size
                if digest:
                    packed = memoryview(ids.astype("<u4").tobytes())
                    values = pa.array([zlib.crc32(packed[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)], pa.int64())
                else:
                    values = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(start), pa.array(size), values], names=["doc_id", "start", "n_tokens", "ids"])

    last = "ids_crc32 long" if digest else "ids array<long>"
    picked = blocks.select("part", "before", "doc_ids", "lengths", "control", "data")
    return picked.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def round_trip(documents: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode, write files, read them back: doc_id, start, n_tokens and ids_crc32 of every document."""
    spark = documents.sparkSession
    folder = folder or f"{run_folder(spark)}/{uuid.uuid4().hex}"
    encode(documents, path, end_id).write.option("compression", "zstd").parquet(f"{folder}/encoded")
    write(spark.read.parquet(f"{folder}/encoded"), f"{folder}/files", id_type(path, end_id))
    return read(spark, f"{folder}/files", digest=True)
