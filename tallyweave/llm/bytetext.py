"""Texts of an Arrow batch as flat numpy byte arrays, and hashes of their words.

All functions work on one bounded chunk of texts at a time, so a worker's
memory depends on the longest single text, not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Target size of one chunk of texts in bytes; a longer single text is a chunk of its own.
CHUNK_BYTES = 1 << 20

#: The characters between words: space and the control characters tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def text_array(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(text_array(batch, column)).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the offsets of the texts in them."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values one to one (multiply, shift, exclusive or)."""
    out = (values ^ np.uint64((seed * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)) * _MULTIPLIER
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base^0 .. base^(count-1) modulo 2^64."""
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:count]


_BASE = 0xA24BAED4963EE407  # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64), 11)


class SpanHashes:
    """64-bit hashes of any byte spans of ``data``: differences of one running sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * powers(np.uint64(_BASE), len(data)), out=self.sums[1:])
        self.inverse = powers(np.uint64(_BASE_INVERSE), len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words (runs free of ``SPACES``); a word never crosses texts."""
    is_word = np.ones(256, bool)
    is_word[list(SPACES)] = False
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and 64-bit hashes of the distinct word shingles, sorted by text, then hash.

    A text with fewer than ``size`` words gives its whole word sequence as one
    shingle; a text without words gives none.
    """
    starts, ends, owner = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = SpanHashes(data).of(starts, ends)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    begin = np.cumsum(counts) - counts
    left = (begin + counts)[owner] - np.arange(len(words))  # words from here to the end of the text
    full = np.flatnonzero(left >= size)
    hashes = np.full(len(full), size, np.uint64)
    for step in range(size):
        hashes = mix(hashes + words[full + step], step + 1)
    owners = owner[full]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = counts[short].astype(np.uint64)
        for step in range(size - 1):
            there = counts[short] > step
            own[there] = mix(own[there] + words[begin[short[there]] + step], step + 1)
        owners, hashes = np.concatenate([owners, short]), np.concatenate([hashes, own])
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (hashes[1:] != hashes[:-1])
    return owners[new], hashes[new]
