"""Byte-level BPE: encode by batched numpy merge rounds, decode by table lookup.

The vocabulary and merges come from a tokenizer file; nothing is trained. A
chunk of texts is cut into pieces, each distinct piece is encoded once, and all
new pieces of a chunk are merged together: their symbols lie in one flat array,
every round finds the ranks of all neighbouring pairs by binary search over the
sorted pair keys, and joins each piece's lowest-ranked pair wherever it occurs.

Null texts count as empty and give no ids. A special token's string inside a
text becomes the special id. Repeated rows give repeated results; extra columns
are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyweave.llm import bytetext

# The split pattern of byte-level BPE files, with Unicode white space written out
# (the regex module's \s also holds the separators U+001C to U+001F).
PIECE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+"""

#: Distinct chunks of text whose ids a worker keeps; beyond it the store starts anew.
STORE_LIMIT = 250_000

_PIECES = regex.compile(PIECE_PATTERN)
#: Where only single spaces and line feeds separate words, no piece crosses these cuts; plain words lose a full stop or comma.
_CUTS = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+(?![^ \n.,])| ?[^ \n]+|[ \n]+(?![^ \n])|\n")
_ODD_SPACE = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|  |\n ")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level files: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """Encoder and decoder for one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        joined = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.joined = keys[order], order, joined  # keys in order, their ranks; ids by rank
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        strings = [b""] * self.size
        for token, number in vocab.items():
            strings[number] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, number in self.special.items():
            strings[number] = token.encode()
        self._special_split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.token_lengths = np.array([len(s) for s in strings], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(strings), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._ids = [np.zeros(0, np.int32)]
        self._lengths = [np.zeros(0, np.int64)]
        self._flat: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _rank(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position, len(keys) where there is none."""
        out = np.full(len(at), len(self.keys), np.int64)
        inner = np.flatnonzero(at < len(symbols) - 1)
        inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
        key = symbols[at[inner]] * self.size + symbols[at[inner] + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[place] == key
        out[inner[found]] = self.ranks[place[found]]
        return out

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each piece has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        never = len(self.keys)
        rank = self._rank(symbols, owner, np.arange(len(symbols)))
        done_ids, done_owner = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.append(first, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), count)
            over = lowest == never  # pieces without a pair to join are ready
            if over.any():
                done_ids.append(symbols[over])
                done_owner.append(owner[over])
            where = np.flatnonzero((rank == lowest) & ~over)
            # In a run of overlapping hits (a pair of equal symbols) every second one is joined, from the left.
            number = np.arange(len(where))
            run_start = np.ones(len(where), bool)
            run_start[1:] = where[1:] != where[:-1] + 1
            where = where[(number - np.maximum.accumulate(np.where(run_start, number, 0))) % 2 == 0]
            symbols[where] = self.joined[rank[where]]
            changed = np.zeros(len(symbols), bool)
            changed[where] = True
            keep = ~over
            keep[where + 1] = False
            symbols, owner, rank, changed = symbols[keep], owner[keep], rank[keep], changed[keep]
            changed[:-1] |= changed[1:]  # the pair to the left has a new right half
            at = np.flatnonzero(changed)
            rank[at] = self._rank(symbols, owner, at)
        if not done_ids:
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        ids, owners = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owners, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owners, minlength=len(pieces))

    def _learn(self, cuts: set[str]) -> None:
        """Encode text chunks that are not in the store yet."""
        new = list(cuts)
        numbers: dict[str, int] = {}
        uses, counts = [], []
        for cut in new:
            pieces = [cut] if cut[cut[0] == " " :].isalpha() else _PIECES.findall(cut)
            counts.append(len(pieces))
            uses.extend([numbers.setdefault(p, len(numbers)) for p in pieces])
        ids, lengths = self.merge([p.encode() for p in numbers])
        used = np.array(uses, np.int64)
        self._ids.append(_spans(ids, np.cumsum(lengths) - lengths, lengths, used))
        bounds = np.concatenate([[0], np.cumsum(lengths[used])])
        ends = np.cumsum(np.array(counts, np.int64))
        self._lengths.append(np.diff(np.concatenate([[0], bounds[ends]])))
        base = len(self._slots)
        self._slots.update((cut, base + i) for i, cut in enumerate(new))
        self._flat = None

    def _plain(self, text: str) -> list[str]:
        if _ODD_SPACE.search(text) is None:
            return _CUTS.findall(text)
        return _PIECES.findall(text)

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row as int32, and how many each text has."""
        if len(self._slots) > STORE_LIMIT:
            self._forget()
        cuts: list[list[str]] = []
        for text in texts:
            if self._special_split is not None and self._special_split.search(text):
                begin, own = 0, []
                for match in self._special_split.finditer(text):
                    own += [*self._plain(text[begin : match.start()]), match.group()]
                    begin = match.end()
                cuts.append([*own, *self._plain(text[begin:])])
            else:
                cuts.append(self._plain(text))
        for token, number in self.special.items():
            if token not in self._slots:
                self._slots[token] = len(self._slots)
                self._ids.append(np.array([number], np.int32))
                self._lengths.append(np.array([1], np.int64))
                self._flat = None
        new = set(chain.from_iterable(cuts)).difference(self._slots)
        if new:
            self._learn(new)
        if self._flat is None:
            ids, lengths = np.concatenate(self._ids), np.concatenate(self._lengths)
            self._ids, self._lengths = [ids], [lengths]
            self._flat = ids, np.cumsum(lengths) - lengths, lengths
        ids, starts, lengths = self._flat
        counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
        used = np.fromiter(map(self._slots.__getitem__, chain.from_iterable(cuts)), np.int64, int(counts.sum()))
        bounds = np.concatenate([[0], np.cumsum(lengths[used])])
        ends = np.cumsum(counts)
        return _spans(ids, starts, lengths, used), np.diff(np.concatenate([[0], bounds[ends]]))

    def decode_batch(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id sequences lying in a row; bytes that are no UTF-8 become U+FFFD."""
        data = _spans(self.token_bytes, self.token_starts, self.token_lengths, ids).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.token_lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _spans(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, used: np.ndarray) -> np.ndarray:
    """values[starts[u] : starts[u] + lengths[u]] for all u of ``used``, in a row."""
    size = lengths[used]
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0)
    return values[at + np.repeat(starts[used] - (ends - size), size)]


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """The tokenizer of a file, once per worker."""
    return ByteBpe(path)


def encode(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, n_tokens, token_ids and the decoded text of every document, in tasks of bounded memory."""
    frame = documents.select(id_column, text_column)
    kind = dict(frame.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in bytetext.chunks(batches, text_column):
            ids, counts = coder.encode_batch(bytetext.text_array(batch, text_column).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(coder.decode_batch(ids, counts))],
                names=[id_column, "n_tokens", "token_ids", "decoded"],
            )

    return frame.mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, token_ids array<int>, decoded string")


def digests(documents: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, and token_ids if asked for."""
    frame = documents.select("doc_id", "text")
    kind = dict(frame.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in bytetext.chunks(batches):
            ids, counts = coder.encode_batch(bytetext.text_array(batch).to_pylist())
            ends = np.cumsum(counts)
            packed = ids.astype("<u4").tobytes()
            spans = zip((4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True)
            arrays = [
                batch.column(0),
                pa.array(counts),
                pa.array([hashlib.sha256(packed[a:b]).hexdigest() for a, b in spans], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in coder.decode_batch(ids, counts)], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return frame.mapInArrow(run, schema + (", token_ids array<int>" if with_ids else ""))
