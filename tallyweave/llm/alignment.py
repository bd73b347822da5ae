"""Alignment of two tokenizers' tokens over the same bytes, by an associative monoid of fragments.

Both token streams spell the same bytes (a space and the text). Where a token of
either stream ends, the streams meet, and the meeting points cut them into
groups. A fragment is what a byte range knows of this: the tokens up to its first
meeting point (open prefix), the groups closed inside it, and the tokens after
its last one (open suffix). Two neighbouring fragments compose to one: the left
suffix and the right prefix become a closed group. Composition is associative,
so a very long document is cut into byte ranges that are aligned in different
tasks, and a tree of joins composes them, some neighbours at a time; closed
groups stay in the rows where they arose, only prefixes and suffixes move.

Shorter documents are one fragment. They are read as runs between single spaces,
where both tokenizers begin anew, and each distinct run is aligned once a worker.

Link counts of the whole corpus: an id pair can only end together if one token's
bytes end with the other's, so the vocabularies alone bound the pair table (the
sum of all token lengths, about half a million); it is numbered beforehand.

Nulls and edge cases: a null or empty text, and one whose tokens spell other
bytes, has no tokens, zeros, and '' for the hash. Null and repeated ids keep one
row for each row given. An empty table gives an empty result. Extra columns are
dropped. Ties for the highest count all count. Memory of a task depends on the
window size and on the longest run without a single space, not on the text; the
hash of a document is fed its groups in order, one row after the other.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import bytetext
from tallyweave.llm.bpe import PIECE_PATTERN, byte_letters
from tallyweave.session import stage

#: Bytes of a byte range; longer documents are cut into windows of about this size.
RANGE_BYTES = 1 << 16
#: Neighbouring fragments composed in one step of the tree.
FAN_IN = 32
#: Distinct runs a worker keeps aligned, and bytes of their groups; beyond either the store starts anew.
STORE_RUNS, STORE_BYTES = 100_000, 1 << 24

#: Both tokenizers begin anew at a single space between other characters.
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass
class Fragment:
    """What a byte range knows: ids before its first meeting point, groups closed inside, ids after the last one.

    Without a meeting point (``first`` is -1) all ids are in the prefix.
    """

    prefix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))
    closed: list[tuple[list[int], list[int]]] = field(default_factory=list)
    suffix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))
    first: int = -1


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring byte ranges; associative, with ``Fragment()`` as neutral element."""
    if left.first < 0 or right.first < 0:
        glue = lambda x, y: (x[0] + y[0], x[1] + y[1])
        if left.first < 0:
            return Fragment(glue(left.prefix, right.prefix), right.closed, right.suffix, right.first)
        return Fragment(left.prefix, left.closed, glue(left.suffix, right.prefix), left.first)
    return Fragment(left.prefix, [*left.closed, joint(left, right), *right.closed], right.suffix, left.first)


def joint(left: Fragment, right: Fragment) -> tuple[list[int], list[int]]:
    """The group that closes where two fragments with meeting points touch."""
    return left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1]


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """The fragment of the tokens that end inside one byte range."""
    meet = np.intersect1d(a_ends, b_ends, assume_unique=True)
    if not len(meet):
        return Fragment((a.tolist(), b.tolist()))
    cut = []
    for ids, ends in ((a.tolist(), a_ends), (b.tolist(), b_ends)):
        stops = np.searchsorted(ends, meet, side="right").tolist()
        cut.append([ids[i:j] for i, j in zip([0, *stops], [*stops, len(ids)], strict=True)])
    groups = [*zip(*cut, strict=True)]
    return Fragment(groups[0], groups[1:-1], groups[-1], int(meet[0]))


def spans(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The spans ``used`` of ``values`` in a row; span u begins at starts[u]."""
    size = lengths[used]
    stop = np.cumsum(size)
    return values[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(starts[used] - (stop - size), size)]


class _Table:
    """Byte strings by number, spelled out by one gather."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([*map(len, strings)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def spell(self, numbers: np.ndarray) -> bytes:
        return spans(self.data, self.starts, self.lengths, numbers).tobytes()


class Aligner:
    """Two tokenizers, the bytes of their tokens and the numbers of the id pairs that can end together."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        letters = byte_letters()
        self.a_bytes = [b""] * (max(spec["vocab"].values()) + 1)
        for token, number in spec["vocab"].items():
            if all(c in letters for c in token):
                self.a_bytes[number] = bytes(letters[c] for c in token)
        merged = [spec["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{a_path}: ids do not follow the order of merges")
        used = {*merged, *(spec["vocab"][c] for c in letters)}
        self.a_bytes = [data if number in used else b"" for number, data in enumerate(self.a_bytes)]
        ranks = {data: number for number, data in enumerate(self.a_bytes) if data}
        self.a = tiktoken.Encoding("file", pat_str=PIECE_PATTERN.replace("[^\\p{White_Space}]", "\\S").replace("\\p{White_Space}", "\\s"), mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        # Where a piece holds a space behind another character, runs would not be encoded alike alone.
        self.apart = not any(" " in p.lstrip(" ") for p in (x.decode("utf-8", "replace") for x in self.b_bytes))
        ids_a, ids_b = {}, {}
        for ids, table in ((ids_a, self.a_bytes), (ids_b, self.b_bytes)):
            for number, data in enumerate(table):
                if data:
                    ids.setdefault(data, []).append(number)
        self.width = len(self.b_bytes)
        pairs = {x * self.width + y for data, many in ids_a.items() for k in range(len(data)) for y in ids_b.get(data[k:], ()) for x in many}
        pairs |= {x * self.width + y for data, many in ids_b.items() for k in range(len(data)) for x in ids_a.get(data[k:], ()) for y in many}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.a_table, self.b_table = _Table(self.a_bytes), _Table(self.b_bytes)
        self.written = _Table([f"{i}{mark}".encode() for i in range(max(len(self.a_bytes), self.width)) for mark in ",|;"])
        self._forget()

    def _piece(self, number: int) -> bytes:
        if self.b.is_control(number) or self.b.is_unknown(number):
            return b""
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, and 1 where the bytes are right
        self.links = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.held = 0

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers for a space and the text; None where they spell other bytes."""
        data = (" " + text).encode()
        a, b = (np.array(x, np.int64) for x in (self.a.encode_ordinary(" " + text), self.b.encode(text)))
        return (a, b) if self.a_table.spell(a) == data and self.b_table.spell(b) == data else None

    def pair_numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of id pairs that end together."""
        return np.searchsorted(self.pairs, np.asarray(a, np.int64) * self.width + np.asarray(b, np.int64)).astype(np.int32)

    def _learn(self, runs: list[str]) -> None:
        pieces = self.b.encode(runs, num_threads=1)
        many = np.fromiter(map(len, pieces), np.int64, len(runs))
        b = np.fromiter(chain.from_iterable(pieces), np.int64, int(many.sum()))
        data = [(" " + run).encode() for run in runs]
        whole = b"".join(data)
        right = np.ones(len(runs), bool)
        if self.b_table.spell(b) != whole:
            stop = np.cumsum(many)
            right = np.array([self.b_table.spell(b[j - n : j]) == d for j, n, d in zip(stop.tolist(), many.tolist(), data, strict=True)])
            b = b[np.repeat(right, many)]
            data = [d for d, r in zip(data, right.tolist(), strict=True) if r]
            whole = b"".join(data)
        a = np.array(self.a.encode_ordinary(whole.decode()) if self.apart else [i for d in data for i in self.a.encode_ordinary(d.decode())], np.int64)
        a_ends, b_ends = np.cumsum(self.a_table.lengths[a]), np.cumsum(self.b_table.lengths[b])
        token_at = np.full(len(whole) + 1, -1, np.int32)
        token_at[a_ends] = np.arange(len(a))
        last_b = np.flatnonzero(token_at[b_ends] >= 0)
        meet = b_ends[last_b]
        last_a = token_at[meet]
        # All tokens in the order in which they are written, group by group, each with the mark behind it.
        text_ids = np.zeros(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        before = np.append(0, last_b + 1)[np.cumsum(ends_a) - ends_a]
        text_ids[np.arange(len(a)) + before] = 3 * a + ends_a
        before = np.append(last_a + 1, 0)[np.cumsum(ends_b) - ends_b]
        text_ids[np.arange(len(b)) + before] = 3 * b + 2 * ends_b
        written = self.written.spell(text_ids)
        # Runs end at meeting points.
        run_ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        counts = np.zeros((len(runs), 4), np.int64)
        stops = [np.searchsorted(ends, run_ends, side="right") for ends in (a_ends, b_ends, meet)]
        for k, stop in enumerate(stops):
            counts[right, k] = np.diff(stop, prepend=0)
        counts[right, 3] = 1
        text_stops = np.cumsum(self.written.lengths[text_ids])[stops[0] + stops[1] - 1].tolist() if len(data) else []
        texts = iter([written[i : j - 1] for i, j in zip([0, *text_stops], text_stops, strict=False)])
        base = len(self.texts)
        self.slots.update((run, base + i) for i, run in enumerate(runs))
        self.texts += [next(texts) if r else b"" for r in right.tolist()]
        self.held += len(written)
        self.sizes = np.concatenate([self.sizes, counts])
        self.links = np.concatenate([self.links, self.pair_numbers(a[last_a], b[last_b])])
        self.starts = np.cumsum(self.sizes[:, 2]) - self.sizes[:, 2]

    def align_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Sizes of each text (tokens of A and B, groups), the pair numbers of all in a row, and the groups written out."""
        if len(self.slots) > STORE_RUNS or self.held > STORE_BYTES:
            self._forget()
        runs = [(t.split(" ") if self.apart else [t]) if t else [] for t in texts]
        new = set(chain.from_iterable(runs)).difference(self.slots)
        if self.apart and (odd := {r for r in new if not r or r[0].isspace() or r[-1].isspace()}):
            # Some spaces stand beside other white space: only single ones are cut at.
            runs = [own if odd.isdisjoint(own) else _CUT.split(t) for own, t in zip(runs, texts, strict=True)]
            new = set(chain.from_iterable(runs)).difference(self.slots)
        if new:
            self._learn(list(new))
        slots = [[*map(self.slots.__getitem__, own)] for own in runs]
        counts = np.fromiter(map(len, slots), np.int64, len(slots))
        used = np.fromiter(chain.from_iterable(slots), np.int64, int(counts.sum()))
        owner = np.repeat(np.arange(len(texts)), counts)
        wrong = np.zeros(len(texts), bool)
        wrong[owner[self.sizes[used, 3] == 0]] = True
        sizes = np.stack([np.bincount(owner, self.sizes[used, k], len(texts)) for k in range(3)], axis=1).astype(np.int64)
        sizes[wrong] = 0
        used = used[~wrong[owner]]
        written = [b"" if bad else b";".join([*map(self.texts.__getitem__, own)]) for own, bad in zip(slots, wrong.tolist(), strict=True)]
        return sizes, spans(self.links, self.starts, self.sizes[:, 2], used), written


def last_ids(groups: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of both streams that end each group."""
    return np.array([x[-1] for x, _ in groups], np.int64), np.array([y[-1] for _, y in groups], np.int64)


def write_groups(groups: list[tuple[list[int], list[int]]]) -> bytes:
    """Groups as ``a1,a2|b1;a3|b2``."""
    return ";".join([f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups]).encode()


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Aligner:
    """The aligner of two tokenizer files, once per worker."""
    return Aligner(a_path, b_path)


def _list(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _whole(documents: DataFrame, a_path: str, b_path: str, with_groups: bool) -> DataFrame:
    """Documents of one fragment each, with sizes, pair numbers and the hash of their groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(a_path, b_path)
        for batch in bytetext.chunks(batches):
            sizes, links, written = aligner.align_batch(bytetext.text_array(batch).to_pylist())
            digest = [hashlib.sha256(w).hexdigest() if w else "" for w in written]
            arrays = [batch.column(0), *map(pa.array, sizes.T), _list(links, sizes[:, 2]), pa.array(digest, pa.string())]
            arrays.append(pa.array([w.decode() for w in written] if with_groups else [None] * len(written), pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_a", "n_b", "n_groups", "links", "groups_sha256", "groups"])

    return documents.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, links array<int>, groups_sha256 string, groups string")


def _windows(documents: DataFrame, apart: bool, size: int) -> DataFrame:
    """Very long texts cut at single spaces into windows that begin in different byte ranges; ``lo`` is the byte before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["document", "doc_id", "lo", "text"]
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key, begin, lo = uuid.uuid4().hex, 0, 0
                while begin < len(text):
                    cut = _CUT.search(text, begin + size) if apart else None
                    part = text[begin : cut.start()] if cut else text[begin:]
                    arrays = [pa.array([key]), pa.array([doc], pa.int64()), pa.array([lo], pa.int64()), pa.array([part])]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    lo += len(part.encode()) + 1
                    begin = cut.end() if cut else len(text)

    return documents.mapInArrow(run, "document string, doc_id long, lo long, text string")


_FRAGMENT = "document string, slot long, lo long, first long, pre_a array<int>, pre_b array<int>, suf_a array<int>, suf_b array<int>"
_CLOSED = "at long, kind int, n_a long, n_b long, n_groups long, links array<int>, groups string"
_LISTS = ("pre_a", "pre_b", "suf_a", "suf_b")


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _arrow_schema(*extra: tuple[str, pa.DataType]) -> pa.Schema:
    lists = pa.list_(pa.int32())
    longs = [(n, pa.int64()) for n in ("slot", "lo", "first")]
    closed = [("at", pa.int64()), ("kind", pa.int32()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups")), ("links", lists), ("groups", pa.string())]
    return pa.schema([("document", pa.string()), *longs, *((n, lists) for n in _LISTS), *closed, *extra])


def _window_fragments(windows: DataFrame, a_path: str, b_path: str, size: int) -> DataFrame:
    """One row for each byte range that a window's tokens end in: its fragment and the groups closed inside."""
    schema = _arrow_schema(("right", pa.bool_()))

    def cut(aligner: Aligner, document: str, lo: int, text: str) -> list[dict]:
        pair = aligner.tokens(text)
        if pair is None:
            return [{"document": document, "slot": lo // size, "lo": lo, "first": -1, "right": False}]
        a, b = pair
        a_ends, b_ends = lo + np.cumsum(aligner.a_table.lengths[a]), lo + np.cumsum(aligner.b_table.lengths[b])
        out = []
        for slot in range(lo // size, (int(a_ends[-1]) - 1) // size + 1):
            inside = [slice(*np.searchsorted(e, [slot * size, (slot + 1) * size], side="right")) for e in (a_ends, b_ends)]
            own = fragment(a[inside[0]], a_ends[inside[0]], b[inside[1]], b_ends[inside[1]])
            row = {"document": document, "slot": slot, "lo": max(lo, slot * size), "first": own.first, "right": True}
            row |= dict(zip(_LISTS, (*own.prefix, *own.suffix), strict=True))
            row |= {"at": own.first, "kind": 1, "n_a": inside[0].stop - inside[0].start, "n_b": inside[1].stop - inside[1].start}
            row |= {"n_groups": len(own.closed), "links": aligner.pair_numbers(*last_ids(own.closed)).tolist(), "groups": write_groups(own.closed).decode()}
            out.append(row)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(a_path, b_path)
        for batch in batches:
            for document, lo, text in zip(*(batch.column(n).to_pylist() for n in ("document", "lo", "text")), strict=True):
                yield from _rows(schema, cut(aligner, document, lo, text)).to_batches()

    spread = windows.repartition("document", "lo")
    return spread.mapInArrow(run, f"{_FRAGMENT}, {_CLOSED}, right boolean")


def _compose_level(fragments: DataFrame, a_path: str, b_path: str, fan_in: int, last: bool) -> DataFrame:
    """Compose the fragments of ``fan_in`` neighbouring slots: a row for the result, and one for each group that closes."""
    schema = _arrow_schema()

    def closes(aligner: Aligner, document: str, at: int, group: tuple[list[int], list[int]]) -> dict:
        links = aligner.pair_numbers(*last_ids([group])).tolist()
        return {"document": document, "at": at, "kind": 0, "n_a": 0, "n_b": 0, "n_groups": 1, "links": links, "groups": write_groups([group]).decode()}

    def reduce(table: pa.Table) -> pa.Table:
        aligner = load(a_path, b_path)
        rows = sorted(table.to_pylist(), key=lambda r: (r["slot"], r["lo"]))
        document, out, total = rows[0]["document"], [], Fragment()
        for row in rows:
            one = Fragment((row["pre_a"], row["pre_b"]), [], (row["suf_a"], row["suf_b"]), row["first"])
            if total.first >= 0 and one.first >= 0:
                out.append(closes(aligner, document, one.first, joint(total, one)))
            total = compose(total, one)
            total.closed = []
        if last and total.first >= 0:  # the document begins and ends at a meeting point
            out.append(closes(aligner, document, total.first, total.prefix))
        whole = {"document": document, "slot": rows[0]["slot"] // fan_in, "lo": rows[0]["lo"], "first": total.first}
        return _rows(schema, [*out, whole | dict(zip(_LISTS, (*total.prefix, *total.suffix), strict=True))])

    keyed = fragments.withColumn("parent", F.floor(F.col("slot") / fan_in))
    return keyed.groupBy("document", "parent").applyInArrow(reduce, f"{_FRAGMENT}, {_CLOSED}")


def _long(documents: DataFrame, a_path: str, b_path: str, size: int, fan_in: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows of closed groups of very long documents, and the documents with their hashes; None if there are none."""
    apart = load(a_path, b_path).apart
    windows = stage(_windows(documents, apart, size), "windows")
    found = stage(_window_fragments(windows, a_path, b_path, size), "fragments")
    most = found.agg(F.max("slot")).first()[0]
    if most is None:
        return None
    wrong = found.where("not right").select("document").distinct()
    found = found.join(wrong, "document", "left_anti")
    closed = [found.drop("right")]
    level = found
    while True:
        level = stage(_compose_level(level.select("document", "slot", "lo", "first", *_LISTS), a_path, b_path, fan_in, most < fan_in), "composed")
        closed.append(level.where("at is not null"))
        level, most = level.where("at is null"), most // fan_in
        if not most:
            break
    parts = closed[0]
    for more in closed[1:]:
        parts = parts.unionByName(more)
    parts = stage(parts.select("document", *(c.split()[0] for c in _CLOSED.split(", "))), "parts")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, some = None, hashlib.sha256(), False
        for batch in batches:
            for document, groups in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if document != held:
                    if held is not None:
                        yield pa.RecordBatch.from_pydict({"document": [held], "groups_sha256": [state.hexdigest()]})
                    held, state, some = document, hashlib.sha256(), False
                if groups:
                    state.update((b";" if some else b"") + groups.encode())
                    some = True
        if held is not None:
            yield pa.RecordBatch.from_pydict({"document": [held], "groups_sha256": [state.hexdigest()]})

    in_order = parts.repartition("document").sortWithinPartitions("document", "at", "kind").select("document", "groups")
    hashes = in_order.mapInArrow(digest, "document string, groups_sha256 string")
    names = windows.groupBy("document").agg(F.first("doc_id").alias("doc_id"))
    return parts, stage(names.join(hashes, "document", "left"), "hashes")


def pair_counts(links: list[DataFrame], a_path: str, b_path: str) -> np.ndarray:
    """Links of the whole corpus for each pair number.

    Tasks count their own rows first; what reaches the driver is at most one
    row for each pair the vocabularies allow.
    """
    size = len(load(a_path, b_path).pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["pair", "n"])

    parts = [x.select("links").mapInArrow(run, "pair long, n long") for x in links]
    both = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    table = both.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[table["pair"].to_numpy()] = table["n"].to_numpy()
    return out


def _scored(parts: DataFrame, key: str, kind: str, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """Rows with the number of best links and the sum of counts instead of the pair numbers."""
    known = parts.sparkSession.sparkContext.broadcast((counts, best))  # at most one entry a vocabulary pair
    frame = parts.select(key, "n_a", "n_b", "n_groups", "groups_sha256" if key == "doc_id" else F.lit("").alias("groups_sha256"), "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = known.value
        for batch in batches:
            links = batch.column(5)
            bounds = np.concatenate([[0], np.cumsum(links.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            flat = links.flatten().to_numpy(zero_copy_only=False)
            sums = [np.concatenate([[0], np.cumsum(x[flat])])[bounds] for x in (best.astype(np.int64), counts)]
            arrays = [*(batch.column(i) for i in range(5)), pa.array(np.diff(bounds)), *(pa.array(np.diff(s)) for s in sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"])

    return frame.mapInArrow(run, f"{key} {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _split(documents: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    return frame.where(~long), frame.where(long)


def align(documents: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, document (null for documents of one fragment), at, kind and groups: the groups of every document in rows.

    Ordered by (document, at, kind) the rows of a document hold its groups in order.
    """
    short, long = _split(documents, range_bytes)
    spots = (F.lit(None).cast("string").alias("document"), F.lit(0).cast("long").alias("at"), F.lit(1).alias("kind"))
    out = _whole(short, a_path, b_path, True).select("doc_id", *spots, "groups")
    found = _long(long, a_path, b_path, range_bytes, fan_in)
    if found is None:
        return out
    return out.unionByName(found[0].where("n_groups > 0").join(found[1].select("document", "doc_id"), "document").select("doc_id", "document", "at", "kind", "groups"))


def digests(documents: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """Sizes, links, best links, sum of corpus-wide counts and the hash of the groups, one row per document."""
    short, long = _split(documents, range_bytes)
    short = stage(_whole(short, a_path, b_path, False).drop("groups"), "aligned")
    found = _long(long, a_path, b_path, range_bytes, fan_in)
    counts = pair_counts([short, found[0]] if found else [short], a_path, b_path)
    aligner = load(a_path, b_path)
    second = aligner.pairs % aligner.width
    highest = np.zeros(aligner.width, np.int64)
    np.maximum.at(highest, second, counts)
    best = counts == highest[second]
    out = _scored(short, "doc_id", "long", counts, best).select("doc_id", *_SUMS, "groups_sha256")
    if found is None:
        return out
    sums = _scored(found[0], "document", "string", counts, best).groupBy("document").agg(*(F.sum(c).alias(c) for c in _SUMS))
    rest = found[1].join(sums, "document", "left")
    return out.unionByName(rest.select("doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _SUMS), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")))
