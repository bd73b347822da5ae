import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyweave.llm import bpe, tokenfiles

BYTES = "/opt/tokenizers/byte_bpe_50k.json"
WORDS = "/opt/tokenizers/word_bpe_49k.json"
BITS = [" ", "  ", "\n", "\n\n", "\t", " ", "a", "The", " the", "'s", "'ll", "123", "é", "É", "ß", "日本", "́", "<|endoftext|>", "!!", "%%%", "\x1c", "\x85", "😀", "aaaa", " ", "I", "'", "\r\n", "\x00", "x.", "y,", "Σ", "İ"]


def texts(count, seed):
    rng = random.Random(seed)
    return ["", " ", "\n", "a" * 3000, " " * 70, *("".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(count))]


def test_bpe_equals_library_and_round_trips():
    coder, library = bpe.ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    some = texts(1500, 5)
    ids, counts = coder.encode_batch(some)
    ends = np.cumsum(counts)
    for text, begin, end, back in zip(some, ends - counts, ends, coder.decode_batch(ids, counts), strict=True):
        assert ids[begin:end].tolist() == library.encode(text, add_special_tokens=False).ids
        assert back == text


def test_bpe_store_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "STORE_LIMIT", 3)
    coder = bpe.ByteBpe(BYTES)
    for _ in range(2):
        ids, counts = coder.encode_batch(["one two three four five", "<|endoftext|>"])
        assert coder.decode_batch(ids, counts) == ["one two three four five", "<|endoftext|>"]


def test_bpe_digests(spark):
    rows = [(1, "Hello world", "x"), (2, None, "x"), (2, "", "x"), (None, "aé" * 9000, "x"), (1, "Hello world", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {(r.doc_id, r.decoded_sha256): r for r in bpe.digests(frame, BYTES).collect()}
    library = Tokenizer.from_file(BYTES)
    for doc, text, _ in rows:
        row = got[doc, hashlib.sha256((text or "").encode()).hexdigest()]
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.digests(frame, BYTES).count() == len(rows)
    assert bpe.digests(frame.limit(0), BYTES).count() == 0
    full = bpe.encode(frame.where("doc_id = 1"), BYTES).first()
    assert full.decoded == "Hello world" and full.n_tokens == len(full.token_ids)


@pytest.mark.parametrize("counts", [[], [0], [1], [3, 4, 0, 5], [1000, 7]])
def test_pack_and_unpack(counts):
    rng, counts = random.Random(len(counts)), np.array(counts, np.int64)
    values = np.array([rng.choice([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]) for _ in range(int(counts.sum()))], np.int64)
    control, data, sizes = tokenfiles.pack(values, counts)
    assert len(control) == sum(-(-c // 4) for c in counts) and sizes.sum() == len(data)
    assert tokenfiles.unpack(control.tobytes(), data.tobytes(), counts).tolist() == values.tolist()
    ends, stops = np.cumsum(counts), np.cumsum(sizes)
    for i, (end, stop) in enumerate(zip(ends, stops, strict=True)):
        alone = tokenfiles.pack(values[end - counts[i] : end], counts[i : i + 1])
        assert alone[1].tobytes() == data[stop - sizes[i] : stop].tobytes()


def test_word_encoder_equals_library(monkeypatch):
    coder = tokenfiles.WordEncoder(WORDS)
    marked = ["word%%%", "(Word),", "it's", "'self", "s's", "a%%a", "--é--", "<|endoftext|>x", "ab<|startoftext|>", "x'll", "...", "%%%", "a1%", "ÀB!?", "\"q\"'s", "e\u0301!", "a\tb%"]
    some = [*texts(1500, 6), *marked, " ".join(marked), ""]
    for limit in (tokenfiles.STORE_LIMIT, 3):
        monkeypatch.setattr(tokenfiles, "STORE_LIMIT", limit)
        ids, counts = coder.encode_batch(some)
        ends = np.cumsum(counts)
        for text, begin, end in zip(some, ends - counts, ends, strict=True):
            assert ids[begin:end].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 50)
    rows = [(i, "word " * (i % 7) + "Über, the end.", 0) for i in range(60, 0, -1)] + [(70, None, 0), (71, "", 0), (5, "again", 0), (None, "no id", 0), (90, "long text " * 5000, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int")
    tokenfiles.encode(frame, WORDS, 2).write.parquet(f"{tmp_path}/encoded")
    tokenfiles.write(spark.read.parquet(f"{tmp_path}/encoded"), f"{tmp_path}/files", tokenfiles.id_type(WORDS, 2), partitions=3)
    got = sorted(tokenfiles.read(spark, f"{tmp_path}/files").collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(WORDS)
    key = lambda r: (r[0] is not None, r[0] or 0, np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    start = 0
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = {(r.doc_id, tuple(r.ids)) for r in got}
    assert at == {(r[0], (*library.encode(r[1] or "", add_special_tokens=False).ids, 2)) for r in rows}
    for row, (doc, text, _) in zip(got, sorted(rows, key=key), strict=True):
        if doc == 5:  # two rows of one id stand in the order of their bytes
            start += row.n_tokens
            continue
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.doc_id, row.start, row.n_tokens, list(row.ids)) == (doc, start, len(ids), ids)
        start += len(ids)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in tokenfiles.read(spark, f"{tmp_path}/files", digest=True).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    assert tokenfiles.round_trip(frame.limit(0), WORDS, 2).count() == 0
