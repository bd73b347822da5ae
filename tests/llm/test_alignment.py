import hashlib
import random
from collections import Counter

import pytest

from tallyweave.llm import alignment

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
BITS = [" ", "  ", "\n", "\n\n", "\t", " ", "a", "The", " the", "'s", "'ll", "123", "é", "日本", "́", "<|endoftext|>", "!!", "%%%", "\x1c", "\x85", "😀", "aaaa", "　", "'", "\r\n", "\x00", "x.", "y,", "<s>", "<0x41>", " word", " other words", "ﬁ"]


def texts(count, seed, most=30):
    rng = random.Random(seed)
    return ["", " ", "\n", " lead", "trail ", "a▁b", "a" * 300, " " * 70, *("".join(rng.choice(BITS) for _ in range(rng.randint(0, most))) for _ in range(count))]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B), alignment.load(A, B)


def brute_force(libraries, text):
    """Token counts, groups and links of one text, by the libraries' own encoding of the whole text."""
    first, second, aligner = libraries
    if not text:
        return (0, 0, []), []
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    spelled = [b"".join(table[i] for i in ids) for table, ids in ((aligner.a_bytes, a), (aligner.b_bytes, b))]
    if spelled != [(" " + text).encode()] * 2:
        return (0, 0, []), []
    ends = []
    for table, ids in ((aligner.a_bytes, a), (aligner.b_bytes, b)):
        at, own = 0, []
        for i in ids:
            at += len(table[i])
            own.append(at)
        ends.append(own)
    groups, i, j = [], 0, 0
    for meet in sorted({*ends[0]} & {*ends[1]}):
        x, y = ends[0].index(meet) + 1, ends[1].index(meet) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return (len(a), len(b), groups), [(x[-1], y[-1]) for x, y in groups]


def test_batches_equal_the_libraries(libraries, monkeypatch):
    aligner = libraries[2]
    for limit in (alignment.STORE_RUNS, 3):
        monkeypatch.setattr(alignment, "STORE_RUNS", limit)
        some = texts(800, 3)
        for begin in range(0, len(some), 90):
            part = some[begin : begin + 90]
            sizes, links, written = aligner.align_batch(part)
            stop = sizes[:, 2].cumsum()
            for k, text in enumerate(part):
                (n_a, n_b, groups), pairs = brute_force(libraries, text)
                assert sizes[k].tolist() == [n_a, n_b, len(groups)]
                assert written[k] == alignment.write_groups(groups)
                assert [divmod(int(aligner.pairs[p]), aligner.width) for p in links[stop[k] - sizes[k, 2] : stop[k]]] == pairs


def test_fragments_compose_to_the_whole_in_any_order(libraries):
    import numpy as np

    aligner, rng = libraries[2], random.Random(4)
    for text in texts(60, 9, 60):
        pair = aligner.tokens(text) if text else None
        if pair is None:
            continue
        ends = [np.cumsum(t.lengths[p]) for t, p in zip((aligner.a_table, aligner.b_table), pair, strict=True)]
        whole = alignment.fragment(pair[0], ends[0], pair[1], ends[1])
        size = len((" " + text).encode())
        cuts = [0, *sorted(rng.randint(0, size) for _ in range(rng.randint(0, 9))), size]
        parts = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            own = [slice(*np.searchsorted(e, [lo, hi], side="right")) for e in ends]
            parts.append(alignment.fragment(pair[0][own[0]], ends[0][own[0]], pair[1][own[1]], ends[1][own[1]]))
        parts.insert(rng.randint(0, len(parts)), alignment.Fragment())
        while len(parts) > 1:
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [alignment.compose(parts[at], parts[at + 1])]
        assert parts[0] == whole


@pytest.mark.parametrize(("size", "fan_in"), [(1 << 16, 32), (20, 2)])
def test_digests_equal_brute_force(spark, libraries, size, fan_in):
    some = [*texts(150, 7), None, "x" * 500, "日本" * 90, "the same words " * 12, "the same words " * 12]
    rows = [(i % 150 if i % 19 else None, t, "x") for i, t in enumerate(some)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    got = alignment.digests(frame, A, B, size, fan_in)
    assert got.columns[0] == "doc_id" and {"n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"} <= {*got.columns}
    found = [brute_force(libraries, t) for t in some]
    counts = Counter(p for _, links in found for p in links)
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    want = []
    for (doc, _, _), ((n_a, n_b, groups), links) in zip(rows, found, strict=True):
        digest = hashlib.sha256(alignment.write_groups(groups)).hexdigest() if groups else ""
        want.append((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), digest))
    key = lambda r: (r[0] is None, r[0] or 0, r[-1], r[1:])
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.select(columns).collect()], key=key) == sorted(want, key=key)


def test_groups_of_long_documents_in_rows(spark, libraries):
    text = "A long text, of many words. " * 20
    rows = alignment.align(spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string"), A, B, 30, 3).collect()
    own = sorted((r for r in rows if r.doc_id == 1), key=lambda r: (r.at, r.kind))
    assert len(own) > 10
    assert ";".join(r.groups for r in own).encode() == alignment.write_groups(brute_force(libraries, text)[0][2])
    assert {r.doc_id for r in rows} == {1, 2, 3}


def test_empty_table(spark):
    assert alignment.digests(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    assert alignment.digests(spark.createDataFrame([(1, None)], "doc_id int, text string"), A, B).first().groups_sha256 == ""
