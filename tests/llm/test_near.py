import random
import re

import numpy as np
import pytest

from tallyweave.llm import circulant
from tallyweave.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute_force(rows, percent=85):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, []).append(shingle_set(text))
    nodes = [(d, s) for d, all_sets in sets.items() for s in all_sets if d is not None]
    group = {d: d for d, _ in nodes}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (a, s) in enumerate(nodes):
        for b, t in nodes[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return sorted((d, len(shingle_set(t)), root(d) if d is not None else None, d is None or root(d) == d) for d, t in rows if d is not None)


def corpus(seed, bases, copies):
    rng, out = random.Random(seed), []
    for _ in range(bases):
        base = [rng.choice(WORDS) for _ in range(rng.randint(3, 160))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, copies)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            out.append(rng.choice([" ", "\n", "\t "]).join(copy).replace("w1", "W1"))
    rng.shuffle(out)
    return list(enumerate(out, 10))


@pytest.mark.parametrize("block", [200_000, 300])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(circulant, "BLOCK_SHINGLES", block)
    rows = [*corpus(1, 40, 8), (1, None), (2, ""), (3, " \n"), (4, "too short"), (5, "Too  SHORT"), (6, "w1 w2 w3 w4 w5 " * 3000), (7, "w1 w2 w3 w4 w5 " * 3000)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int")
    got = sorted(tuple(r) for r in circulant.near_groups(frame).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == brute_force(rows)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (1, "other words stand in this line"), (3, "other words stand in this line"), (None, "a b c d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = circulant.near_groups(frame).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 1, False), (None, None, True)}
    assert len(got) == len(rows)
    kept = circulant.drop_near(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert circulant.near_groups(frame).count() == 0
    assert circulant.drop_near(frame).count() == 0


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = values[:2000], values[1000:]
    same = circulant.signature(a, 96) == circulant.signature(b, 96)
    assert abs(same.mean() - 1 / 3) < 0.2
    assert (circulant.signature(a, 96) == circulant.signature(a[::-1], 96)).all()


def test_verified_links_of_blocks():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 100)
    sets = [np.unique(np.concatenate([base[: 100 - k], rng.integers(0, 1 << 60, k)])) for k in range(0, 30, 3)]
    sides = np.arange(len(sets)) % 2
    for given in (None, sides):
        group = list(range(len(sets)))
        for i, j in circulant.linked_pairs(sets, given, 85):
            assert 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
        for i in range(len(sets)):
            for j in range(i):
                near = 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
                if near and (given is None or sides[i] != sides[j]):
                    assert group[i] == group[j]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7), (None, 3), (101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
