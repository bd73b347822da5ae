import random

import numpy as np
import pytest

from tallyweave.llm import angular, itq

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"
ODD = [
    (9001, None, 1, "x"),
    (9002, [0.0] * 16, 1, "x"),
    (9003, [1.0, None] + [0.5] * 14, 1, "x"),
    (9004, [float("nan")] * 16, 1, "x"),
    (9005, [float("inf")] + [1.0] * 15, 1, "x"),
    (9006, [1.0] * 16, None, "x"),
    (9007, [1.0] * 16, 1, "x"),
    (9007, [1.0] * 16, 1, "x"),
    (9008, [1.0] * 15, 1, "x"),
    (9010, [], 1, "x"),
]


def vectors(count, seed, size=16, labels=3, copies=80):
    """Random vectors with a dense group of near copies, a chain and some exact copies."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, size))
    centre = rng.standard_normal(size)
    x[:copies] = centre + 0.06 * rng.standard_normal((copies, size))
    for i in range(copies, copies + 12):
        x[i] = x[i - 1] + 0.17 * rng.standard_normal(size)
    x[copies + 12 : copies + 20] = x[copies + 20]
    x[copies + 20 : copies + 24] = 3 * x[copies + 20]
    label = np.where(np.arange(count) < copies + 30, 1, rng.integers(0, labels, count))
    return [(i, x[i].astype(np.float32).tolist(), int(label[i]), "x") for i in rng.permutation(count).tolist()]


def near_by_force(rows, cosine=0.98):
    """Link counts, components and the linked pairs of rows."""
    fit = [i for i, (d, e, label, _) in enumerate(rows) if d is not None and label is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for n, i in enumerate(fit):
        for j in fit[:n]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i in fit:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least.get(find(i), rows[i][0])) for i in range(len(rows))]


@pytest.mark.parametrize(("block", "core_least"), [(itq.BLOCK, itq.CORE_LEAST), (16, 4), (16, 10**9)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block, core_least):
    monkeypatch.setattr(itq, "BLOCK", block)
    monkeypatch.setattr(itq, "CORE_LEAST", core_least)
    rows = [*vectors(500, 5), *ODD]
    want = near_by_force(rows)
    got = itq.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)
    found, all_ = sum(r.n_links for r in got), sum(w[1] for w in want)
    assert 0.97 * all_ <= found <= all_ and all_ > 6000
    by_id = {}
    for doc, links, component in want:
        by_id.setdefault(doc, (links, component))
    assert all(r.n_links <= by_id[r.vec_id][0] for r in got)
    assert sum(r.component_id == by_id[r.vec_id][1] for r in got) >= 0.99 * len(rows)


def test_forest_joins_what_the_matrix_joins():
    rng = np.random.default_rng(2)
    for size in (1, 2, 9, 30):
        hit = rng.random((size, size)) < 1.2 / size
        hit |= hit.T
        np.fill_diagonal(hit, False)
        links = itq.forest(hit)
        reach = np.linalg.matrix_power(hit.astype(float) + np.eye(size), size) > 0
        tree = np.eye(size)
        for a, b in links:
            assert hit[a, b]
            tree[a, b] = tree[b, a] = 1
        assert len(links) == size - len({tuple(r) for r in reach.tolist()})
        assert ((np.linalg.matrix_power(tree, size) > 0) == reach).all()


def test_rotation_balances_codes():
    x = np.random.default_rng(3).standard_normal((4000, 12)) * np.linspace(3, 0.2, 12)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    directions, least = itq._planes(x, 40)
    assert directions.shape == (12, 40)
    assert np.abs((x @ directions >= least).mean(axis=0) - 0.5).max() < 0.01
    assert np.allclose(directions[:, :12].T @ directions[:, :12], np.eye(12))


def test_empty_vectors(spark):
    assert itq.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert angular.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = itq.near_vectors(spark.createDataFrame(ODD[:6], SCHEMA)).collect()
    assert len(odd) == 6 and all(r.kept and r.n_links == 0 for r in odd)


def negatives_by_force(rows, every):
    part = {}
    for doc, e, label, _ in rows:
        if doc is None or label is None or not e or None in e or not np.isfinite(e).all():
            continue
        q = tuple(int(v) for v in np.floor(256 * np.array(e, float)))
        part[doc, (label + 1) % 10 if doc % 7 == 0 else label, q] = None
    out = set()
    for anchor, label, q in part:
        if anchor % every:
            continue
        others = [(-sum(x * y for x, y in zip(q, p, strict=True)), d, own) for d, own, p in part if d != anchor and len(p) == len(q)]
        for score, positive, _ in sorted(o for o in others if o[2] == label)[:5]:
            fit = sorted(o for o in others if o[2] != label and 80 * -score <= 100 * -o[0] <= 100 * -score)[:5]
            out |= {(anchor, positive, rank, o[1], -score, -o[0]) for rank, o in enumerate(fit, 1)}
    return out


@pytest.mark.parametrize("block", [angular.BLOCK, 40])
def test_hard_negatives_equal_brute_force(spark, block):
    rng = random.Random(6)
    base = vectors(600, 8)
    rows = [(d, e, rng.choice([1, 2, 3]) if d < 100 else label, n) for d, e, label, n in base]
    rows += [(5000 + i, [0.25] * 16, i % 4, "x") for i in range(30)] + [(6000 + i, [0.0] * 16, 2, "x") for i in range(12)] + ODD
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = angular.hard_negatives(frame, every=20, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == negatives_by_force(rows, 20)


def test_bounds_hold_for_every_pair(spark):
    rows = angular.quantised(spark.createDataFrame([*vectors(300, 9), *ODD], SCHEMA))
    located = angular._located(rows, angular.references(rows)).cache()
    layout = angular.Layout(located, 30)
    placed = angular._in_blocks(located, layout).collect()
    for a in placed[:40]:
        for low, high in ((-1e9, 1e9), (2e4, 6e4), (0, 5e3)):
            reach = set(layout.reachable(a["size"], np.array(a["angles"]), a["norm"], low, high).tolist())
            for b in placed:
                if a["size"] == b["size"] and low <= sum(x * y for x, y in zip(a["q"], b["q"], strict=True)) <= high:
                    assert b["block"] in reach
