import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyweave.llm import quality, toxicity
from tallyweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def ranks_right(scores, labels):
    """Share of (positive, negative) pairs in the right order."""
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.fixture(scope="module")
def letters(spark):
    return toxicity.letter_model(spark.createDataFrame([("you are an idiot and a stupid moron, what a loser. " * 50 + "the people of this land are loud",)], "text string"))


def test_restores_disguised_words(letters):
    cases = ["you 1d10t", "i d i o t here", "stuuuupid m0r0n", "l.o.s.e.r", "what a l0$er", "plain words stay, 1999 too", "", "50% off", "a b", "x" * 300]
    got = toxicity.restore(cases, letters)
    assert got[:6] == ["you idiot", "idiot here", "stupid moron", "loser", "what a loser", "plain words stay, 1999 too"]
    assert got[6:9] == ["", "50% off", "a b"]


def test_viterbi_equals_all_paths(letters):
    from itertools import product

    for span in ("1d1ot", "st00pid", "aaab", "l.o$", "m0r0n"):
        options = toxicity._options(span)

        def cost(path):
            total, before = 0.0, 0
            for x, c, _ in path:
                total += c
                if x >= 0:
                    total -= letters[before, x]
                    before = x
            return total - letters[before, 0]

        best = min(cost(p) for p in product(*options))
        found = toxicity.decode([span, "x"], letters)[0]
        assert any("".join(x[2] for x in p) == found and abs(cost(p) - best) < 1e-9 for p in product(*options))


def test_learns_marks_and_ignores_held_out_labels(spark):
    rng = random.Random(2)
    words = ["green", "tree", "house", "river", "stone", "cloud"]
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        text = " ".join(rng.choice(words) for _ in range(30)) + (rng.choice([" vilewort", " v1lewort", " VILEWORT", " v i l e w o r t"]) if toxic else "")
        rows.append((i, text, "en"))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, int(toxic) ^ held))  # wrong where held out
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "vilewort " * 20000, "en"), (1003, "vi1ewort", "en"), (None, "tree", "en"), (1003, "vi1ewort", "en")]
    labels += [(1000, None), (7, 1), (7, 0), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == (i % 5 == 0) for i in range(300))
    assert [by_id[i].predicted for i in (1000, 1001, 1002, 1003, None)] == [0, 0, 1, 1, 0]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect() if r.doc_id is None or r.doc_id < 300} == {None, *(i for i in range(300) if i % 5)}
    one_kind = toxicity.fit(docs, marks.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, one_kind).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), marks)).count() == 0


def test_toxicity_on_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in rows])
    assert ranks_right(np.array([r.score for r in rows]), truth) > 0.9
    assert np.mean([r.predicted == t for r, t in zip(rows, truth, strict=True)]) > 0.93


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(1)
    texts, grades = [], []
    for _ in range(600):
        g = int(rng.integers(0, 4))
        texts.append(" ".join(rng.choice(["good", "bad"], p=[0.1 + 0.25 * g, 0.9 - 0.25 * g], size=40)))
        grades.append(g)
    owner, token, value = quality.vectors(pa.array(texts, pa.large_string()))
    model = quality.fit_rows(owner, token, value, np.array(grades))
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    tails = model.tails(pa.array(["bad " * 40, "good " * 40, "good bad " * 20], pa.large_string()))
    assert (np.diff(tails, axis=1) <= 0).all()
    expected = model.expected(tails)
    assert expected[0] < 0.7 and expected[1] > 2.3 and expected[0] < expected[2] < expected[1]
    assert np.corrcoef(model.expected(model.tails(pa.array(texts, pa.large_string()))), grades)[0, 1] > 0.9
    assert (model.tail(tails, 0) == 1).all() and (model.tail(tails, 9) == 0).all()


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, None), (3, ""), (None, "x " * 50000), (1, "some words here"), (4, "%%% *** !!!")], "doc_id long, text string")
    ratings = spark.createDataFrame([(1, 2), (1, 2), (3, 0), (4, 0), (2, None), (None, 1), (9, 5)], "doc_id long, grade int")
    model = quality.fit(docs, ratings)
    assert model.grades == [0, 2]
    got = quality.score(docs, model, grade=1).collect()
    assert len(got) == 6 and all(0 <= r.tail_probability <= 1 for r in got)
    assert {r.kept for r in got if r.doc_id == 1} == {True} and {r.kept for r in got if r.doc_id == 4} == {False}
    assert sorted(quality.select(docs, model, 1).columns) == ["doc_id", "text"]
    assert quality.fit(docs, ratings.limit(0)).grades == [0]
    assert quality.score(docs.limit(0), model, 1).count() == 0


def test_quality_on_unseen_documents(spark):
    """Fit on the large folder's labels, hold against documents outside the sample's ids."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    graded = quality.graded(labels)
    model = quality.fit(docs, graded.where("doc_id % 4 <> 0"))
    rest = {r.doc_id: r.grade for r in graded.where("doc_id % 4 = 0").collect()}
    rows = [r for r in quality.score(docs.join(graded.where("doc_id % 4 = 0"), "doc_id"), model, 1).collect()]
    truth = np.array([rest[r.doc_id] >= 1 for r in rows]).astype(int)
    assert ranks_right(np.array([r.tail_probability for r in rows]), truth) > 0.97
    assert np.mean([r.kept for r, t in zip(rows, truth, strict=True) if t]) > 0.98


def test_restores_signs_at_ends_and_wide_gaps(letters):
    cases = ["you !diot", "|diot", "idi07", "i - d - i - o - t", "i  d  i  o  t", "i\nd\ni\no\nt", "what a lo$er", "a m0r0n", "los3r", "people will all feel well", "from 1999 to 2020, 50% of a b"]
    assert toxicity.restore(cases, letters) == ["you idiot", "idiot", "idiot", "idiot", "idiot", "idiot", "what a loser", "a moron", "loser", "people will all feel well", "from 1999 to 2020, 50% of a b"]
