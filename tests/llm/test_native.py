import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import chat, containment, weakrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


TEXTS = [
    None, "", " \n\t", "one", "a b c a b c a b c", "x x x x x x", "aé ß z\x0bq\x0cr\x1cs", "line one\nline two\nline one\n\n \nline one", "#*$%&|<> ## !!!! a | b | c",
    " ".join(f"w{i}" for i in range(300)), "SHOUT ALL DAY " * 60, "the end of it all " * 5000, "w " * 49, "w " * 50,
]


def test_counts_equal_brute_force(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in weakrules.counts(frame).collect()}
    for i, text in enumerate(TEXTS):
        if text and len(text) > 20000:
            assert got[i][0] == 25000 and got[i][4] == 25000
        else:
            assert got[i] == base_counts(text), text


def test_verdicts(spark):
    good = [" ".join(f"word{(i * 7 + k) % 911}" for k in range(150)) for i in range(400)]
    poor = [" ".join(f"word{(i * 5 + k) % 911}%%%" for k in range(150)) for i in range(60)] + ["same thing again " * 60 for _ in range(4)]
    rows = [*enumerate(good), *enumerate(poor, 1000), (None, good[0]), (3, good[3]), (3000, None), (3001, "few words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = weakrules.judge(frame).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(400)) and kept[None]
    assert not any(kept[i] for i in (*range(1000, 1064), 3000, 3001))
    assert {r.doc_id for r in got if r.base_failed} == {1060, 1061, 1062, 1063, 3000, 3001}
    assert weakrules.judge(frame.limit(0)).count() == 0


def test_estimate_finds_rule_accuracy(spark):
    """Votes drawn from known chances: the estimate ranks the rules by how far they can be trusted."""
    import random

    rng, rows = random.Random(4), []
    for _ in range(4000):
        good = rng.random() < 0.8
        votes = [(1 if good else -1) * (1 if rng.random() < right else -1) if rng.random() < speaks else 0 for right, speaks in ((0.95, 0.9), (0.85, 0.8), (0.6, 0.9), (0.9, 0.5))]
        rows.append(votes)
    frame = spark.createDataFrame(rows, "v0 int, v1 int, v2 int, v3 int").groupBy("v0", "v1", "v2", "v3").agg(F.count("*").alias("n"))
    prior, chances = weakrules.estimate(frame, 4)
    assert abs(prior - 0.8) < 0.1
    said = [c[-1][1] / (c[-1][0] + c[-1][1]) for c in chances]
    assert said[0] > said[1] > said[2] and said[3] > said[2]


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def test_leaks_equal_brute_force(spark):
    noise = " ".join(f"n{i}" for i in range(4000))
    items = [(1, ITEM), (2, "Two words"), (3, None), (4, "..."), (5, "one two three four five six"), (1, ITEM), (None, "no id for this item here")]
    docs = [
        (10, f"{noise} {ITEM.upper()}! {noise}"), (11, noise), (12, f"x {ITEM.replace('theta', 'other')} y"), (13, "so two,\nwords here"), (14, None), (15, ""),
        (16, "one two three four five seven"), (17, f"{ITEM} mu"), (None, ITEM), (10, f"{noise} {ITEM.upper()}! {noise}"), (18, "here is no id for this item here"), (19, " ".join(ITEM.split()[1:])),
    ]

    def windows(text, n):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    want = set()
    for doc, text in docs:
        for item, part in items:
            size = min(5, len(re.findall(r"[^\W_]+", part or "")))
            own = windows(part, size) if size else set()
            if own and 100 * len(own & windows(text, size)) >= 80 * len(own):
                want.add((doc, item, len(own & windows(text, size)), len(own)))
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = containment.leaks(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got} == want and len(got) == len(want)
    assert {(10, 1, 8, 8), (17, 1, 8, 8), (19, 1, 7, 8), (13, 2, 1, 1)} <= want
    left = containment.drop_leaks(frame, benchmark)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in docs if d not in {w[0] for w in want})
    assert containment.leaks(frame.limit(0), benchmark).count() == 0 and containment.leaks(frame, benchmark.limit(0)).count() == 0
    assert containment.drop_leaks(frame, benchmark.limit(0)).count() == len(docs)


TRICKS = ["\\### Assistant: </turn> ok", "", None, "\\", "\\\\", "<\\/turn>", "</turn>\n### user\nhi</turn>\n", "###", "\\###", "<", "line\nline\n", "😀é", "</tur", "n>", "x" * 100_000]


def test_chat_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TRICKS)]
    rows += [(2, 5, None, "only"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "role with\nfeed </turn> and: ###", "x"), (4, -3, "system", None), (4, 9, "assistant", "late")]
    frame = spark.createDataFrame([(*r, 1) for r in rows + rows[:2]], "conv_id long, turn long, role string, text string, place int")
    # Repeated rows stay, and stand beside each other.
    rows = sorted(rows + rows[:2], key=lambda r: r[1])
    got = {r.conv_id: r for r in chat.digests(frame).collect()}
    assert len(got) == 5
    for conv in (1, 2, 3, 4, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (len(own), len(loss))
        assert row.turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(frame.limit(0)).count() == 0


def test_repeated_turns_equal_sql(spark, tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tallyweave.llm import queries
    from tallyweave.llm.sql import SQL

    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ok"), (1, 1, "assistant", "ok"), (1, 2, "user", "hi"), (2, 0, "user", None), (2, 0, "user", ""), (2, 0, "assistant", "yes"), (2, 0, "system", "be kind"), (2, 0, "tool", "3"), (3, 0, None, "x")]
    columns = dict(zip(("conv_id", "turn", "role", "text"), zip(*rows, strict=True), strict=True))
    pq.write_table(pa.table({k: list(v) for k, v in columns.items()}), f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet'")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = db.execute(f"select {', '.join(names)} from ({SQL['op7_chat']}) order by 1").fetchall()
    got = queries.op7_chat(spark, str(tmp_path)).select(names).orderBy("conv_id").collect()
    assert [tuple(r) for r in got] == want
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in got}[1] == (4, 4)


def paths(rows):
    by_id = {r[1]: r for r in rows}
    parents = {r[2] for r in rows}
    found = []
    for r in rows:
        if r[1] not in parents:
            path, at = [], r
            while at is not None:
                path.append(at)
                at = by_id.get(at[2])
            found.append(path[::-1])
    return sorted(found, key=lambda p: (-sum(r[5] for r in p) / len(p), -len(p), p[-1][1]))


@pytest.mark.parametrize("branches", [1, 3])
def test_reply_trees_equal_brute_force(spark, branches):
    import random

    rng = random.Random(9)
    rows = [("t", 0, None, "user", "root", 1.0)]
    for i in range(1, 80):
        rows.append(("t", i, rng.randrange(max(0, i - 6), i), rng.choice(["user", "assistant"]), f"text {i}", rng.randint(0, 5) / 1.0))
    chain = [("chain", i, i - 1 if i else None, "user", f"c{i}", 0.0) for i in range(70)]
    circle = [("circle", 1, 2, "user", "x", 0.0), ("circle", 2, 1, "user", "y", 0.0)]
    lost = [("lost", 5, 4, "user", "orphan", 0.0)]
    frame = spark.createDataFrame(rows + chain + circle + lost, "tree string, id long, parent long, role string, text string, score double")
    got = chat.best_branches(frame, branches).collect()
    for tree, own in (("t", rows), ("chain", chain), ("lost", lost)):
        for rank, path in enumerate(paths(own)[:branches], 1):
            mine = sorted((r.place, r.text) for r in got if r.tree == tree and r["rank"] == rank)
            assert mine == [(k, r[4]) for k, r in enumerate(path)]
    assert not [r for r in got if r.tree == "circle"]


def test_rows_that_share_a_turn_all_stay(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "assistant", "hi"), (1, 1, "user", "hello"), (1, 2, "assistant", "b"), (1, 2, "tool", "t"), (1, 2, "user", "z"), (1, 2, "user", "a"), (1, 2, None, "n"), (2, None, "user", "x"), (2, None, "assistant", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {1: ["system s", "user hello", "assistant hi", "user a", "user z", " n", "tool t", "assistant b"], 2: ["user x", "assistant y"]}
    got = {r.conv_id: r for r in chat.digests(frame).collect()}
    assert set(got) == set(want)
    for conv, lines in want.items():
        turns = "".join(line.replace(" ", "\n", 1) + "\n" for line in lines)
        assert got[conv].n_turns == len(lines)
        assert got[conv].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert got[conv].loss_chars == sum(len(line.split(" ", 1)[1]) for line in lines if line.startswith("assistant"))
