"""Quality rules as weak supervision: rules vote or abstain, and an estimated model weighs the votes.

Every rule votes 1 (good), -1 (poor) or 0 (abstains) on a document's counts.
Expectation-maximisation finds the share of good documents and how often each
rule gives each vote on good and on poor ones; the posterior probability of
being good then replaces "all rules must pass". Only DataFrame functions: counts
come from array functions within the row, so no document's words are shuffled;
votes are summed by pattern (at most 3^rules rows), and each round is one
aggregation of the pattern table, of which the driver sees the sums.

A null text counts as empty. Words are ``[^\\x20\\x09-\\x0D]+``. Documents with a
failed base condition (few words, or half of them in repeated three-word
windows) are never kept. Repeated rows each count and give repeated results.
With no documents the result is empty. Extra columns are dropped by ``judge``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import stage

ROUNDS = 10
#: Before any data a vote is held right with chance ``BELIEF``; this counts ``TRUST`` times what the votes themselves show.
#: Without it the two classes may settle on any split of the corpus, such as by length, and rules that catch different faults lose to each other.
BELIEF, TRUST = 0.95, 1.0
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r"

#: name: (condition of a good vote, condition of a poor vote) on the counts; else the rule abstains.
RULES = {
    "length": ("n_words >= 100", "n_words < 50"),
    "word_length": ("word_chars >= 3 * n_words and word_chars <= 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    "symbols": ("100 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "dense_symbols": ("false", "2 * n_symbols > n_words"),
    "lines": ("n_dup_lines = 0", "n_dup_lines >= 3"),
    "repeats": ("100 * n_repeat_words <= 5 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "capitals": ("100 * n_shouted <= 5 * n_words", "100 * n_shouted > 20 * n_words"),
    "stutter": ("n_stutter <= 1", "100 * n_stutter > 5 * n_words"),
    "bangs": ("false", "100 * n_bangs > 5 * n_words"),
    "cells": ("false", "100 * n_cells > 5 * n_words"),
}


def _without(text: Column, letters: str) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), letters, text)


def _times(text: Column, part: str) -> Column:
    """How often ``part`` occurs, without overlaps."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def counts(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules look at."""
    text = F.coalesce("text", F.lit(""))
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACES, text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    found = documents.select(
        "doc_id",
        F.array_remove(F.split(spaced, " "), "").alias("words"),
        lines.alias("lines"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        _times(text, "!!").alias("n_bangs"),
        _times(text, " | ").alias("n_cells"),
    )
    # Each array stands in a column of its own and is used twice, so that it is built once.
    words, size = F.col("words"), F.size("words")
    starts = F.when(size >= 3, F.sequence(F.lit(0), size - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    found = found.select(
        "doc_id",
        size.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_bangs",
        "n_cells",
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))).cast("long").alias("n_shouted"),
        F.size(F.filter("words", lambda w, i: w == F.get(words, i - 1))).cast("long").alias("n_stutter"),
        F.sort_array(windows).alias("windows"),
    )
    same = lambda w, i: (w["h"] == F.get("windows", i - 1)["h"]) | (w["h"] == F.get("windows", i + 1)["h"])
    again = F.sort_array(F.transform(F.filter("windows", lambda w, i: F.coalesce(same(w, i), F.lit(False))), lambda w: w["i"]))
    found = found.withColumn("again", again).drop("windows")
    # A repeated window covers its three words, or those up to the next repeated window.
    covered = F.transform("again", lambda at, k: F.least(F.lit(3), F.coalesce(F.get("again", k + 1) - at, F.lit(3))))
    return found.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, b: a + b).cast("long")).drop("again")


def votes(counted: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """One column v0, v1, ... for each rule; a poor vote wins over a good one."""
    cast = [F.when(F.expr(poor), -1).when(F.expr(good), 1).otherwise(0).alias(f"v{i}") for i, (good, poor) in enumerate(rules.values())]
    return counted.select("*", *cast)


def _posterior(prior: float, chances: list[dict[int, tuple[float, float]]]) -> Column:
    """Probability of being good, from the share of good documents and P(vote | good), P(vote | poor) of every rule."""
    total = F.lit(math.log(prior) - math.log(1 - prior))
    for i, chance in enumerate(chances):
        ratio = {v: math.log(g) - math.log(p) for v, (g, p) in chance.items()}
        total = total + F.when(F.col(f"v{i}") == 1, ratio[1]).when(F.col(f"v{i}") == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-total))


def estimate(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Share of good documents and each rule's vote chances, from vote patterns with their numbers n.

    Starts from the sum of the votes; every count has one added, so that no
    chance is 0 and an empty table gives even ones.
    """
    good = 1 / (1 + F.exp(-sum((F.col(f"v{i}") for i in range(rules)), F.lit(0.0))))
    for _ in range(rounds):
        weighed = patterns.select("*", (F.col("n") * good).alias("g"), (F.col("n") * (1 - good)).alias("p"))
        parts = [F.sum(F.when(F.col(f"v{i}") == v, F.col(c))).alias(f"{c}{i}_{v + 1}") for i in range(rules) for v in (-1, 0, 1) for c in "gp"]
        row = weighed.agg(F.sum("g").alias("g"), F.sum("p").alias("p"), *parts).first().asDict()
        row = {k: v or 0.0 for k, v in row.items()}
        prior = (row["g"] + 1) / (row["g"] + row["p"] + 2)
        chances = []
        for i in range(rules):
            mass = {v: [row[f"g{i}_{v + 1}"], row[f"p{i}_{v + 1}"]] for v in (-1, 0, 1)}
            for v, right in ((-1, 1), (1, 0)):
                both = sum(mass[v])
                mass[v][right] = (mass[v][right] + TRUST * BELIEF * both) / (1 + TRUST)
                mass[v][1 - right] = both - mass[v][right]
            sums = [sum(m[k] for m in mass.values()) + 3 for k in (0, 1)]
            chances.append({v: ((m[0] + 1) / sums[0], (m[1] + 1) / sums[1]) for v, m in mass.items()})
        good = _posterior(prior, chances)
    return prior, chances


def judge(documents: DataFrame, rules: dict[str, tuple[str, str]] | None = None, least: float = 0.5) -> DataFrame:
    """doc_id, counts, base_failed, probability of good quality and kept for every document."""
    rules = rules or RULES
    voted = stage(votes(counts(documents), rules), "votes")
    names = [f"v{i}" for i in range(len(rules))]
    patterns = stage(voted.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    probability = _posterior(*estimate(patterns, len(rules)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (probability >= least)).alias("kept"), F.round(probability, 6).alias("probability"),
    )
