"""Licence scan: a trained paragraph classifier whose findings a template must confirm.

Paragraphs (lines) are sparse sets of hashed word n-grams. A multinomial logistic
regression over licence families and one unknown class is trained on the
templates below, cut, shortened and garbled at random, and on a bounded sample
of the corpus's own paragraphs as unknown ones. A temperature fitted on a part
kept out of training calibrates the probabilities. A paragraph is given a family
if its probability is at least ``LEAST`` and one of the family's templates shares
at least ``OVERLAP`` of its word pairs with it. Runs of lines up to a line without words
are read as one text as well: wherever a template shares that much with a stretch
of a run, the classifier judges the matched words, and what a confirmed family
explains is taken away before the next, so wrapped statements and several
families of one line are found. A finding counts once in its run; a line that is
part of another family's wrapped statement is none of its own.

Nulls: a null text counts as empty and has no licence. Long paragraphs are read
whole: only n-grams that the templates hold count, so length does not thin them
out. An empty table trains on the templates alone. Repeated rows give repeated
results; extra columns are dropped.
"""

from __future__ import annotations

import random
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import bytetext

# Usual statements of licence families.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License version 3 (GPLv3).",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License version 2 (GPLv2).",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "This program is licensed under the terms of the GNU Affero General Public License as published by the Free Software Foundation."],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "This software is released under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
}
#: Statements that sound like licences and are of no family.
OTHERS = [
    "All rights reserved.",
    "Copyright by the authors, all rights reserved.",
    "The driver needs a license to use the road in this state.",
    "Public work on the general terms of the contract was released in version 2.",
    "He was granted permission to use the software free of charge.",
    "The terms of this agreement are subject to the law of the state.",
    "Released under pressure, the work of the author was licensed to any person.",
]

SIZES = (1, 2, 3)
#: Labelled rows made from each template, corpus documents for unknown ones, fitting rounds, weight penalty.
COPIES, SAMPLE_DOCUMENTS, ROUNDS, PENALTY = 40, 300, 200, 1e-3
LEAST, OVERLAP = 0.8, 0.5
#: Everything but ASCII letters and digits and the bytes of other letters separates words here.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD[ord("a") : ord("z") + 1] = _FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[10] = 10


def _worded(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, line (counted over all texts) and text number of every word."""
    data, offsets = bytetext.utf8(array)
    plain = _FOLD[data]
    starts, ends, owner = bytetext.word_spans(plain, offsets)
    lines = np.cumsum(np.concatenate([[0], plain == 10]))
    words = bytetext.SpanHashes(plain).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return words, lines[starts], owner


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    hashes = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for k in range(size):
        hashes = bytetext.mix(hashes + words[k : k + len(hashes)], 900 + k)
    return hashes


def ngrams(array: pa.Array, worded: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Paragraph numbers (rising over all texts), hashes and sizes of their word n-grams, and each paragraph's text number."""
    words, lines, owner = worded or _worded(array)
    # A new paragraph at every text and every line feed.
    line = lines + owner
    number = np.cumsum(np.concatenate([[True], line[1:] != line[:-1]])) - 1 if len(line) else line
    owners, found, sizes = [], [], []
    for size in SIZES:
        if len(words) < size:
            continue
        hashes = _grams(words, size)
        inside = number[: len(hashes)] == number[size - 1 :]
        owners.append(number[: len(hashes)][inside])
        found.append(hashes[inside])
        sizes.append(np.full(int(inside.sum()), size))
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if len(number) else np.zeros(0, np.int64)
    join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)])
    return join(owners, np.int64), join(found, np.uint64), join(sizes, np.int64), owner[first]


def _strings(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class LicenceModel:
    """Weights of template n-grams by class (class 0 is unknown), and the templates' word pairs."""

    families: list[str]
    grams: np.ndarray  # sorted hashes
    weights: np.ndarray  # grams x classes
    bias: np.ndarray
    temperature: float
    pairs: list[tuple[int, np.ndarray]]  # class and sorted word-pair hashes of each template
    words: dict[int, int]  # class of the words that only one class's templates hold, 0 of others

    def known(self, owner: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (paragraph, n-gram number) pairs of n-grams that the templates hold."""
        at = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        hit = self.grams[at] == found
        return np.divmod(np.unique(owner[hit] * len(self.grams) + at[hit]), len(self.grams))

    def scores(self, owner: np.ndarray, gram: np.ndarray, count: int) -> np.ndarray:
        sums = np.zeros((count, len(self.bias)))
        np.add.at(sums, owner, self.weights[gram])
        return sums + self.bias

    def paragraphs(self, array: pa.Array) -> list[tuple[int, str, float]]:
        """(text number, family, probability) of every confirmed paragraph, and of every other family of a run of lines."""
        worded = _worded(array)
        words, lines, texts = worded
        if not len(words):
            return []
        out = self._lines(array, worded)
        run = np.cumsum(np.concatenate([[True], (lines[1:] - lines[:-1] > 1) | (texts[1:] != texts[:-1])])) - 1
        line = lines + texts
        first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        runs, wrapped = self._runs(words, run, line)
        named = {(r, family) for r, _, family, _ in runs}
        own = [(int(run[first[n]]), int(line[first[n]]), x) for n, *x in out]
        kept = [(r, x) for r, at, x in own if at not in wrapped or (r, x[1]) in named]
        taken = {(r, x[1]) for r, x in kept}
        return [tuple(x) for _, x in kept] + [(int(texts[i]), family, chance) for r, i, family, chance in runs if (r, family) not in taken]

    def _runs(self, words: np.ndarray, run: np.ndarray, line: np.ndarray) -> tuple[list[tuple[int, int, str, float]], set[int]]:
        """(run, word, family, probability) of every family of a run, and the lines of statements over several lines."""
        holders: dict[int, list[int]] = {}
        for t, (_, pairs) in enumerate(self.pairs):
            for h in pairs.tolist():
                holders.setdefault(h, []).append(t)
        pair = _grams(words, 2)
        hits = np.flatnonzero((run[1:] == run[:-1]) & np.isin(pair, np.array(list(holders), np.uint64)))
        out: dict[tuple[int, str], tuple] = {}
        wrapped: set[int] = set()
        cuts = np.flatnonzero(np.diff(run[hits])) + 1
        for part in np.split(hits, cuts):
            if len(part) < 2:
                continue
            places: dict[int, list[tuple[int, int]]] = {}
            for i, h in zip(part.tolist(), pair[part].tolist(), strict=True):
                for t in holders[h]:
                    places.setdefault(t, []).append((i, h))
            walls: list[int] = []
            while found := max((x for t in places if (x := self._stretch(t, places[t], walls))), default=None):
                _, _, minus, at = found
                kind = self.pairs[-minus][0]
                chance = self._judge(words, at, kind)
                used = set(at)
                if chance.argmax() == kind and chance[kind] >= LEAST:
                    name, where = self.families[kind - 1], int(run[at[0]])
                    out.setdefault((where, name), (where, at[0], name, float(chance[kind])))
                    over = set(line[sorted({w for i in at for w in (i, i + 1)})].tolist())
                    wrapped |= over if len(over) > 1 else set()
                    walls = sorted({*walls, *at})
                    places = {t: [x for x in own if x[0] not in used] for t, own in places.items()}
                else:
                    places[-minus] = [x for x in places[-minus] if x[0] not in used]
        return list(out.values()), wrapped

    def _stretch(self, template: int, own: list[tuple[int, int]], walls: list[int]) -> tuple[float, int, int, list[int]] | None:
        """Share and number of a template's pairs in the stretch between walls that holds most of them, if enough, and where they stand."""
        size = len(self.pairs[template][1])
        if len({h for _, h in own}) < OVERLAP * size:
            return None
        best, begin, count = (0, 0, 0), 0, {}
        for end, (i, h) in enumerate(own):
            count[h] = count.get(h, 0) + 1
            wall = bisect(walls, i)
            while i - own[begin][0] > 2 * size + 2 or bisect(walls, own[begin][0]) != wall:
                old = own[begin][1]
                count[old] -= 1
                if not count[old]:
                    del count[old]
                begin += 1
            best = max(best, (len(count), begin - end, end))
        if best[0] < OVERLAP * size:
            return None
        return best[0] / size, best[0], -template, [i for i, _ in own[best[2] + best[1] : best[2] + 1]]

    def _judge(self, words: np.ndarray, at: list[int], kind: int) -> np.ndarray:
        """Probabilities of the words of the pairs at these places; all 0 if a single word between them is another family's alone."""
        begin = at[0]
        inside = np.zeros(at[-1] + 2 - begin, bool)
        for i in at:
            inside[i - begin : i - begin + 2] = True
        own = words[begin : at[-1] + 2]
        between = np.flatnonzero(~inside[1:-1] & inside[:-2] & inside[2:]) + 1
        for h in _grams(own[between], 1).tolist():
            if self.words.get(h, kind) not in (kind, 0):
                return np.zeros(len(self.bias))
        inside[between] = True
        found = []
        for size in SIZES:
            grams = _grams(own, size)
            whole = np.ones(len(grams), bool)
            for k in range(size):
                whole &= inside[k : k + len(grams)]
            found.append(grams[whole])
        found = np.concatenate(found)
        _, gram = self.known(np.zeros(len(found), np.int64), found)
        return _softmax(self.scores(np.zeros(len(gram), np.int64), gram, 1) / self.temperature)[0]

    def _lines(self, array: pa.Array, worded: tuple) -> list[tuple[int, int, str, float]]:
        """(paragraph, text number, family, probability) of every confirmed line."""
        owner, found, sizes, text = ngrams(array, worded)
        if not len(found):
            return []
        row, gram = self.known(owner, found)
        # Without a pair or triple of a template's words a paragraph cannot share half of its pairs.
        long = np.unique(owner[(sizes > 1) & np.isin(found, self.grams)])
        keep = np.isin(row, long)
        row, gram = row[keep], gram[keep]
        where, local = np.unique(row, return_inverse=True)
        if not len(where):
            return []
        chance = _softmax(self.scores(local, gram, len(where)) / self.temperature)
        best = chance.argmax(axis=1)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.concatenate([where, where + 1]))
        out = []
        for i in np.flatnonzero((best > 0) & (chance.max(axis=1) >= LEAST)):
            own = found[order[bounds[i] : bounds[i + len(where)]]]
            if any(c == best[i] and np.isin(pairs, own).mean() >= OVERLAP for c, pairs in self.pairs):
                out.append((int(where[i]), int(text[where[i]]), self.families[best[i] - 1], float(chance[i, best[i]])))
        return out


def _garbled(text: str, rng: random.Random) -> str:
    """A template as it is met in texts: cut, words lost, letter case and signs changed, other words around it."""
    words = text.split()
    if len(words) > 12 and rng.random() < 0.5:
        begin = rng.randrange(len(words) - 10)
        words = words[begin : begin + rng.randint(10, len(words))]
    words = [w for w in words if len(words) < 6 or rng.random() > 0.05]
    around = ["file", "see", "note", "project", "code", "here", "2021", "author", "data"]
    words = [rng.choice(around) for _ in range(rng.choice([0, 0, 0, 1, 3]))] + words + [rng.choice(around) for _ in range(rng.choice([0, 0, 0, 1, 3]))]
    out = " ".join(words)
    return rng.choice([out, out, out.lower(), out.upper(), out.replace(",", ""), out.rstrip(".")])


def _fit(row: np.ndarray, gram: np.ndarray, label: np.ndarray, width: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a penalised multinomial regression, classes weighing alike."""
    weights, bias = np.zeros((width, classes)), np.zeros(classes)
    share = 1 / np.maximum(np.bincount(label, minlength=classes), 1)[label] / classes
    target = np.eye(classes)[label]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    by_row = np.argsort(row, kind="stable")
    begin = np.searchsorted(row[by_row], np.arange(len(label) + 1))
    filled = np.flatnonzero(np.diff(begin))
    speed, scale = np.zeros_like(weights), np.full_like(weights, 1e-12)
    for step in range(1, ROUNDS + 1):
        sums = np.tile(bias, (len(label), 1))
        sums[filled] += np.add.reduceat(weights[gram[by_row]], begin[filled], axis=0)
        error = (_softmax(sums) - target) * share[:, None]
        slope = PENALTY * weights / width
        slope[gram[first]] += np.add.reduceat(error[row], first, axis=0)
        speed = 0.9 * speed + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        weights = weights - 0.05 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-6)
        bias = bias - 2.0 * error.sum(axis=0)
    return weights, bias


def fit(negatives: list[str]) -> LicenceModel:
    """Model from the templates and from texts whose paragraphs count as unknown unless they repeat a template."""
    rng = random.Random(20240501)
    families = list(TEMPLATES)
    texts, labels, folds = [], [], []
    for k, name in enumerate(families, 1):
        for template in TEMPLATES[name]:
            for copy in range(COPIES):
                texts.append(_garbled(template, rng) if copy else template)
                labels.append(k)
                folds.append(copy % 5 == 4)
    for text in OTHERS:
        for copy in range(COPIES):
            texts.append(_garbled(text, rng) if copy else text)
            labels.append(0)
            folds.append(copy % 5 == 4)
    plain = [t for n in TEMPLATES.values() for t in n]
    owner, found, sizes, _ = ngrams(_strings([*plain, *OTHERS]))
    grams = np.unique(found)
    pairs = []
    owners = [k for k, n in enumerate(families, 1) for _ in TEMPLATES[n]]
    for i, k in enumerate(owners):
        pairs.append((k, np.unique(found[(owner == i) & (sizes == 2)])))
    alone: dict[int, int] = {}
    for i, h in zip(owner[sizes == 1].tolist(), found[sizes == 1].tolist(), strict=True):
        k = owners[i] if i < len(owners) else 0
        alone[h] = k if alone.get(h, k) == k else 0
    model = LicenceModel(families, grams, np.zeros((len(grams), len(families) + 1)), np.zeros(len(families) + 1), 1.0, pairs, alone)
    lines = sorted({line for t in negatives for line in t.split("\n") if line.strip()})
    if lines:
        owner, found, sizes, number = ngrams(_strings(lines))
        two = sizes == 2
        # A corpus paragraph with half of a template's pairs may be a licence: it is no example of an unknown one.
        order = np.argsort(owner[two], kind="stable")
        own, hashes = owner[two][order], found[two][order]
        ends = np.searchsorted(own, np.arange(len(number) + 1))
        near = np.zeros(len(number), bool)
        near[owner[two & np.isin(found, np.concatenate([p for _, p in pairs]))]] = True
        for i in range(len(number)):
            mine = hashes[ends[i] : ends[i + 1]]
            if not near[i] or not any(np.isin(p, mine).mean() >= OVERLAP for _, p in pairs if len(p)):
                texts.append(lines[number[i]])
                labels.append(0)
                folds.append(i % 5 == 4)
    label, fold = np.array(labels), np.array(folds)
    owner, found, _, number = ngrams(_strings([t.replace("\n", " ") for t in texts]))
    row, gram = model.known(number[owner], found)
    train = ~fold
    place = np.cumsum(train) - 1
    here = train[row]
    model.weights, model.bias = _fit(place[row[here]], gram[here], label[train], len(grams), len(families) + 1)
    # The temperature with the least loss on the part kept out.
    rest = np.cumsum(fold) - 1
    sums = model.scores(rest[row[~here]], gram[~here], int(fold.sum()))
    losses = {t: -np.log(np.maximum(_softmax(sums / t)[np.arange(len(sums)), label[fold]], 1e-12)).mean() for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)}
    model.temperature = min(losses, key=lambda t: (losses[t], t))
    return model


def train(documents: DataFrame) -> LicenceModel:
    """Model with the paragraphs of at most ``SAMPLE_DOCUMENTS`` documents (by hash of the id) as unknown ones."""
    chosen = documents.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text").where("text is not null").collect()
    return fit([r.text for r in rows])


def scan(documents: DataFrame, model: LicenceModel) -> DataFrame:
    """doc_id, licences (families in order, separated by commas; empty if none), n_paragraphs and probability (of the surest)."""
    frame = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytetext.chunks(batches):
            found: dict[int, list[tuple[str, float]]] = {}
            for text, family, chance in model.paragraphs(bytetext.text_array(batch)):
                found.setdefault(text, []).append((family, chance))
            rows = [found.get(i, []) for i in range(batch.num_rows)]
            arrays = [
                batch.column(0),
                pa.array([",".join(sorted({f for f, _ in r})) for r in rows], pa.string()),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([max((p for _, p in r), default=0.0) for r in rows], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "licences", "n_paragraphs", "probability"])

    return frame.mapInArrow(run, f"doc_id {dict(frame.dtypes)['doc_id']}, licences string, n_paragraphs long, probability double")
