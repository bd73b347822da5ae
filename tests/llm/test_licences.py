import re

import numpy as np
import pyarrow as pa
import pytest

from tallyweave.llm import licences
from tallyweave.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PLANTED = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
}


@pytest.fixture(scope="module")
def model():
    return licences.fit(["plain words of a letter\nthe house by the river", "Released under the MIT License.\nmore of it"])


def families(model, *texts):
    found = model.paragraphs(pa.array(texts, pa.large_string()))
    return [sorted({f for i, f, _ in found if i == k}) for k in range(len(texts))]


def test_templates_and_variants(model):
    for name, texts in licences.TEMPLATES.items():
        for text in texts:
            assert families(model, f"one\n{text}\ntwo") == [[name]], text
    got = families(model, "see FILE: released under the mit license", "licensed under GNU General Public License version 2", "word " * 30000 + "Licensed under CC BY-SA 4.0", "MIT\nreleased under the MIT license\nCC0 1.0 Universal dedicated to the public domain")
    assert got == [["MIT"], ["GPL-2.0"], ["CC-BY-SA"], ["CC0", "MIT"]]


def test_others_are_unknown(model):
    assert families(model, *licences.OTHERS, "", " \n ", "the license of the house", "under the version of the work") == [[]] * (len(licences.OTHERS) + 4)


def test_whole_table_against_planted_lines(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = {d: ",".join(sorted({PLANTED[line] for line in t.split("\n") if line in PLANTED})) for d, t in docs.items()}
    got = {r.doc_id: r for r in QUERIES["op10_licences"](spark, FOLDER).collect()}
    assert {d: r.licences for d, r in got.items()} == want
    assert any(want.values())
    assert all((r.n_paragraphs > 0) == (r.probability > 0) == bool(r.licences) for r in got.values())


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "Released under the MIT License."), (3, "Released under the MIT License.")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, probability int")
    model = licences.train(frame)
    got = sorted((r.doc_id or 0, r.licences) for r in licences.scan(frame, model).collect())
    assert got == [(0, "MIT"), (1, ""), (2, ""), (3, "MIT"), (3, "MIT")]
    empty = frame.limit(0)
    assert licences.scan(empty, licences.train(empty)).count() == 0


def test_ngrams_equal_brute_force():
    texts = ["a b\nc d e", "", "A, b!\n\nx", "\n"]
    owner, found, sizes, number = licences.ngrams(pa.array(texts, pa.large_string()))
    lines = [(i, re.findall(r"[a-z0-9]+", line.lower())) for i, t in enumerate(texts) for line in t.split("\n")]
    lines = [(i, w) for i, w in lines if w]
    assert number.tolist() == [i for i, _ in lines]
    for k, (_, words) in enumerate(lines):
        assert [int(((owner == k) & (sizes == n)).sum()) for n in licences.SIZES] == [max(0, len(words) - n + 1) for n in licences.SIZES]
    same = {(int(o), int(s)): set(found[(owner == o) & (sizes == s)].tolist()) for o in range(len(lines)) for s in licences.SIZES}
    assert same[0, 2] == same[2, 2] and not same[0, 2] & same[1, 2]
    assert np.unique(found[sizes == 1]).size == 6


MIT = """// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Software"), to deal
// in the Software without restriction, including without limitation the rights"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version."""


def test_wrapped_and_dual_statements(model):
    assert families(model, f"code\n\n{MIT}\n\nmore", GPL.format(3), GPL.format(2).replace("software:", "software;").replace("Foundation,", "Foundation;")) == [["MIT"], ["GPL-3.0"], ["GPL-2.0"]]
    assert families(model, "licensed under the MIT license or the Apache License, Version 2.0") == [["Apache-2.0", "MIT"]]
    assert families(model, f"{MIT}\n//\n{GPL.format(3)}") == [["GPL-3.0", "MIT"]]
    agpl = GPL.format(3).replace("GNU General", "GNU Affero General")
    assert families(model, agpl) == [["AGPL-3.0"]]
    # A line without words ends the run.
    assert families(model, "Permission is hereby granted, free of charge\n\nto any person\n\nobtaining a copy of the letter") == [[]]
