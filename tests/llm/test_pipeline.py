import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from tallyweave.llm import bpe

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_a_row(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(texts)
    library = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    for r in got:
        assert list(r.token_ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(r.token_ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_stages_keep_odd_rows_apart(spark, tmp_path):
    """Nulls, empty texts, repeated rows and an extra column go through every stage."""
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "s", 5, "e"), (1, text, "en", "s", 5, "e"), (2, text, None, None, None, None), (None, None, None, None, None, "e"), (3, "", "en", "s", 0, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1, 3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
    assert bpe.digests(docs, "/opt/tokenizers/byte_bpe_50k.json").count() == 3
