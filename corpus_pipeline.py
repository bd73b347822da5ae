"""A cleaning pipeline over ``documents``: quality, toxicity, near-duplicates, benchmark leaks, token ids.

Each stage takes what the one before kept. Between stages the documents are
written as Parquet to the folder of ``spark.checkpoint.dir`` and read again, so a
later stage starts from files and survives the loss of executors. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm import bpe, circulant, containment, quality, toxicity
from tallyweave.llm.queries import TOKENIZERS, table
from tallyweave.session import run_folder


def keep_readable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are readable rather than not, by the ordinal quality model."""
    model = quality.fit(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.select(docs, model, grade=1)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group."""
    return circulant.drop_near(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return containment.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with digests of the ids and of the decoded text."""
    return bpe.digests(docs, f"{TOKENIZERS}/byte_bpe_50k.json", with_ids=True)


STAGES = [
    ("quality", keep_readable),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("token_ids", encode),
]

#: Trained models and byte-pair merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the Parquet files of the one before; returns the last one's files."""
    folder = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
