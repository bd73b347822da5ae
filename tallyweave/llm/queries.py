"""Queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade of every document and its probability of being readable; see ``quality``."""
    from tallyweave.llm import quality

    documents = table(spark, folder, "documents")
    model = quality.fit(documents, quality.graded(table(spark, folder, "labels")))
    return quality.score(documents, model, grade=1)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents; see ``containment``."""
    from tallyweave.llm import containment

    return containment.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("doc")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page; see ``wrappers``."""
    from tallyweave.llm import wrappers

    return wrappers.main_text(table(spark, folder, "pages"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE of every document; see ``bpe``."""
    from tallyweave.llm import bpe

    return bpe.digests(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; see ``toxicity``."""
    from tallyweave.llm import toxicity

    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


def op6_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and the verdict of weighed rules; see ``weakrules``."""
    from tallyweave.llm import weakrules

    return weakrules.judge(table(spark, folder, "documents"))


def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one full of control strings, formatted and read back; see ``chat``."""
    from tallyweave.llm import chat

    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    trap = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat.digests(rows.union(trap))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents; see ``circulant``."""
    from tallyweave.llm import circulant

    return circulant.near_groups(table(spark, folder, "documents"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids written to files and read back; see ``tokenfiles``."""
    from tallyweave.llm import tokenfiles

    return tokenfiles.round_trip(table(spark, folder, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", end_id=2)


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families named in every document; see ``licences``."""
    from tallyweave.llm import licences

    documents = table(spark, folder, "documents")
    return licences.scan(documents, licences.train(documents))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens over every document; see ``alignment``."""
    from tallyweave.llm import alignment

    return alignment.digests(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op12_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all vectors of a label; see ``itq``."""
    from tallyweave.llm import itq

    return itq.near_vectors(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all vectors; see ``angular``."""
    from tallyweave.llm import angular

    return angular.hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_main_text": op3_main_text,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_weak_rules": op6_weak_rules,
    "op7_chat": op7_chat,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_files": op9_token_files,
    "op10_licences": op10_licences,
    "op11_alignment": op11_alignment,
    "op12_near_vectors": op12_near_vectors,
    "op13_hard_negatives": op13_hard_negatives,
}
