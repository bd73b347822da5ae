"""Plans at scale: what is shuffled, what is read, and how hot keys are met."""

from contextlib import contextmanager

import household_fixture as fx
import pytest
from pyspark.sql import functions as F

from tallyweave.operators import dedupe, lookups, transfer
from tallyweave.plans import weight_household
from tallyweave.session import stage


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """Plan after the run, as adaptive execution left it."""
    df.collect()
    return plan(df)


LARGE = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
SKEW = {
    "spark__sql__shuffle__partitions": "8",
    **LARGE,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_output_pass_does_not_shuffle_microdata(spark):
    out = weight_household(fx.raw(spark), *fx.templates(spark), order=None).microdata
    text = plan(out)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_output_pass_without_broadcast_is_a_plain_join(spark):
    with settings(spark, **LARGE):
        done = weight_household(fx.raw(spark), *fx.templates(spark)).microdata
        text = plan(done)
        assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text and "Window" not in text
        got = {r.ID: r.PEMBERAT_FINAL for r in done.collect()}
    assert got == {k: v[2] for k, v in fx.EXPECTED.items()}


def test_counting_reads_only_key_columns(spark):
    people = stage(spark.range(10).select("id", F.lit("x").alias("wide"), F.lit(1).alias("NG")), "people")
    assert "ReadSchema: struct<NG:int>" in plan(people.groupBy("NG").count())


@pytest.mark.parametrize("column", ["id", "name"])
def test_hot_key_of_transfer_is_split(spark, column):
    """A third of the target shares one key; the staged donors let the join split it."""
    other = F.concat(F.lit("k"), F.col("id").cast("string"))
    hot = F.when(F.col("id") % 3 == 0, "HOT").otherwise(other)
    target = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("n"),
        (hot if column == "id" else F.concat(F.lit("t"), other)).alias("ID_38"),
        (hot if column == "name" else F.lit("nobody")).alias("NAMA"),
    )
    donors = spark.range(2000).select(
        F.when(F.col("id") == 0, "HOT").otherwise(other).alias("ID_38"),
        F.when(F.col("id") == 0, "HOT").otherwise(other).alias("NAMA"),
        F.col("id").cast("double").alias("PEMBERATFINAL"),
        F.col("id").alias("_ord"),
    )
    with settings(spark, **SKEW):
        done = transfer.transfer_weight(target, donors)
        text = final_plan(done)
        assert "skewed" in text
        hits = {r.MATCH: r["count"] for r in done.groupBy("MATCH").count().collect()}
    assert hits[column] == 10000 + sum(1 for n in range(2000) if n % 3 and n)


def test_hot_key_of_sample_lookup_is_split(spark):
    key = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string"))
    firms = spark.range(0, 30000, 1, 8).select(key.alias("NEWSSID"), F.col("id").alias("n"))
    sample = spark.createDataFrame([("HOT", "r", "t"), ("1", "r1", "t1")], "NEWSSID string, REGISTERED_NAME string, TRADING_NAME string")
    with settings(spark, **SKEW):
        done = lookups.lookup_sample(firms, sample)
        assert "skewed" in final_plan(done)
        assert done.filter("REGISTERED_NAME = 'r'").count() == 10000


def test_marks_of_a_hot_key_spread_evenly(spark):
    """No task of the join sees the hot key whole: rows are hashed by key and position."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    df = spark.range(0, 30000, 1, 8).select(hot.alias("k"), F.col("id").alias("o"))
    with settings(spark, **LARGE, spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false"):
        marked = dedupe.mark_first(df, ["k"], "o")
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30000 and max(sizes) < 1.2 * min(sizes)
