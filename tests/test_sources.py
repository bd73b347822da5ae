import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave import session, sources
from tallyweave.streaming import intake_files


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_read_drops_empty_rows_and_null_words(spark, tmp_path):
    path = write(tmp_path / "a.csv", "﻿NG,NAME,X,\n1,Johor,nan,\n\n2,,5,\n,,,\n")
    df = sources.read_delimited(spark, path)
    assert df.columns[:3] == ["NG", "NAME", "X"]
    assert rows(df, "NG", "NAME", "X") == [("1", "Johor", None), ("2", None, "5")]


def test_control_template_reads_to_its_rows(spark, tmp_path):
    body = "".join(f"{n},State {n},{n * 1000},{c},\n" for c in (1, 2) for n in range(1, 17))
    path = write(tmp_path / "t.csv", "NG,NEGERI,ANGGARAN_PENDUDUK(BPPD),CIT_NONCIT,\n" + body + ",,,,\n")
    df = sources.infer_integers(sources.read_delimited(spark, path))
    assert df.count() == 32
    assert dict(df.dtypes)["ANGGARAN_PENDUDUK(BPPD)"] == "bigint"


def test_declared_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "A,B\n1,2\n")
    assert rows(sources.read_delimited(spark, path, columns=["A", "B"])) == [("1", "2")]


def test_encoding_fallback(spark, tmp_path):
    path = write(tmp_path / "a.csv", "NAME\nJosé\n", "latin-1")
    assert rows(sources.read_delimited(spark, path, encoding=None)) == [("José",)]
    utf8 = write(tmp_path / "b.csv", "NAME\nJosé\n")
    assert rows(sources.read_delimited(spark, utf8, encoding=None)) == [("José",)]


def test_integer_inference(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "-3", "7", None, "1234567890123456789"), ("02", "2", "4", "", "5", "1")], "a string, b string, c string, d string, e string, f string"
    )
    assert dict(sources.infer_integers(df).dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "string", "e": "string", "f": "bigint"}
    assert tuple(sources.integer_columns(df).first()) == (True, False, False, False, False, True)


def test_header_offset_keeps_equal_lines_below(spark, tmp_path):
    path = write(tmp_path / "a.csv", "report\n,\nA,B\n1,2\nreport\nA,B\n3,\"x, y\"\n")
    df = sources.read_with_offset(spark, path, 2)
    assert df.columns == ["A", "B"]
    assert rows(df) == [("1", "2"), ("3", "x, y"), ("A", "B"), ("report", None)]


def test_header_offset_over_several_blocks(spark, tmp_path):
    body = "".join(f"{i},{i * 2}\n" for i in range(5000))
    path = write(tmp_path / "a.csv", "first\nA,B\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = sources.read_with_offset(spark, path, 1)
        assert df.agg(F.count("*"), F.sum(F.col("A").cast("long"))).first() == (5000, sum(range(5000)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_source_order_follows_the_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", "A\n" + "".join(f"{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = sources.read_delimited(spark, path, keep_order=True)
        assert [int(r.A) for r in df.orderBy("_ord").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latest_file(spark, tmp_path):
    old, new = write(tmp_path / "b.csv", "A\n"), write(tmp_path / "a.csv", "A\n")
    os.utime(old, (1, 1))
    os.utime(new, (time.time(), time.time()))
    assert sources.latest_file(spark, f"{tmp_path}/*.csv").endswith("/a.csv")


def test_ingest_monthly_and_quarterly(spark, tmp_path):
    write(tmp_path / "m" / "JR4M02Y2021_FINAL.csv", "A,B\n1,2\n,\n")
    write(tmp_path / "m" / "JR4M11Y2020_FINAL.csv", "A,C\n3,4\n")
    got = sources.ingest_finals(spark, f"{tmp_path}/m")
    assert list(got) == ["JR4M02Y2021", "JR4M11Y2020"]
    assert rows(got["JR4M02Y2021"]) == [("1", "2", 2, 2021, 1)]
    assert rows(got["JR4M11Y2020"], "A", "C", "QUARTER") == [("3", "4", 4)]
    write(tmp_path / "q" / "JR4Q3Y2021.csv", "A\n1\n")
    assert rows(sources.ingest_finals(spark, f"{tmp_path}/q", "quarterly")["JR4Q3Y2021"]) == [("1", 3, 2021, 2)]
    write(tmp_path / "bad" / "JR4M13Y2021.csv", "A\n1\n")
    with pytest.raises(ValueError, match="period 13"):
        sources.ingest_finals(spark, f"{tmp_path}/bad")


def test_control_record(spark):
    df = spark.createDataFrame([(1, 2020, None), (3, 2021, 2), (2, 2019, 4)], "seq int, year int, quarter int")
    assert rows(sources.clean_control(sources.latest_control(df, "seq"))) == [(3, 2021, 2)]
    first = sources.latest_control(df.filter("seq = 1"), "seq")
    assert rows(sources.clean_control(first)) == [(1, 2020, 0)]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS finals LOCATION '{tmp_path}/finals'")
    try:
        df = spark.createDataFrame([("a", 1, 2021)], "`x y` string, QUARTER int, YEARS int")
        sources.publish(df, sources.table_name("household_quarterly", quarter=1, year=2021), "finals")
        sources.publish(df.withColumn("QUARTER", F.lit(2)), "other", "finals")
        sources.publish(df.drop("QUARTER"), "undated", "finals")
        assert sources.find_period_tables(spark, "finals", QUARTER=1, YEARS=2021) == ["jr4q1y2021_fc"]
        assert sources.load_table(spark, "finals.JR4Q1Y2021_FC").columns == ["xy", "QUARTER", "YEARS"]
        sources.publish(df.withColumn("z", F.lit(1)), "undated", "finals")
        assert "z" in spark.table("finals.undated").columns
    finally:
        spark.sql("DROP DATABASE finals CASCADE")


def test_replace_period_and_pruning(spark, tmp_path):
    path = f"{tmp_path}/t"
    sources.replace_period(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, YEARS int"), path, "YEARS")
    sources.replace_period(spark.createDataFrame([(9, 2021)], "v int, YEARS int"), path, "YEARS")
    assert rows(spark.read.parquet(path)) == [(1, 2020), (9, 2021)]
    pruned = sources.read_period(spark.read.parquet(path), YEARS=2021)
    assert "PartitionFilters: [isnotnull(YEARS" in pruned._jdf.queryExecution().executedPlan().toString()
    assert rows(pruned) == [(9, 2021)]


def test_quality_table_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "NG int, v string")
    sources.write_quality_table(df, f"{tmp_path}/q", "NG")
    assert sorted(p for p in os.listdir(tmp_path / "q") if p.startswith("NG")) == ["NG=1", "NG=2"]
    sources.write_csv(df, f"{tmp_path}/c")
    assert rows(sources.infer_integers(sources.read_delimited(spark, f"{tmp_path}/c"))) == [(1, "a"), (2, "b")]


def test_intake_reads_each_file_once(spark, tmp_path):
    folder, table, state = (f"{tmp_path}/{n}" for n in ("in", "table", "state"))
    write(tmp_path / "in" / "a.csv", "A,B\n1,2\n,\n")
    intake_files(spark, folder, table, state, ["A", "B"], timeout=120)
    write(tmp_path / "in" / "b.csv", "A,B\n3,4\n")
    intake_files(spark, folder, table, state, ["A", "B"], timeout=120)
    intake_files(spark, folder, table, state, ["A", "B"], timeout=120)
    assert rows(spark.read.parquet(table)) == [("1", "2", "a.csv"), ("3", "4", "b.csv")]


def test_intake_archives(spark, tmp_path):
    folder, table, state, archive = (f"{tmp_path}/{n}" for n in ("in", "table", "state", "bin"))
    for name, value in (("a.csv", 1), ("b.csv", 2), ("c.csv", 3)):
        write(tmp_path / "in" / name, f"A\n{value}\n")
        intake_files(spark, folder, table, state, ["A"], archive=archive, timeout=120)
    assert rows(spark.read.parquet(table), "A") == [("1",), ("2",), ("3",)]
    moved = [f for _, _, files in os.walk(archive) for f in files]
    assert "a.csv" in moved


def test_staged_table_lies_in_the_configured_folder(spark):
    staged = session.stage(spark.range(3).withColumn("a (b)", F.lit(1)), "part")
    assert staged.columns == ["id", "a (b)"] and staged.count() == 3
    assert session.shared_folder(spark) in staged.inputFiles()[0]
