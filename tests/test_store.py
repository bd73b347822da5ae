import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators.audits import sole_row, sole_values
from tallyweave.operators.headers import header_rows_report
from tallyweave.sources import Conflict, PeriodStore, compare_runs, find_period_tables, publish, read_snapshots, write_snapshot
from tallyweave.streaming import upsert_files


def data(spark, *entries):
    return spark.createDataFrame(list(entries), "year long, k long, v string")


@pytest.fixture
def store(spark, tmp_path):
    made = PeriodStore(spark, str(tmp_path / "store"), ["year"])
    made.accept(made.propose(data(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 1, None))))
    return made


def states(store):
    return {(r.year, r.version): r.state for r in store.manifest().collect()}


def files(store):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(f"{store.path}/data") for n in names if n.endswith(".parquet")}


def test_candidates_are_invisible_until_accepted(spark, store):
    new = store.propose(data(spark, (1, 1, "A")))
    assert [(r["year"], r["version"], r["state"]) for r in new] == [(1, 2, "candidate")]
    assert rows(store.current().select("year", "k", "v")) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 1, None)]
    assert rows(store.version(2, year=1).select("k", "v")) == [(1, "A")]
    store.accept(new)
    assert rows(store.current().filter("year = 1").select("k", "v")) == [(1, "A")]
    assert states(store) == {(1, 1): "superseded", (2, 1): "accepted", (3, 1): "accepted", (1, 2): "accepted"}
    with pytest.raises(ValueError, match="accepted, not candidate"):
        store.reject(new)


def test_rejected_versions_and_rollback(spark, store):
    store.reject(store.propose(data(spark, (1, 1, "A"))))
    assert states(store)[1, 2] == "rejected"
    store.write_back(data(spark, (1, 1, "B")))
    store.roll_back(year=1)
    assert rows(store.current().filter("year = 1").select("k", "v")) == [(1, "a"), (2, "b")]
    assert states(store)[1, 3] == "withdrawn"
    with pytest.raises(ValueError, match="nothing to go back to"):
        store.roll_back(year=2)


def test_a_reader_keeps_the_generation_it_planned(spark, store):
    before, number = store.current(), store.generation()
    store.write_back(data(spark, (1, 9, "new"), (2, 9, "new")))
    assert before.count() == 4 and store.current(number).count() == 4
    assert rows(store.current().filter("year < 3").select("year", "k")) == [(1, 9), (2, 9)]


def test_a_failed_write_changes_nothing(spark, store):
    number = store.generation()
    bad = data(spark, (1, 1, "x")).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("boom"))).otherwise("y"))
    with pytest.raises(Exception, match="boom"):
        store.propose(bad)
    with pytest.raises(ValueError, match="rows without"):
        store.propose(data(spark, (None, 1, "x")))
    assert store.generation() == number and store.current().count() == 4


def test_the_second_of_two_writers_fails(spark, store, monkeypatch):
    other = PeriodStore(spark, store.path, ["year"])
    base, listed = other._listed()
    store.write_back(data(spark, (1, 1, "first")))
    with pytest.raises(Conflict):
        other._publish(listed, base)
    assert rows(store.current().filter("year = 1").select("v")) == [("first",)]


def test_write_back_touches_changed_periods_only(spark, store):
    before = files(store)
    same = data(spark, (2, 1, "c"), (1, 2, "b"), (1, 1, "a"), (3, 1, "now"))
    assert [(r["year"], r["version"]) for r in store.write_back(same)] == [(3, 2)]
    after = files(store)
    assert {f: after[f] for f in before} == before and all("year=3" in f for f in set(after) - set(before))
    assert store.write_back(same) == []


def test_retention_removes_files_after_the_grace(spark, store):
    store.write_back(data(spark, (2, 1, "C")))
    reader = store.current()
    store.retire(newest=2)
    assert reader.count() == 4 and rows(store.current().select("year", "v")) == [(2, "C"), (3, None)]
    assert store.sweep(grace=2) == []
    removed = store.sweep(grace=0)
    assert any("year=1" in p for p in removed)
    assert rows(spark.read.parquet(f"{store.path}/data").select("year", "v")) == [(2, "C"), (3, None)]
    assert states(store) == {(2, 2): "accepted", (3, 1): "accepted"}


def test_orphans_go_once_they_are_old(spark, store):
    orphan = f"{store.path}/data/batch=orphan"
    data(spark, (1, 1, "x")).write.partitionBy("year").parquet(orphan)
    store.sweep()
    assert os.path.exists(orphan)
    time.sleep(0.05)
    store.sweep(orphan_seconds=0.01)
    assert not os.path.exists(orphan) and store.current().count() == 4


def test_compaction_keeps_rows_and_versions(spark, store):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write_back(spark.range(200).select(F.lit(4).cast("long").alias("year"), F.col("id").alias("k"), F.lit("x").alias("v")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    before = rows(store.current().select("year", "k", "v"))
    small = store.compact(64 << 20)
    assert {r["year"] for r in small} >= {4}
    assert rows(store.current().select("year", "k", "v")) == before
    store.sweep(grace=0)
    assert sum("year=4" in f for f in files(store)) == 1 and rows(store.current().select("year", "k", "v")) == before
    assert store.compact(64 << 20) == []


def test_new_and_missing_columns(spark, store):
    store.write_back(spark.createDataFrame([(5, 1, 7)], "year long, k long, extra int"))
    assert rows(store.current().filter("year in (3, 5)").select("year", "v", "extra")) == [(3, None, None), (5, None, 7)]


def test_empty_store(spark, tmp_path):
    empty = PeriodStore(spark, str(tmp_path / "none"), ["year"])
    assert empty.generation() == 0 and empty.manifest().count() == 0
    with pytest.raises(LookupError):
        empty.current()
    assert empty.propose(data(spark).limit(0)) == [] and empty.generation() == 0


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["k,year,v", *lines]) + "\n")


def test_replayed_renamed_and_revised_files(spark, tmp_path):
    folder, store = tmp_path / "in", PeriodStore(spark, str(tmp_path / "store"), ["year"])

    def intake(state="state"):
        upsert_files(spark, str(folder), store, str(tmp_path / "ledger"), str(tmp_path / state), ["k", "year", "v"], ["k"], {"year": F.col("year").cast("long")})
        return rows(store.current().select("k", "year", "v")), store.generation()

    write(folder, "a.csv", "1,1,a", "2,1,b", "3,2,c")
    first, number = intake()
    assert first == [("1", 1, "a"), ("2", 1, "b"), ("3", 2, "c")]
    write(folder, "copy.csv", "3,2,c", "1,1,a", "2,1,b")
    assert intake() == (first, number)
    assert intake("other state") == (first, number)
    before = files(store)
    write(folder, "revised.csv", "3,2,C", "4,2,d")
    now, _ = intake()
    assert now == [("1", 1, "a"), ("2", 1, "b"), ("3", 2, "C"), ("4", 2, "d")]
    assert all("year=2" in f for f in set(files(store)) - set(before))
    assert states(store)[1, 1] == "accepted" and (1, 2) not in states(store)


def test_snapshots_are_added_and_compared(spark, tmp_path):
    path = str(tmp_path / "quality")
    one = spark.createDataFrame([(1, "x", 1.0), (1, None, 2.0), (2, "x", 3.0)], "ng int, cell string, f double")
    two = spark.createDataFrame([(1, "x", 1.0), (1, None, 5.0), (3, "x", None)], "ng int, cell string, f double")
    write_snapshot(one, path, "r1", "ng")
    write_snapshot(two, path, "r2", "ng")
    with pytest.raises(FileExistsError):
        write_snapshot(two, path, "r2", "ng")
    with pytest.raises(ValueError):
        write_snapshot(two, path, "r/3")
    assert rows(read_snapshots(spark, path).groupBy("run").count()) == [("r1", 3), ("r2", 3)]
    got = rows(compare_runs(spark, path, "r1", "r2", ["ng", "cell"], ["f"]))
    assert got == [(1, None, "f", 2.0, 5.0, 3.0, "changed"), (2, "x", "f", 3.0, None, None, "removed"), (3, "x", "f", None, None, None, "added")]


def test_period_tables_are_found_by_partitions_or_one_job(spark, tmp_path):
    spark.sql(f"CREATE DATABASE found LOCATION '{tmp_path}/found'")
    base = spark.createDataFrame([(2020, 1, 5), (2021, 2, 6)], "YEARS int, QUARTER int, x int")
    publish(base, "whole", "found", ("YEARS", "QUARTER"))
    publish(base.filter("YEARS = 2020"), "early", "found", ("YEARS",))
    publish(base.filter("YEARS = 2021"), "flat", "found")
    publish(base.select("x"), "other", "found")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("discovery", "period search")
    assert find_period_tables(spark, "found", YEARS=2021, QUARTER=2) == ["flat", "whole"]
    jobs = tracker.getJobIdsForGroup("discovery")
    spark.sparkContext.setJobGroup("discovery-2", "partitions only")
    assert find_period_tables(spark, "found", YEARS=2020) == ["early", "whole"]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert find_period_tables(spark, "found", YEARS=1999) == []
    spark.sql("DROP DATABASE found CASCADE")
    assert len(jobs) <= 2


def test_sole_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)], "k int, v string")
    assert rows(sole_values(df, "v", ["k"])) == [(1, "a", False), (2, None, True), (3, None, False)]
    assert rows(sole_row(df.filter("k = 1"), "v")) == [("a",)]
    with pytest.raises(Exception, match="more than one value: a, b"):
        sole_row(df, "v").collect()


def test_header_rows_report(spark):
    given = spark.createDataFrame([("f", "A"), ("f", "A"), ("f", "X"), ("g", "B")], "file string, header string")
    got = rows(header_rows_report(given, [("A", "a"), ("B", "b")]))
    assert got == [("f", "A", "a", "mapped"), ("f", "B", "b", "missing"), ("f", "X", None, "extra"), ("g", "A", "a", "missing"), ("g", "B", "b", "mapped")]
