import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators import audits, cells, classify, dedupe, lookups, measures, rules, transfer, versions, weights


def test_mark_first_null_keys_are_one_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 2), (None, 5), ("b", 4)], "k string, o int")
    assert rows(dedupe.mark_first(df, ["k"], "o"), "o", "PF_OUTPUT") == [(1, 1), (2, 1), (3, 2), (4, 1), (5, 2)]
    assert rows(dedupe.repeat_rows(df, ["k"], "o"), "o") == [(3,), (5,)]
    renamed = dedupe.mark_first(df, ["k"], ["o"], name="m", first=1, repeat=0, order_is_unique=True)
    assert rows(renamed, "o", "m") == [(1, 1), (2, 1), (3, 0), (4, 1), (5, 0)]


def test_mark_first_order_only_unique_within_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3)], "k string, o int")
    assert rows(dedupe.mark_first(df, ["k"], "o"), "k", "o", "PF_OUTPUT") == [("a", 1, 1), ("a", 2, 2), ("b", 2, 1), ("b", 3, 2)]


def test_first_rows_keep_null_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("b", 3, 7.0)], "k string, o int, v double")
    assert rows(dedupe.first_rows(df, ["k"], "o", ["v"])) == [("a", None), ("b", 7.0)]


def test_order_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, o int")
    assert rows(dedupe.order_ties(df, ["k"], "o")) == [("a", 1, 2)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_position_over_slices(spark, width):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") * 2).alias("o")).repartition(5)
    got = rows(dedupe.running_position(df, ["k"], "o", slice_width=width))
    assert got == sorted((k, o, i + 1) for k in range(3) for i, o in enumerate(range(2 * k, 1000, 6)))


def test_block_position(spark):
    df = spark.range(40).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("o"))
    got = rows(dedupe.block_position(df, ["k"], "o"), "o", "block", "position")
    assert got == [(i, i // 18 + 1, i % 18 + 1) for i in range(40)]


def test_audits(spark):
    df = spark.createDataFrame([("aa", 1), ("b", None), ("aa", 3), (None, 4)], "s string, n int")
    assert rows(audits.length_audit(df, "s")) == [(1, 1), (2, 2), (None, 1)]
    assert rows(audits.value_counts(df, "s")) == [("aa", 2), ("b", 1)]
    assert rows(audits.uniqueness_audit(df, "s")) == [("aa", 2)]
    assert rows(audits.uniqueness_audit(df, "s", above=2)) == []
    assert rows(audits.presence_counts(df, "n")) == [(False, 1), (True, 3)]
    assert rows(audits.null_audit(df)) == [("n", 4, 1), ("s", 4, 1)]
    assert rows(audits.distinct_values(df, "s")) == [("aa",), ("b",), (None,)]
    assert audits.all_null_rows(df).count() == 0
    assert rows(audits.discrepancies(df.withColumn("d", F.col("n") - 1), "d"), "d") == [(2,), (3,), (None,)]


def test_sole_value(spark):
    assert audits.sole_value(spark.createDataFrame([(3,), (3,)], "m int"), "m") == 3
    with pytest.raises(ValueError, match="more than one value"):
        audits.sole_value(spark.createDataFrame([(3,), (4,)], "m int"), "m")


def test_reconcile(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 1, 3)], "a int, b int, t int")
    assert rows(audits.reconcile(df, {"t": ["a", "b"]})) == [("t", 6.0, 5.0, False)]
    assert rows(audits.reconcile(df.limit(1), {"t": ["a", "b"]})) == [("t", 3.0, 3.0, True)]


def test_classify_overlong_fields(spark):
    raw = spark.createDataFrame([("1", "12", "30", "458", "11009", "1")], "NG string, ST string, U string, KW string, KET string, J string")
    got = classify.classify(classify.build_id(raw, {"NG": 2, "ST": 1, "KET": 4, "J": 1}, "ID")).first()
    # The strata digit and ethnic code are cut to their ID widths before they are read.
    assert (got.ID, got.ST, got.KET, got.G3, got.RIN_STRATA, got.NG) == ("01111001", 1, 1100, 1, 1, 1)


def test_responding_counts_with_hot_key(spark):
    df = spark.range(3000).select(F.lit(1).alias("NG"), F.lit(2).alias("RIN_STRATA"), F.greatest(F.col("id") - 1000, F.lit(0)).alias("k"))
    assert rows(cells.responding_counts(df, ["k"])) == [(1, 2, 2000, 1000)]


def test_weighted_cells_drop_null_keys(spark):
    df = spark.createDataFrame([(1, 1, 2.5), (1, None, 9.0), (1, 1, None)], "NG int, G int, w double")
    assert rows(cells.weighted_cells(df, ["NG", "G"], "w")) == [(1, 1, 2.5)]


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([(1, 1, 2.5), (1, 2, 1.0), (2, 2, 4.0)], "NG int, CIT int, w double")
    wide = cells.pivot_sum(df, ["NG"], "CIT", [1, 2], "w")
    assert rows(wide) == [(1, 2.5, 1.0), (2, None, 4.0)]
    long = cells.unpivot_values(wide, ["NG"], ["1", "2"], "CIT", "w").filter("w is not null")
    assert rows(long) == [(1, "1", 2.5), (1, "2", 1.0), (2, "2", 4.0)]


def test_design_weight_leaves_out_silent_states(spark):
    frame = spark.createDataFrame([(1, 1, 10.0), (1, 2, 6.0), (2, 1, 5.0)], "NG long, RIN_STRATA int, BIL_ISI_RUMAH double")
    counts = spark.createDataFrame([(1, 1, 3, 0)], "NG long, RIN_STRATA int, responding long, repeats long")
    got = rows(weights.design_weight(frame, counts), "NG", "RIN_STRATA", "responding", "ADJUSTED_WEIGHT")
    assert got == [(1, 1, 3, 3.33), (1, 2, 0, None)]
    # A state that responds only in a stratum outside the frame still responds.
    elsewhere = spark.createDataFrame([(2, 2, 4, 0)], "NG long, RIN_STRATA int, responding long, repeats long")
    got = rows(weights.design_weight(frame, elsewhere), "NG", "RIN_STRATA", "responding", "ADJUSTED_WEIGHT")
    assert got == [(2, 1, 0, None)]


def test_calibrate_options(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (3, 4.0), (None, 1.0)], "g int, w double")
    controls = spark.createDataFrame([(1, "1,000"), (2, "50")], "g int, c string")
    done = weights.calibrate(df, controls, ["g"], weight="w", final="f", control="c")
    assert rows(done, "g", "w", "f") == [(1, 2.0, 400.0), (1, 3.0, 600.0), (2, None, None), (3, 4.0, None), (None, 1.0, None)]
    kept = weights.calibrate(df, controls, ["g"], weight="w", final="f", control="c", keep_unmatched_controls=False)
    assert kept.count() == 4


def test_factor_without_sample_documented(spark):
    pop = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 4.0)], "k int, POPULATION double")
    sample = spark.createDataFrame([(1, 4.0), (3, 0.0)], "k int, SAMPLE double")
    assert rows(weights.population_factor(pop, sample, ["k"]), "k", "POPFAC") == [(1, 2.5), (2, 0.0), (3, 0.0)]
    assert rows(weights.population_factor(pop, sample, ["k"], missing=None), "k", "POPFAC") == [(1, 2.5)]


def test_transfer_tiers(spark):
    donors = spark.createDataFrame(
        [("i1", "ANN", 1.0, 0), ("i1", "ANN", 9.0, 1), ("i2", "BOB", None, 2), (None, "CAT", 3.0, 3), ("i4", None, 4.0, 4)],
        "ID_38 string, NAMA string, PEMBERATFINAL double, _ord long",
    )
    target = spark.createDataFrame(
        [(1, "i1", "BOB", 0.5), (2, "i2", "ANN", 0.5), (3, "x", "CAT", 0.5), (4, "x", "DAN", 0.5), (5, None, None, 0.5), (6, "i4", "ANN", None)],
        "n int, ID_38 string, NAMA string, PEMBERATFINAL double",
    )
    done = transfer.transfer_weight(target, donors)
    got = rows(done, "n", "PEMBERATFINAL", "MATCH")
    assert got == [(1, 1.0, "id"), (2, None, "id"), (3, 3.0, "name"), (4, 0.5, "none"), (5, 0.5, "none"), (6, 4.0, "id")]
    assert rows(transfer.unmatched_report(done, ["n"])) == [(4,), (5,)]
    fresh = transfer.transfer_weight(target.drop("PEMBERATFINAL"), donors)
    assert rows(fresh.filter("MATCH = 'none'"), "PEMBERATFINAL") == [(None,), (None,)]


def test_transfer_equals_row_loop(spark):
    """Against the plain loop over target rows: first donor by ID, else first by name; a third of the names are one name."""
    donors = [(f"i{n % 70}", f"n{n % 40}" if n % 3 else "HOT", None if n % 11 == 0 else float(n), n) for n in range(120)]
    target = [(n, f"i{n}", f"n{n % 55}" if n % 3 else "HOT") for n in range(200)]
    expected = []
    for n, key, name in target:
        hit = next((d for d in donors if d[0] == key), None) or next((d for d in donors if d[1] == name), None)
        expected.append((n, hit[2] if hit else None))
    done = transfer.transfer_weight(
        spark.createDataFrame(target, "n int, ID_38 string, NAMA string").repartition(3),
        spark.createDataFrame(donors, "ID_38 string, NAMA string, PEMBERATFINAL double, _ord int").repartition(5),
    )
    assert rows(done, "n", "PEMBERATFINAL") == expected


def test_section_lookup_keeps_raw_rows_and_places(spark):
    raw = spark.createDataFrame(
        [(1, None, None, "00101", "5"), (2, "old", None, "x", None)], "n int, SECTION string, SECTION_SMPL string, MSIC2008 string, MSIC2008_SMPL string"
    )
    table = spark.createDataFrame([("101", "A"), ("5", "C"), ("101", "B")], "`without '0'` string, SECTION string")
    done = lookups.lookup_section(raw, table, {"MSIC2008": "SECTION", "MSIC2008_SMPL": "SECTION_SMPL"})
    assert done.columns == raw.columns
    assert rows(done, "n", "SECTION", "SECTION_SMPL") == [(1, "A", "C"), (2, None, None)]


def test_sample_lookup(spark):
    raw = spark.createDataFrame([("1", "mine"), ("2", "kept"), (None, "kept")], "NEWSSID string, TRADING_NAME string")
    sample = spark.createDataFrame([("1", "Reg", "Trade")], "NEWSSID string, REGISTERED_NAME string, TRADING_NAME string")
    got = rows(lookups.lookup_sample(raw, sample), "NEWSSID", "REGISTERED_NAME", "TRADING_NAME")
    assert got == [("1", "Reg", "Trade"), ("2", None, "kept"), (None, None, "kept")]


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 200)], "id int, v int")
    checks = {"negative": "v < 0", "missing": "v is null", "large": "v > 100 or v < 0"}
    flagged = rules.flag_errors(df, checks)
    assert rows(flagged, "id", "ERRORS", "IND_STATUS") == [(1, [], 0), (2, ["missing"], 1), (3, ["negative", "large"], 1), (4, ["large"], 1)]
    good, bad = rules.split_errors(flagged)
    assert (good.count(), bad.count()) == (1, 3)
    assert rows(rules.rule_report(df, checks)) == [("large", 2, 4), ("missing", 1, 4), ("negative", 1, 4)]
    long = spark.createDataFrame([("A", 1), ("Z", 2), (None, 3)], "variable string, v int")
    assert rows(rules.drop_variable(long), "v") == [(1,), (3,)]


def test_versions(spark):
    df = spark.createDataFrame([(202101, 1, "a"), (202101, 2, "b"), (202102, 1, "c"), (202103, 4, "d"), (202103, 4, "e")], "period int, version int, v string")
    assert rows(versions.retain_periods(df), "v") == [("b",), ("c",), ("d",), ("e",)]
    assert rows(versions.retain_periods(df, newest=2), "v") == [("c",), ("d",), ("e",)]


def test_time_series_round_trip(spark):
    df = spark.createDataFrame([("a", "Q1", 1), ("a", "Q2", 2), ("b", "Q2", 5)], "k string, period string, v int")
    wide = versions.to_time_series(df, ["k"], "period", ["Q1", "Q2", "Q3"], "v")
    assert rows(wide) == [("a", 1, 2, None), ("b", None, 5, None)]
    assert rows(versions.from_time_series(wide, ["k"], "period", "v")) == [("a", "Q1", 1), ("a", "Q2", 2), ("b", "Q2", 5)]
    assert versions.from_time_series(wide, ["k"], "period", "v", keep_null=True).count() == 6


def test_totals_summed_in_the_row_equal_long_ones(spark):
    df = spark.createDataFrame(
        [(1, 1, 2, 3, 4, 9), (1, 5, None, 7, 8, 9), (2, 1, 1, 1, 1, 9)], "id int, L23104F01011 int, L23104F01012 int, M23104F01011 int, M23104F01012 int, Q23104F01010 int"
    )
    long = measures.to_long(df, ["id"], 1)
    assert rows(measures.row_total_long(df, ["id"], ["L", "M"], "Q", 1)) == rows(measures.long_row_total(long, ["id"], ["L", "M"], "Q"))
    assert rows(measures.category_total_long(df, ["id"], 1)) == rows(measures.long_category_total(long, ["id"]))


@pytest.mark.parametrize("total", ["row", "category"])
def test_long_totals_shuffle_one_row_per_id(spark, total):
    """Labels become rows after the shuffle, which would carry a row per id and label otherwise."""
    schema = "id long, value_id string, L23104F01011 string, L23104F01012 string, M23104F01011 string, M23105F01012 string, M23104F01010 string"
    data = [(1, "a", "2", "3.9", "4", None, "9"), (1, "a", "2", "3.9", "4", None, "9"), (1, None, None, "x", "", "7", "9"), (None, None, "5", "-1", None, "1", "9")]
    df = spark.createDataFrame(data, schema)
    parts = [["L", "M"], "Q"] if total == "row" else []
    wide_form, long_form = (getattr(measures, n) for n in (f"{total}_total_long", f"long_{total}_total"))
    for ids in (["id", "value_id"], ["id"], []):
        for table in (df, df.limit(0)):
            got, want = wide_form(table, ids, *parts, 2), long_form(measures.to_long(table, ids, 2), ids, *parts)
            assert (got.columns, rows(got)) == (want.columns, rows(want))
    got = wide_form(df, ["id", "value_id"], *parts, 2)
    sums = rows(got.filter("value_id = 'a'"), "variable", "period", "category", "value")
    if total == "row":
        assert sums == [("Q", "23104", "0", 18), ("Q", "23104", "1", 12), ("Q", "23104", "2", 6), ("Q", "23105", "2", 0)]
    else:
        assert sums == [("L", "23104", "0", 10), ("M", "23104", "0", 8), ("M", "23105", "0", 0)]
    above, below = got._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)
    assert "Generate" in above and "Generate" not in below
