import household_fixture as fx
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators import cells, dedupe, weights
from tallyweave.plans import prepare_household, roll_up, weight_household
from tallyweave.plans.household import with_cell_group


@pytest.fixture(scope="module")
def base(spark):
    return weight_household(fx.raw(spark), *fx.templates(spark))


def finals(result):
    out = result.microdata.select("ID", "PEMBERAT_1", "WEIGHT_POP", "PEMBERAT_FINAL").collect()
    return {r.ID: tuple(r)[1:] for r in out}


def test_worked_example(base):
    assert finals(base) == fx.EXPECTED


def test_worked_example_literal(spark):
    # The non-citizen of group 5 meets no factor row, which calibration evens out.
    got = finals(weight_household(fx.raw(spark), *fx.templates(spark), semantics="literal"))
    assert got == fx.EXPECTED | {"d": (25.0, 4.0, 100.0)}


def test_first_marks_and_ids(base):
    out = base.microdata
    marks = {r.ID: r.PF_OUTPUT for r in out.collect()}
    assert marks == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 2, "f": 1, "g": 1}
    assert {r.n for r in out.select(F.length("NOID_38").alias("n")).collect()} == {38}


def test_control_without_sample_survives(spark):
    extra = [(2, "Kedah", "1,234", 1)]
    done = weight_household(fx.raw(spark), *fx.templates(spark, extra))
    lone = done.microdata.filter("ID is null").collect()
    assert len(lone) == 1
    assert (lone[0].NG, lone[0].CIT_NONCIT, lone[0]["ANGGARAN_PENDUDUK(BPPD)"], lone[0].PEMBERAT_FINAL) == (2, 1, 1234.0, None)
    dropped = weight_household(fx.raw(spark), *fx.templates(spark, extra), keep_unmatched_controls=False)
    assert dropped.microdata.count() == 7


def test_totals_equal_controls_and_order_is_irrelevant(spark, base):
    first = base.microdata
    shuffled = fx.raw(spark).repartition(7).orderBy(F.desc("_ord"))
    second = weight_household(shuffled, *fx.templates(spark)).microdata
    assert rows(first) == rows(second)
    totals = first.groupBy("CIT_NONCIT").agg(F.sum("PEMBERAT_FINAL")).collect()
    assert {tuple(r) for r in totals} == {(1, 570.0), (2, 100.0)}


def test_quality_tables(spark):
    people = [*fx.PEOPLE, ("h", "7", "9", "x", None, "1100", "1")]
    q = weight_household(fx.raw(spark, people), *fx.templates(spark)).quality
    assert rows(q["weight_discrepancies"], "RIN_STRATA", "SEMAKAN_AW_BMP") == [(2, -10.5)]
    assert rows(q["strata_without_weight"]) == [(1, 2, 9, 1)]
    assert rows(q["imputed"]) == [("KET", 0), ("KW", 1), ("ST", 0), ("U", 1)]
    assert rows(q["id_lengths"]) == [(38, 8)]


def test_operator_chain_equals_plan(spark, base):
    """The plan works on counted combinations; the operators one by one work on records."""
    people = with_cell_group(prepare_household(fx.raw(spark)))
    frame = fx.households(spark).withColumnRenamed("KOD_NEGERI", "NG")
    design = weights.design_weight(frame, cells.responding_counts(people))
    weighed = weights.attach_weight(people, weights.spread_weight(design, fx.crosswalk(spark)))
    sample = cells.weighted_cells(weighed, cells.CELL, "ADJUSTED_WEIGHT")
    assert rows(sample, "KU_5", "J", "GRP", "SAMPLE") == [(1, 1, 1, 105.0), (2, 2, 1, 25.0), (9, 1, 0, 25.0), (18, 2, 4, 30.0)]
    factors = weights.population_factor(cells.population_cells(fx.population(spark)), sample)
    assert rows(factors.filter("POPFAC > 0"), "KU_5", "POPFAC") == [(1, 2.0), (2, 1.2), (9, 2.0), (18, 1.5)]
    assert factors.filter("POPFAC = 0").count() == 18 * 2 * 6 - 4
    first = weights.first_weight(weights.attach_factor(weighed, weights.factor_keys(factors)))
    done = weights.calibrate(first, fx.controls(spark).withColumn("NG", F.col("NG").cast("long")), ["NG", "CIT_NONCIT"])
    got = {r.ID: (r.PEMBERAT_1, r.WEIGHT_POP, r.PEMBERAT_FINAL) for r in done.collect()}
    assert got == fx.EXPECTED
    assert rows(base.microdata, "ID", "PEMBERAT_FINAL") == rows(done, "ID", "PEMBERAT_FINAL")


def test_zero_factor_stays_zero_and_stranger_gets_one(spark):
    # Band 3 is in the population template without people: factor 0. A negative age has no band: factor 1.
    people = [*fx.PEOPLE, ("z", "8", "1", "12", "458", "1100", "1"), ("n", "9", "1", "-1", "458", "1100", "1")]
    out = weight_household(fx.raw(spark, people), *fx.templates(spark)).microdata
    got = {r.ID: r.POPFAC for r in out.filter("ID in ('z', 'n')").collect()}
    assert got == {"z": 0.0, "n": 1.0}


def test_empty_stratum_has_no_weight(spark):
    people = [p for p in fx.PEOPLE if p[2] != "3"]
    done = weight_household(fx.raw(spark, people), *fx.templates(spark))
    assert rows(done.quality["design_weights"], "RIN_STRATA", "responding", "ADJUSTED_WEIGHT") == [(1, 4, 25.0), (2, 0, None)]


def test_blank_cells_are_shared(spark):
    cell = spark.createDataFrame(
        [(1, 1, 1, 1, 100.0, 10.0), (1, 1, 1, 2, 60.0, 5.0), (1, 1, 1, 3, 40.0, None),
         (1, 1, 2, 1, 1000.0, 9.0), (1, 1, 2, 2, 5.0, None)],
        "NG int, J int, KU_5 int, GRP int, POPULATION double, SAMPLE double",
    )
    got = rows(weights.redistribute_blank(cell), "KU_5", "GRP", "POPULATION_ADJUSTED")
    # Block 1: a = 40, c = 160 -> 100 + 25, 60 + 15. Block 2: a/b below 1 % -> unchanged.
    assert got == [(1, 1, 125.0), (1, 2, 75.0), (1, 3, 40.0), (2, 1, 1000.0), (2, 2, 5.0)]


def test_share_blank_cells_option(spark):
    done = weight_household(fx.raw(spark), *fx.templates(spark), share_blank_cells=True)
    totals = done.microdata.groupBy("CIT_NONCIT").agg(F.sum("PEMBERAT_FINAL")).collect()
    assert {tuple(r) for r in totals} == {(1, 570.0), (2, 100.0)}


def test_roll_up_orders_by_period(spark):
    def final(people, month):
        df = fx.raw(spark, people).withColumnsRenamed({"_ord": "src", "Converted BP": "CONVERTED_BP"})
        return df.withColumns({"MONTHS": F.lit(month), "YEARS": F.lit(2021), "QUARTER": F.lit(1)})

    late, early = fx.PEOPLE[:4], fx.PEOPLE[4:]
    frames = {"A_late": final(late, 2), "B_early": final(early, 1).withColumn("EXTRA", F.lit("x"))}
    done = roll_up(frames, *fx.templates(spark), kind="quarterly", order="src")
    assert finals(done) == fx.EXPECTED
    marks = {r.ID: r.PF_OUTPUT for r in done.microdata.select("ID", "PF_OUTPUT").collect()}
    assert marks["e"] == 1 and marks["a"] == 2
    assert rows(done.quality["drift"]) == [("EXTRA", ["B_early"], ["A_late"])]
    assert rows(done.quality["tables"]) == [("quarterly", 2, 3)]
    shapes = {r.table: (r.rows, r.surplus) for r in done.quality["shapes"].collect()}
    assert shapes == {"A_late": (4, 1), "B_early": (3, 0)}


def test_wide_quality_tables(base):
    factors = base.quality["factors"]
    wide = cells.region_table(factors, "SEM", "POPFAC")
    assert wide.columns == ["NG", "KU_5", *[f"{j}_{g}" for j in (1, 2) for g in range(6)]]
    assert wide.count() == 18
    master = base.quality["master_sem"]
    assert master.columns[:4] == ["1_1", "1_1_SEM", "1_2", "1_2_SEM"] and len(master.columns) == 2 * 2 * 6 + 2
    assert rows(master.filter("KU_5 = 1"), "1_1", "1_1_SEM", "1_BW") == [(105.0, 210.0, None)]
    assert base.quality["master_sar"].count() == 0
    stacked = base.quality["factor_columns"]
    assert stacked.count() == 18 * 5
    assert rows(stacked.filter("KU_5 = 1 and block = 1"), "Male", "Female", "Non Citizen") == [(2.0, 0.0, 0.0)]


def test_hot_response_key_does_not_change_marks(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    marked = dedupe.mark_first(df, ["k"], "o", order_is_unique=True)
    assert rows(marked.groupBy("PF_OUTPUT").count()) == [(1, 2001), (2, 999)]
    assert dedupe.repeat_rows(df, ["k"], "o").count() == 999
    assert "Window" not in marked._jdf.queryExecution().toString()


def test_records_without_id_weigh_in_the_sample_only(spark):
    people = [*fx.PEOPLE, (None, "1", "1", "3", "458", "1100", "1")]
    done = weight_household(fx.raw(spark, people), *fx.templates(spark))
    out = done.microdata
    assert out.count() == 7
    assert rows(done.quality["unidentified"]) == [(1,)]
    # The record joins the first cell (sample 130 in place of 105): factor 210 / 130 = 1.62.
    factor = {r.ID: r.POPFAC for r in out.collect()}
    assert factor["a"] == 1.62
    totals = out.groupBy("CIT_NONCIT").agg(F.round(F.sum("PEMBERAT_FINAL"), 6)).collect()
    assert {tuple(r) for r in totals} == {(1, 570.0), (2, 100.0)}


def test_literal_strangers_need_citizens_in_their_band(spark, base):
    # The only non-citizen of band 9 shares its band with no citizen: no sample cell, hence factor 0 on the diagonal.
    people = [p if p[0] != "d" else ("d", "4", "2", "40", "100", "1100", "1") for p in fx.PEOPLE]
    literal = weight_household(fx.raw(spark, people), *fx.templates(spark), semantics="literal").microdata
    assert [r.POPFAC for r in literal.filter("ID = 'd'").collect()] == [0.0]
    assert [r.POPFAC for r in base.microdata.filter("ID = 'd'").collect()] == [2.0]
