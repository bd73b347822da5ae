import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave import config
from tallyweave import functions as fn


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).coalesce(1).select(*columns).collect()]


def test_fixed_width_pads_and_keeps_the_left(spark):
    got = values(spark, [("7",), ("12345",), (None,), ("",)], "a string", fn.fixed_width("a", 4))
    assert got == [("0007",), ("1234",), (None,), ("0000",)]


def test_id_widths_add_up():
    assert sum(config.ID_WIDTHS.values()) == 38
    assert set(config.RESPONSE_FIELDS) <= set(config.ID_WIDTHS)


def test_composite_id_null_field_gives_null(spark):
    got = values(spark, [("1", "2"), (None, "2")], "a string, b string", fn.composite_id({"a": 2, "b": 3}))
    assert got == [("01002",), (None,)]


def test_to_number_and_int(spark):
    data = [("3.7",), (" -2 ",), ("1e3",), ("x",), (None,), ("",), ("1d",), ("NaN",), ("Infinity",), ("1,000",)]
    got = values(spark, data, "a string", fn.to_number("a"), fn.to_int("a"))
    assert got == [(3.7, 3), (-2.0, -2), (1000.0, 1000)] + [(None, 0)] * 7


@pytest.mark.parametrize("digits", [0, 2])
def test_round_half_even_equals_numpy(spark, digits):
    numbers = [0.125, 0.375, 2.5, 3.5, -2.5, 1.005, 1.015, 0.285, 2.675, 1e9 + 0.125, 0.0, -0.125]
    got = [r[0] for r in values(spark, [(x,) for x in numbers], "a double", fn.round_half_even("a", digits))]
    assert got == [float(np.round(x, digits)) for x in numbers]


def test_safe_ratio(spark):
    got = values(spark, [(1.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double", fn.safe_ratio("a", "b"))
    assert got == [(0.5,), (None,), (None,)]


def test_text_clean_up(spark):
    data = [("1,234.5", "9.0", "1.2.", " abc ")]
    got = values(
        spark, data, "a string, b string, c string, d string",
        fn.strip_commas("a"), fn.strip_point_zero("b"), fn.strip_dots("c"), fn.upper_trim("d"), fn.pair_key("b", F.lit("2")),
    )
    assert got == [(1234.5, "9", 12, "ABC", "92")]


def test_pad_code(spark):
    got = values(spark, [("",), ("0",), ("7",), ("123",), (None,)], "a string", fn.pad_code("a", 2))
    assert got == [("",), ("0",), ("07",), ("123",), (None,)]


def test_id_text(spark):
    data = [("12.0",), (" 7 ",), ("A12",), (None,), ("99999999999999999999",)]
    assert values(spark, data, "a string", fn.id_text("a")) == [("12",), ("7",), ("A12",), ("",), ("99999999999999999999",)]
    assert values(spark, data, "a string", fn.id_text("a", config.LITERAL)) == [("",)] * 5
    assert values(spark, [(12.0,), (None,)], "a double", fn.id_text("a", is_text=False)) == [("12",), ("",)]


def test_factor_or_one(spark):
    data = [("2.5", None), (None, "0"), (None, None), ("", None)]
    assert values(spark, data, "a string, b string", fn.factor_or_one(fn.first_present("a", "b"))) == [(2.5,), (0.0,), (1.0,), (1.0,)]


def test_age_bands_at_the_edges(spark):
    ages = [-1, 0, 4, 5, 84, 85, 129, 130]
    got = values(spark, [(a,) for a in ages], "a long", fn.age_band_5("a"), fn.age_band_10("a"))
    assert got == [(None, None), (1, 1), (1, 1), (2, 1), (17, 9), (18, 9), (18, 13), (18, None)]


def test_code_groups(spark):
    codes = [1100, 3210, 2114, 2117, 3110, 3150, 3220, 4140, 4110, 4260, 3998, 5998, 6180, 9998, 9999, 0]
    got = values(
        spark, [(c,) for c in codes], "a long",
        *[fn.code_group("a", g) for g in (config.GROUPS_PENINSULAR, config.GROUPS_SABAH, config.GROUPS_SARAWAK)],
    )
    expected = {
        1100: (1, 1, 1), 3210: (1, 1, 1), 2114: (2, 5, 5), 2117: (None,) * 3, 3110: (2, 3, 5), 3150: (2, 2, 5), 3220: (2, 4, 5),
        4140: (2, 5, 2), 4110: (2, 5, 3), 4260: (2, 5, 4), 3998: (2, 5, 5), 5998: (3, 6, 6), 6180: (4, 7, 7), 9998: (5, 7, 7),
        9999: (None,) * 3, 0: (None,) * 3,
    }
    assert got == [expected[c] for c in codes]


def test_code_sets_do_not_overlap():
    for groups in (config.GROUPS_PENINSULAR, config.GROUPS_SABAH, config.GROUPS_SARAWAK):
        codes = [c for group in groups.values() for c in group]
        assert len(codes) == len(set(codes))
        assert set(codes) == {c for g in config.GROUPS_PENINSULAR.values() for c in g}


def test_binary_and_strata(spark):
    assert values(spark, [(458,), (100,), (None,)], "a long", fn.binary_code("a")) == [(1,), (2,), (2,)]
    got = values(spark, [(x,) for x in (-1, 0, 1, 2, 3, 9, 10)], "a long", fn.urban_rural("a"))
    assert got == [(None,), (2,), (1,), (1,), (2,), (2,), (None,)]


def test_size_stratum(spark):
    sizes = [0.0, 4.0, 4.5, 5.0, 29.0, 30.0, 30.5, 74.0, 75.0, 76.0, 200.0, 201.0, None]
    data = [(s, n) for s in ("C", "G", None) for n in sizes]
    got = values(spark, data, "s string, n double", "s", fn.size_stratum("s", "n"), fn.size_stratum("s", "n", semantics=config.LITERAL))
    c = [4, 4, 4, 3, 3, 3, None, 3, 2, 2, 2, 1, None]
    other = [4, 4, 4, 3, 3, 2, None, 2, 2, 1, 1, 1, None]
    assert [g[1] for g in got] == c + other + other
    assert [g[2] for g in got] == [None] * len(c) + other + other


def test_label_code(spark):
    assert values(spark, [("MALE",), ("FEMALE",), ("?",)], "a string", fn.label_code("a", {"MALE": 1, "FEMALE": 2})) == [(1,), (2,), (None,)]


def test_periods(spark):
    months = spark.range(1, 13).select(F.col("id").alias("m"), fn.quarter_of_month("id").alias("q"), fn.half_of_month("id").alias("h"))
    assert rows(months) == [(m, (m + 2) // 3, 1 if m <= 6 else 2) for m in range(1, 13)]
    with pytest.raises(Exception, match="month must lie between 1 and 12, got 13"):
        spark.range(13, 14).select(fn.quarter_of_month("id")).collect()


def test_exact_sum_ignores_row_order(spark):
    df = spark.range(1000).select((F.col("id") / 100).alias("a"))
    sums = {df.repartition(n).agg(fn.exact_sum("a", 2)).first()[0] for n in (1, 3, 7)}
    assert sums == {4995.0}


def test_name_parts(spark):
    got = values(spark, [("L23204F01011",)], "a string", fn.name_part("a", 1, 6), fn.digit_runs("a"))
    assert got == [("L23204", [23204, 1011])]
