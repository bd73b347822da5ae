import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators import measures
from tallyweave.plans import clean_establishments, transfer_individual_weights
from tallyweave.plans.establishments import clean_codes

MONTHS = ["04", "05", "06"]


def names(letters="DEFLMNOPQRX", digits="1290"):
    return [f"{v}232{m}F0101{d}" for v in letters for m in MONTHS for d in digits]


def wide(spark, rows_=3):
    columns = names()
    data = [
        (i, *[None if c[0] in "QX" or c[-1] == "0" else str((i + 1) * (n % 7) + 0.9) for n, c in enumerate(columns)])
        for i in range(rows_)
    ]
    return spark.createDataFrame(data, "NEWSSID int, " + ", ".join(f"{c} string" for c in columns))


def expected_totals(row):
    value = {c: int(float(row[c] or 0)) for c in names()}
    for m in MONTHS:
        for d in "1290":
            value[f"Q232{m}F0101{d}"] = sum(value[f"{v}232{m}F0101{d}"] for v in "LMNOP")
            value[f"X232{m}F0101{d}"] = sum(value[f"{v}232{m}F0101{d}"] for v in "DEF")
    for v in "DEFLMNOPQRX":
        for m in MONTHS:
            value[f"{v}232{m}F01010"] = sum(value[f"{v}232{m}F0101{d}"] for d in "129")
    return value


def test_totals_equal_plain_sums(spark):
    df = wide(spark)
    done, made_of = measures.establishment_totals(df, 1)
    assert done.columns == df.columns
    got = {r.NEWSSID: r.asDict() for r in done.collect()}
    for row in df.collect():
        want = expected_totals(row.asDict())
        assert {c: got[row.NEWSSID][c] for c in names()} == want
    assert set(made_of) == {c for c in names() if c[0] in "QX" or c[-1] == "0"}


def test_literal_leaves_variable_r(spark):
    done, made_of = measures.establishment_totals(wide(spark, 1), 1, "literal")
    assert not [c for c in made_of if c.startswith("R")]
    assert done.first()["R23204F01010"] is None


def test_long_totals_equal_wide_totals(spark):
    df = wide(spark)
    done, _ = measures.establishment_totals(df, 1)
    long = measures.to_long(df, ["NEWSSID"], 1)
    pay = measures.long_row_total(long, ["NEWSSID"], list("LMNOP"), "Q").filter("category <> '0'")
    flat = measures.to_long(done, ["NEWSSID"], 1).select("NEWSSID", "variable", "period", "category", "value")
    assert rows(pay) == rows(flat.filter("variable = 'Q' and category <> '0'"))
    totals = measures.long_category_total(long.filter("variable not in ('Q', 'X')"), ["NEWSSID"])
    assert rows(totals) == rows(flat.filter("category = '0' and variable not in ('Q', 'X')"))


def test_long_and_back(spark):
    df = wide(spark)
    back = measures.to_wide(measures.to_long(df, ["NEWSSID"], 1), ["NEWSSID"], names())
    assert back.columns == df.columns
    assert back.first()["L23204F01011"] is not None


def test_totals_do_not_shuffle(spark):
    done, _ = measures.establishment_totals(wide(spark), 1)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_measure_groups():
    groups = measures.measure_groups(["NEWSSID", "M23204F01", "L23204F01", "L23206F01", "Q23205F01"])
    assert groups == {"04": ["L23204", "M23204"], "05": ["Q23205"], "06": ["L23206"]}
    assert measures.measure_start(["a", "b", "L23204F0101"]) == 2


@pytest.mark.parametrize(("semantics", "msic", "r_total", "strata"), [("documented", "00101", 3, 3), ("literal", "", None, None)])
def test_clean_establishments(spark, semantics, msic, r_total, strata):
    columns = ["NEWSSID", "SECTION", "SECTION_SMPL", "MSIC2008", "MSIC2008_SMPL", "STATE_CODE", "SUBSTATE_CODE", "STRATA_EMPL", "B232F1310"]
    columns += [f"R23204F0101{d}" for d in "120"] + [f"L23204F0101{d}" for d in "120"] + [f"Q23204F0101{d}" for d in "120"]
    pairs = [(str(i), c.lower(), c) for i, c in enumerate(columns)]
    mapping = spark.createDataFrame(pairs[::-1], "`NEW_ORDER BY VAR` string, `ORI_EJOB HEADER` string, `NEW_DATASET HEADER` string")
    values = ["77", None, None, "101", "202", "1", "0", None, "74", "1", "2", "9", "4", "5", None, None, None, None, "extra"]
    raw = spark.createDataFrame([tuple(values)], ", ".join(f"{c.lower()} string" for c in [*columns, "more"]))
    industries = spark.createDataFrame([("101", "A"), ("202", "C")], "`without '0'` string, SECTION string")
    done, quality = clean_establishments(raw, mapping, industries, semantics=semantics)
    assert done.columns == columns
    row = done.first()
    assert (row.SECTION, row.SECTION_SMPL, row.STRATA_EMPL) == ("A", "C", strata)
    assert row.MSIC2008 == msic
    assert row.R23204F01010 == (r_total if r_total is not None else "9")
    assert (row.Q23204F01011, row.Q23204F01012, row.Q23204F01010, row.L23204F01010) == (4, 5, 9, 9)
    assert quality["totals"].filter("not matches").count() == 0
    assert ("more", None, "extra") in rows(quality["headers"])


def test_code_padding(spark):
    df = spark.createDataFrame([("77", "101", "1", "0"), ("", "123456", None, "10")], "NEWSSID string, MSIC2008 string, STATE_CODE string, SUBSTATE_CODE string")
    assert rows(clean_codes(df)) == [("", "123456", "", "10"), ("000000000077", "00101", "01", "0")]
    numeric = spark.createDataFrame([(77.0, 101)], "NEWSSID double, MSIC2008 int")
    assert rows(clean_codes(numeric, "literal")) == [("000000000077", "000000000101")]


def test_individual_weight_transfer(spark):
    fields = ["NG", "DP", "DB", "BP", "BP2", "Converted BP", "ST", "NOTK", "NOIR", "S", "NP", "PKIS", "HMIS", "J", "KET", "B"]
    schema = ", ".join(f"`{f}` string" for f in fields)

    def person(n):
        return [str(n)] + ["1"] * (len(fields) - 1)

    target = spark.createDataFrame(
        [(*person(1), " ann ", 0), (*person(2), "bob", 1), (*person(3), "zed", 2), (*person(1), "ann", 3)], schema + ", NAMA string, _ord long"
    )
    donors = spark.createDataFrame(
        [(*person(1), "someone", "1.5", 0), (*person(9), "BOB ", "2.5", 1), (*person(9), "bob", "9.5", 2)], schema + ", Nama string, PEMBERAT_FINAL string, _ord long"
    )
    done, quality = transfer_individual_weights(target, donors, month=3, year=2021)
    got = rows(done, "NG", "NAMA", "PEMBERATFINAL", "MATCH", "MONTHS", "YEARS")
    assert got == [
        ("01", "ANN", "1.5", "id", 3, 2021), ("01", "ANN", "1.5", "id", 3, 2021), ("02", "BOB", "2.5", "name", 3, 2021), ("03", "ZED", None, "none", 3, 2021),
    ]
    assert rows(quality["unmatched"], "NAMA", "YEARS") == [("ZED", 2021)]
    assert quality["duplicates"].count() == 1
    assert rows(quality["target_repeated_ids"].select(F.length("ID_38"), "rows")) == [(38, 2)]
    assert rows(quality["donor_repeated_ids"], "rows") == [(2,)]
