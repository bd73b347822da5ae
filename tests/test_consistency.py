import pytest
from conftest import rows

from tallyweave.operators.consistency import RULE_SCHEMA, check_rules


@pytest.fixture(scope="module")
def tables(spark):
    sales = [(1, "a", 2020, 5), (2, "a", 2021, 9), (3, "b", 2020, 1), (4, "b", 2023, 1), (5, None, 2020, None), (5, None, 2021, 50)]
    shops = [("a", 14), ("c", 1), ("c", 2)]
    return {
        "sales": spark.createDataFrame(sales, "id int, shop string, year int, n int"),
        "shops": spark.createDataFrame(shops, "name string, total int"),
    }


def checked(spark, tables, *rules):
    return check_rules(spark.createDataFrame([r + (None,) * (10 - len(r)) for r in rules], RULE_SCHEMA), tables)


def test_all_kinds(spark, tables):
    done = checked(
        spark,
        tables,
        ("row", "row", "sales", "id", "n > 8"),
        ("group", "group", "sales", "shop", "value > 10 and n = 2", "sum(n)"),
        ("missing", "reference", "sales", "shop", None, None, None, "shops", "name"),
        ("total", "reference", "sales", "shop", "value <> other", "sum(n)", None, "shops", "name", "max(total)"),
        ("unused", "reference", "shops", "name", None, None, None, "sales", "shop"),
        ("growth", "period", "sales", "shop", "value > previous or gap > 1", "sum(n)", "year"),
        ("quiet", "row", "shops", "name", "total > 99"),
    )
    assert rows(done.violations) == [
        ("group", "group", "shop=a", None, 14.0, None, 2),
        ("group", "group", "shop=null", None, 50.0, None, 2),
        ("growth", "period", "shop=a", 2021, 9.0, 5.0, 1),
        ("growth", "period", "shop=b", 2023, 1.0, 1.0, 1),
        ("missing", "reference", "shop=b", None, None, None, 2),
        ("row", "row", "id=2", None, None, None, 1),
        ("row", "row", "id=5", None, None, None, 1),
        ("unused", "reference", "name=c", None, None, None, 2),
    ]
    assert rows(done.report) == [
        ("group", "group", 3, 2),
        ("growth", "period", 6, 2),
        ("missing", "reference", 2, 1),
        ("quiet", "row", 3, 0),
        ("row", "row", 6, 2),
        ("total", "reference", 2, 0),
        ("unused", "reference", 2, 1),
    ]


def test_rules_of_one_key_count_their_own_rows(spark, tables):
    done = checked(spark, tables, ("a", "row", "sales", "id", "n > 8"), ("b", "row", "sales", "id", "year >= 2020 and id = 5"), ("c", "row", "sales", "shop", "n < 6"))
    assert rows(done.violations, "rule", "key", "rows") == [("a", "id=2", 1), ("a", "id=5", 1), ("b", "id=5", 2), ("c", "shop=a", 1), ("c", "shop=b", 2)]


def test_bad_rules_are_refused_together(spark, tables):
    with pytest.raises(ValueError) as error:
        checked(spark, tables, ("a", "odd", "sales", "id", "n > 1"), ("b", "row", "nowhere", "id", "n > 1"), ("c", "period", "sales", "id", "value > 1"), ("d", "row", "sales", "", "n > 1"), ("d", "group", "sales", "id", None))
    for part in ("a: unknown kind 'odd'", "b: unknown table 'nowhere'", "c: a period rule needs", "d: no keys", "d: no condition", "d: named twice"):
        assert part in str(error.value)


def test_no_rules_and_no_rows(spark, tables):
    done = checked(spark, tables)
    assert done.violations.count() == 0 and done.report.count() == 0
    empty = {name: df.limit(0) for name, df in tables.items()}
    done = checked(spark, empty, ("row", "row", "sales", "id", "n > 8"), ("gap", "period", "sales", "shop", "gap > 1", "count(1)", "year"))
    assert done.violations.count() == 0 and rows(done.report) == [("gap", "period", 0, 0), ("row", "row", 0, 0)]


def test_each_table_is_read_once(spark, tables, tmp_path):
    """All kinds of rules over one table add no scan of it."""
    tables["sales"].write.parquet(f"{tmp_path}/sales")
    source = spark.read.parquet(f"{tmp_path}/sales")
    from tallyweave.operators import consistency

    seen = []
    real = consistency.stage
    try:
        consistency.stage = lambda df, label: (seen.append((label, df._jdf.queryExecution().executedPlan().toString())), real(df, label))[1]
        checked(
            spark,
            {"sales": source},
            ("row", "row", "sales", "id", "n > 8"),
            ("group", "group", "sales", "shop", "value > 10", "sum(n)"),
            ("again", "reference", "sales", "shop", None, None, None, "sales", "id"),
            ("growth", "period", "sales", "shop", "gap > 1", "sum(n)", "year"),
        ).violations.collect()
    finally:
        consistency.stage = real
    scans = {label: text.count(f"{tmp_path}/sales") for label, text in seen}
    assert scans["groups-sales"] == 1 and sum(scans.values()) == 1
