import pytest
from conftest import rows

from tallyweave.operators import headers, stacking


def frame(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"`{n}` int" for n in names))


def test_header_clean_ups(spark):
    df = frame(spark, " conv_bp ", "a (b)")
    assert headers.upper_headers(df).columns == ["CONV_BP", "A(B)"]
    assert headers.compact_headers(df).columns == ["CONVBP", "A(B)"]
    assert headers.compact_headers(df, keep_underscore=True).columns == ["CONV_BP", "A_(B)"]
    assert headers.plain_headers(df).columns == ["CONVBP", "AB"]


@pytest.mark.parametrize(
    ("name", "safe"), [("ANGGARAN_PENDUDUK(BPPD)", "ANGGARAN_PENDUDUKBPPD"), ("12_AB c", "ABc"), ("__A", "_A"), ("1A1", "A1")]
)
def test_sanitize_name(name, safe):
    assert headers.sanitize_name(name) == safe


def test_colliding_names_fail(spark):
    with pytest.raises(ValueError, match="collide"):
        headers.plain_headers(frame(spark, "a b", "a_b"))


def test_remap_orders_fills_and_drops(spark):
    mapping = spark.createDataFrame(
        [("2", "old a", "A"), ("10", "gone", "C"), ("1", "b", "B")],
        "`NEW_ORDER BY VAR` string, `ORI_EJOB HEADER` string, `NEW_DATASET HEADER` string",
    )
    pairs = headers.header_mapping(mapping)
    assert pairs == [("b", "B"), ("old a", "A"), ("gone", "C")]
    df = frame(spark, "old a", "b", "extra")
    assert rows(headers.remap_columns(df, pairs)) == [(1, 0, None)]
    assert headers.remap_columns(df, pairs).columns == ["B", "A", "C"]
    report = rows(headers.verify_headers(spark, df.columns, pairs))
    assert report == [("b", "B", "mapped"), ("extra", None, "extra"), ("gone", "C", "missing"), ("old a", "A", "mapped")]


def test_already_renamed_column_is_kept(spark):
    assert rows(headers.remap_columns(frame(spark, "A"), [("old", "A")])) == [(0,)]


def test_moves_prefixes_slices(spark):
    df = frame(spark, "a", "b", "c", "d")
    assert headers.move_columns(df, {"d": 0, "a": 2}).columns == ["d", "b", "a", "c"]
    assert headers.prefix_after(df, "b", "1").columns == ["a", "b", "1_c", "1_d"]
    assert headers.column_slice(df, "c", "d").columns == ["a", "b", "c", "d"]
    assert headers.column_slice(df, "d", "d").columns == ["a", "b", "d"]


def test_order_by_number(spark):
    df = frame(spark, "NG", "KU_5", "2_1_SEM", "1_1_SEM", "1_BW_SEM", "1_1", "1_BW", "2_1", "CIT_NONCIT")
    assert headers.order_by_number(df, "SEM").columns == [
        "1_1", "1_1_SEM", "1_BW", "1_BW_SEM", "2_1", "2_1_SEM", "NG", "KU_5",
    ]


def test_pick_columns(spark):
    df = frame(spark, "NEWSSID", "B23104F1310", "L23104F01011", "Q23104F01011")
    assert headers.pick_columns(df, contains="F1310") == ["B23104F1310"]
    assert headers.pick_columns(df, letters="LQ", start=2) == ["L23104F01011", "Q23104F01011"]
    assert headers.pick_columns(df, pattern=r"1011$") == ["L23104F01011", "Q23104F01011"]


def test_pivot_groups_keeps_absent_cells(spark):
    cells = spark.createDataFrame([(1, 1, 2, 5.0), (2, 2, 1, 7.0)], "NG int, J int, GRP int, v double")
    wide = headers.pivot_groups(cells, ["NG"], "v", [1, 2], [1, 2])
    assert wide.columns == ["NG", "1_1", "1_2", "2_1", "2_2"]
    assert rows(wide) == [(1, None, 5.0, None, None), (2, None, None, 7.0, None)]


def test_stack_and_drift(spark):
    frames = {"m1": frame(spark, "a", "b"), "m2": frame(spark, "b", "c"), "m3": frame(spark, "b")}
    stacked = stacking.stack(frames)
    assert stacked.columns == ["a", "b", "c"] and stacked.count() == 3
    assert dict(stacking.stack(frames, as_text=True).dtypes) == {"a": "string", "b": "string", "c": "string"}
    drift = rows(stacking.column_drift(spark, frames))
    assert drift == [("a", ["m1"], ["m2", "m3"]), ("c", ["m2"], ["m1", "m3"])]
    shapes = rows(stacking.shape_report(frames))
    assert shapes == [("m1", 1, 2, 1), ("m2", 1, 2, 1), ("m3", 1, 1, 2)]
