"""Worked example of the household weighting, small enough to check by hand."""

from tallyweave import config

PEOPLE = [
    # id, household, ST, U, KW, KET, J
    ("a", "1", "1", "3", "458", "1100", "1"),
    ("b", "2", "1", "7", "458", "1100", "2"),
    ("c", "3", "2", "3", "458", "1100", "1"),
    ("d", "4", "2", "40", "100", "9110", "1"),
    ("e", "1", "1", "3", "458", "1100", "1"),
    ("f", "5", "3", "3", "458", "1100", "1"),
    ("g", "6", "3", "90", "458", "6110", "2"),
]

EXPECTED = {
    # id: (PEMBERAT_1, WEIGHT_POP, PEMBERAT_FINAL)
    "a": (50.0, 2.0, 100.0),
    "b": (30.0, 2.0, 60.0),
    "c": (50.0, 2.0, 100.0),
    "d": (50.0, 2.0, 100.0),
    "e": (50.0, 2.0, 100.0),
    "f": (60.0, 2.0, 120.0),
    "g": (45.0, 2.0, 90.0),
}


def raw_rows(people=PEOPLE):
    rows = []
    for n, (pid, house, st, age, kw, ket, sex) in enumerate(people):
        base = {"ID": pid, "NG": "1", "DP": "1", "DB": "2", "BP": "3", "BP2": "4", "Converted BP": "5", "ST": st}
        base |= {"NOTK": house, "NOIR": "1", "S": "1", "NP": "1", "PKIS": "1", "HMIS": "1", "J": sex, "KET": ket, "B": "6"}
        base |= {"U": age, "KW": kw, "_ord": n}
        rows.append(base)
    return rows


def raw(spark, people=PEOPLE):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    data = raw_rows(people)
    schema = StructType(
        [StructField(c, LongType() if c == "_ord" else StringType()) for c in data[0]]
    )
    return spark.createDataFrame([tuple(r.values()) for r in data], schema)


def households(spark):
    return spark.createDataFrame(
        [(1, 1, 100.0, 25.0), (1, 2, 60.0, 30.5)],
        "KOD_NEGERI int, RIN_STRATA int, BIL_ISI_RUMAH double, ADJUSTED_WEIGHT_BMP double",
    )


def population(spark):
    filled = {
        (1, "MALE", "BPPD_MALAY"): 210.0,
        (2, "FEMALE", "BPPD_MALAY"): 30.0,
        (18, "FEMALE", "BPPD_INDIAN"): 45.0,
        (9, "MALE", "BPPD_BUKAN_WARGA"): 50.0,
    }
    columns = list(config.POPULATION_COLUMNS)
    rows = [
        (1, band, "Johor", "band", sex, *[filled.get((band, sex, c)) for c in columns])
        for band in range(1, 19)
        for sex in ("MALE", "FEMALE")
    ]
    schema = "KOD_NEGERI int, KU_5 int, NEGERI string, AGE_GROUP string, GENDER string, " + ", ".join(
        f"`{c}` double" for c in columns
    )
    return spark.createDataFrame(rows, schema)


def controls(spark, extra=()):
    return spark.createDataFrame(
        [(1, "Johor", "570", 1), (1, "Johor", "100", 2), *extra],
        "NG int, NEGERI string, `ANGGARAN_PENDUDUK(BPPD)` string, CIT_NONCIT int",
    )


def crosswalk(spark):
    rows = [(1, 1, 1), (1, 2, 1), (1, 3, 2), (1, 4, 2)]
    return spark.createDataFrame(rows, "NG int, ST int, RIN_STRATA int")


def templates(spark, extra_controls=()):
    return households(spark), population(spark), controls(spark, extra_controls), crosswalk(spark)
