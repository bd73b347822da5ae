"""Jobs from files to published tables."""

import csv

import household_fixture as fx
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.plans import control_period, run_establishments, run_individual, run_ingest, run_monthly, run_roll_up, run_running_roll_up
from tallyweave.sources import PeriodStore, compare_runs, ingest_finals, publish


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE published LOCATION '{tmp_path}/published'")
    yield "published"
    spark.sql("DROP DATABASE published CASCADE")


def dump(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, list(data[0]))
        writer.writeheader()
        writer.writerows(data)
    return str(path)


def dump_frame(path, df):
    return dump(path, [r.asDict() for r in df.collect()])


@pytest.fixture
def templates(spark, tmp_path):
    period = {"BULAN": F.lit(3), "TAHUN": F.lit(2021), "QUARTER": F.lit(1)}
    return {
        "households": dump_frame(tmp_path / "t01.csv", fx.households(spark).withColumns(period)),
        "population": dump_frame(tmp_path / "t02.csv", fx.population(spark)),
        "controls": dump_frame(tmp_path / "t03.csv", fx.controls(spark)),
        "crosswalk": dump_frame(tmp_path / "map.csv", fx.crosswalk(spark)),
    }


def people():
    return [{k: v for k, v in r.items() if k != "_ord"} for r in fx.raw_rows()]


def test_monthly_run(spark, tmp_path, templates, database):
    raw = dump(tmp_path / "raw" / "a.csv", people())
    name = run_monthly(spark, raw, **templates, database=database, quality_path=f"{tmp_path}/qc")
    assert name == "`published`.`JR4M3Y2021_FC`"
    done = spark.table(name)
    assert {"ANGGARAN_PENDUDUKBPPD", "KUARTER", "PF_INPUT"} <= set(done.columns)
    got = {r.ID: (r.PEMBERAT_1, r.WEIGHT_POP, r.PEMBERAT_FINAL) for r in done.collect()}
    assert got == fx.EXPECTED
    assert rows(done.select("BULAN", "TAHUN", "KUARTER").distinct()) == [(3, 2021, 1)]
    assert {r.PF_OUTPUT for r in done.filter("ID = 'e'").collect()} == {2}
    assert spark.read.parquet(f"{tmp_path}/qc/ratios").count() == 2


def test_roll_up_run_from_ingested_files(spark, tmp_path, templates, database):
    rows_ = people()
    dump(tmp_path / "finals" / "JR4M01Y2021_FINAL.csv", rows_[:3])
    dump(tmp_path / "finals" / "JR4M02Y2021_FINAL.csv", [r | {"EXTRA": "x"} for r in rows_[3:6]])
    dump(tmp_path / "finals" / "JR4M03Y2021_FINAL.csv", rows_[6:])
    dump(tmp_path / "finals" / "JR4M04Y2021_FINAL.csv", rows_)
    spark.sql(f"CREATE DATABASE finals_m LOCATION '{tmp_path}/finals_m'")
    try:
        for table, df in ingest_finals(spark, f"{tmp_path}/finals").items():
            publish(df, table, "finals_m")
        inputs = spark.createDataFrame([(2020, 4, 0), (2021, 1, None)], "year int, quarter int, seq int").withColumn(
            "seq", F.monotonically_increasing_id()
        )
        period = control_period(inputs, "seq")
        assert period == {"year": 2021, "quarter": 1}
        name = run_roll_up(spark, "quarterly", finals="finals_m", period=period, **templates, database=database)
        assert name.endswith("`JR4Q1Y2021_FC`")
        got = {r.ID: (r.PEMBERAT_1, r.WEIGHT_POP, r.PEMBERAT_FINAL) for r in spark.table(name).collect()}
        assert got == fx.EXPECTED
        with pytest.raises(ValueError, match="no table"):
            run_roll_up(spark, "annual", finals="finals_m", period={"year": 1999}, **templates, database=database)
    finally:
        spark.sql("DROP DATABASE finals_m CASCADE")


def test_running_roll_up_equals_the_stacked_one(spark, tmp_path, templates, database):
    """Month after month merged into the stored state; a revised month starts the merge anew."""
    rows_ = people()
    spark.sql(f"CREATE DATABASE finals_r LOCATION '{tmp_path}/finals_r'")
    spark.sql(f"CREATE DATABASE states_r LOCATION '{tmp_path}/states_r'")
    fixed = {"finals": "finals_r", "period": {"year": 2021, "quarter": 1}, "database": database, "record_id": "ID", **templates}

    def take_in(month, part):
        dump(tmp_path / f"finals{month}" / f"JR4M0{month}Y2021.csv", part)
        run_ingest(spark, f"{tmp_path}/finals{month}", database="finals_r")

    def weighted(run, **more):
        name = run(spark, "quarterly", **fixed, **more)
        found = {r.ID: (r.PF_OUTPUT, r.PEMBERAT_1, r.PEMBERAT_FINAL) for r in spark.table(name).collect()}
        spark.sql(f"DROP TABLE {name}")
        return found

    def running(**more):
        return weighted(run_running_roll_up, states="states_r", buckets=2, **more)

    try:
        take_in(1, rows_[:3])
        take_in(2, rows_[3:6])
        assert len(running()) == 6
        take_in(3, rows_[6:])
        # The state of January and February is not built again.
        before = spark.table("states_r.JR4M01Y2021_people").inputFiles()
        assert {k: v[1:] for k, v in running().items()} == {k: (v[0], v[2]) for k, v in fx.EXPECTED.items()}
        assert spark.table("states_r.JR4M01Y2021_people").inputFiles() == before
        spark.sql("DROP TABLE finals_r.JR4M02Y2021")
        take_in(2, rows_[3:5])
        revised = running(revised=["JR4M02Y2021"])
        assert "f" not in revised and revised == weighted(run_roll_up)
    finally:
        spark.sql("DROP DATABASE finals_r CASCADE")
        spark.sql("DROP DATABASE states_r CASCADE")


def test_quality_history_of_runs(spark, tmp_path, templates, database):
    raw = dump(tmp_path / "raw" / "a.csv", people())
    for run, part in (("first", raw), ("second", dump(tmp_path / "raw2" / "a.csv", people()[:4]))):
        name = run_monthly(spark, part, **templates, database=database, quality_path=f"{tmp_path}/qc", quality_run=run)
        spark.sql(f"DROP TABLE {name}")
    changes = compare_runs(spark, f"{tmp_path}/qc/factors", "first", "second", ["NG", "CIT_NONCIT", "KU_5", "J", "GRP"], ["POPFAC"])
    assert {r.status for r in changes.collect()} == {"changed"} and changes.count() >= 1
    assert (tmp_path / "qc" / "factors" / "run=first" / "NG=1").exists()


def test_individual_run(spark, tmp_path, database):
    donors = [r | {"NAMA": f"P{r['ID']}", "PEMBERAT_FINAL": str(i), "MONTHS": 3, "YEARS": 2021} for i, r in enumerate(people())]
    dump(tmp_path / "finals" / "JR4M03Y2021.csv", donors)
    dump(tmp_path / "raw" / "a.csv", [people()[1] | {"NAMA": "pz"}, people()[2] | {"NAMA": " pa ", "B": "9"}, people()[3] | {"NAMA": "q", "B": "9"}])
    spark.sql(f"CREATE DATABASE finals_i LOCATION '{tmp_path}/finals_i'")
    try:
        for table, df in ingest_finals(spark, f"{tmp_path}/finals").items():
            publish(df, table, "finals_i")
        name = run_individual(spark, f"{tmp_path}/raw/a.csv", finals="finals_i", period={"month": 3, "year": 2021}, database=database)
        got = rows(spark.table(name), "NAMA", "PEMBERATFINAL", "MATCH")
        assert got == [("PA", "0", "name"), ("PZ", "1", "id"), ("Q", None, "none")]
    finally:
        spark.sql("DROP DATABASE finals_i CASCADE")


def test_establishment_run(spark, tmp_path, database):
    columns = ["NEWSSID", "REGISTERED_NAME", "TRADING_NAME", "YEAR", "QUARTER", "SECTION", "SECTION_SMPL", "MSIC2008", "MSIC2008_SMPL"]
    columns += ["STATE_CODE", "SUBSTATE_CODE", "STRATA_EMPL", "B23104F1310", "L23104F01011", "L23104F01012", "L23104F01010"]
    columns += ["Q23104F01011", "Q23104F01012", "Q23104F01010"]
    preamble = "mapping\n\n\n\n\n"
    lines = "".join(f"{i},{c.lower()},{c}\n" for i, c in enumerate(columns))
    (tmp_path / "map.csv").write_text(preamble + "NEW_ORDER BY VAR,ORI_EJOB HEADER,NEW_DATASET HEADER\n" + lines)
    (tmp_path / "industry.csv").write_text("without '0',SECTION\n101,A\n202,C\n")
    (tmp_path / "sample.csv").write_text("NEWSSID,REGISTERED_NAME,TRADING_NAME\n77,Reg,Trade\n")
    body = "77,,,2023,1,,,101,202,1,3,,201,4,5,,,,\n88,own,,2023,1,,,,101,1,3,,3,1,x,,,,\n"
    (tmp_path / "raw.csv").write_text("title\n,,\n" + ",".join(c.lower() for c in columns) + "\n" + body)
    name = run_establishments(
        spark, f"{tmp_path}/raw.csv", mapping=f"{tmp_path}/map*.csv", industries=f"{tmp_path}/industry.csv",
        sample=f"{tmp_path}/sample*.csv", database=database,
    )
    assert name.endswith("`FRDQ1Y2023`")
    got = rows(spark.table(name), "NEWSSID", "REGISTERED_NAME", "SECTION", "SECTION_SMPL", "MSIC2008", "STRATA_EMPL", "Q23104F01010")
    store = PeriodStore(spark, f"{tmp_path}/store", ["YEAR", "QUARTER"])
    inputs = {"mapping": f"{tmp_path}/map*.csv", "industries": f"{tmp_path}/industry.csv", "sample": f"{tmp_path}/sample*.csv", "store": store}
    store.accept(run_establishments(spark, f"{tmp_path}/raw.csv", **inputs))
    (tmp_path / "revised.csv").write_text((tmp_path / "raw.csv").read_text().replace("own", "renamed"))
    revised = run_establishments(spark, f"{tmp_path}/revised.csv", **inputs)
    assert rows(store.current(), "REGISTERED_NAME") == [("Reg",), ("own",)]
    store.accept(revised)
    assert rows(store.current(), "REGISTERED_NAME") == [("Reg",), ("renamed",)]
    store.roll_back(YEAR=2023, QUARTER=1)
    assert rows(store.current(), "REGISTERED_NAME") == [("Reg",), ("own",)]
    assert got == [("000000000077", "Reg", "A", "C", "00101", 1, 9), ("000000000088", "own", None, "A", "", 4, 1)]


def test_monthly_outputs_roll_up_after_ingest(spark, tmp_path, templates, database):
    """The chain of jobs: weighted months written as finals, taken in, and weighted again as a quarter."""
    from tallyweave.plans import run_ingest
    from tallyweave.sources import write_csv

    rows_ = people()
    controls = [r | {"NG": "1"} for r in csv.DictReader(open(templates["controls"]))] + [{"NG": "2", "NEGERI": "Kedah", "ANGGARAN_PENDUDUK(BPPD)": "9", "CIT_NONCIT": "1"}]
    extra = templates | {"controls": dump(tmp_path / "t03_more.csv", controls)}
    for month, part in ((1, rows_[:3]), (2, rows_[3:])):
        raw = dump(tmp_path / f"raw{month}" / "a.csv", part)
        name = run_monthly(spark, raw, **extra, database=database)
        write_csv(spark.table(name), f"{tmp_path}/finals/JR4M0{month}Y2021.csv")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE DATABASE finals_c LOCATION '{tmp_path}/finals_c'")
    try:
        assert run_ingest(spark, f"{tmp_path}/finals", database="finals_c") == ["`finals_c`.`JR4M01Y2021`", "`finals_c`.`JR4M02Y2021`"]
        assert {"SRCFILE", "SRCBLOCK", "SRCROW"} <= set(spark.table("finals_c.JR4M01Y2021").columns)
        name = run_roll_up(spark, "quarterly", finals="finals_c", period={"year": 2021, "quarter": 1}, record_id="ID", **templates, database=database)
        got = {r.ID: (r.PEMBERAT_1, r.WEIGHT_POP, r.PEMBERAT_FINAL) for r in spark.table(name).collect()}
        assert got == fx.EXPECTED
    finally:
        spark.sql("DROP DATABASE finals_c CASCADE")


def test_repeated_template_keys_fail(spark):
    from tallyweave.plans import weight_household

    household, population, control, crosswalk = fx.templates(spark)
    for broken in ((household.union(household), population, control, crosswalk), (household, population, control.union(control), crosswalk), (household, population, control, crosswalk.union(crosswalk))):
        with pytest.raises(ValueError, match="rows with NG=1"):
            weight_household(fx.raw(spark), *broken)
