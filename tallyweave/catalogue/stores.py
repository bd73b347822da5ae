"""Versions, roll-forward of periods, retention, snapshots and intake by content over the driver tables."""

import uuid

from pyspark.sql import functions as F

from tallyweave.catalogue.jobs import _CELLS_SQL, _population
from tallyweave.catalogue.registry import query
from tallyweave.operators.audits import sole_values
from tallyweave.operators.cells import population_cells
from tallyweave.operators.headers import header_rows_report
from tallyweave.operators.versions import from_time_series, to_time_series
from tallyweave.session import run_folder, stage
from tallyweave.sources import PeriodStore, compare_runs, ingest_finals, write_csv, write_snapshot
from tallyweave.streaming import upsert_files


def _scratch(t, name: str) -> str:
    return f"{run_folder(t.spark)}/{uuid.uuid4().hex}/{name}"


def _yearly(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("years"), F.col("o_totalprice").alias("price"))


def _revised_store(t) -> PeriodStore:
    """All years accepted, then two revisions of each: the first for even years, the second for odd ones; 1997 is rolled back."""
    store = PeriodStore(t.spark, _scratch(t, "orders"), ["years"])
    store.accept(store.propose(_yearly(t)))
    double = store.propose(_yearly(t).withColumn("price", F.col("price") * 2))
    triple = store.propose(_yearly(t).withColumn("price", F.col("price") * 3))
    even = lambda rows: [r for r in rows if r["years"] % 2 == 0]
    odd = lambda rows: [r for r in rows if r["years"] % 2]
    store.accept(even(double) + odd(triple))
    store.reject(odd(double) + even(triple))
    store.roll_back(years=1997)
    return store


@query(
    "K8 A12",
    """
    select o_orderkey, year(o_orderdate)::bigint as years,
           case when year(o_orderdate) = 1997 then o_totalprice when year(o_orderdate) % 2 = 0 then o_totalprice * 2 else o_totalprice * 3 end as price
    from orders
    """,
)
def accepted_revisions(t):
    """Current rows after revisions of every year were accepted, rejected and one rolled back."""
    return _revised_store(t).current().select("o_orderkey", "years", "price")


@query(
    "K8",
    """
    with size as (select year(o_orderdate)::bigint as years, count(*) as rows from orders group by 1)
    select years, 1::bigint as version, case when years = 1997 then 'accepted' else 'superseded' end as state, rows from size
    union all select years, 2, case when years % 2 = 0 then 'accepted' else 'rejected' end, rows from size
    union all select years, 3, case when years = 1997 then 'withdrawn' when years % 2 = 0 then 'rejected' else 'accepted' end, rows from size
    """,
)
def version_states(t):
    """Every version of every year with its state."""
    return _revised_store(t).manifest().select("years", F.col("version").cast("long").alias("version"), "state", "rows")


@query(
    "K6 K5",
    """
    with quarters as (select o_orderpriority, year(o_orderdate)::bigint as years, quarter(o_orderdate)::bigint as quarter,
                             sum((o_totalprice * 100)::bigint)::bigint as total from orders group by all)
    select o_orderpriority, years, quarter, total + case when years = 1997 and quarter = 2 and o_orderpriority = '1-URGENT' then 5 else 0 end as total,
           case when years = 1997 and quarter = 2 then 2 else 1 end::bigint as version
    from quarters
    """,
)
def written_back_quarters(t):
    """A series with one revised value written back: only the quarter it lies in gets a new version."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    dated = t.orders.select("o_orderpriority", F.year("o_orderdate").alias("years"), F.quarter("o_orderdate").alias("quarter"), cents.alias("cents"))
    quarters = dated.groupBy("o_orderpriority", "years", "quarter").agg(F.sum("cents").alias("total"))
    store = PeriodStore(t.spark, _scratch(t, "quarters"), ["years", "quarter"])
    store.write_back(quarters)
    series = to_time_series(store.current().withColumn("yq", F.col("years") * 10 + F.col("quarter")), ["o_orderpriority"], "yq", None, "total")
    revised = series.withColumn("19972", F.col("19972") + F.when(F.col("o_orderpriority") == "1-URGENT", 5).otherwise(0))
    long = from_time_series(revised, ["o_orderpriority"], "yq", "total").withColumn("yq", F.col("yq").cast("long"))
    back = long.select("o_orderpriority", F.floor(F.col("yq") / 10).alias("years"), (F.col("yq") % 10).alias("quarter"), "total")
    store.write_back(back)
    versions = store.manifest().filter("state = 'accepted'").select("years", "quarter", F.col("version").cast("long").alias("version"))
    return store.current().join(versions, ["years", "quarter"]).select("o_orderpriority", "years", "quarter", "total", "version")


@query(
    "K7",
    """
    with newest as (select distinct year(o_orderdate) as y from orders order by y desc limit 3)
    select o_orderkey, year(o_orderdate)::bigint as years, case when year(o_orderdate) = (select max(y) from newest) then o_totalprice * 2 else o_totalprice end as price
    from orders where year(o_orderdate) in (select y from newest)
    """,
)
def retained_files(t):
    """What the files themselves hold once all but the newest three years, in their latest versions, were removed."""
    store = PeriodStore(t.spark, _scratch(t, "orders"), ["years"])
    store.write_back(_yearly(t))
    last = _yearly(t).agg(F.max("years").alias("years"))
    store.write_back(_yearly(t).join(last, "years").withColumn("price", F.col("price") * 2))
    store.retire(3)
    store.compact(64 << 20)
    store.sweep(grace=0)
    return t.spark.read.parquet(f"{store.path}/data").select("o_orderkey", F.col("years").cast("long").alias("years"), "price")


@query(
    "A15 K5",
    "select o_orderkey::varchar as o_orderkey, year(o_orderdate)::bigint as years, case when o_orderkey % 10 = 3 then 'revised' else o_orderpriority end as priority from orders",
)
def upserted_files(t):
    """Three intakes: a first part; a copy of it under other names with the rest; a revision of some rows."""
    folder, ledger, state = (_scratch(t, n) for n in ("incoming", "ledger", "state"))
    store = PeriodStore(t.spark, _scratch(t, "orders"), ["years"])
    columns = ["o_orderkey", "year", "priority"]
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority"))
    first = rows.filter("o_orderkey % 4 = 1")
    revised = rows.filter("o_orderkey % 10 = 3").withColumn("priority", F.lit("revised"))

    def intake():
        upsert_files(t.spark, folder, store, ledger, state, columns, ["o_orderkey"], {"years": F.col("year").cast("long")})

    write_csv(first, f"{folder}/a")
    intake()
    write_csv(first, f"{folder}/b")
    write_csv(rows.filter("o_orderkey % 4 <> 1"), f"{folder}/c")
    intake()
    write_csv(revised, f"{folder}/d")
    intake()
    return store.current().select("o_orderkey", "years", "priority")


@query(
    "A14",
    f"""
    with {_CELLS_SQL},
    changed as (select ng, ku_5, j, grp, people as before, case when ku_5 = 18 then null when ng % 2 = 0 then people * 2 else people end as after from cells where ku_5 <> 1
                union all select ng, ku_5, j, grp, null, case when ng % 2 = 0 then people * 2 else people end from cells where ku_5 = 1)
    select ng, ku_5, j::bigint as j, grp::bigint as grp, 'POPFAC' as measure, before, after, after - before as change,
           case when before is null then 'added' when after is null then 'removed' else 'changed' end as status
    from changed where before is distinct from after
    """,
)
def snapshot_changes(t):
    """Factors of every state as two runs wrote them: one band removed, one added, even states doubled."""
    path = _scratch(t, "factors")
    cell = population_cells(_population(t)).select("NG", "KU_5", "J", "GRP", F.col("POPULATION").alias("POPFAC"))
    write_snapshot(cell.filter("KU_5 <> 1"), path, "first", "NG")
    later = F.when(F.col("NG") % 2 == 0, F.col("POPFAC") * 2).otherwise(F.col("POPFAC"))
    write_snapshot(cell.filter("KU_5 <> 18").withColumn("POPFAC", later), path, "second", "NG")
    out = compare_runs(t.spark, path, "first", "second", ["NG", "KU_5", "J", "GRP"], ["POPFAC"])
    longs = {c: F.col(c).cast("long") for c in ("NG", "KU_5", "J", "GRP")}
    return out.withColumns(longs).withColumnsRenamed({c: c.lower() for c in longs})


@query(
    "A11",
    """
    select o_orderkey::varchar as o_orderkey, quarter(o_orderdate)::bigint as quarter, year(o_orderdate)::bigint as years,
           case when quarter(o_orderdate) <= 2 then 1 else 2 end::bigint as halfyear
    from orders
    """,
)
def quarterly_finals(t):
    """Every quarter of the orders as a final file of its own, read back with the period of its name."""
    path = _scratch(t, "finals")
    dated = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"))
    periods = sorted((r.y, r.q) for r in dated.select("y", "q").distinct().collect())
    stored = stage(dated, "dated")
    for year, quarter in periods:
        write_csv(stored.filter((F.col("y") == year) & (F.col("q") == quarter)).select("o_orderkey").coalesce(1), f"{path}/JR4Q{quarter}Y{year}.csv")
    finals = list(ingest_finals(t.spark, path, "quarterly").values())
    whole = finals[0]
    for more in finals[1:]:
        whole = whole.unionByName(more)
    return whole.select("o_orderkey", *[F.col(c).cast("long").alias(c.lower()) for c in ("QUARTER", "YEARS", "HALFYEAR")])


@query(
    "B6",
    """
    with given as (select n_regionkey::varchar as file, n_name as header from nation),
    mapping as (select n_name as source, 'V' || n_nationkey as target from nation where n_nationkey % 3 <> 0 union all select 'ABSENT', 'V99'),
    wanted as (select file, source, target from (select distinct file from given), mapping)
    select coalesce(given.file, wanted.file) as file, coalesce(header, source) as source, target,
           case when source is null then 'extra' when header is null then 'missing' else 'mapped' end as status
    from given full outer join wanted on given.file = wanted.file and header = source
    """,
)
def header_rows(t):
    """Headers of several files, given as rows, held against a mapping."""
    given = t.nation.select(F.col("n_regionkey").cast("string").alias("file"), F.col("n_name").alias("header"))
    mapping = [(r.n_name, f"V{r.n_nationkey}") for r in t.nation.filter("n_nationkey % 3 <> 0").collect()]
    return header_rows_report(given, [*mapping, ("ABSENT", "V99")])


@query(
    "AG9",
    """
    select o_custkey, case when count(distinct o_orderstatus) = 1 then min(o_orderstatus) end as value, (count(distinct o_orderstatus) > 1) as several
    from orders group by 1
    """,
)
def sole_status(t):
    """The one status of each customer's orders, and which customers have several."""
    return sole_values(t.orders, "o_orderstatus", ["o_custkey"])
