"""Headers, lookups, stacking, sources and sinks over the driver tables."""

import uuid

from pyspark.sql import functions as F

from tallyweave.catalogue.registry import query
from tallyweave.functions.periods import quarter_range
from tallyweave.operators import audits, headers, lookups, stacking, transfer
from tallyweave.operators.joins import repeated_keys
from tallyweave.session import run_folder, stage
from tallyweave.sources import (
    clean_control,
    drop_empty_rows,
    find_period_tables,
    infer_integers,
    ingest_finals,
    integer_columns,
    latest_control,
    latest_file,
    load_table,
    publish,
    read_delimited,
    read_period,
    read_with_offset,
    replace_period,
    write_csv,
)
from tallyweave.streaming import intake_files


def _scratch(t, name: str) -> str:
    return f"{run_folder(t.spark)}/{uuid.uuid4().hex}/{name}"


@query(
    "N1 N2",
    """
    select o_orderkey, o_custkey, null::varchar as o_orderpriority, o_totalprice from orders where o_orderdate < timestamp '1998-01-01'
    union all select o_orderkey, null, o_orderpriority, o_totalprice from orders where o_orderdate >= timestamp '1998-01-01'
    """,
)
def stack_drift(t):
    return stacking.stack(_halves(t)).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


def _halves(t):
    early = t.orders.filter("o_orderdate < timestamp '1998-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")
    late = t.orders.filter("o_orderdate >= timestamp '1998-01-01'").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return {"early": early, "late": late}


@query(
    "B9 N3",
    """
    select 'o_custkey' as "column", 'early' as present_in, 'late' as missing_from,
           count(*)::bigint as rows, count(*) filter (o_orderdate >= timestamp '1998-01-01')::bigint as nulls from orders
    union all
    select 'o_orderpriority', 'late', 'early', count(*), count(*) filter (o_orderdate < timestamp '1998-01-01') from orders
    """,
)
def column_drift(t):
    """Columns that some table lacks, and the nulls this leaves after stacking."""
    halves = _halves(t)
    drift = stacking.column_drift(t.spark, halves)
    nulls = audits.null_audit(stacking.stack(halves))
    return drift.join(nulls, "column").select(
        "column", F.concat_ws("|", "present_in").alias("present_in"), F.concat_ws("|", "missing_from").alias("missing_from"), "rows", "nulls"
    )


@query(
    "B8",
    """
    select 'customer' as "table", count(*)::bigint as rows, 5::bigint as columns, 6::bigint as surplus from customer
    union all select 'orders', count(*), 6, 5 from orders
    """,
)
def shape_report(t):
    made = stacking.shape_report({"customer": t.customer, "orders": t.orders})
    return made.withColumns({"columns": F.col("columns").cast("long"), "surplus": F.col("surplus").cast("long")})


@query(
    "B5 B7 D13",
    """
    select c_name as "NAME", null::varchar as "MISSING", c_custkey as "KEY", c_acctbal as "BALANCE" from customer
    """,
)
def remap_reorder(t):
    """Remap by a mapping of old to new names; the balance is then moved to the end."""
    mapping = [("c_acctbal", "BALANCE"), ("c_name", "NAME"), ("no_such_column", "MISSING"), ("c_custkey", "KEY")]
    return headers.move_columns(headers.remap_columns(t.customer, mapping), {"BALANCE": 3})


@query(
    "B1 B2 B3 B4 B10 B11",
    """
    select s_suppkey as "KEYCODE", s_name as "Name1", s_acctbal as "X_BALANCE_BPPD", s_nationkey::bigint as "X_NATION_CODE" from supplier
    """,
)
def sanitize_names(t):
    awkward = t.supplier.select(
        F.col("s_suppkey").alias(" key_code "),
        F.col("s_name").alias("2_Name1"),
        F.col("s_acctbal").alias("balance (bppd)"),
        F.col("s_nationkey").cast("long").alias("nation code"),
    )
    left = headers.sanitize_columns(headers.compact_headers(awkward.select(" key_code ")))
    rest = headers.compact_headers(awkward.select("balance (bppd)", "nation code"), keep_underscore=True)
    plain = headers.plain_headers(awkward.select(F.col(" key_code ")))
    assert left.columns == plain.columns == ["KEYCODE"]
    names = [*left.columns, *headers.sanitize_columns(awkward.select("2_Name1")).columns, *rest.columns]
    joined = headers.prefix_after(awkward.toDF(*names), names[1], "X")
    return headers.sanitize_columns(headers.column_slice(joined, joined.columns[2], joined.columns[3]))


@query(
    "B12 B14 B16",
    """
    select n.n_nationkey::bigint as "NG",
           count(*) filter (c_mktsegment = 'BUILDING')::bigint as "1_1", count(*)::bigint as "1_1_SEM",
           count(*) filter (c_mktsegment = 'MACHINERY')::bigint as "1_2", sum(c_custkey)::bigint as "1_2_SEM"
    from customer join nation n on n_nationkey = c_nationkey group by 1
    """,
)
def paired_columns(t):
    """Factor columns next to their control columns, by the number in the name."""
    counted = t.customer.groupBy(F.col("c_nationkey").cast("long").alias("NG")).agg(
        F.sum("c_custkey").alias("second"),
        F.count(F.lit(1)).alias("first"),
        F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("1_2"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("1_1"),
        F.lit(1).alias("CIT_NONCIT"),
    )
    renamed = counted.withColumnsRenamed({"first": "1_1_SEM", "second": "1_2_SEM"})
    ordered = headers.order_by_number(renamed, "SEM")
    return ordered.select("NG", *[f"`{c}`" for c in ordered.columns if c != "NG"])


@query(
    "J11",
    """
    with code as (select n_nationkey::bigint as code, case when n_regionkey <> 2 then n_name end as section from nation)
    select c_custkey, a.section as section, b.section as section_smpl
    from customer left join code a on a.code = c_nationkey left join code b on b.code = c_custkey % 30
    """,
)
def lookup_section(t):
    raw = t.customer.select(
        "c_custkey",
        F.lit(None).cast("string").alias("section"),
        F.lit(None).cast("string").alias("section_smpl"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("msic"),
        (F.col("c_custkey") % 30).cast("string").alias("msic_smpl"),
    )
    industries = t.nation.select(F.col("n_nationkey").cast("string").alias("without '0'"), F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("SECTION"))
    return lookups.lookup_section(raw, industries, {"msic": "section", "msic_smpl": "section_smpl"}).drop("msic", "msic_smpl")


@query(
    "J13",
    """
    with frame as (
      select s_suppkey as k, s_name as registered, case when s_suppkey % 3 = 0 then null else s_nationkey::varchar end as trading from supplier
      union all select s_suppkey, 'Z' || s_name, 'A' || s_nationkey from supplier),
    best as (select k, registered, trading from (select *, row_number() over (partition by k order by trading is null, registered, trading) as rn from frame) where rn = 1)
    select c_custkey, registered as registered_name, coalesce(trading, c_name) as trading_name from customer left join best on k = c_custkey
    """,
)
def sample_lookup(t):
    """Names from a frame with two rows for each firm; both names come from one of them."""
    firms = t.customer.select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("NEWSSID"), F.col("c_name").alias("trading_name"))
    key = F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("NEWSSID")
    nation = F.col("s_nationkey").cast("string")
    frame = t.supplier.select(key, F.col("s_name").alias("registered_name"), F.when(F.col("s_suppkey") % 3 != 0, nation).alias("trading_name"))
    frame = frame.union(t.supplier.select(key, F.concat(F.lit("Z"), "s_name"), F.concat(F.lit("A"), nation)))
    return lookups.lookup_sample(firms, frame, columns=["registered_name", "trading_name"]).select("c_custkey", "registered_name", "trading_name")


_TRANSFER_SQL = """
    target as (select c_custkey, c_custkey as id, n_name || case when c_acctbal > 5000 then 'H' else 'L' end as nama, c_acctbal as weight
               from customer join nation on n_nationkey = c_nationkey),
    donor as (select s_suppkey as id, n_name || case when s_acctbal > 5000 then 'H' else 'L' end as nama,
                     case when s_acctbal > 1000 then s_acctbal end as weight
              from supplier join nation on n_nationkey = s_nationkey),
    by_name as (select nama, weight from (select *, row_number() over (partition by nama order by id) as rn from donor) where rn = 1),
    done as (select t.c_custkey, t.nama, case when d.id is not null then d.weight when n.nama is not null then n.weight else t.weight end as weight,
                    case when d.id is not null then 'id' when n.nama is not null then 'name' else 'none' end as match
             from target t left join donor d on d.id = t.id left join by_name n on n.nama = t.nama)
"""


def _transferred(t):
    def named(table, key, nation, balance):
        label = F.concat("n_name", F.when(F.col(balance) > 5000, "H").otherwise("L"))
        return table.join(t.nation, F.col("n_nationkey") == F.col(nation)).select(
            F.col(key).alias("id"), label.alias("nama"), F.col(balance).alias("weight")
        )

    target = named(t.customer, "c_custkey", "c_nationkey", "c_acctbal").withColumn("c_custkey", F.col("id"))
    donors = named(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal").withColumn("weight", F.when(F.col("weight") > 1000, F.col("weight")))
    return transfer.transfer_weight(target, donors, id_column="id", name_column="nama", weight="weight", order="id")


@query("J12 W2", f"with {_TRANSFER_SQL} select c_custkey, weight, match from done")
def transfer_weight(t):
    return _transferred(t).select("c_custkey", "weight", F.col("MATCH").alias("match"))


@query(
    "J12 W2",
    """
    select o_orderkey, coalesce(i.c_acctbal, n.c_acctbal) as weight,
           case when i.c_custkey is not null then 'id' when n.c_custkey is not null then 'name' else 'none' end as match
    from orders left join customer i on i.c_custkey = o_orderkey
    left join customer n on n.c_name = 'Customer#' || lpad(o_custkey::varchar, 9, '0')
    """,
)
def transfer_to_orders(t):
    """Each order takes the balance of the customer with its number, else of its own customer by name."""
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    target = t.orders.select("o_orderkey", F.col("o_orderkey").alias("id"), name.alias("nama"))
    donors = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nama"), F.col("c_acctbal").alias("weight"))
    done = transfer.transfer_weight(target, donors, id_column="id", name_column="nama", weight="weight", order="id")
    return done.select("o_orderkey", "weight", F.col("MATCH").alias("match"))


@query("K10 P16", f"with {_TRANSFER_SQL} select c_custkey, nama from done where match = 'none'")
def unmatched_weights(t):
    return transfer.unmatched_report(_transferred(t), ["c_custkey", "nama"])


@query(
    "A8 A9 W4 S3",
    """
    select coalesce(try_cast(user_id as int), 0)::bigint as user_id, coalesce(try_cast(event_type as int), 0)::bigint as event_type, event_id
    from events order by ts desc limit 1
    """,
)
def latest_control_record(t):
    record = latest_control(t.events.select("ts", "event_id", "user_id", "event_type"), "ts")
    cleaned = clean_control(record, "user_id", "event_type")
    return cleaned.select(F.col("user_id").cast("long").alias("user_id"), F.col("event_type").cast("long").alias("event_type"), "event_id")


@query(
    "A6",
    "select o_orderkey, o_totalprice from orders where year(o_orderdate) = 1997 and quarter(o_orderdate) = 2",
)
def period_rows(t):
    begin, end = quarter_range(1997, 2)
    return t.orders.filter((F.col("o_orderdate") >= begin) & (F.col("o_orderdate") < end)).select("o_orderkey", "o_totalprice")


@query("A1", "select c_custkey, c_name, c_mktsegment from customer")
def drop_all_null_rows(t):
    blank = t.supplier.select(*[F.lit(None).alias(c) for c in ("c_custkey", "c_name", "c_mktsegment")])
    both = t.customer.select("c_custkey", "c_name", "c_mktsegment").union(blank)
    return drop_empty_rows(both)


@query(
    "A2",
    "select "
    + ", ".join(f"bool_and({c} is not null and regexp_full_match({c}::varchar, '[0-9]+'))::int::bigint as {c}" for c in ("p_partkey", "p_name", "p_size", "p_retailprice"))
    + " from part",
)
def infer_integer_columns(t):
    text = t.part.select(*[F.col(c).cast("string").alias(c) for c in ("p_partkey", "p_name", "p_size", "p_retailprice")])
    found = integer_columns(text)
    return found.select(*[F.col(c).cast("long").alias(c) for c in found.columns])


@query("A5", "select count(*)::bigint as rows from orders")
def latest_file_rows(t):
    """Rows of the orders file changed last."""
    newest = latest_file(t.spark, t.path("orders") + "*")
    return t.spark.read.parquet(newest).agg(F.count(F.lit(1)).alias("rows"))


@query("A1 A2 A13 A16", "select s_suppkey, s_name, s_nationkey::bigint as s_nationkey, s_acctbal::varchar as s_acctbal from supplier")
def delimited_round_trip(t):
    """Written as CSV, read as text, whole-number columns inferred."""
    path = _scratch(t, "supplier")
    write_csv(t.supplier, path)
    return infer_integers(read_delimited(t.spark, path))


@query(
    "A12 K8",
    """
    select o_orderkey, year(o_orderdate)::bigint as years, case when year(o_orderdate) = 1997 then o_totalprice * 2 else o_totalprice end as price
    from orders
    """,
)
def replaced_period(t):
    """All years written, then the accepted version of one year written over its partition."""
    path = _scratch(t, "orders_by_year")
    priced = t.orders.select("o_orderkey", F.year("o_orderdate").alias("years"), F.col("o_totalprice").alias("price"))
    replace_period(priced, path, "years")
    revised = priced.filter("years = 1997").withColumn("price", F.col("price") * 2)
    replace_period(revised, path, "years")
    return t.spark.read.parquet(path).select("o_orderkey", F.col("years").cast("long").alias("years"), "price")


@query("A15", "select c_custkey::varchar as c_custkey, c_name, c_mktsegment from customer")
def incremental_intake(t):
    """CSV files read once by an available-now stream into a table."""
    folder, table, state = (_scratch(t, n) for n in ("incoming", "table", "state"))
    write_csv(t.customer.select("c_custkey", "c_name", "c_mktsegment"), folder)
    intake_files(t.spark, folder, table, state, ["c_custkey", "c_name", "c_mktsegment"])
    return t.spark.read.parquet(table).drop("source_file")


_PART_COLUMNS = {0: ["o_orderkey", "o_orderpriority", "o_totalprice"], 1: ["o_totalprice", "o_orderkey", "o_orderpriority"], 2: ["o_orderpriority", "o_totalprice", "o_orderkey"]}


def _written_parts(t, name):
    """Orders as CSV in three parts with their columns in different orders, the last one in ISO-8859-1."""
    path = _scratch(t, name)
    label = F.concat(F.col("o_orderpriority"), F.lit(" café"))
    for part, columns in _PART_COLUMNS.items():
        rows = t.orders.filter(F.col("o_orderkey") % 3 == part).withColumn("o_orderpriority", label).select(*columns)
        encoding = "ISO-8859-1" if part == 2 else "UTF-8"
        rows.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(f"{path}/part{part}")
    return path


_PARTS_SQL = "select o_orderkey::varchar as o_orderkey, o_orderpriority || ' café' as o_orderpriority, o_totalprice::varchar as o_totalprice from orders"


@query("A1 A3", _PARTS_SQL)
def many_file_read(t):
    """Files of different headers and encodings read as one table by name."""
    return read_delimited(t.spark, f"{_written_parts(t, 'many_files')}/*/*.csv", encoding=None).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("A4", "select s_suppkey::varchar as s_suppkey, s_name || ' ñ' as s_name from supplier")
def offset_read(t):
    """Files with two lines above the header, in ISO-8859-1, read by their header line."""
    path = _scratch(t, "offset")
    lines = t.supplier.select(F.concat_ws(",", F.col("s_suppkey").cast("string"), F.concat("s_name", F.lit(" ñ"))).alias("value"), F.col("s_suppkey").alias("place"))
    head = t.spark.createDataFrame([("a report", -3), ("", -2), ("s_suppkey,s_name", -1)], "value string, place long")
    ordered = lines.union(head).repartition(1).sortWithinPartitions("place").select("value")
    ordered.write.mode("overwrite").option("encoding", "ISO-8859-1").text(path)
    return read_with_offset(t.spark, f"{path}/*.txt", 2, encoding=None)


@query("A10 A11", "select o_orderkey::varchar as o_orderkey, o_orderpriority || ' café' as o_orderpriority, o_totalprice::varchar as o_totalprice, 5::bigint as months, 1997::bigint as years, 2::bigint as quarter from orders")
def ingested_finals(t):
    """Three files of one month, in folders as Spark writes them, stacked under one period."""
    path = _scratch(t, "finals")
    label = F.concat(F.col("o_orderpriority"), F.lit(" café"))
    for part, columns in _PART_COLUMNS.items():
        rows = t.orders.filter(F.col("o_orderkey") % 3 == part).withColumn("o_orderpriority", label).select(*columns)
        write_csv(rows, f"{path}/JR4M05Y1997_{part}.csv")
    finals = ingest_finals(t.spark, path)
    only = finals.pop("JR4M05Y1997")
    return only.select("o_orderkey", "o_orderpriority", "o_totalprice", *[F.col(c).cast("long").alias(c.lower()) for c in ("MONTHS", "YEARS", "QUARTER")])


@query("J1 J2", "select c_nationkey::bigint as c_nationkey, c_mktsegment, count(*) as rows from customer group by all having count(*) > 1")
def template_key_audit(t):
    """Keys of a template that stand in more than one row."""
    return repeated_keys(t.customer, ["c_nationkey", "c_mktsegment"]).withColumn("c_nationkey", F.col("c_nationkey").cast("long"))


@query("A6 A7 A14 S2", "select o_orderkey, o_totalprice, o_orderpriority from orders where year(o_orderdate) = 1997 and quarter(o_orderdate) = 2")
def published_period(t):
    """Orders published as two tables of a database; the one that holds the period is found and read."""
    database = f"period_{uuid.uuid4().hex[:12]}"
    spark = t.spark
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_scratch(t, database)}'")
    dated = t.orders.withColumns({"YEARS": F.year("o_orderdate"), "QUARTER": F.quarter("o_orderdate")})
    publish(dated.filter("YEARS <= 1997"), "early", database, ("YEARS", "QUARTER"))
    publish(dated.filter("YEARS > 1997"), "late", database, ("YEARS", "QUARTER"))
    names = find_period_tables(spark, database, YEARS=1997, QUARTER=2)
    parts = [read_period(load_table(spark, f"{database}.{n}"), YEARS=1997, QUARTER=2) for n in names]
    whole = read_period(load_table(spark, f"{database}.early"), YEARS=1997, QUARTER=2).limit(0)
    for part in parts:
        whole = whole.unionByName(part)
    found = stage(whole.select("o_orderkey", "o_totalprice", "o_orderpriority"), "period")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found
