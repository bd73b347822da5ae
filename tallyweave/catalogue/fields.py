"""Text and number fields over the driver tables."""

from pyspark.sql import functions as F

from tallyweave import functions as fn
from tallyweave.catalogue.registry import query
from tallyweave.operators import audits


@query(
    "C1 C2",
    """
    select c_custkey, lpad(c_custkey::varchar, 8, '0') || lpad(c_nationkey::varchar, 2, '0') as id,
           length(lpad(c_custkey::varchar, 8, '0') || lpad(c_nationkey::varchar, 2, '0'))::bigint as id_length
    from customer
    """,
)
def fixed_width_id(t):
    made = t.customer.select("c_custkey", fn.composite_id({"c_custkey": 8, "c_nationkey": 2}).alias("id"))
    return made.withColumn("id_length", F.length("id").cast("long"))


@query(
    "C1",
    """
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey,
           lpad(l_partkey::varchar, 3, '0') as part3, lpad(l_linenumber::varchar, 2, '0') as line2
    from lineitem
    """,
)
def fixed_width_truncates(t):
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        fn.fixed_width("l_partkey", 3).alias("part3"),
        fn.fixed_width("l_linenumber", 2).alias("line2"),
    )


@query(
    "C4",
    """
    select length(o_custkey::varchar || o_orderkey::varchar)::bigint as length, count(*)::bigint as rows
    from orders group by 1
    """,
)
def id_length_audit(t):
    made = t.orders.select(F.concat(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("id"))
    return audits.length_audit(made, "id").withColumn("length", F.col("length").cast("long"))


@query(
    "C3",
    """
    select o_custkey::varchar || o_orderstatus || o_orderpriority as response_key, count(*)::bigint as rows
    from orders group by 1
    """,
)
def response_key(t):
    key = F.concat(*[F.col(c).cast("string") for c in ("o_custkey", "o_orderstatus", "o_orderpriority")])
    return audits.value_counts(t.orders.select(key.alias("response_key")), "response_key")


_MESSY = """case l_linenumber % 4 when 0 then cast(cast(l_quantity as bigint) as string) || '.50' when 1 then 'n/a'
            when 2 then null else ' -' || cast(cast(l_quantity as bigint) as string) || ' ' end"""


@query(
    "C5 C6",
    f"""
    with messy as (select l_linenumber, {_MESSY} as text from lineitem),
    coerced as (select l_linenumber, try_cast(trim(text) as double) as number from messy)
    select l_linenumber::bigint as line, count(*)::bigint as rows, count(number)::bigint as numbers,
           sum(coalesce(number, 0) * 100)::double / 100 as total,
           sum(trunc(coalesce(number, 0))::bigint)::bigint as whole_total
    from coerced group by 1
    """,
)
def coerce_numeric(t):
    messy = t.lineitem.select(F.col("l_linenumber").cast("long").alias("line"), F.expr(_MESSY).alias("text"))
    return messy.groupBy("line").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(fn.to_number("text")).alias("numbers"),
        fn.exact_sum(F.coalesce(fn.to_number("text"), F.lit(0.0)), 2).alias("total"),
        F.sum(fn.to_int("text")).alias("whole_total"),
    )


@query(
    "C14 C15",
    """
    with codes as (
      select s_suppkey, s_suppkey::varchar as code, s_nationkey::varchar as state, trunc(s_acctbal)::bigint::varchar as number
      from supplier)
    select s_suppkey,
           case when code in ('', '0') or length(code) > 5 then code else lpad(code, 5, '0') end as code,
           case when state in ('', '0') or length(state) > 2 then state else lpad(state, 2, '0') end as state,
           case when number in ('', '0') or length(number) > 3 then number else lpad(number, 3, '0') end as number
    from codes
    """,
)
def pad_code_conditional(t):
    return t.supplier.select(
        "s_suppkey",
        fn.pad_code(fn.id_text(F.concat(F.col("s_suppkey").cast("string"), F.lit(".0"))), 5).alias("code"),
        fn.pad_code(fn.id_text("s_nationkey", is_text=False), 2).alias("state"),
        fn.pad_code(fn.id_text("s_acctbal", is_text=False), 3).alias("number"),
    )


@query(
    "C7 C8 C9 C10",
    """
    select o_orderkey, replace(format('{:,.2f}', o_totalprice), ',', '')::double as price,
           o_custkey as customer_code, o_custkey::varchar || o_orderkey::varchar as pair
    from orders
    """,
)
def clean_number_text(t):
    return t.orders.select(
        "o_orderkey",
        fn.strip_commas(F.format_number("o_totalprice", 2)).alias("price"),
        fn.strip_dots(F.concat(F.col("o_custkey").cast("string"), F.lit("."))).alias("customer_code"),
        fn.pair_key(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")), "o_orderkey").alias("pair"),
    )


@query(
    "C11 C18",
    """
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey,
           (l_extendedprice / nullif(l_quantity, 0) * 100)::bigint / 100.0 as unit_price,
           (l_extendedprice / nullif(l_tax, 0) * 100)::bigint / 100.0 as per_tax
    from lineitem
    """,
)
def rounded_ratio(t):
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        fn.round_half_even(fn.safe_ratio("l_extendedprice", "l_quantity"), 2).alias("unit_price"),
        fn.round_half_even(fn.safe_ratio("l_extendedprice", "l_tax"), 2).alias("per_tax"),
    )


@query(
    "C12 C13",
    """
    select p_partkey, upper(p_name) as name, p_brand as brand from part
    """,
)
def trim_upper_names(t):
    padded = t.part.select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), "p_brand").alias("brand"),
    )
    return fn.with_trimmed_text(padded.withColumn("name", fn.upper_trim("name")))


@query(
    "C16 C17",
    """
    select c_custkey, case when r_name = 'AFRICA' then c_acctbal when r_name = 'ASIA' then 2.5::double
                           when r_name = 'EUROPE' then 0::double else 1::double end as factor
    from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
    """,
)
def factor_default(t):
    placed = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")
    )
    first = F.when(F.col("r_name") == "AFRICA", F.col("c_acctbal").cast("string"))
    second = F.when(F.col("r_name") == "ASIA", "2.5")
    third = F.when(F.col("r_name") == "EUROPE", "0").when(F.col("r_name") == "AMERICA", "")
    return placed.select("c_custkey", fn.factor_or_one(fn.first_present(first, second, third)).alias("factor"))


@query(
    "C21",
    """
    select c_custkey, substring(c_name, 1, 6) as head, right(c_name, 2) as tail,
           regexp_extract(c_name, '(\\d+)', 1)::bigint as number
    from customer
    """,
)
def name_parts(t):
    return t.customer.select(
        "c_custkey",
        fn.name_part("c_name", 1, 6).alias("head"),
        F.right("c_name", F.lit(2)).alias("tail"),
        F.element_at(fn.digit_runs("c_name"), 1).alias("number"),
    )


@query(
    "A10 A11 C19 C20",
    """
    select o_orderkey, month(o_orderdate)::bigint as months, year(o_orderdate)::bigint as years,
           quarter(o_orderdate)::bigint as quarter, ceil(quarter(o_orderdate) / 2)::bigint as halfyear, 1::bigint as version
    from orders
    """,
)
def period_stamp(t):
    name = F.concat(F.lit("JR4M"), F.date_format("o_orderdate", "MM"), F.lit("Y"), F.date_format("o_orderdate", "yyyy"), F.lit("_x.csv"))
    period = fn.stamp(t.orders, version=1)
    from tallyweave.sources import period_of_name

    monthly = period_of_name(name)
    quarterly = period_of_name(F.concat(F.lit("JR4Q"), F.quarter("o_orderdate").cast("string"), F.lit("Y"), F.date_format("o_orderdate", "yyyy")), "quarterly")
    return period.select(
        "o_orderkey",
        monthly["MONTHS"].cast("long").alias("months"),
        monthly["YEARS"].cast("long").alias("years"),
        monthly["QUARTER"].cast("long").alias("quarter"),
        quarterly["HALFYEAR"].cast("long").alias("halfyear"),
        F.col("version").cast("long").alias("version"),
    )
