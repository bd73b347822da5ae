"""First occurrences, frequencies and positions over the driver tables."""

from pyspark.sql import functions as F

from tallyweave.catalogue.registry import query
from tallyweave.operators import audits, cells, dedupe


@query(
    "W1 C3",
    """
    select o_orderkey, o_custkey, (case when row_number() over (partition by o_custkey order by o_orderkey) = 1 then 1 else 2 end)::bigint as pf_output
    from orders
    """,
)
def first_marker(t):
    marked = dedupe.mark_first(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "o_orderkey", name="pf_output", order_is_unique=True)
    return marked.withColumn("pf_output", F.col("pf_output").cast("long"))


@query(
    "W3",
    """
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, l_extendedprice from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
                                   order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as rn
      from (select * from lineitem union all select * from lineitem where l_linenumber = 1)) where rn > 1
    """,
)
def duplicate_rows(t):
    """Repeats of line items, the first lines standing in the table twice."""
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    items = t.lineitem.select("l_orderkey", "l_linenumber", *order)
    items = items.union(items.filter("l_linenumber = 1"))
    again = dedupe.repeat_rows(items, ["l_orderkey", "l_linenumber"], order)
    return again.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "W2",
    """
    select o_custkey, o_orderkey, o_totalprice, o_orderpriority from (
      select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn = 1
    """,
)
def first_donor(t):
    return dedupe.first_rows(t.orders, ["o_custkey"], "o_orderkey", ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query(
    "W5",
    """
    with placed as (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) - 1 as p from customer)
    select c_custkey, c_nationkey::bigint as nation, (p // 18 + 1)::bigint as block, (p % 18 + 1)::bigint as position from placed
    """,
)
def block_position(t):
    people = t.customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("nation"))
    return dedupe.block_position(people, ["nation"], "c_custkey")


_BY = ["c_nationkey", "c_mktsegment"]


@query(
    "AG1 AG2",
    """
    select c_nationkey::bigint as nation, c_mktsegment as segment, count(distinct o_custkey)::bigint as responding,
           (count(*) - count(distinct o_custkey))::bigint as repeats
    from orders join customer on c_custkey = o_custkey group by 1, 2
    """,
)
def responding_counts(t):
    joined = t.orders.select("o_custkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    counted = cells.responding_counts(joined, ["o_custkey"], _BY)
    return counted.select(F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment"), "responding", "repeats")


@query("AG6", "select l_quantity, count(*)::bigint as rows from lineitem group by 1")
def value_counts(t):
    return audits.value_counts(t.lineitem, "l_quantity").orderBy("l_quantity")


@query("AG7", "select o_custkey, count(*)::bigint as rows from orders group by 1 having count(*) > 2")
def uniqueness_audit(t):
    return audits.uniqueness_audit(t.orders, "o_custkey", above=2)


@query("AG11", "select distinct p_brand from part")
def distinct_values(t):
    return audits.distinct_values(t.part, "p_brand")


@query(
    "S1 S3",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100",
)
def sort_top(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("S1", "select p_partkey, p_brand, p_retailprice from part order by p_brand, p_partkey")
def sorted_rows(t):
    return t.part.select("p_partkey", "p_brand", "p_retailprice").orderBy("p_brand", "p_partkey")
