"""Consistency rules over orders, lines, customers and nations."""

from tallyweave.catalogue.registry import query
from tallyweave.operators.consistency import RULE_SCHEMA, check_rules

# rule, kind, table, keys, condition, measure, period, other table, other keys, other measure
_RULES = [
    ("R1 odd line", "row", "lineitem", "l_orderkey; l_linenumber", "l_returnflag = 'R' and l_linestatus = 'O' or l_quantity > 49", None, None, None, None, None),
    ("R2 high discount", "row", "lineitem", "l_orderkey; l_linenumber", "l_discount >= 0.1 and l_tax = 0", None, None, None, None, None),
    ("R3 cheap order", "row", "orders", "o_orderkey", "o_totalprice < 2000", None, None, None, None, None),
    ("G1 heavy order", "group", "lineitem", "l_orderkey", "value > 250", "sum(cast(l_quantity as bigint))", None, None, None, None),
    ("G2 many lines", "group", "lineitem", "l_orderkey", "n >= 7 and value = n", "count(distinct l_suppkey)", None, None, None, None),
    ("G3 busy customer", "group", "orders", "o_custkey", "n > 25", None, None, None, None, None),
    ("F1 order without line", "reference", "orders", "o_orderkey", None, None, None, "lineitem", "l_orderkey", None),
    ("F2 status against lines", "reference", "orders", "o_orderkey", "found and value = 1 and other > 0", "max(case when o_orderstatus = 'F' then 1 else 0 end)", None, "lineitem", "l_orderkey", "count_if(l_linestatus = 'O')"),
    ("F3 unknown customer", "reference", "orders", "o_custkey + 40", "not found", None, None, "customer", "c_custkey", None),
    ("P1 fewer orders", "period", "orders", "o_orderpriority", "value < previous * 0.95 or gap > 1", "count(1)", "year(o_orderdate) * 4 + quarter(o_orderdate)", None, None, None),
    ("P2 more open orders", "period", "orders", "o_orderpriority", "value > previous + 20", "count_if(o_orderstatus = 'O')", "year(o_orderdate) * 4 + quarter(o_orderdate)", None, None, None),
]

_SQL = """
lines as (select l_orderkey, count(*) as n, sum(l_quantity::bigint) as quantity, count(distinct l_suppkey) as suppliers, count(*) filter (where l_linestatus = 'O') as open from lineitem group by 1),
statuses as (select o_orderkey, max(case when o_orderstatus = 'F' then 1 else 0 end) as done, count(*) as n from orders group by 1),
custom as (select o_custkey, count(*) as n from orders group by 1),
quarters as (select *, lag(orders) over w as orders_before, lag(open) over w as open_before, period - lag(period) over w as gap
             from (select o_orderpriority, year(o_orderdate) * 4 + quarter(o_orderdate) as period, count(*) as orders, count(*) filter (where o_orderstatus = 'O') as open from orders group by all)
             window w as (partition by o_orderpriority order by period)),
violations as (
  select 'R1 odd line' as rule, 'row' as kind, 'l_orderkey=' || l_orderkey || ', l_linenumber=' || l_linenumber as key, null::bigint as period, null::double as value, null::double as other, count(*) as rows
  from lineitem where l_returnflag = 'R' and l_linestatus = 'O' or l_quantity > 49 group by 3
  union all select 'R2 high discount', 'row', 'l_orderkey=' || l_orderkey || ', l_linenumber=' || l_linenumber, null, null, null, count(*) from lineitem where l_discount >= 0.1 and l_tax = 0 group by 3
  union all select 'R3 cheap order', 'row', 'o_orderkey=' || o_orderkey, null, null, null, count(*) from orders where o_totalprice < 2000 group by 3
  union all select 'G1 heavy order', 'group', 'l_orderkey=' || l_orderkey, null, quantity, null, n from lines where quantity > 250
  union all select 'G2 many lines', 'group', 'l_orderkey=' || l_orderkey, null, suppliers, null, n from lines where n >= 7 and suppliers = n
  union all select 'G3 busy customer', 'group', 'o_custkey=' || o_custkey, null, null, null, n from custom where n > 25
  union all select 'F1 order without line', 'reference', 'o_orderkey=' || o_orderkey, null, null, null, statuses.n from statuses left join lines on o_orderkey = l_orderkey where l_orderkey is null
  union all select 'F2 status against lines', 'reference', 'o_orderkey=' || o_orderkey, null, done, open, statuses.n from statuses join lines on o_orderkey = l_orderkey where done = 1 and open > 0
  union all select 'F3 unknown customer', 'reference', 'o_custkey + 40=' || (o_custkey + 40), null, null, null, n from custom where o_custkey + 40 not in (select c_custkey from customer)
  union all select 'P1 fewer orders', 'period', 'o_orderpriority=' || o_orderpriority, period, orders, orders_before, orders from quarters where orders < orders_before * 0.95 or gap > 1
  union all select 'P2 more open orders', 'period', 'o_orderpriority=' || o_orderpriority, period, open, open_before, orders from quarters where open > open_before + 20)
"""


def _checked(t):
    tables = {name: getattr(t, name) for name in ("lineitem", "orders", "customer")}
    return check_rules(t.spark.createDataFrame(_RULES, RULE_SCHEMA), tables)


@query("K4 K3", f"with {_SQL} select * from violations")
def consistency_violations(t):
    """Faults of rules over rows, groups, references and periods, from one pass over each table."""
    return _checked(t).violations


@query(
    "K4",
    f"""
    with {_SQL},
    checked as (
      select * from (values ('R1 odd line', 'row'), ('R2 high discount', 'row')), (select count(*) as checked from lineitem)
      union all select 'R3 cheap order', 'row', count(*) from orders
      union all select rule, 'group', n from (values ('G1 heavy order'), ('G2 many lines')) as r(rule), (select count(*) as n from lines)
      union all select 'G3 busy customer', 'group', count(*) from custom
      union all select rule, 'reference', n from (values ('F1 order without line'), ('F2 status against lines')) as r(rule), (select count(*) as n from statuses)
      union all select 'F3 unknown customer', 'reference', count(*) from custom
      union all select rule, 'period', n from (values ('P1 fewer orders'), ('P2 more open orders')) as r(rule), (select count(*) as n from quarters)) 
    select c.col0 as rule, c.col1 as kind, c.checked, (select count(*) from violations v where v.rule = c.col0) as faults from checked c
    """,
)
def consistency_report(t):
    """Each rule with what it checked and how many faults it found."""
    return _checked(t).report
