"""Measures, totals, time series and rules over the driver tables."""

from pyspark.sql import functions as F

from tallyweave.catalogue.registry import query
from tallyweave.operators import audits, measures, rules, versions
from tallyweave.operators.stacking import stack

# Measures per order line: five pay parts, three separation parts, categories 1 and 2 with their totals.
_MEASURES = {
    "L23104F01011": "cast(l_quantity as bigint)",
    "L23104F01012": "l_linenumber",
    "M23104F01011": "cast(l_extendedprice as bigint)",
    "M23104F01012": "l_suppkey",
    "N23104F01011": "l_partkey",
    "N23104F01012": "case when l_returnflag = 'R' then 1 end",
    "O23104F01011": "2",
    "O23104F01012": "l_linenumber * 2",
    "P23104F01011": "1",
    "P23104F01012": "0",
    "D23104F01011": "l_linenumber",
    "D23104F01012": "l_linenumber + 1",
    "E23104F01011": "cast(l_quantity as bigint)",
    "E23104F01012": "case when l_linestatus = 'F' then 5 end",
    "F23104F01011": "3",
    "F23104F01012": "4",
}
_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _int_division_free(expression: str) -> str:
    return expression.replace("cast(l_extendedprice as bigint)", "cast(trunc(l_extendedprice) as bigint)")


def _part(name: str) -> str:
    return f"coalesce({_int_division_free(_MEASURES[name])}, 0)::bigint"


def _total(letters: str, digit: str) -> str:
    return " + ".join(_part(f"{x}23104F0101{digit}") for x in letters)


def _wide(t):
    made = [F.expr(e).cast("string").alias(n) for n, e in _MEASURES.items()]
    blank = [F.lit(None).cast("string").alias(f"{v}23104F0101{d}") for v in "QX" for d in "120"]
    blank += [F.lit("9").alias(f"{v}23104F01010") for v in "LMNOPDEF"]
    return t.lineitem.select(*[F.col(c).cast("long").alias(c) for c in _ID], *made, *blank)


@query(
    "P18 P19 B15 C21 S4",
    "select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"({_total(p, d)})::bigint as {v}{d}" for v, p in (("q", "LMNOP"), ("x", "DEF")) for d in "12")
    + " from lineitem",
)
def row_total(t):
    done, _ = measures.establishment_totals(_wide(t), len(_ID))
    return done.select(*_ID, *[F.col(f"{v}23104F0101{d}").alias(f"{v.lower()}{d}") for v in "QX" for d in "12"])


@query(
    "P20",
    "select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"({_total(v, '1')} + {_total(v, '2')})::bigint as {v.lower()}0" for v in "LMNOPDEF")
    + ", "
    + ", ".join(f"({_total(p, '1')} + {_total(p, '2')})::bigint as {v}0" for v, p in (("q", "LMNOP"), ("x", "DEF")))
    + " from lineitem",
)
def category_total(t):
    done, _ = measures.establishment_totals(_wide(t), len(_ID))
    return done.select(*_ID, *[F.col(f"{v}23104F01010").alias(f"{v.lower()}0") for v in "LMNOPDEFQX"])


@query(
    "P20 R5",
    "select l_orderkey, variable, sum(value)::bigint as value from ("
    + " union all ".join(f"select l_orderkey, '{v}' as variable, {_total(v, d)} as value from lineitem" for v in "LMNOPDEF" for d in "12")
    + ") group by all",
)
def category_total_long(t):
    wide = _wide(t).select(*_ID, *_MEASURES)
    return measures.category_total_long(wide, ["l_orderkey"], len(_ID)).select("l_orderkey", "variable", "value")


@query(
    "P18 R5",
    "select l_orderkey, category, sum(value)::bigint as value from ("
    + " union all ".join(f"select l_orderkey, '{d}' as category, {_total('LMNOP', d)} as value from lineitem" for d in "12")
    + ") group by all",
)
def row_total_long(t):
    wide = _wide(t).select(*_ID, *_MEASURES)
    return measures.row_total_long(wide, ["l_orderkey"], list("LMNOP"), "Q", len(_ID)).select("l_orderkey", "category", "value")


@query(
    "P21 AG10",
    "with t as (select "
    + ", ".join(f"{_total(v, d)} as {v}{d}" for v in "LMNOPDEF" for d in "12")
    + " from lineitem), s as (select "
    + ", ".join(f"sum({v}{d})::double as {v}{d}" for v in "LMNOPDEF" for d in "12")
    + " from t) "
    + " union all ".join(
        f'select \'{name}23104F0101{d}\' as "column", {e} as derived_sum, {e} as input_sum, 1::bigint as matches from s'
        for name, parts in (("Q", "LMNOP"), ("X", "DEF"))
        for d in "120"
        for e in ["(" + " + ".join(f"{p}{c}" for p in parts for c in ("12" if d == "0" else d)) + ")"]
    )
    + " union all "
    + " union all ".join(
        f"select '{v}23104F01010', {v}1 + {v}2, {v}1 + {v}2, 1 from s" for v in "LMNOPDEF"
    ),
)
def reconcile(t):
    done, made_of = measures.establishment_totals(_wide(t), len(_ID))
    return audits.reconcile(done, made_of).withColumn("matches", F.col("matches").cast("long"))


@query(
    "R1 R3 R4 R5",
    """
    select o_orderkey, o_custkey as "A23104F01011", trunc(o_totalprice)::bigint as "A23104F01012", year(o_orderdate)::bigint as "B23104F01011"
    from orders
    """,
)
def unpivot_pivot(t):
    """Wide measures to long and back."""
    wide = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("A23104F01011"),
        F.col("o_totalprice").alias("A23104F01012"),
        F.year("o_orderdate").alias("B23104F01011"),
    )
    long = measures.to_long(wide, ["o_orderkey"], 1)
    return measures.to_wide(long, ["o_orderkey"], ["A23104F01011", "A23104F01012", "B23104F01011"])


@query(
    "K7",
    """
    with v as (select o_orderkey, (year(o_orderdate) * 10 + quarter(o_orderdate))::bigint as period, month(o_orderdate)::bigint as version from orders),
    ranked as (select *, max(version) over (partition by period) as latest, dense_rank() over (order by period desc) as r from v)
    select o_orderkey, period, version from ranked where version = latest and r <= 12
    """,
)
def retain_periods(t):
    versioned = t.orders.select(
        "o_orderkey",
        (F.year("o_orderdate") * 10 + F.quarter("o_orderdate")).cast("long").alias("period"),
        F.month("o_orderdate").cast("long").alias("version"),
    )
    return versions.retain_periods(versioned, newest=12)


# The quarters of the test tables' orders, for the comparison SQL alone.
_PERIODS = [f"{y}Q{q}" for y in range(1995, 2002) for q in range(1, 5)][:27]
_SERIES_SQL = """
    select o_orderpriority, cast(year(o_orderdate) as string) || 'Q' || cast(quarter(o_orderdate) as string) as period,
           cast(floor(o_totalprice) as bigint) as value from {orders}
"""
_SERIES = _SERIES_SQL.format(orders="orders")


@query(
    "K5",
    f"with s as ({_SERIES}) select o_orderpriority, "
    + ", ".join(f"sum(case when period = '{p}' then value end)::bigint as \"{p}\"" for p in _PERIODS)
    + " from s group by 1",
)
def timeseries_stack(t):
    """Finals of the years before 1999 and raw quarters after, stacked, one column per quarter."""
    series = t.sql(_SERIES_SQL, "orders")
    early, late = series.filter("period < '1999'"), series.filter("period >= '1999'")
    return versions.to_time_series(stack([early, late]), ["o_orderpriority"], "period", None, "value")


@query("K6", f"with s as ({_SERIES}) select o_orderpriority, period, sum(value)::bigint as value from s group by all")
def timeseries_explode(t):
    wide = versions.to_time_series(t.sql(_SERIES_SQL, "orders"), ["o_orderpriority"], "period", None, "value")
    return versions.from_time_series(wide, ["o_orderpriority"], "period", "value")


_RULES = {
    "large_discount": "l_discount > 0.09",
    "untaxed_return": "l_returnflag = 'R' and l_tax = 0",
    "early_open": "l_linestatus = 'O' and year(l_shipdate) < 1996",
}


@query(
    "K3",
    "select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, 1::bigint as ind_status, concat_ws('|', "
    + ", ".join(f"case when {r} then '{n}' end" for n, r in _RULES.items())
    + ") as errors from lineitem where "
    + " or ".join(f"({r})" for r in _RULES.values()),
)
def rule_flags(t):
    _, bad = rules.split_errors(rules.flag_errors(t.lineitem, _RULES))
    return bad.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        F.col("IND_STATUS").cast("long").alias("ind_status"),
        F.concat_ws("|", "ERRORS").alias("errors"),
    )


@query(
    "K4",
    " union all ".join(
        f"select '{n}' as rule, count(*) filter ({r})::bigint as errors, count(*)::bigint as rows from lineitem" for n, r in _RULES.items()
    ),
)
def rule_report(t):
    return rules.rule_report(t.lineitem, _RULES)


@query(
    "K9",
    """
    select l_orderkey, variable, sum(value)::bigint as value from (
      select l_orderkey, 'A' as variable, l_quantity::bigint as value from lineitem
      union all select l_orderkey, 'B', l_partkey from lineitem) group by all
    """,
)
def drop_variable(t):
    wide = t.lineitem.select(
        "l_orderkey",
        F.col("l_quantity").alias("A23104F01011"),
        F.col("l_partkey").alias("B23104F01011"),
        F.col("l_suppkey").alias("Z23104F01011"),
    )
    long = rules.drop_variable(measures.to_long(wide, ["l_orderkey"], 1))
    return long.groupBy("l_orderkey", "variable").agg(F.sum("value").alias("value"))
