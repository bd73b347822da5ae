"""Weights, cells, factors and calibration over the driver tables."""

from pyspark.sql import functions as F

from tallyweave.catalogue.registry import query
from tallyweave.functions import age_band_10
from tallyweave.operators import audits, cells, headers, weights
from tallyweave.operators.joins import lookup
from tallyweave.session import stage

_BY = ["c_nationkey", "c_mktsegment"]

# Responding customers: those with an order above the threshold.
_DESIGN_SQL = """
    frame as (select c_nationkey, c_mktsegment, count(*)::double as households from customer group by all),
    answered as (
      select c_nationkey, c_mktsegment, count(distinct o_custkey)::bigint as responding
      from orders join customer on c_custkey = o_custkey where o_totalprice > 400000 group by all),
    design as (
      select c_nationkey, c_mktsegment, households, coalesce(responding, 0)::bigint as responding,
             (households / nullif(coalesce(responding, 0), 0) * 100)::bigint / 100.0 as weight
      from frame left join answered using (c_nationkey, c_mktsegment)
      where c_nationkey in (select c_nationkey from answered))
"""


def _design(t):
    frame = t.customer.groupBy(*_BY).agg(F.count(F.lit(1)).cast("double").alias("BIL_ISI_RUMAH"))
    # All orders are counted, those below the threshold apart.
    answered = (F.col("o_totalprice") > 400000).alias("answered")
    joined = t.orders.select("o_custkey", answered).join(t.customer.select("c_custkey", *_BY), F.col("o_custkey") == F.col("c_custkey"))
    counts = stage(cells.responding_counts(joined, ["o_custkey"], [*_BY, "answered"]), "counts").filter("answered").drop("answered")
    return weights.design_weight(stage(frame, "frame"), counts, by=_BY, state="c_nationkey")


@query(
    "P4 J1",
    f"with {_DESIGN_SQL} select c_nationkey::bigint as nation, c_mktsegment as segment, households, responding, weight from design",
)
def design_weight(t):
    return _design(t).select(
        F.col("c_nationkey").cast("long").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("BIL_ISI_RUMAH").alias("households"),
        "responding",
        F.col("ADJUSTED_WEIGHT").alias("weight"),
    )


@query(
    "P5 D14",
    f"""
    with {_DESIGN_SQL},
    checked as (
      select c_nationkey::bigint as nation, c_mktsegment as segment,
             ((weight - coalesce(case when c_nationkey % 2 = 0 then weight else weight + 0.5 end, 0)) * 100)::bigint / 100.0 as diff
      from design)
    select nation, segment, diff from checked where diff is distinct from 0
    """,
)
def weight_check(t):
    supplied = F.when(F.col("c_nationkey") % 2 == 0, F.col("ADJUSTED_WEIGHT")).otherwise(F.col("ADJUSTED_WEIGHT") + 0.5)
    checked = weights.weight_check(_design(t).withColumn("ADJUSTED_WEIGHT_BMP", supplied))
    return audits.discrepancies(checked, "SEMAKAN_AW_BMP").select(
        F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("SEMAKAN_AW_BMP").alias("diff")
    )


@query(
    "J2 J3 P6",
    f"""
    with {_DESIGN_SQL}
    select c_custkey, weight from customer left join design using (c_nationkey, c_mktsegment)
    """,
)
def attach_weight(t):
    table = stage(_design(t).select(*_BY, F.col("ADJUSTED_WEIGHT").alias("weight")), "design")
    return weights.attach_weight(t.customer, table, _BY).select("c_custkey", "weight")


_CELL_SQL = """
    select c_nationkey::bigint as nation, (o_orderkey % 18 + 1)::bigint as band, (case o_orderstatus when 'F' then 1 when 'O' then 2 end)::bigint as j,
           left(o_orderpriority, 1)::bigint as grp, (o_totalprice * 100)::bigint as cents
    from orders join customer on c_custkey = o_custkey
"""


def _cells(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_nationkey").cast("long").alias("nation"),
        (F.col("o_orderkey") % 18 + 1).alias("band"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).alias("J"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("GRP"),
        "o_totalprice",
    )


@query(
    "AG3 P7 B16",
    f"with cell as ({_CELL_SQL}) select nation, band, "
    + ", ".join(f'sum(case when j = {j} and grp = {g} then cents end)::double / 100 as "{j}_{g}"' for j in (1, 2) for g in range(1, 6))
    + " from cell where j is not null group by all",
)
def sample_cells_pivot(t):
    long = cells.weighted_cells(_cells(t), ["nation", "band", "J", "GRP"], "o_totalprice")
    return headers.pivot_groups(long, ["nation", "band"], "SAMPLE", [1, 2], range(1, 6))


@query(
    "AG3 P7",
    f"""
    with cell as ({_CELL_SQL})
    select nation, band, j, grp, sum(cents)::double / 100 as sample from cell where j is not null group by all
    """,
)
def sample_cells_long(t):
    long = cells.weighted_cells(_cells(t), ["nation", "band", "J", "GRP"], "o_totalprice", name="sample")
    return long.select("nation", "band", F.col("J").cast("long").alias("j"), F.col("GRP").cast("long").alias("grp"), "sample")


@query(
    "AG4 J4",
    """
    with item as (
      select l_linenumber::bigint as ng, (floor(l_quantity / 10) + 1)::bigint as band, l_returnflag = 'R' as foreigner,
             (l_extendedprice * 100)::bigint as cents from lineitem),
    own as (select ng, band, sum(cents)::double / 100 as citizens from item where not foreigner group by all),
    other as (select ng, band, sum(cents)::double / 100 as noncitizens from item where foreigner group by all)
    select ng, band, citizens, noncitizens from own left join other using (ng, band)
    """,
)
def noncitizen_cells(t):
    item = t.lineitem.select(
        F.col("l_linenumber").cast("long").alias("ng"),
        age_band_10("l_quantity").cast("long").alias("band"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("cit"),
        "l_extendedprice",
    )
    both = stage(cells.weighted_cells(item, ["ng", "band", "cit"], "l_extendedprice"), "cells")
    own = both.filter("cit = 1").select("ng", "band", F.col("SAMPLE").alias("citizens"))
    other = both.filter("cit = 2").select("ng", "band", F.col("SAMPLE").alias("noncitizens"))
    return lookup(own, other, ["ng", "band"])


@query(
    "P8 P9 R2 J6 C18",
    """
    with population as (select c_nationkey, c_mktsegment, sum((c_acctbal * 100)::bigint)::double / 100 as population from customer group by all),
    sample as (
      select c_nationkey, c_mktsegment, sum((o_totalprice * 100)::bigint)::double / 100 as sample
      from orders join customer on c_custkey = o_custkey where o_totalprice > 450000 group by all)
    select c_nationkey::bigint as nation, c_mktsegment as segment, population, sample,
           coalesce((population / nullif(sample, 0) * 100)::bigint / 100.0, 0::double) as popfac
    from population left join sample using (c_nationkey, c_mktsegment)
    """,
)
def population_factor(t):
    people = cells.weighted_cells(t.customer, _BY, "c_acctbal", name="POPULATION")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    sample = cells.weighted_cells(joined.withColumn("o_totalprice", F.when(F.col("o_totalprice") > 450000, F.col("o_totalprice"))), _BY, "o_totalprice")
    factors = weights.population_factor(people, sample, _BY)
    return factors.select(
        F.col("c_nationkey").cast("long").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("POPULATION").alias("population"),
        F.col("SAMPLE").alias("sample"),
        F.col("POPFAC").alias("popfac"),
    )


@query(
    "J7 J8 P10 P11",
    """
    with factor as (
      select s_nationkey, case when count(*) > 1 then (avg((s_acctbal * 100)::bigint) / 100)::bigint::double else 0::double end as popfac
      from supplier where s_acctbal > 2000 group by all)
    select c_custkey, coalesce(popfac, 1) as popfac, c_acctbal * coalesce(popfac, 1) as first_weight
    from customer left join factor on s_nationkey = c_nationkey
    """,
)
def attach_factor_once(t):
    mean = F.rint(F.avg(F.rint(F.col("s_acctbal") * 100).cast("long")) / 100)
    supplier = t.supplier.withColumn("s_acctbal", F.when(F.col("s_acctbal") > 2000, F.col("s_acctbal")))
    # Null where no supplier of the nation counts, which attach_factor reads as no factor.
    factor = supplier.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(
        F.when(F.count("s_acctbal") > 1, mean).when(F.count("s_acctbal") == 1, 0.0).alias("POPFAC")
    )
    found = weights.attach_factor(t.customer, stage(factor, "factors"), ["c_nationkey"])
    made = weights.first_weight(found.withColumnRenamed("c_acctbal", "ADJUSTED_WEIGHT"))
    return made.select("c_custkey", F.col("POPFAC").alias("popfac"), F.col("PEMBERAT_1").alias("first_weight"))


# Microdata: line items by band and flag. Controls: parts by band and parity, with more bands than the items.
_RATIO_SQL = """
    item as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                    (floor(l_quantity / 10) + 1)::bigint as band, (case l_linestatus when 'F' then 1 else 2 end)::bigint as cit from lineitem),
    estimate as (select band, cit, sum((l_extendedprice * 100)::bigint)::double / 100 as estimate from item group by all),
    control as (select (floor(p_size * 2 / 10) + 1)::bigint as band, (p_partkey % 2 + 1)::bigint as cit,
                       sum((p_retailprice * 100)::bigint)::double / 100 as control from part group by all),
    ratio as (select band, cit, estimate, control, control / nullif(estimate, 0) as weight_pop, estimate is not null as in_sample
              from estimate full outer join control using (band, cit))
"""


def _items(t):
    return t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        age_band_10("l_quantity").cast("long").alias("band"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("long").alias("cit"),
    )


def _controls(t):
    domain = t.part.select(age_band_10(F.col("p_size") * 2).cast("long").alias("band"), (F.col("p_partkey") % 2 + 1).alias("cit"), "p_retailprice")
    return cells.weighted_cells(domain, ["band", "cit"], "p_retailprice", name="control")


@query(
    "P13 J9 J10 C8",
    f"""
    with {_RATIO_SQL}
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey, band, cit, weight_pop, weight_pop * l_extendedprice as final
    from item join ratio using (band, cit)
    union all select null, null, null, null, band, cit, weight_pop, null from ratio where not in_sample
    """,
)
def calibrate(t):
    done = weights.calibrate(_items(t), _controls(t), ["band", "cit"], weight="l_extendedprice", final="final", control="control", digits=2)
    return done.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "band", "cit", F.col("WEIGHT_POP").alias("weight_pop"), "final")


@query(
    "J10 D15",
    f"""
    with {_RATIO_SQL}
    select band, cit, in_sample::int::bigint as in_sample, control, estimate from ratio
    """,
)
def keep_unmatched_controls(t):
    estimates = cells.weighted_cells(_items(t), ["band", "cit"], "l_extendedprice", name="estimate")
    ratios = weights.control_ratios(estimates, _controls(t), ["band", "cit"], estimate="estimate", control="control")
    return ratios.select("band", "cit", F.col("in_sample").cast("long").alias("in_sample"), "control", "estimate")


@query(
    "P13",
    f"""
    with {_RATIO_SQL}
    select band, cit, count(*)::bigint as rows, any_value(control) as control,
           (sum(weight_pop * l_extendedprice))::bigint as total
    from item join ratio using (band, cit) group by all
    """,
)
def calibration_invariant(t):
    """Calibrated weights add up to the control of each domain."""
    done = weights.calibrate(_items(t), _controls(t), ["band", "cit"], weight="l_extendedprice", final="final", control="control", digits=2)
    known = done.filter("l_orderkey is not null")
    return known.groupBy("band", "cit").agg(
        F.count(F.lit(1)).alias("rows"), F.any_value("control").alias("control"), F.rint(F.sum("final")).cast("long").alias("total")
    )


_BLANK_SQL = """
    population as (select c_nationkey, c_mktsegment, (count(*) * 10)::double as population from customer group by all),
    sample as (
      select c_nationkey, c_mktsegment, count(distinct o_custkey)::double as sample
      from orders join customer on c_custkey = o_custkey where o_totalprice > 490000 group by all),
    cell as (select c_nationkey, c_mktsegment, population, sample from population left join sample using (c_nationkey, c_mktsegment))
"""


@query(
    "K1 K2",
    f"""
    with {_BLANK_SQL},
    block as (select *, coalesce(sum(case when sample is null then population end) over (partition by c_nationkey), 0) as a,
                     sum(population) over (partition by c_nationkey) as b from cell),
    moved as (select *, case when sample is not null and 100 * a / nullif(b, 0) >= 1
                             then (population + population / nullif(b - a, 0) * a)::bigint::double else population end as adjusted from block)
    select c_nationkey::bigint as nation, c_mktsegment as segment, population, adjusted,
           (adjusted / nullif(sample, 0) * 100)::bigint / 100.0 as popfac
    from moved where sample is not null
    """,
)
def redistribute_blank(t):
    people = t.customer.groupBy(*_BY).agg((F.count(F.lit(1)) * 10).cast("double").alias("POPULATION"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    buyers = F.countDistinct(F.when(F.col("o_totalprice") > 490000, F.col("o_custkey")))
    sample = stage(joined.groupBy(*_BY).agg(F.nullif(buyers, F.lit(0)).cast("double").alias("SAMPLE")), "sample")
    moved = weights.redistribute_blank(lookup(people, sample, _BY), ["c_nationkey"])
    moved = moved.withColumnRenamed("POPULATION", "BEFORE").withColumnRenamed("POPULATION_ADJUSTED", "POPULATION")
    factors = weights.population_factor(moved.drop("SAMPLE"), sample, _BY, missing=None)
    return factors.select(
        F.col("c_nationkey").cast("long").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("BEFORE").alias("population"),
        F.col("POPULATION").alias("adjusted"),
        F.col("POPFAC").alias("popfac"),
    )


@query(
    "P12 AG5 AG9",
    """
    select s_nationkey::bigint as nation, (case when s_acctbal > 5000 then 1 else 2 end)::bigint as cit,
           sum((s_acctbal * 100)::bigint)::double / 100 as estimate
    from supplier group by all
    """,
)
def sample_estimate(t):
    """Sums by domain, pivoted to a column per class and back."""
    domain = t.supplier.select(
        F.col("s_nationkey").cast("long").alias("nation"), F.when(F.col("s_acctbal") > 5000, 1).otherwise(2).alias("cit"), "s_acctbal"
    )
    wide = cells.pivot_sum(domain, ["nation"], "cit", [1, 2], "s_acctbal")
    long = cells.unpivot_values(wide, ["nation"], ["1", "2"], "cit", "estimate")
    return long.filter("estimate is not null").withColumn("cit", F.col("cit").cast("long"))
