"""Bands, code sets and predicates over the driver tables."""

from pyspark.sql import functions as F

from tallyweave import config
from tallyweave import functions as fn
from tallyweave.catalogue.registry import query
from tallyweave.operators import audits


def _counts(df, *columns):
    return df.groupBy(*[F.col(c).cast("long").alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "D1",
    """
    with aged as (select p_size * 3 - 5 as age from part)
    select (case when age >= 85 then 18 when age >= 0 then floor(age / 5) + 1 end)::bigint as ku_5, count(*)::bigint as rows
    from aged group by 1
    """,
)
def band_5(t):
    return _counts(t.part.select(fn.age_band_5(F.col("p_size") * 3 - 5).alias("ku_5")), "ku_5")


@query(
    "D2",
    """
    with aged as (select p_size * 3 - 5 as age from part)
    select (case when age between 0 and 129 then floor(age / 10) + 1 end)::bigint as g2, count(*)::bigint as rows
    from aged group by 1
    """,
)
def band_10(t):
    return _counts(t.part.select(fn.age_band_10(F.col("p_size") * 3 - 5).alias("g2")), "g2")


_CODE = "1100 + (l_partkey * 37 + l_suppkey) % 8950"


# The code ranges of the ethnic families in the SQL below.
@query(
    "D3 D4 D5",
    f"""
    with coded as (select {_CODE} as ket from lineitem),
    families as (
      select ket,
        ket in (1100, 3210) as malay,
        (ket between 2111 and 2116 or ket between 2121 and 2126 or ket between 2131 and 2136
         or (ket % 10 = 0 and (ket between 3110 and 3260 or ket between 4110 and 4360) and ket <> 3210)
         or ket in (3998, 4998)) as bumi,
        ((ket % 10 = 0 and ket between 5110 and 5200) or ket = 5998) as chinese,
        ((ket % 10 = 0 and ket between 6110 and 6180) or ket = 6998) as indian,
        ((ket % 10 = 0 and (ket between 7110 and 7230 or ket between 8110 and 8160 or ket between 9110 and 9150))
         or ket in (7998, 8998, 9998)) as others
      from coded),
    grouped as (
      select (case when malay then 1 when bumi then 2 when chinese then 3 when indian then 4 when others then 5 end)::bigint as g3,
        (case when malay then 1 when ket in (3150, 3190) then 2 when ket = 3110 then 3 when ket = 3220 then 4
              when bumi then 5 when chinese then 6 when indian or others then 7 end)::bigint as g4,
        (case when malay then 1 when ket = 4140 then 2 when ket = 4110 then 3 when ket = 4260 then 4
              when bumi then 5 when chinese then 6 when indian or others then 7 end)::bigint as g5
      from families)
    select g3, g4, g5, count(*)::bigint as rows from grouped group by all
    """,
)
def code_set_class(t):
    coded = t.lineitem.select(F.expr(_CODE).alias("ket"))
    grouped = coded.select(
        fn.code_group("ket", config.GROUPS_PENINSULAR).alias("g3"),
        fn.code_group("ket", config.GROUPS_SABAH).alias("g4"),
        fn.code_group("ket", config.GROUPS_SARAWAK).alias("g5"),
    )
    return _counts(grouped, "g3", "g4", "g5")


@query(
    "D6",
    """
    select c_nationkey::bigint as nation, (case when c_nationkey = 7 then 1 else 2 end)::bigint as class, count(*)::bigint as rows
    from customer group by all
    """,
)
def binary_class(t):
    return _counts(t.customer.select(F.col("c_nationkey").alias("nation"), fn.binary_code("c_nationkey", 7).alias("class")), "nation", "class")


@query(
    "D7",
    """
    with digits as (select c_custkey % 12 - 1 as st from customer)
    select st::bigint as st, (case when st in (1, 2) then 1 when st between 0 and 9 then 2 end)::bigint as rin_strata, count(*)::bigint as rows
    from digits group by all
    """,
)
def strata_class(t):
    digits = t.customer.select((F.col("c_custkey") % 12 - 1).alias("st"))
    return _counts(digits.withColumn("rin_strata", fn.urban_rural("st")), "st", "rin_strata")


_SECTION = "case p_brand when 'Brand#12' then 'C' when 'Brand#13' then null else 'G' end"
_EMPLOYEES = "p_size * 6 - 5 + (p_partkey % 2) * 0.5"


@query(
    "D9",
    f"""
    with firms as (select {_SECTION} as section, {_EMPLOYEES} as n from part)
    select section, (case when n < 5 then 4
        when section = 'C' then case when n >= 201 then 1 when n = floor(n) and n between 75 and 200 then 2
                                     when n = floor(n) and n between 5 and 74 then 3 end
        when n >= 76 then 1 when n = floor(n) and n between 30 and 75 then 2
        when n = floor(n) and n between 5 and 29 then 3 end)::bigint as strata_empl, count(*)::bigint as rows
    from firms group by all
    """,
)
def size_stratum(t):
    firms = t.part.selectExpr(f"{_SECTION} as section", f"cast({_EMPLOYEES} as double) as n")
    found = firms.select("section", fn.size_stratum("section", "n").cast("long").alias("strata_empl"))
    return found.groupBy("section", "strata_empl").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "D8",
    """
    with joined as (select lang, source, quality, toxic from documents left join labels using (doc_id))
    select 'lang' as "column", count(*)::bigint as rows, count(*) filter (lang is null)::bigint as nulls from joined
    union all select 'source', count(*), count(*) filter (source is null) from joined
    union all select 'quality', count(*), count(*) filter (quality is null) from joined
    union all select 'toxic', count(*), count(*) filter (toxic is null) from joined
    """,
)
def null_audit(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return audits.null_audit(joined, ["lang", "source", "quality", "toxic"])


@query(
    "AG8",
    """
    select (quality is not null)::int::bigint as present, count(*)::bigint as rows
    from documents left join labels using (doc_id) group by 1
    """,
)
def presence_counts(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return audits.presence_counts(joined, "quality").withColumn("present", F.col("present").cast("long"))


@query(
    "D11 D13 B13",
    """
    select l_orderkey, l_partkey, l_suppkey, l_quantity from lineitem
    where l_returnflag in ('A', 'R') and l_linenumber = 1
    """,
)
def filter_project(t):
    kept = t.lineitem.filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_linenumber") == 1))
    return kept.drop("l_linenumber", "l_returnflag").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "D10 D12",
    """
    select o_orderkey, (case o_orderstatus when 'F' then 1 when 'O' then 2 end)::bigint as code,
           (case when quarter(o_orderdate) in (1, 2) then 1 else 2 end)::bigint as halfyear
    from orders
    """,
)
def sex_code(t):
    return t.orders.select(
        "o_orderkey",
        fn.label_code("o_orderstatus", {"F": 1, "O": 2}).cast("long").alias("code"),
        fn.half_of_month(F.month("o_orderdate")).cast("long").alias("halfyear"),
    )


@query(
    "D16",
    """
    select count(*)::bigint as rows from orders left join documents on doc_id = o_orderkey
    where lang is null and source is null
    """,
)
def all_null_rows(t):
    joined = t.orders.join(t.documents, F.col("doc_id") == F.col("o_orderkey"), "left").select("lang", "source")
    return audits.all_null_rows(joined).agg(F.count(F.lit(1)).alias("rows"))
