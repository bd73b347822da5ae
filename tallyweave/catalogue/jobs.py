"""The whole jobs over the driver tables, with the survey inputs derived from them."""

import uuid

from pyspark.sql import functions as F

from tallyweave import config
from tallyweave.catalogue.registry import query
from tallyweave.operators.audits import sole_row
from tallyweave.operators.cells import factor_columns, population_cells, region_master
from tallyweave.operators.headers import sanitize_columns, verify_headers
from tallyweave.plans import build_state, clean_establishments, merge_states, roll_up, save_state, transfer_individual_weights, weigh_state, weight_household
from tallyweave.session import run_folder, stage

# Orders as persons, their customers as households. Valid in both SQL dialects.
PEOPLE = """
  select cast(o_orderkey as string) as PERSON,
         cast(c_nationkey % 16 + 1 as string) as NG, cast(c_custkey % 97 as string) as DP, '0' as DB,
         cast(c_custkey % 1000 as string) as BP, cast(cast(floor(c_custkey / 1000) as bigint) % 1000 as string) as BP2,
         cast(cast(floor(c_custkey / 1000000) as bigint) % 1000 as string) as CONVERTEDBP,
         cast(c_custkey % 10 as string) as ST, cast(cast(floor(c_custkey / 1000000000) as bigint) % 10000 as string) as NOTK,
         '0' as NOIR, '0' as S, '0' as NP, '0' as PKIS, '0' as HMIS, cast(1 + o_orderkey % 2 as string) as J,
         case o_orderkey % 13 when 0 then '1100' when 1 then '3210' when 2 then '3150' when 3 then '3110' when 4 then '3220'
              when 5 then '4140' when 6 then '4110' when 7 then '4260' when 8 then '2111' when 9 then '5110' when 10 then '6110'
              when 11 then '7110' else '9999' end as KET,
         '1' as B, case when o_orderkey % 89 = 88 then 'x' else cast(o_orderkey % 89 as string) end as U,
         case when c_mktsegment = 'MACHINERY' then '100' when c_mktsegment = 'BUILDING' and o_orderkey % 50 = 0 then null else '458' end as KW,
         c_name as NAMA, o_orderkey, o_orderstatus, o_orderdate
  from {orders} join {customer} on o_custkey = c_custkey
"""
HOUSEHOLDS = """
  select cast(c_nationkey % 16 + 1 as bigint) as KOD_NEGERI, case when c_custkey % 10 in (1, 2) then 1 else 2 end as RIN_STRATA,
         cast(count(*) * 3 as double) as BIL_ISI_RUMAH, cast(3 as double) as ADJUSTED_WEIGHT_BMP
  from {customer} group by 1, 2
"""
CROSSWALK = """
  select distinct cast(c_nationkey % 16 + 1 as bigint) as NG, c_custkey % 10 as ST,
         case when c_custkey % 10 in (1, 2) then 1 when c_custkey % 10 < 9 then 2 end as RIN_STRATA
  from {customer}
"""
CONTROLS = """
  select cast(s_nationkey % 16 + 1 as bigint) as NG, cast(s_suppkey % 2 + 1 as int) as CIT_NONCIT, count(*) * 1234 as people
  from {supplier} group by 1, 2
"""
BANDS = """
  select cast(c_nationkey % 16 + 1 as bigint) as NG, cast(c_custkey % 18 + 1 as int) as KU_5, c_custkey % 2 as female, count(*) as n
  from {customer} group by 1, 2, 3
"""

_COLUMNS = list(config.POPULATION_COLUMNS)
# States by region.
_REGION = """case when ng in (1,2,3,4,5,6,7,8,9,10,11,14,16) then 'SEM' when ng in (12, 15) then 'SAB' when ng = 13 then 'SAR' end"""
# Column number, group and region of the population template, written out for the comparison SQL.
_COLUMN_ROWS = """
    (0, 1, 'SEM'), (1, 2, 'SEM'), (2, 3, 'SEM'), (3, 4, 'SEM'), (4, 5, 'SEM'), (5, 0, 'SEM'), (6, 1, 'SAB'),
    (7, 2, 'SAB'), (8, 3, 'SAB'), (9, 4, 'SAB'), (10, 5, 'SAB'), (11, 6, 'SAB'), (12, 7, 'SAB'), (13, 0, 'SAB'),
    (14, 1, 'SAR'), (15, 2, 'SAR'), (16, 3, 'SAR'), (17, 4, 'SAR'), (18, 5, 'SAR'), (19, 6, 'SAR'), (20, 7, 'SAR'),
    (21, 0, 'SAR')
"""


def _plain(text: str) -> str:
    return text.format(orders="orders", customer="customer", supplier="supplier")


def _household_sql(order: str, literal: bool = False) -> str:
    """The whole weighting in SQL; ``order`` ranks the records of one response key.

    Fixed values: the ethnic codes and their groups by region, and the code of citizens.
    """
    other = "case when cit = 2 then j else grp end" if literal else "grp"
    attached = ""
    if literal:
        attached = "and (cit = 1 or (ng, ku_5) in (select (ng, ku_5) from weighed where cit = 1 and grp is not null and ku_5 is not null))"
    cell_group = "routed" if literal else "case when cit = 1 then routed else 0 end"
    return f"""
    with raw as ({_plain(PEOPLE)}),
    numbered as (
      select *, lpad(NG,2,'0') || lpad(DP,2,'0') || lpad(DB,3,'0') || lpad(BP,3,'0') || lpad(BP2,3,'0') || lpad(CONVERTEDBP,3,'0')
                || lpad(ST,1,'0') || lpad(NOTK,4,'0') || lpad(NOIR,2,'0') || lpad(S,1,'0') || lpad(NP,3,'0') || lpad(PKIS,2,'0')
                || lpad(HMIS,2,'0') || lpad(J,1,'0') || lpad(KET,4,'0') || lpad(B,2,'0') as noid_38,
             NG::bigint as state, ST::bigint as digit, J::bigint as sex, KET::bigint as code, coalesce(try_cast(U as bigint), 0) as age,
             coalesce(try_cast(KW as bigint), 0) as country from raw),
    classed as (
      select o_orderkey, o_orderdate, noid_38, state as ng, digit as st, sex as j,
             case when age >= 85 then 18 when age >= 0 then (floor(age / 5) + 1)::int end as ku_5,
             case when country = 458 then 1 else 2 end as cit, case when digit in (1, 2) then 1 else 2 end as rin,
             case when code in (1100, 3210) then 1 when code in (2111, 3150, 3110, 3220, 4140, 4110, 4260) then 2 when code = 5110 then 3 when code = 6110 then 4 when code = 7110 then 5 end as g3,
             case when code in (1100, 3210) then 1 when code = 3150 then 2 when code = 3110 then 3 when code = 3220 then 4 when code in (2111, 4140, 4110, 4260) then 5 when code = 5110 then 6 when code in (6110, 7110) then 7 end as g4,
             case when code in (1100, 3210) then 1 when code = 4140 then 2 when code = 4110 then 3 when code = 4260 then 4 when code in (2111, 3150, 3110, 3220) then 5 when code = 5110 then 6 when code in (6110, 7110) then 7 end as g5,
             B || noid_38[:23] as response_key
      from numbered),
    routed as (select *, case {_REGION} when 'SEM' then g3 when 'SAB' then g4 when 'SAR' then g5 end as routed from classed),
    people as (select *, {cell_group} as grp, case when row_number() over (partition by response_key order by {order}) = 1 then 1 else 2 end as pf from routed),
    answered as (select ng, rin, count(distinct response_key) as responding from people group by all),
    frame as ({_plain(HOUSEHOLDS)}),
    design as (select kod_negeri as ng, rin_strata as rin, (bil_isi_rumah / nullif(responding, 0) * 100)::bigint / 100.0 as aw
               from frame left join answered on ng = kod_negeri and rin = rin_strata),
    crosswalk as ({_plain(CROSSWALK)}),
    spread as (select design.ng, design.rin, crosswalk.st, aw from design join crosswalk on crosswalk.ng = design.ng and crosswalk.rin_strata = design.rin),
    weighed as (select people.*, aw from people left join spread using (ng, rin, st)),
    sample as (select ng, cit, ku_5, j, {"case when cit = 2 then 0 else grp end" if literal else "grp"} as grp, sum((aw * 100)::bigint)::double / 100 as sample
               from weighed where grp is not null and ku_5 is not null {attached} group by all),
    columns(i, grp, region) as (values {_COLUMN_ROWS}),
    bands as ({_plain(BANDS)}),
    population as (select bands.ng, case when grp = 0 then 2 else 1 end as cit, ku_5, 1 + female as j, grp, (n * (i + 3))::double as population
                   from bands join columns on region = {_REGION.replace("ng", "bands.ng", 3)}),
    factor as (select p.ng, p.cit, p.ku_5, p.j, {other.replace("grp", "p.grp").replace("cit", "p.cit").replace(" j ", " p.j ")} as grp,
                      coalesce((population / nullif(sample, 0) * 100)::bigint / 100.0, 0::double) as popfac
               from population p left join sample s on s.ng = p.ng and s.cit = p.cit and s.ku_5 = p.ku_5 and s.j = p.j and s.grp = p.grp),
    factored as (select weighed.*, coalesce(popfac, 1) as popfac, aw * coalesce(popfac, 1) as p1 from weighed left join factor using (ng, cit, ku_5, j, grp)),
    estimate as (select ng, cit, sum((p1 * 10000)::bigint)::double / 10000 as estimate from factored group by all),
    control as (select ng, cit_noncit as cit, people::double as control from ({_plain(CONTROLS)})),
    ratio as (select ng, cit, estimate, control, control / nullif(estimate, 0) as weight_pop from estimate full outer join control using (ng, cit)),
    seen as (select distinct ng, cit from people)
    select o_orderkey as person, noid_38, ng, j, ku_5::bigint as ku_5, cit::bigint as cit, rin::bigint as rin, routed::bigint as grouping, pf::bigint as pf,
           aw, popfac, p1, estimate, control, weight_pop, weight_pop * p1 as final
    from factored left join ratio using (ng, cit)
    union all
    select null, null, ng, null, null, cit, null, null, null, null, null, null, estimate, control, weight_pop, null
    from ratio anti join seen using (ng, cit)
    """


def _inputs(t):
    people = t.sql(PEOPLE, "orders", "customer").withColumn("_ord", F.col("o_orderkey"))
    households = t.sql(HOUSEHOLDS, "customer")
    crosswalk = t.sql(CROSSWALK, "customer")
    controls = t.sql(CONTROLS, "supplier").withColumn("ANGGARAN_PENDUDUK(BPPD)", F.format_number("people", 0))
    return people, households, _population(t), controls, crosswalk


def _population(t):
    bands = t.sql(BANDS, "customer")
    gender = F.when(F.col("female") == 1, "FEMALE").otherwise("MALE").alias("GENDER")
    values = [(F.col("n") * (i + 3)).cast("double").alias(c) for i, c in enumerate(_COLUMNS)]
    return bands.select(F.col("NG").alias("KOD_NEGERI"), "KU_5", gender, *values)


def _report(done):
    grouping = F.when(F.col("NG").isin(config.SABAH), F.col("G4")).when(F.col("NG").isin(config.SARAWAK), F.col("G5")).otherwise(F.col("G3"))
    return done.microdata.select(
        F.col("PERSON").cast("long").alias("person"),
        F.col("NOID_38").alias("noid_38"),
        F.col("NG").alias("ng"),
        F.col("J").alias("j"),
        F.col("KU_5").cast("long").alias("ku_5"),
        F.col("CIT_NONCIT").cast("long").alias("cit"),
        F.col("RIN_STRATA").cast("long").alias("rin"),
        grouping.cast("long").alias("grouping"),
        F.col("PF_OUTPUT").cast("long").alias("pf"),
        F.col("ADJUSTED_WEIGHT").alias("aw"),
        F.col("POPFAC").alias("popfac"),
        F.col("PEMBERAT_1").alias("p1"),
        F.col("ANGGARAN_SAMPEL_STB").alias("estimate"),
        F.col("ANGGARAN_PENDUDUK(BPPD)").alias("control"),
        F.col("WEIGHT_POP").alias("weight_pop"),
        F.col("PEMBERAT_FINAL").alias("final"),
    )


@query("P1 P2 P3 P4 P5 P6 P7 P8 P9 P10 P11 P12 P13", _household_sql("o_orderkey"))
def household_weights(t):
    return _report(weight_household(*_inputs(t)))


@query("P13 X5", _household_sql("o_orderkey", literal=True))
def household_weights_literal(t):
    return _report(weight_household(*_inputs(t), semantics=config.LITERAL))


@query("P15", _household_sql("year(o_orderdate), quarter(o_orderdate), o_orderkey"))
def rolled_up_weights(t):
    """First and second halves of the years as two finals, stacked and weighted."""
    people, *templates = _inputs(t)
    dated = people.drop("_ord").withColumns({"YEARS": F.year("o_orderdate"), "QUARTER": F.quarter("o_orderdate"), "src": F.col("o_orderkey")})
    dated = dated.drop("o_orderkey", "o_orderstatus", "o_orderdate")
    first = dated.filter("QUARTER <= 2")
    second = dated.filter("QUARTER > 2").withColumn("NOTE", F.lit("second half"))
    return _report(roll_up({"first": first, "second": second}, *templates, kind="halfyear", order="src"))


@query("P15 P14", _household_sql("year(o_orderdate), quarter(o_orderdate), o_orderkey"))
def rolled_up_finals(t):
    """Both halves of the years weighted on their own, and the two outputs stacked and weighted again."""
    people, *templates = _inputs(t)
    dated = people.drop("_ord").withColumns({"YEARS": F.year("o_orderdate"), "QUARTER": F.quarter("o_orderdate"), "src": F.col("o_orderkey")})
    dated = dated.drop("o_orderkey", "o_orderstatus", "o_orderdate")
    finals = {}
    for name, part in (("first", "QUARTER <= 2"), ("second", "QUARTER > 2")):
        done = weight_household(dated.filter(part), *templates, order=None, record_id="PERSON")
        finals[name] = stage(sanitize_columns(done.microdata), name)
    return _report(roll_up(finals, *templates, kind="halfyear", order="SRC", record_id="PERSON"))


@query("P15 P3", _household_sql("year(o_orderdate), quarter(o_orderdate), o_orderkey"))
def merged_periods(t):
    """Four quarters (of all years) as stored states, merged two by two, stored, merged again and weighted."""
    people, *templates = _inputs(t)
    dated = people.drop("_ord").withColumns({"YEARS": F.year("o_orderdate"), "QUARTER": F.quarter("o_orderdate"), "src": F.col("o_orderkey")})
    dated = dated.drop("o_orderkey", "o_orderstatus", "o_orderdate")
    database = f"states_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{run_folder(t.spark)}/{database}'")
    quarters = [build_state(dated.filter(f"QUARTER = {q}"), f"q{q}", database, order="src", buckets=8) for q in (1, 2, 3, 4)]
    first, second = (save_state(merge_states(quarters[i : i + 2]), n, database, buckets=8) for i, n in ((0, "h1"), (2, "h2")))
    done = stage(_report(weigh_state(merge_states([second, first]), *templates, record_id="PERSON")), "merged")
    t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return done


_CELLS_SQL = f"""bands as ({_plain(BANDS)}), columns(i, grp, region) as (values {_COLUMN_ROWS}),
    cells as (select bands.NG as ng, ku_5::bigint as ku_5, 1 + female as j, grp, region, (n * (i + 3))::double as people
              from bands join columns on region = {_REGION.replace("ng", "bands.ng", 3)})"""
_MASTER_GROUPS = {"1": 1, "2": 2, "3": 3, "4": 4, "5": 5, "BW": 0}


@query(
    "J5",
    f"with {_CELLS_SQL} select ng, ku_5, "
    + ", ".join(
        f"""max(case when j = {j} and grp = {g} then people / 2 end) as "{j}_{n}", max(case when j = {j} and grp = {g} then people end) as "{j}_{n}_SEM" """
        for j in (1, 2)
        for n, g in _MASTER_GROUPS.items()
    )
    + " from cells where region = 'SEM' group by all",
)
def peninsular_master(t):
    """Sample and population cells side by side; half the population stands in for the sample."""
    cell = population_cells(_population(t)).withColumn("SAMPLE", F.col("POPULATION") / 2)
    master = region_master(cell, "SEM")
    return master.withColumns({"ku_5": F.col("KU_5").cast("long")}).withColumnRenamed("NG", "ng")


@query(
    "R3",
    f"""with {_CELLS_SQL} select ng, ku_5, (case when grp = 0 then j else grp end)::bigint as block,
        coalesce(max(case when grp > 0 and j = 1 then people end), 0) as male, coalesce(max(case when grp > 0 and j = 2 then people end), 0) as female,
        max(case when grp = 0 then people end) as strangers
    from cells group by all""",
)
def factor_blocks(t):
    cell = population_cells(_population(t)).withColumn("POPFAC", F.col("POPULATION"))
    wide = factor_columns(cell)
    return wide.select(
        F.col("NG").alias("ng"),
        F.col("KU_5").cast("long").alias("ku_5"),
        F.col("block").cast("long").alias("block"),
        F.col("Male").alias("male"),
        F.col("Female").alias("female"),
        F.col("Non Citizen").alias("strangers"),
    )


@query(
    "P8 B12 D10 R1",
    f"""
    with bands as ({_plain(BANDS)}), columns(i, grp, region) as (values {_COLUMN_ROWS})
    select bands.NG as ng, (case when grp = 0 then 2 else 1 end)::bigint as cit, ku_5::bigint as ku_5, (1 + female)::bigint as j, grp::bigint as grp,
           (n * (i + 3))::double as population
    from bands join columns on region = {_REGION.replace("ng", "bands.ng", 3)}
    """,
)
def population_template(t):
    cell = population_cells(_population(t))
    return cell.select(
        F.col("NG").alias("ng"),
        F.col("CIT_NONCIT").cast("long").alias("cit"),
        F.col("KU_5").cast("long").alias("ku_5"),
        F.col("J").alias("j"),
        F.col("GRP").cast("long").alias("grp"),
        F.col("POPULATION").alias("population"),
    )


_ID_SQL = """lpad(NG,2,'0') || lpad(DP,2,'0') || lpad(DB,3,'0') || lpad(BP,3,'0') || lpad(BP2,3,'0') || lpad(CONVERTEDBP,3,'0')
             || lpad(ST,1,'0') || lpad(NOTK,4,'0') || lpad(NOIR,2,'0') || lpad(S,1,'0') || lpad(NP,3,'0') || lpad(PKIS,2,'0')
             || lpad(HMIS,2,'0') || lpad(J,1,'0') || lpad({ket},4,'0') || lpad(B,2,'0')"""
_TARGET_KET = "case when o_orderstatus = 'F' then KET else '8888' end"
_TARGET_NAME = "case when o_orderstatus = 'P' then 'NOBODY' else NAMA end"


@query(
    "P16 B2 K10 W2 W3",
    f"""
    with raw as ({_plain(PEOPLE)}),
    donor as (select {_ID_SQL.format(ket="KET")} as id_38, upper(NAMA) as nama, o_orderkey as ord, (o_orderkey % 1000)::double / 4 as weight from raw),
    target as (select o_orderkey, {_ID_SQL.format(ket=f"({_TARGET_KET})")} as id_38, upper({_TARGET_NAME}) as nama from raw),
    by_id as (select id_38, arg_min(weight, ord) as weight from donor group by 1),
    by_name as (select nama, arg_min(weight, ord) as weight from donor group by 1)
    select o_orderkey as person, t.id_38, t.nama, case when i.id_38 is not null then i.weight else n.weight end as weight,
           case when i.id_38 is not null then 'id' when n.nama is not null then 'name' else 'none' end as match, 3::bigint as months
    from target t left join by_id i on i.id_38 = t.id_38 left join by_name n on n.nama = t.nama
    """,
)
def individual_weights(t):
    people = t.sql(PEOPLE, "orders", "customer").withColumnRenamed("CONVERTEDBP", "Converted BP")
    donors = people.select("*", ((F.col("o_orderkey") % 1000) / 4).alias("PEMBERAT_FINAL"), F.col("o_orderkey").alias("_ord"))
    target = people.withColumns(
        {
            "KET": F.expr(_TARGET_KET),
            "NAMA": F.concat(F.lit(" "), F.lower(F.expr(_TARGET_NAME)), F.lit("  ")),
            "_ord": F.col("o_orderkey"),
        }
    )
    drop = ("o_orderkey", "o_orderstatus", "o_orderdate", "U", "KW")
    done, _ = transfer_individual_weights(target.drop(*drop), donors.drop(*drop, "PERSON"), month=3, year=2021)
    return done.select(
        F.col("PERSON").cast("long").alias("person"),
        F.col("ID_38").alias("id_38"),
        F.col("NAMA").alias("nama"),
        F.col("PEMBERATFINAL").alias("weight"),
        F.col("MATCH").alias("match"),
        F.col("MONTHS").cast("long").alias("months"),
    )


@query("AG9", "select max(year(o_orderdate))::bigint as year from orders")
def sole_year(t):
    """The one year that all orders carry once they are stamped with the latest."""
    latest = t.orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    stamped = t.orders.withColumn("YEAR", F.when(F.year("o_orderdate") <= latest, latest))
    return sole_row(stamped, "YEAR").select(F.col("YEAR").cast("long").alias("year"))


@query(
    "B6",
    """
    select column_name as source, case when column_name = 'p_partkey' then 'NEWSSID' when column_name = 'p_size' then 'EMPLOYEES' end as target,
           case when column_name in ('p_partkey', 'p_size') then 'mapped' else 'extra' end as status
    from (describe part) union all select 'p_absent', 'STRATA', 'missing'
    """,
)
def header_report(t):
    """Headers of the parts table held against a mapping of three names."""
    return verify_headers(t.spark, t.part.columns, [("p_partkey", "NEWSSID"), ("p_size", "EMPLOYEES"), ("p_absent", "STRATA")])


# Establishment headers: raw name -> new name. Measures of two variables plus their total.
_HEADERS = {
    "e_id": "NEWSSID",
    "e_reg": "REGISTERED_NAME",
    "e_trade": "TRADING_NAME",
    "e_year": "YEAR",
    "e_quarter": "QUARTER",
    "e_sec": "SECTION",
    "e_secs": "SECTION_SMPL",
    "e_msic": "MSIC2008",
    "e_msics": "MSIC2008_SMPL",
    "e_state": "STATE_CODE",
    "e_sub": "SUBSTATE_CODE",
    "e_strata": "STRATA_EMPL",
    "e_emp": "B23104F1310",
    "m_l1": "L23104F01011",
    "m_l2": "L23104F01012",
    "m_l0": "L23104F01010",
    "m_m1": "M23104F01011",
    "m_m2": "M23104F01012",
    "m_m0": "M23104F01010",
    "m_q1": "Q23104F01011",
    "m_q2": "Q23104F01012",
    "m_q0": "Q23104F01010",
}


@query(
    "P17 P18 P20 B5 J11 J13 D9 C15",
    """
    with code as (select n_nationkey, case when n_regionkey = 2 then 'C' else n_name end as section from nation),
    firm as (
      select p_partkey, lpad(p_partkey::varchar, 12, '0') as padded, a.section as section, b.section as section_smpl, p_size * 6 - 5 as n,
             p_size as l1, p_partkey % 7 as l2, p_partkey % 11 as m1, 3 as m2
      from part left join code a on a.n_nationkey = p_partkey % 30 left join code b on b.n_nationkey = p_partkey % 25)
    select case when p_partkey = 0 then '0' else padded end as newssid, s_name as registered_name, section, section_smpl,
           lpad((p_partkey % 30)::varchar, 5, '0') as msic, (case when n < 5 then 4
             when section_smpl = 'C' then case when n >= 201 then 1 when n >= 75 then 2 else 3 end
             when n >= 76 then 1 when n >= 30 then 2 else 3 end)::bigint as strata_empl,
           (l1 + l2)::bigint as l0, (m1 + m2)::bigint as m0, (l1 + m1)::bigint as q1, (l2 + m2)::bigint as q2, (l1 + l2 + m1 + m2)::bigint as q0
    from (select *, case when p_partkey % 30 = 0 then '0' end as zero from firm) left join supplier on s_suppkey = p_partkey
    """.replace("lpad((p_partkey % 30)::varchar, 5, '0') as msic", "coalesce(zero, lpad((p_partkey % 30)::varchar, 5, '0')) as msic"),
)
def establishments(t):
    key = F.col("p_partkey")
    made = {
        "e_id": key,
        "e_year": F.lit(2023),
        "e_quarter": F.lit(1),
        "e_msic": key % 30,
        "e_msics": key % 25,
        "e_state": key % 16,
        "e_sub": key % 20,
        "e_emp": F.col("p_size") * 6 - 5,
        "m_l1": F.col("p_size"),
        "m_l2": key % 7,
        "m_m1": key % 11,
        "m_m2": F.lit("3.9"),
        "extra": F.lit("dropped"),
    }
    raw = t.part.select(*[c.cast("string").alias(n) for n, c in made.items()])
    mapping = t.spark.createDataFrame(
        [(str(i), old, new) for i, (old, new) in enumerate(_HEADERS.items())],
        "`NEW_ORDER BY VAR` string, `ORI_EJOB HEADER` string, `NEW_DATASET HEADER` string",
    )
    industries = t.nation.select(
        F.col("n_nationkey").cast("string").alias("without '0'"),
        F.when(F.col("n_regionkey") == 2, "C").otherwise(F.col("n_name")).alias("SECTION"),
    )
    sample = t.supplier.select(F.col("s_suppkey").cast("string").alias("NEWSSID"), F.col("s_name").alias("REGISTERED_NAME"), F.lit(None).cast("string").alias("TRADING_NAME"))
    done, _ = clean_establishments(raw, mapping, industries, sample)
    totals = {"l0": "L23104F01010", "m0": "M23104F01010", "q1": "Q23104F01011", "q2": "Q23104F01012", "q0": "Q23104F01010"}
    return done.select(
        F.col("NEWSSID").alias("newssid"),
        F.col("REGISTERED_NAME").alias("registered_name"),
        F.col("SECTION").alias("section"),
        F.col("SECTION_SMPL").alias("section_smpl"),
        F.col("MSIC2008").alias("msic"),
        F.col("STRATA_EMPL").cast("long").alias("strata_empl"),
        *[F.col(c).alias(n) for n, c in totals.items()],
    )
