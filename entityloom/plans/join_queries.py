"""Projections, filters, scalar expressions and lookups."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from entityloom.functions.scalars import iso_date, or_zero
from entityloom.operators.fanout import fan_outs
from entityloom.operators.labels import first_of_each_label
from entityloom.operators.lookups import Lookup, lookup_join, widen
from entityloom.plans.order_profile import (
    NATION_LIST,
    REGION_LIST,
    code_table,
    numeric_code,
    order_profile,
    with_code_tables,
)
from entityloom.plans.registry import query
from entityloom.sources.cuts import balanced_conditions
from entityloom.sources.jdbc import text_ranges
from entityloom.sources.tables import query_rows

CODES = """
  codes as (
    select 33 as ref_id, cast(n_nationkey as varchar) as code_value, n_name as code_desc,
           case when n_regionkey < 4 then 'en' else 'fr' end as lang
    from nation
    union all
    select 33, cast(n_nationkey as varchar), 'FR_' || n_name, 'fr'
    from nation where n_regionkey < 4
    union all
    select 1, cast(r_regionkey as varchar), r_name, 'en' from region
    union all
    select distinct 99, p_brand, p_type, 'en' from part
  )
"""

NATION = Lookup(
    "nation",
    on={"n_nationkey": "c_nationkey"},
    take={"nation_name": "n_name", "region_key": "n_regionkey"},
)


@query(
    f"""
    with {CODES},
    status(code, descr, lang) as (
      values ('F', 'finished', 'en'), ('O', 'open', 'en'), ('F', 'fini', 'fr')
    )
    select cast(o_orderkey as varchar) as order_id,
           o_orderstatus as order_status_code,
           status.descr as order_status_desc,
           strftime(o_orderdate, '%Y-%m-%d') as order_date,
           coalesce(l_extendedprice, 0) as first_line_amount,
           c_name as customer_name,
           n_name as nation_name,
           nd.code_desc as nation_desc,
           rd.code_desc as region_desc
    from orders
    left join status on status.code = o_orderstatus and status.lang = 'en'
    left join lineitem on l_orderkey = o_orderkey and l_linenumber = 1
    left join customer on c_custkey = o_custkey and c_mktsegment = 'BUILDING'
    left join nation on n_nationkey = c_nationkey
    left join codes nd on try_cast(nd.code_value as smallint) = c_nationkey
      and nd.ref_id = 33 and nd.lang = 'en'
    left join codes rd on try_cast(rd.code_value as smallint) = n_regionkey
      and rd.ref_id = 1 and rd.lang = 'en'
    """
)
def entity_profile(t):
    return order_profile().rows(with_code_tables(t))


@query(
    """
    select cast(o_orderkey as varchar) as order_id, o_totalprice as total_amount,
           o_orderpriority as priority_code
    from orders
    """
)
def project_alias(t):
    return t["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("priority_code"),
    )


@query("select * from orders where o_custkey = 42")
def filter_param(t):
    return t["orders"].where(F.col("o_custkey") == F.lit(42))


@query(
    """
    select o_orderkey, o_orderstatus, o_totalprice from orders
    where o_orderstatus = 'F' and o_totalprice >= 100000
    """
)
def query_text(t):
    return query_rows(
        t["orders"].sparkSession,
        t,
        "select o_orderkey, o_orderstatus, o_totalprice, o_custkey as O_ORDERKEY "
        "from {orders} where o_orderstatus = :status and o_totalprice >= :least",
        {"status": "F", "least": 100000},
    )


@query(
    """
    select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as order_date from orders
    """
)
def date_to_text(t):
    return t["orders"].select("o_orderkey", iso_date(F.col("o_orderdate")).alias("order_date"))


LABEL = Lookup("labels", on={"doc_id": "doc_id"}, take={"quality": "quality"})


@query(
    """
    select d.doc_id, coalesce(l.quality, 0) as quality
    from documents d left join labels l on l.doc_id = d.doc_id
    """
)
def coalesce_default(t):
    rows = lookup_join(t["documents"].select("doc_id"), t["labels"], LABEL)
    return rows.select("doc_id", or_zero(F.col("quality")).alias("quality"))


@query(
    """
    select c_custkey, c_name, n_name as nation_name
    from customer left join nation on n_nationkey = c_nationkey
    """,
    name="lookup_join",
)
def lookup_join_nation(t):
    rows = lookup_join(t["customer"], t["nation"], NATION)
    return rows.select("c_custkey", "c_name", "nation_name")


@query(
    """
    select d.doc_id, l.toxic
    from documents d left join labels l on l.doc_id = d.doc_id and l.quality = 1
    """
)
def lookup_literal_on(t):
    good = Lookup(
        "labels", on={"doc_id": "doc_id"}, where={"quality": 1}, take={"toxic": "toxic"}
    )
    return lookup_join(t["documents"].select("doc_id"), t["labels"], good)


@query(
    f"""
    with {CODES}
    select c_custkey, code_desc as nation_desc
    from customer left join codes on try_cast(code_value as smallint) = c_nationkey
      and ref_id = 33 and lang = 'en'
    """
)
def cast_key_lookup(t):
    spec = numeric_code(NATION_LIST, "c_nationkey", "nation_desc")
    rows = lookup_join(t["customer"], code_table(t), spec)
    return rows.select("c_custkey", "nation_desc")


@query(
    """
    select o_orderkey, c_name as customer_name, n_name as nation_name, r_name as region_name
    from orders
    left join customer on c_custkey = o_custkey and c_mktsegment = 'BUILDING'
    left join nation on n_nationkey = c_nationkey
    left join region on r_regionkey = n_regionkey
    """
)
def chained_lookup(t):
    rows = widen(
        t["orders"].select("o_orderkey", "o_custkey"),
        t,
        [
            Lookup(
                "customer",
                on={"c_custkey": "o_custkey"},
                where={"c_mktsegment": "BUILDING"},
                take={"customer_name": "c_name", "c_nationkey": "c_nationkey"},
            ),
            NATION,
            Lookup(
                "region", on={"r_regionkey": "region_key"}, take={"region_name": "r_name"}
            ),
        ],
    )
    return rows.select("o_orderkey", "customer_name", "nation_name", "region_name")


@query(
    """
    select c_custkey, o_orderkey as pending_order, o_totalprice as pending_amount
    from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'P'
    """
)
def satellite_fanout(t):
    pending = Lookup(
        "orders",
        on={"o_custkey": "c_custkey"},
        where={"o_orderstatus": "P"},
        take={"pending_order": "o_orderkey", "pending_amount": "o_totalprice"},
        satellite=True,
    )
    return widen(t["customer"].select("c_custkey"), t, [pending])


@query(
    f"""
    with {CODES}
    select c_custkey, nd.code_desc as nation_desc, rd.code_desc as region_desc
    from customer
    left join nation on n_nationkey = c_nationkey
    left join codes nd on try_cast(nd.code_value as smallint) = c_nationkey
      and nd.ref_id = 33 and nd.lang = 'en'
    left join codes rd on try_cast(rd.code_value as smallint) = n_regionkey
      and rd.ref_id = 1 and rd.lang = 'en'
    """
)
def lookup_reuse(t):
    rows = widen(
        t["customer"].select("c_custkey", "c_nationkey"),
        {"nation": t["nation"], "codes": code_table(t)},
        [
            NATION,
            numeric_code(NATION_LIST, "c_nationkey", "nation_desc"),
            numeric_code(REGION_LIST, "region_key", "region_desc"),
        ],
    )
    return rows.select("c_custkey", "nation_desc", "region_desc")


@query(
    """
    select o_orderkey, o_custkey as custkey
    from orders left join customer on c_custkey = o_custkey
    """
)
def duplicate_label(t):
    orders = t["orders"].select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = t["customer"].select(F.col("c_custkey").alias("custkey"))
    rows = orders.join(customers, orders.custkey == customers.custkey, "left")
    return first_of_each_label(rows)


@query(
    """
    select c_custkey, n_name as nation_name from customer
    left join nation on n_nationkey = c_nationkey
    """
)
def lookup_padded(t):
    """Padding on the base, on the table, on both and on neither."""

    def padded(key: str, of: str, width: int):
        text = F.col(key).cast("string")
        return F.when(F.col(of) % 2 == 0, F.rpad(text, width, " ")).otherwise(text)

    customers = t["customer"].select(
        "c_custkey", padded("c_nationkey", "c_custkey", 5).alias("nation_code")
    )
    nations = t["nation"].select(
        padded("n_nationkey", "n_regionkey", 9).alias("code"),
        "n_name",
        F.lit("en ").alias("language"),
    )
    spec = Lookup(
        "nation",
        on={"code": "nation_code"},
        where={"language": "en"},
        take={"nation_name": "n_name"},
        trim=True,
    )
    return lookup_join(customers, nations, spec).select("c_custkey", "nation_name")


CUTS = ["Customer#000000100", "Customer#000000500", "Customer#000001000"]


@query(
    """
    select c_custkey, 1 as times_read,
           (c_name >= 'Customer#000000100')::int + (c_name >= 'Customer#000000500')::int
             + (c_name >= 'Customer#000001000')::int as read_by
    from customer
    """
)
def text_range_split(t):
    met = [F.expr(condition).cast("int") for condition in text_ranges("c_name", CUTS)]
    read_by = [F.lit(i) * m for i, m in enumerate(met)]
    return t["customer"].select(
        "c_custkey",
        sum(met[1:], met[0]).alias("times_read"),
        sum(read_by[1:], read_by[0]).alias("read_by"),
    )


@query(
    """
    select count(*) as rows, count(*) as met_once, count(*) filter (o_custkey % 3 = 0) as hot,
           true as balanced
    from orders
    """
)
def balanced_parts(t):
    """Orders, a third of them on one customer, cut into parts by a sample of their own."""
    third = F.when(F.col("o_custkey") % 3 == 0, F.lit(3)).otherwise(F.col("o_custkey"))
    orders = t["orders"].select(third.alias("customer"), F.col("o_orderkey").alias("order"))
    share = max(0.05, min(1.0, 50_000 / max(1, orders.count())))
    sample = orders.sample(share, seed=3)
    conditions = balanced_conditions(sample, "customer", 12, "`order`")
    met = [F.expr(condition).cast("int") for condition in conditions]
    sizes = [F.sum(m).alias(f"p{i}") for i, m in enumerate(met)]
    whole = orders.agg(
        F.count("*").alias("rows"),
        F.count_if(sum(met[1:], met[0]) == 1).alias("met_once"),
        F.count_if(F.col("customer") == 3).alias("hot"),
        *sizes,
    )
    largest = F.greatest(*[F.col(f"p{i}") for i in range(len(met))])
    balanced = largest <= 2.2 * F.col("rows") / 12  # twice the mean, and the sample's error
    return whole.select("rows", "met_once", "hot", balanced.alias("balanced"))


@query(
    f"""
    with {CODES},
    met as (
      select 'nation' as lookup, count(*) as before, count(*) as after from customer
      union all
      select 'orders', count(*), sum(greatest(n, 1))::bigint
      from (select c_custkey, count(o_orderkey) as n
            from customer left join orders on o_custkey = c_custkey group by c_custkey)
      union all
      select 'codes', count(*), sum(greatest(n, 1))::bigint
      from (select c_custkey, (select count(*) from codes
                               where ref_id = 1 and code_value = cast(n_regionkey as varchar)) as n
            from customer left join nation on n_nationkey = c_nationkey)
    )
    select * from met
    """
)
def lookup_fan_out(t):
    """What each lookup makes of a customer's row; the codes are looked up by the nation's region."""
    codes = code_table(t).where("code_table_ref_id = 1")
    lookups = [
        replace(NATION, take={"region_key": "n_regionkey"}),
        Lookup("orders", on={"o_custkey": "c_custkey"}, take={"order": "o_orderkey"}, satellite=True),
        Lookup("codes", on={"code_value": "region_key"}, take={"region": "code_desc"}, code_type="int"),
    ]
    tables = {"nation": t["nation"], "orders": t["orders"], "codes": codes}
    found = fan_outs(t["customer"].select("c_custkey", "c_nationkey"), tables, lookups)
    rows = [(f.table, f.before, f.after) for f in found]
    return t["customer"].sparkSession.createDataFrame(rows, "lookup string, before long, after long")
