"""The type rules, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from entityloom.operators.entities import to_long, with_key
from entityloom.operators.lookups import lookup_join
from entityloom.operators.normalise import normalise
from entityloom.plans.join_queries import LABEL
from entityloom.plans.registry import query


@query(
    """
    select cast(n_nationkey as bigint) as n_nationkey, n_name,
           cast(n_regionkey as bigint) as n_regionkey
    from nation
    """
)
def norm_int(t):
    return normalise(t["nation"])


@query("select c_custkey, c_acctbal < 0 as in_debt from customer")
def norm_bool(t):
    return normalise(
        t["customer"].select("c_custkey", (F.col("c_acctbal") < 0).alias("in_debt"))
    )


@query("select c_custkey, hex(cast(c_name as blob)) as name_bytes from customer")
def norm_binary(t):
    rows = normalise(
        t["customer"].select("c_custkey", F.col("c_name").cast("binary").alias("name"))
    )
    return rows.select("c_custkey", F.hex("name").alias("name_bytes"))


@query(
    """
    select vec_id, cast(unnest(range(len(embedding))) as bigint) as place,
           cast(unnest(embedding) as double) as value
    from embeddings
    """
)
def norm_float(t):
    return normalise(
        t["embeddings"].select("vec_id", F.posexplode("embedding").alias("place", "value"))
    )


@query(
    """
    select event_id,
           'INTERVAL ''' || user_id || ' 00:00:00'' DAY TO SECOND' as days,
           'INTERVAL ''' || user_id // 12 || '-' || user_id % 12 || ''' YEAR TO MONTH' as months
    from events
    """
)
def norm_interval(t):
    number = F.col("user_id").cast("int")
    return normalise(
        t["events"].select(
            "event_id",
            F.make_dt_interval(number).alias("days"),
            F.make_ym_interval(F.lit(0), number).alias("months"),
        )
    )


@query(
    """
    select o_orderkey, cast(cast(o_totalprice as decimal(15,2)) as double) as total
    from orders
    """
)
def norm_decimal(t):
    total = F.col("o_totalprice").cast("decimal(15,2)").alias("total")
    return normalise(t["orders"].select("o_orderkey", total))


@query("select c_custkey, c_name from customer")
def norm_string(t):
    return normalise(t["customer"].select("c_custkey", "c_name"))


@query(
    """
    select o_orderkey, cast(cast(o_orderdate as date) as timestamp) as order_day
    from orders
    """
)
def norm_date(t):
    day = F.col("o_orderdate").cast("date").alias("order_day")
    return normalise(t["orders"].select("o_orderkey", day))


@query("select event_id, ts from events")
def norm_timestamp(t):
    return normalise(t["events"].select("event_id", "ts"))


@query(
    """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
           '[' || l_partkey || ',null,' || l_suppkey || ']' as made_of,
           '{"flag":"' || l_returnflag || '","gap":null}' as state
    from lineitem
    """
)
def norm_other_text(t):
    gap = F.lit(None)
    return normalise(
        t["lineitem"].select(
            "l_orderkey",
            "l_linenumber",
            F.array("l_partkey", gap.cast("bigint"), "l_suppkey").alias("made_of"),
            F.struct(
                F.col("l_returnflag").alias("flag"), gap.cast("string").alias("gap")
            ).alias("state"),
        )
    )


@query(
    """
    select page_id, cast(to_json(string_split(url, '/')) as varchar) as url_parts
    from pages
    """
)
def norm_text_array(t):
    parts = F.split("url", "/").alias("url_parts")
    return normalise(t["pages"].select("page_id", parts))


@query(
    """
    select 'Document' as kind, cast(d.doc_id as varchar) as key_name,
           'quality' as property,
           case when l.quality is null then 'null' else 'long' end as value_type,
           cast(l.quality as bigint) as long_value
    from documents d left join labels l on l.doc_id = d.doc_id
    union all
    select 'Document', cast(doc_id as varchar), 'doc_id', 'long', doc_id from documents
    """
)
def norm_null(t):
    rows = lookup_join(t["documents"].select("doc_id"), t["labels"], LABEL)
    keyed = with_key(normalise(rows), ["doc_id"], "demo", "Document", cast_keys=True)
    return to_long(keyed).select("kind", "key_name", "property", "value_type", "long_value")


@query(
    """
    select o_orderkey, cast(cast(o_totalprice as decimal(15,2)) as varchar) as total
    from orders
    """
)
def norm_override(t):
    total = F.col("o_totalprice").cast("decimal(15,2)").alias("total")
    return normalise(
        t["orders"].select("o_orderkey", total),
        overrides={"decimal": lambda c: c.cast("string")},
    )


@query(
    """
    select key_name, property, value_type, long_value, string_value from (
      select cast(p_partkey as varchar) as key_name, 'part_id' as property,
             'string' as value_type, cast(null as bigint) as long_value,
             cast(p_partkey as varchar) as string_value
      from part
      union all
      select cast(p_partkey as varchar), 'brand', 'long', try_cast(p_brand as integer), null
      from part where try_cast(p_brand as integer) is not null
      union all
      select cast(p_partkey as varchar), 'size', 'long', cast(p_size as bigint), null
      from part
    )
    """
)
def drop_bad_value(t):
    rows = t["part"].select(
        F.col("p_partkey").cast("string").alias("part_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("size"),
    )
    typed = normalise(rows, reads={"brand": "int", "size": "int"})
    long = to_long(with_key(typed, ["part_id"], "demo", "Part"))
    return long.select("key_name", "property", "value_type", "long_value", "string_value")
