"""Keys, entity forms, collapse, upsert, sinks and run counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from entityloom.operators.collapse import ROWS, Order, collapse_by_key, collapse_counted
from entityloom.operators.entities import KEY, split_bad_keys, to_long, with_key
from entityloom.operators.lookups import Lookup, lookup_join
from entityloom.operators.metrics import run_metrics
from entityloom.operators.normalise import normalise
from entityloom.operators.upsert import upsert_entities
from entityloom.plans.entity_job import EntityRules, run, store
from entityloom.plans.registry import SCHEMAS, query
from entityloom.sources.buckets import read_buckets, upsert_buckets
from entityloom.sources.entity_rows import PARQUET_CLIENT, ClientSource
from entityloom.sources.entity_store import write_entities
from entityloom.sources.files import write_by_date
from entityloom.sources.folder_store import STORE, stored_rows
from entityloom.sources.shared import new_folder, new_path
from entityloom.sources.tables import land

PROJECT = "demo"

LONG_SQL = """
    select 'Customer' as kind, cast(c_custkey as varchar) as key_name,
           'customer_id' as property, 'string' as value_type,
           cast(null as bigint) as long_value, cast(null as double) as double_value,
           cast(c_custkey as varchar) as string_value
    from customer
    union all
    select 'Customer', cast(c_custkey as varchar), 'name', 'string', null, null, c_name
    from customer
    union all
    select 'Customer', cast(c_custkey as varchar), 'nation', 'long', c_nationkey, null, null
    from customer
    union all
    select 'Customer', cast(c_custkey as varchar), 'balance', 'double', null, c_acctbal, null
    from customer
"""
LONG_COLUMNS = [
    "kind",
    "key_name",
    "property",
    "value_type",
    "long_value",
    "double_value",
    "string_value",
]


def keyed_customers(t):
    rows = t["customer"].select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    return with_key(normalise(rows), ["customer_id"], PROJECT, "Customer")


@query(
    """
    select 'demo' as project, 'LineItem' as kind,
           l_orderkey || '/' || l_linenumber as key_name, count(*) as rows_per_key
    from lineitem group by l_orderkey, l_linenumber
    """
)
def entity_key(t):
    # Different parts give different keys, so the parts can be counted before the text is made.
    rows = t["lineitem"].groupBy("l_orderkey", "l_linenumber")
    keyed = with_key(
        normalise(rows.agg(F.count("*").alias("rows_per_key"))),
        ["l_orderkey", "l_linenumber"],
        PROJECT,
        "LineItem",
        cast_keys=True,
    )
    return keyed.select(
        F.col(f"{KEY}.project").alias("project"),
        F.col(f"{KEY}.kind").alias("kind"),
        F.col(f"{KEY}.name").alias("key_name"),
        "rows_per_key",
    )


@query(
    """
    select 'demo' as project, 'Customer' as kind, cast(c_custkey as varchar) as key_name,
           cast(c_custkey as varchar) as customer_id, c_name as name,
           cast(c_nationkey as bigint) as nation, c_acctbal as balance
    from customer
    """
)
def entity_wide(t):
    return keyed_customers(t).select(
        F.col(f"{KEY}.project").alias("project"),
        F.col(f"{KEY}.kind").alias("kind"),
        F.col(f"{KEY}.name").alias("key_name"),
        "customer_id",
        "name",
        "nation",
        "balance",
    )


@query(LONG_SQL)
def entity_long(t):
    return to_long(keyed_customers(t)).select(*LONG_COLUMNS)


@query(
    """
    select d.doc_id, d.lang
    from documents d left join labels l on l.doc_id = d.doc_id
    where l.doc_id is null
    """
)
def key_quarantine(t):
    label = Lookup("labels", on={"doc_id": "doc_id"}, take={"label_id": "doc_id"})
    rows = lookup_join(t["documents"].select("doc_id", "lang"), t["labels"], label)
    keyed = with_key(normalise(rows), ["label_id"], PROJECT, "Label", cast_keys=True)
    _, bad = split_bad_keys(keyed)
    return bad.select("doc_id", "lang")


@query(
    """
    select o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate
    from (
      select *, row_number() over (
        partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
      from orders
    ) where rn = 1
    """,
    name="collapse_by_key",
)
def collapse_by_key_latest(t):
    orders = t["orders"].select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    latest_first = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    return collapse_by_key(orders, ["o_custkey"], latest_first)


@query(
    """
    select cast(o_orderkey as varchar) as order_id,
           case when o_orderdate >= '2000-01-01' then 'incoming' else 'current' end as batch,
           o_totalprice as amount,
           case when o_orderdate >= '2000-01-01' then o_orderpriority end as priority
    from orders
    """,
    name="upsert_entities",
)
def upsert_orders(t):
    stored = F.col("o_orderkey").cast("string").alias("order_id")
    amount = F.col("o_totalprice").alias("amount")
    current = (
        t["orders"]
        .where("o_orderdate < timestamp_ntz '2001-01-01 00:00:00'")
        .select(stored, F.lit("current").alias("batch"), amount)
    )
    incoming = (
        t["orders"]
        .where("o_orderdate >= timestamp_ntz '2000-01-01 00:00:00'")
        .select(
            stored,
            F.lit("incoming").alias("batch"),
            amount,
            F.col("o_orderpriority").alias("priority"),
        )
    )
    return upsert_entities(current, incoming, "order_id")


UPSERT_LONG_SQL = """
    with stored as (
      select cast(o_orderkey as varchar) as key_name, *, o_orderdate >= '2000-01-01' as late
      from orders)
    select key_name, 'order_id' as property, 'string' as value_type,
           cast(null as bigint) as long_value, cast(null as double) as double_value,
           key_name as string_value
    from stored
    union all
    select key_name, 'amount', 'double', null, o_totalprice, null from stored
    union all
    select key_name, 'status', 'string', null, null, o_orderstatus from stored where not late
    union all
    select key_name, 'rank', case o_orderstatus when 'F' then 'long' else 'null' end,
           case o_orderstatus when 'F' then cast(o_orderpriority[1] as bigint) end, null, null
    from stored where late and o_orderstatus <> 'O'
"""


def order_batches(t, spelled: str = "amount"):
    """Stored and incoming orders: each side has a property the other lacks, one is spelled
    ``spelled`` on the incoming side, and ranks of open orders cannot be read."""
    order_id = F.col("o_orderkey").cast("string").alias("order_id")
    amount = F.col("o_totalprice").alias("amount")
    digit = F.substring("o_orderpriority", 1, 1)
    current = t["orders"].where("o_orderdate < timestamp_ntz '2001-01-01 00:00:00'")
    current = normalise(current.select(order_id, amount, F.col("o_orderstatus").alias("status")))
    rank = F.when(F.col("o_orderstatus") == "F", digit).when(F.col("o_orderstatus") == "O", "none")
    incoming = t["orders"].where("o_orderdate >= timestamp_ntz '2000-01-01 00:00:00'")
    incoming = normalise(
        incoming.select(order_id, amount.alias(spelled), rank.alias("rank")), reads={"rank": "int"}
    )
    return [with_key(df, ["order_id"], PROJECT, "Order") for df in (current, incoming)]


ORDER_LONG = ["key_name", "property", "value_type", "long_value", "double_value", "string_value"]


@query(
    """
    select cast(c_custkey as varchar) as key_name, 'balance' as property, 'decimal' as value_type,
           cast(cast(cast(c_acctbal as decimal(11,2)) as decimal(14,5)) as varchar) as amount
    from customer
    union all
    select cast(c_custkey as varchar), 'share', 'decimal',
           cast(cast(cast(c_nationkey as decimal(8,5)) as decimal(14,5)) as varchar)
    from customer
    """
)
def entity_long_decimals(t):
    """Kept decimals of two scales, in one value column that holds both."""
    rows = t["customer"].select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_acctbal").cast("decimal(11,2)").alias("balance"),
        F.col("c_nationkey").cast("decimal(8,5)").alias("share"),
    )
    long = to_long(with_key(normalise(rows, decimal="keep"), ["id"], PROJECT, "Customer"))
    amounts = long.where("value_type = 'decimal'")
    amount = F.col("decimal_value").cast("string").alias("amount")
    return amounts.select("key_name", "property", "value_type", amount)


@query(UPSERT_LONG_SQL)
def upsert_long(t):
    """One property has two spellings; the stored one counts."""
    return to_long(upsert_entities(*order_batches(t, "Amount"), KEY)).select(*ORDER_LONG)


@query(UPSERT_LONG_SQL, name="upsert_buckets")
def upsert_in_buckets(t):
    """The same through a store in buckets, the incoming orders in two writes."""
    current, incoming = order_batches(t)
    path = new_path(t["orders"].sparkSession, "bucket-store")
    upsert_buckets(path, current, buckets=16)
    late = F.crc32(F.col("order_id").cast("binary")) % 3 == 0
    for part in (incoming.where(late), incoming.where(~late)):
        upsert_buckets(path, part)
    return to_long(read_buckets(current.sparkSession, path)).select(*ORDER_LONG)


@query(
    """
    select cast(event_id as varchar) as key_name, 'event_id' as property,
           'string' as value_type, cast(event_id as varchar) as string_value,
           cast(null as boolean) as bool_value, cast(null as varchar) as blob_hex,
           cast(null as timestamp) as timestamp_value
    from events
    union all
    select cast(event_id as varchar), 'large', 'bool', null, value > 50, null, null from events
    union all
    select cast(event_id as varchar), 'props', 'blob', null, null, hex(cast(props as blob)), null
    from events
    union all
    select cast(event_id as varchar), 'ts', 'timestamp', null, null, null, ts from events
    """
)
def entity_long_types(t):
    rows = t["events"].select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("value") > 50).alias("large"),
        F.col("props").cast("binary").alias("props"),
        "ts",
    )
    long = to_long(with_key(normalise(rows), ["event_id"], PROJECT, "Event"))
    return long.select(
        "key_name",
        "property",
        "value_type",
        "string_value",
        "bool_value",
        F.hex("blob_value").alias("blob_hex"),
        F.col("timestamp_value").cast("timestamp_ntz").alias("timestamp_value"),
    )


@query(
    LONG_SQL.replace("c_acctbal, null", "case when c_acctbal < 0 then 0 else c_acctbal end, null")
)
def entity_sink(t):
    """Two writes with overlapping keys; the second sets the balance of debtors to zero."""
    first = keyed_customers(t)
    second = first.where("balance < 0").withColumn("balance", F.lit(0.0))
    stored = store(store(None, first), second)
    return to_long(stored).select(*LONG_COLUMNS)


LONG_SCHEMA = (
    "kind string, key_name string, property string, value_type string,"
    " long_value bigint, double_value double, string_value string"
)


@query(
    LONG_SQL.replace("c_acctbal, null", "case when c_acctbal < 0 then 0 else c_acctbal end, null")
)
def external_store(t):
    """The writes of ``entity_sink`` put into a keyed store through the data source, a property a row."""
    first = keyed_customers(t)
    spark = t["customer"].sparkSession
    second = first.where("balance < 0").withColumn("balance", F.lit(0.0))
    folder = new_folder(spark, "folder-store")
    for number, rows in enumerate((first, second)):
        options = {"folder": folder, "write": str(number)}
        long = to_long(rows).select(*LONG_COLUMNS)
        write_entities(long, STORE, options, LONG_COLUMNS[:3], batch_rows=20_000)
    return stored_rows(spark, folder, LONG_SCHEMA, LONG_COLUMNS[:3])


@query(
    """
    select o_orderkey, o_custkey, o_totalprice, c_name
    from orders left join customer on c_custkey = o_custkey
    where o_orderstatus = 'F'
    """
)
def client_rows(t):
    """Two tables read through a client of one's own, by row groups; the filter reaches it."""
    spark = t["orders"].sparkSession
    folder = new_path(spark, "for-a-client")
    for name in ("orders", "customer"):
        land(t[name], name, folder)
    source = ClientSource(
        PARQUET_CLIENT,
        {name: SCHEMAS[name] for name in ("orders", "customer")},
        {"folder": folder},
    )
    orders = source.rows(
        spark, "orders", columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    )
    name = Lookup("customer", on={"c_custkey": "o_custkey"}, take={"c_name": "c_name"})
    customers = source.rows(spark, "customer", columns=["c_custkey", "c_name"])
    rows = lookup_join(orders.where("o_orderstatus = 'F'"), customers, name)
    return rows.drop("o_orderstatus")


@query(
    """
    with rows as (
      select c.conv_id, c.role, l.doc_id as label_id
      from conversations c left join labels l on l.doc_id = c.conv_id
    )
    select count(*) as rows,
           count(*) - count(label_id) as bad_keys,
           count(role) - count(try_cast(role as integer)) as dropped_values,
           count(distinct label_id) as entities,
           count(label_id) - count(distinct label_id) as collapsed,
           'role=' || (count(role) - count(try_cast(role as integer))) as dropped_by_column
    from rows
    """,
    name="run_metrics",
)
def run_metrics_conversations(t):
    counts = run_metrics(TALK.keyed(turns(t)))
    return counts.withColumn("dropped_by_column", by_column_text())


TALK = EntityRules(
    ["label_id"], PROJECT, "Talk", cast_keys=True, reads={"role": "int"}, keep_rejected=True
)


def turns(t):
    label = Lookup("labels", on={"doc_id": "conv_id"}, take={"label_id": "doc_id"})
    return lookup_join(t["conversations"].select("conv_id", "role"), t["labels"], label)


def by_column_text():
    """The counts by column as text, ``name=count`` by name."""
    pairs = F.transform(
        F.array_sort(F.map_entries("dropped_by_column")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return F.array_join(pairs, ",")


@query(
    """
    with rows as (
      select c.conv_id, c.role, l.doc_id as label_id
      from conversations c left join labels l on l.doc_id = c.conv_id
    )
    select count(*) as rows,
           count(*) - count(label_id) as bad_keys,
           count(role) - count(try_cast(role as integer)) as dropped_values,
           count(distinct label_id) as entities,
           count(label_id) - count(distinct label_id) as collapsed,
           'role=' || (count(role) - count(try_cast(role as integer))) as dropped_by_column
    from rows
    """
)
def run_exact_metrics(t):
    """The counts of a whole run, from the entities and the quarantine it landed."""
    counts = run(turns(t), TALK, exact_counts=True).metrics
    return counts.withColumn("dropped_by_column", by_column_text())


@query(
    """
    select cast(l.doc_id as varchar) as key_name, 'role' as property, 'string' as source_type,
           'int' as wanted_type, c.role as raw_text
    from conversations c left join labels l on l.doc_id = c.conv_id
    where c.role is not null and try_cast(c.role as integer) is null
    """
)
def run_rejected(t):
    """Every value of a run that could not be read."""
    rejected = run(turns(t), TALK).rejected
    return rejected.select("key_name", "property", "source_type", "wanted_type", "raw_text")


@query(
    """
    select o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, n as rows_per_key
    from (
      select *, count(*) over (partition by o_custkey) as n, row_number() over (
        partition by o_custkey order by o_orderdate desc, o_orderpriority desc, o_orderkey) as rn
      from orders
    ) where rn = 1
    """
)
def collapse_counted_latest(t):
    """One aggregate picks a customer's latest order and counts all."""
    orders = t["orders"].select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    order = [Order("o_orderdate", True), Order("o_orderpriority", True), Order("o_orderkey")]
    kept = collapse_counted(orders, ["o_custkey"], order)
    return kept.withColumnRenamed(ROWS, "rows_per_key").drop("o_orderpriority")


@query(
    """
    select o_orderkey, o_totalprice, o_orderpriority,
           cast(year(o_orderdate) as integer) as year,
           cast(month(o_orderdate) as integer) as month
    from orders
    """
)
def files_by_date(t):
    spark = t["orders"].sparkSession
    written = t["orders"].select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate"
    )
    root = write_by_date(written, new_path(spark, "orders") + "/YYYY/MM/", "o_orderdate")
    return spark.read.schema(
        "o_orderkey long, o_totalprice double, o_orderpriority string,"
        " year int, month int"
    ).json(root)
