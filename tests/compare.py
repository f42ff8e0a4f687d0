"""Comparing a Spark result with SQL over the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from entityloom.plans.catalogue import SCHEMAS


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(
            f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')"
        )
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bytearray):
        return bytes(value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


# Type families: how a Spark type shows in the SQL engine.
FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql) -> tuple[int, list[str]]:
    """Row count and the list of differences."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        return sum(actual.values()), [f"columns {sorted(df.columns)} / {sorted(names)}"]
    for name, spark_type in df.dtypes:
        if FAMILY.get(spark_type, spark_type) != types[name]:
            problems.append(f"type of {name}: {spark_type} / {types[name]}")
    if actual != expected:
        more, less = actual - expected, expected - actual
        problems.append(
            f"rows {sum(actual.values())} / {sum(expected.values())},"
            f" only here {list(more.items())[:2]}, only there {list(less.items())[:2]}"
        )
    return sum(actual.values()), problems
