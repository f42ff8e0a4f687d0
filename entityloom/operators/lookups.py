"""Widening a base table by left outer lookups and satellites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.functions.scalars import all_of, guarded_code, quoted
from entityloom.operators.skew import find_hot_keys, spread_left_join
from entityloom.together import together


MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 32 << 20
AUTO = "auto"


@dataclass(frozen=True)
class Lookup:
    """One left outer join of a chain.

    ``on`` maps a column of the table to a column of the row built so far, which
    may itself come from an earlier lookup.  ``take`` maps new column names to
    columns of the table.  ``where`` holds literals the table rows must equal;
    they restrict the table, so base rows without a match stay.
    """

    table: str
    on: Mapping[str, str]
    take: Mapping[str, str]
    where: Mapping[str, object] = field(default_factory=dict)
    code_type: str | None = None  # the table's key is text, compare it as this type
    on_bad_code: str = "fail"
    trim: bool = False  # text keys of either side and the literals may be blank padded
    unique: bool = False  # fail if a key occurs twice
    satellite: bool = False  # may hold many rows per key, some keys very many
    measure: bool = False  # Spark cannot know the size: measure, broadcast if small


class DuplicateLookupKey(ValueError):
    pass


def lookup_rows(table: DataFrame, spec: Lookup) -> DataFrame:
    """The part of a table a join needs: key columns ``__k0..`` and ``take``."""

    def column(name: str):
        is_text = spec.trim and isinstance(table.schema[name].dataType, T.StringType)
        return F.rtrim(F.col(name)) if is_text else F.col(name)

    def literal(value: object):
        return F.lit(value.rstrip(" ") if spec.trim and isinstance(value, str) else value)

    conditions = [column(c) == literal(v) for c, v in spec.where.items()]
    guard = all_of(conditions)
    keys = []
    for i, name in enumerate(spec.on):
        key = column(name)
        if spec.code_type:
            key = guarded_code(key, spec.code_type, guard, spec.on_bad_code)
        keys.append(key.alias(f"__k{i}"))
    rows = table.where(guard) if conditions else table
    return rows.select(*keys, *[F.col(c).alias(n) for n, c in spec.take.items()])


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        rows.where(all_of([F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .where("rows > 1")
    )


def will_be_broadcast(rows: DataFrame) -> bool:
    """Whether Spark's own estimate puts ``rows`` below its broadcast threshold."""
    conf = rows.sparkSession._jsparkSession.sessionState().conf()
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= conf.autoBroadcastJoinThreshold()


def small_tables(
    tables: Mapping[str, DataFrame],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> set[str]:
    """Which of ``tables`` are within the broadcast bounds, by measuring all of
    them in one job that returns one row each."""
    if not tables:
        return set()

    def size(df: DataFrame):
        width = F.lit(0)
        for f in df.schema.fields:
            text = isinstance(f.dataType, T.StringType)
            value = F.col(f.name) if text else F.to_json(F.struct(f.name))
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        return F.coalesce(F.sum(width), F.lit(0))

    measured = [
        df.agg(
            F.lit(name).alias("name"), F.count("*").alias("rows"), size(df).alias("bytes")
        )
        for name, df in tables.items()
    ]
    return {
        m["name"]
        for m in reduce(DataFrame.unionByName, measured).collect()
        if m["rows"] <= max_rows and m["bytes"] <= max_bytes
    }


def lookup_join(
    base: DataFrame,
    table: DataFrame,
    spec: Lookup,
    hot: DataFrame | None = None,
    small: bool = False,
) -> DataFrame:
    """``base`` with the ``take`` columns of ``table``; a null key matches nothing.

    Unless the table was measured and is ``small``, no broadcast is asked for:
    Spark broadcasts a table whose files, or shuffled rows, it finds to be below
    its threshold, and shuffles otherwise.
    """
    if taken := sorted({c.lower() for c in base.columns} & {c.lower() for c in spec.take}):
        raise ValueError(f"{spec.table}: the rows have a column {', '.join(taken)} already")
    rows = lookup_rows(table, spec)
    if small:
        rows = F.broadcast(rows)
    keys = [f"__k{i}" for i in range(len(spec.on))]
    if spec.unique and (twice := repeated_keys(rows, keys).take(1)):
        raise DuplicateLookupKey(f"{spec.table}: key {twice[0][:-1]} is not unique")
    names = list(spec.on.values())
    padded = [n for n in names if isinstance(base.schema[n].dataType, T.StringType)]
    if not spec.trim or not padded:
        return spread_left_join(base, rows, list(zip(names, keys)), hot)
    plain = {n: f"__b{i}" for i, n in enumerate(padded)}
    trimmed = base.select("*", *[F.rtrim(quoted(n)).alias(b) for n, b in plain.items()])
    pairs = [(plain.get(n, n), k) for n, k in zip(names, keys)]
    return spread_left_join(trimmed, rows, pairs, hot).drop(*plain.values())


def widen(
    base: DataFrame,
    tables: Mapping[str, DataFrame],
    lookups: Sequence[Lookup],
    hot_rows: int | str | None = AUTO,
    known: Mapping[str, object] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``base`` joined with each lookup in turn.

    Each satellite that Spark would not broadcast is first scanned for keys with more
    than ``hot_rows`` rows (by default those of an ordinary shuffle partition; None: not at
    all), and the lookups marked so are measured: one within ``max_rows`` and ``max_bytes``
    is broadcast, a larger one is shuffled, with the same rows.  No other job is started.  ``known`` gives base columns that equal one value in every row, so
    tables joined on them need only be read there.  Lookups share no state, so
    one table may be used several times.  The tables must not change meanwhile:
    land those of a live database first.
    """
    specs = [_restricted(spec, known or {}) for spec in lookups]
    unmeasured, scanned = {}, {}
    for i, spec in enumerate(specs):
        if spec.measure:
            unmeasured[str(i)] = lookup_rows(tables[spec.table], spec)
        if spec.satellite and hot_rows is not None:
            rows = lookup_rows(tables[spec.table], spec)
            if hot_rows != AUTO or not will_be_broadcast(rows):
                scanned[i] = rows
    least = None if hot_rows == AUTO else hot_rows
    small, *hot = together(
        base.sparkSession,
        partial(small_tables, unmeasured, max_rows, max_bytes),
        *[
            partial(find_hot_keys, rows, [f"__k{k}" for k in range(len(specs[i].on))], least)
            for i, rows in scanned.items()
        ],
    )
    hot_of = dict(zip(scanned, hot))
    row = base
    for i, spec in enumerate(specs):
        row = lookup_join(row, tables[spec.table], spec, hot_of.get(i), str(i) in small)
    return row


def _restricted(spec: Lookup, known: Mapping[str, object]) -> Lookup:
    """``spec`` reading only the rows whose key is the base's one known value."""
    fixed = {c: known[r] for c, r in spec.on.items() if r in known}
    if not fixed or spec.code_type:
        return spec
    return replace(spec, where={**spec.where, **fixed})
