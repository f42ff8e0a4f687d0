"""One row per key: by ranking a key's rows, or by an aggregate that counts them too."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.functions.scalars import quoted
from entityloom.operators.entities import KEY, KEY_FIELDS
from entityloom.operators.normalise import ABSENT


# How many rows an entity stands for, and how many of its values could not be read, by column.
ROWS = "__rows__"
DROPPED = "__dropped__"

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


@dataclass(frozen=True)
class Order:
    """A column to order by, as data, so that a sort and an aggregate can both follow it."""

    column: str
    descending: bool = False
    nulls_last: bool = True

    def sort(self) -> Column:
        col = quoted(self.column)
        if self.descending:
            return col.desc_nulls_last() if self.nulls_last else col.desc_nulls_first()
        return col.asc_nulls_last() if self.nulls_last else col.asc_nulls_first()

    def rising(self, kind: T.DataType) -> list[Column]:
        """Columns whose ascending order is this one."""
        col = quoted(self.column)
        null = col.isNull() if self.nulls_last else col.isNotNull()
        return [null, *(_falling(col, kind) if self.descending else [col])]


def _falling(col: Column, kind: T.DataType) -> list[Column]:
    """Columns that ascend as ``col`` descends."""
    if isinstance(kind, _NUMBERS):
        # As a decimal, so that the least of its type can be negated too.
        wide = col if isinstance(kind, T.DecimalType) else col.cast("decimal(20,0)")
        return [-wide]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [~F.isnan(col), -col]  # NaN is the largest
    if isinstance(kind, T.BooleanType):
        return [~col]
    if isinstance(kind, T.DateType):
        return [-F.unix_date(col)]
    if isinstance(kind, T.TimestampType):
        return [-F.unix_micros(col)]
    if isinstance(kind, T.TimestampNTZType):
        return [-F.unix_micros(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), col).cast("timestamp"))]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # Each digit turned round; the end ranks behind every digit, as a prefix comes last.
        digits = F.hex(col.cast("binary"))
        return [F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    raise TypeError(f"{kind.simpleString()} cannot be ordered downwards")


def entity_keys() -> list[Column]:
    """The key's fields, the most selective first."""
    return [F.col(f"{KEY}.{field}") for field in KEY_FIELDS]


def _ties(df: DataFrame, settled: set[str]) -> list[str]:
    """The columns that tell a key's rows apart."""
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.MapType, T.VariantType)):
            raise TypeError(f"{f.name} cannot be ordered: normalise first")
    return [c for c in df.columns if c not in settled]


def collapse_by_key(
    df: DataFrame,
    keys: Sequence[str | Column] | None = None,
    order_by: Sequence[Column | Order] = (),
) -> DataFrame:
    """The first row of each key under ``order_by``, ties broken by all columns.

    Rows of one key that are equal in every column are interchangeable, so the
    result does not depend on arrival order.  Spark keeps one row per key in each
    task before it shuffles, so a key with very many rows sends few.
    """
    keys = list(keys) if keys else entity_keys()
    settled = {KEY, *[k for k in keys if isinstance(k, str)]}
    by = [quoted(k) if isinstance(k, str) else k for k in keys]
    ties = [quoted(name).asc_nulls_last() for name in _ties(df, settled)]
    first = [o.sort() if isinstance(o, Order) else o for o in order_by]
    ranked = W.partitionBy(*by).orderBy(*first, *ties)
    return (
        df.withColumn("__rank", F.row_number().over(ranked))
        .where("__rank = 1")
        .drop("__rank")
    )


def collapse_counted(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[Order] = (),
    read: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``collapse_by_key``, each with ``__rows__``, the rows of its key.

    One aggregate, so each task sends one row per key with its count, and a repeated task
    changes nothing.  With ``read``, names of properties that may be absent, a struct
    ``__dropped__`` counts the key's rows in which each of them is.
    """
    settled = {KEY, *(keys or [])}
    fields = []
    for i, order in enumerate(order_by):
        parts = order.rising(df.schema[order.column].dataType)
        fields += [part.alias(f"o{i}_{j}") for j, part in enumerate(parts)]
    places = {}
    for i, name in enumerate(_ties(df, settled)):
        fields += [quoted(name).isNull().alias(f"n{i}"), quoted(name).alias(f"v{i}")]
        places[name] = f"v{i}"
    if KEY in df.columns:
        fields.append(F.col(KEY).alias("key"))
        places[KEY] = "key"
    by = [quoted(k).alias(f"__g{i}") for i, k in enumerate(keys)] if keys else []
    by = by or [k.alias(f"__g{i}") for i, k in enumerate(entity_keys())]
    counts = [F.count("*").alias(ROWS)]
    if read:
        absent = [F.count_if(F.array_contains(ABSENT, name)).alias(name) for name in read]
        counts.append(F.struct(*absent).alias(DROPPED))
    first = F.min(F.struct(*fields) if fields else F.lit(True)).alias("__first")
    groups = {k: f"__g{i}" for i, k in enumerate(keys or [])}
    return df.groupBy(*by).agg(first, *counts).select(
        *[
            F.col(f"__first.{places[c]}" if c in places else groups[c]).alias(c)
            for c in df.columns
        ],
        ROWS,
        *([DROPPED] if read else []),
    )
