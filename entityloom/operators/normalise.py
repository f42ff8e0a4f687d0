"""Every column to its property type, as one projection built from the schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.functions.property_types import to_property
from entityloom.functions.scalars import quoted, read_text
from entityloom.operators.labels import first_of_each_label

# Names of the row's properties that could not be read.  A property that is
# null is there; one named here is absent.  The column exists only with ``reads``.
ABSENT = "__absent__"

# What could not be read, kept on request: (property, source_type, wanted_type, raw_text) each.
REJECTED = "__rejected__"

Override = Callable[[Column], Column]


def normalise(
    df: DataFrame,
    overrides: Mapping[str, Override] | None = None,
    reads: Mapping[str, str] | None = None,
    decimal: str = "double",
    keep_rejected: bool = False,
) -> DataFrame:
    """``df`` with each column converted to its property type; nulls stay nulls.

    ``overrides`` replaces the conversion of a column, by its name, or of all
    columns of a type, by the type's name (``decimal``, ``date``, ``array``, ..);
    the result is brought to a property type in turn.  ``reads`` names columns
    to be read as another type first.  A value that cannot be read makes the
    property absent and keeps the row; with ``keep_rejected`` its text and types are kept
    beside it in ``__rejected__``.  ``decimal`` is ``double`` or ``keep``.
    """
    if decimal not in ("double", "keep"):
        raise ValueError(f"decimal must be 'double' or 'keep', not {decimal!r}")
    rows = first_of_each_label(df)
    overrides, reads = dict(overrides or {}), dict(reads or {})
    if missing := set(reads) - set(rows.columns):
        raise ValueError(f"no such columns to read: {sorted(missing)}")

    read = rows.select(*[_read(f, overrides, reads) for f in rows.schema.fields])
    values = [
        to_property(quoted(f.name), f.dataType, decimal).alias(f.name)
        for f in read.schema.fields
    ]
    if not reads:
        return read.select(*values)

    def bad(f: T.StructField) -> Column:
        return quoted(f.name).isNotNull() & _as(f, reads[f.name]).isNull()

    def raw(f: T.StructField) -> Column:
        return F.struct(
            F.lit(f.name).alias("property"),
            F.lit(f.dataType.simpleString()).alias("source_type"),
            F.lit(reads[f.name]).alias("wanted_type"),
            quoted(f.name).cast("string").alias("raw_text"),
        )

    asked = [f for f in rows.schema.fields if f.name in reads]
    names = F.array_compact(F.array(*[F.when(bad(f), F.lit(f.name)) for f in asked]))
    marks = [names.alias(ABSENT)]
    if keep_rejected:
        texts = F.array_compact(F.array(*[F.when(bad(f), raw(f)) for f in asked]))
        marks.append(texts.alias(REJECTED))
    marked = rows.select(*[_read(f, overrides, reads) for f in rows.schema.fields], *marks)
    return marked.select(*values, ABSENT, *([REJECTED] if keep_rejected else []))


def _as(field: T.StructField, type_name: str) -> Column:
    col = quoted(field.name)
    is_text = isinstance(field.dataType, T.StringType)
    return read_text(col, type_name) if is_text else col.try_cast(type_name)


def _read(
    field: T.StructField, overrides: Mapping[str, Override], reads: Mapping[str, str]
) -> Column:
    col = _as(field, reads[field.name]) if field.name in reads else quoted(field.name)
    change = overrides.get(field.name) or overrides.get(field.dataType.typeName())
    return (change(col) if change else col).alias(field.name)
