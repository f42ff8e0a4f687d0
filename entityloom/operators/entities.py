"""Keys, and entities in their wide and long forms.

Wide: one row per entity, ``__key__ struct<project, kind, name>`` and one typed
column per property.  Long: one row per property, with exactly one value column
set, or none where the property is null.  An absent property has no long row.  Decimals that
were kept have a value column of their own, of the smallest type that holds them all; it is
there only if there are any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.functions import property_types as P
from entityloom.functions.scalars import quoted
from entityloom.operators.normalise import ABSENT, REJECTED

KEY = "__key__"
KEY_FIELDS = ["name", "kind", "project"]
SEPARATOR = "/"
LONG_KEY = ["kind", "key_name", "property"]  # what a long row is stored under

_VALUE_COLUMNS = {
    P.LONG: ("long_value", "bigint"),
    P.DOUBLE: ("double_value", "double"),
    P.BOOL: ("bool_value", "boolean"),
    P.STRING: ("string_value", "string"),
    P.BLOB: ("blob_value", "binary"),
    P.TIMESTAMP: ("timestamp_value", "timestamp"),
}


def key_name(parts: Sequence[Column]) -> Column:
    """Key text: the column itself, or several joined by ``/``.

    Null if any part is null or empty.
    """
    usable = F.lit(True)
    for part in parts:
        usable = usable & part.isNotNull() & (part != "")
    name = parts[0] if len(parts) == 1 else F.concat_ws(SEPARATOR, *parts)
    return F.when(usable, name)


def _escaped(part: Column) -> Column:
    """``part`` with ``\\`` and ``/`` marked, so that no two keys join to one text."""
    marked = F.replace(part, F.lit("\\"), F.lit("\\\\"))
    return F.replace(marked, F.lit(SEPARATOR), F.lit("\\" + SEPARATOR))


def with_key(
    df: DataFrame,
    key_columns: Sequence[str],
    project: str,
    kind: str,
    cast_keys: bool = False,
    on_bad_key: str = "quarantine",
) -> DataFrame:
    """``df`` with its complete key in front; the key columns stay properties.

    A key column must be text; this is checked before anything runs.  A row with
    a null or empty key gets a null name, to be split off by ``split_bad_keys``,
    or fails the run (``on_bad_key='fail'``).
    """
    if on_bad_key not in ("quarantine", "fail"):
        raise ValueError(f"on_bad_key must be 'quarantine' or 'fail', not {on_bad_key!r}")
    if not key_columns:
        raise ValueError("no key column given")
    parts = []
    for name in key_columns:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        if not is_text and not cast_keys:
            raise TypeError(
                f"key column {name} is {df.schema[name].dataType.simpleString()}, not string"
            )
        part = quoted(name) if is_text else quoted(name).cast("string")
        if len(key_columns) > 1:
            part = _escaped(part)
        parts.append(part)
    name = key_name(parts)
    if on_bad_key == "fail":
        message = f"null or empty key in {', '.join(key_columns)}"
        name = F.coalesce(name, F.raise_error(F.lit(message)).cast("string"))
    key = F.struct(
        F.lit(project).alias("project"), F.lit(kind).alias("kind"), name.alias("name")
    )
    return df.select(key.alias(KEY), *[quoted(c) for c in df.columns])


def split_bad_keys(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable key, and the quarantined rest."""
    bad = F.col(f"{KEY}.name").isNull()
    return keyed.where(~bad), keyed.where(bad)


def _common_decimal(kinds: Sequence[T.DecimalType]) -> T.DecimalType:
    scale = max(k.scale for k in kinds)
    digits = max(k.precision - k.scale for k in kinds)
    if digits + scale > 38:
        raise TypeError(f"no decimal of 38 digits holds {digits} before and {scale} after the point")
    return T.DecimalType(digits + scale, scale)


def to_long(wide: DataFrame) -> DataFrame:
    """One row per property of each entity; no shuffle."""
    names = [c for c in wide.columns if c not in (KEY, ABSENT, REJECTED)]
    values = dict(_VALUE_COLUMNS)
    kinds = [wide.schema[name].dataType for name in names]
    if kept := [k for k in kinds if isinstance(k, T.DecimalType)]:
        values[P.DECIMAL] = ("decimal_value", _common_decimal(kept).simpleString())
    cells = []
    for name, found in zip(names, kinds):
        kind = P.DECIMAL if isinstance(found, T.DecimalType) else P.stored_kind(found)
        if kind is None:
            raise TypeError(f"{name} is {found.simpleString()}: normalise first")
        col = quoted(name)
        cells += [
            F.lit(name),
            F.when(col.isNull(), "null").otherwise(kind),
            *[
                (col if of == kind else F.lit(None)).cast(type_name)
                for of, (_, type_name) in values.items()
            ],
        ]
    labels = ["property", "value_type", *[label for label, _ in values.values()]]
    has_absent = ABSENT in wide.columns
    rows = wide.select(
        F.col(f"{KEY}.kind").alias("kind"),
        F.col(f"{KEY}.name").alias("key_name"),
        *([F.col(ABSENT)] if has_absent else []),
        F.stack(F.lit(len(names)), *cells).alias(*labels),
    )
    if not has_absent:
        return rows
    absent = F.coalesce(F.array_contains(ABSENT, F.col("property")), F.lit(False))
    return rows.where(~absent).drop(ABSENT)
