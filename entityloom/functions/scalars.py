"""The scalar expressions of a profile: dates as text, defaults, numeric codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name, also where it holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def iso_date(col: Column) -> Column:
    """Date as ``yyyy-MM-dd`` text; null stays null."""
    return F.date_format(col, "yyyy-MM-dd")


def or_zero(col: Column) -> Column:
    """Null becomes 0."""
    return F.coalesce(col, F.lit(0))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


_INTEGER_NAMES = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")
_FLOAT_NAMES = ("float", "real", "double")
_MAY_BE_INTEGER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_MAY_BE_FLOAT = r"^[\x00-\x20\x7f]*[+-]?([0-9.]|(?i:inf|nan))"


def read_text(col: Column, type_name: str) -> Column:
    """Text as ``type_name``, null where it cannot be read.

    The same as ``try_cast``, which raises and catches an exception for every
    text that is not a number; most of these are sorted out by a pattern first.
    """
    read = col.try_cast(type_name)
    if type_name in _INTEGER_NAMES:
        return F.when(col.rlike(_MAY_BE_INTEGER), read)
    if type_name in _FLOAT_NAMES:
        return F.when(col.rlike(_MAY_BE_FLOAT), read)
    return read


def guarded_code(
    col: Column, code_type: str, guard: Column, on_bad_code: str = "fail"
) -> Column:
    """Text code as a number, evaluated only for the rows ``guard`` accepts.

    A code table holds several lists of codes and some of them are not numeric.
    A filter on the list does not keep the optimiser from casting first, so the
    cast itself carries the condition.  Bad text inside the wanted list is an
    error (``fail``) or matches nothing (``null``).
    """
    if on_bad_code not in ("fail", "null"):
        raise ValueError(f"on_bad_code must be 'fail' or 'null', not {on_bad_code!r}")
    fail = on_bad_code == "fail"
    return F.when(guard, col.cast(code_type) if fail else read_text(col, code_type))
