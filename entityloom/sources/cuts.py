"""Conditions that split a table into parts of about equal size, from a sample of its values."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_SAMPLED = 100_000


def literal(value: object) -> str:
    """A value as text of the condition; text is quoted."""
    if isinstance(value, bool) or not isinstance(
        value, (str, int, float, decimal.Decimal, datetime.date, datetime.datetime)
    ):
        raise TypeError(f"no cuts by {type(value).__name__}")
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return f"timestamp '{value}'"
    return f"date '{value}'" if isinstance(value, datetime.date) else str(value)


def _ranges(column: str, starts: Sequence[object]) -> list[str]:
    """Conditions of the ranges that begin at ``starts``, the first open below and with the nulls."""
    if not starts:
        return ["1 = 1"]
    at = [literal(s) for s in starts]
    between = [f"{column} >= {a} and {column} < {b}" for a, b in zip(at, at[1:])]
    return [f"({column} < {at[0]} or {column} is null)", *between, f"{column} >= {at[-1]}"]


def _starts(counts: Iterable[tuple[object, int]], most: float) -> list[object]:
    """Where ranges of at most ``most`` rows begin; a value with more rows has a range alone."""
    starts, held, first = [], 0, True
    for value, n in counts:
        if not first and held + n > most:
            starts.append(value)
            held = 0
        held, first = held + n, False
    return starts


def balanced_conditions(
    sample: DataFrame, column: str, parts: int, second: str | None = None
) -> list[str]:
    """About ``parts`` conditions, of which each row of the table meets exactly one.

    ``sample`` holds ``column``, and ``second``, of rows chosen without regard to them: let the
    database choose (``tablesample``), so that few rows are sent.  At most ``MOST_SAMPLED``
    of them come to the driver.  No part has more than twice the mean of the sample's rows,
    except a single value of ``column`` that is not split: one with more rows than a part is cut by
    ``second``, where given.  Values must order in the database as they do here.
    """
    names = [column, *([second] if second else [])]  # as the condition spells them, quotes included
    few = sample.select(*names).orderBy(F.rand(7)).limit(MOST_SAMPLED)  # any of a larger sample
    rows = [tuple(r) for r in few.collect()]
    counts = Counter(r[0] for r in rows)
    nulls = counts.pop(None, 0)
    most = len(rows) / parts
    ordered = sorted(counts.items())
    heavy = {v for v, n in ordered if second and n > most}
    starts = _starts([(None, nulls)] * bool(nulls) + ordered, most)
    # A heavy value begins a range of its own, and so does what follows it.
    for (value, _), after in zip(ordered, [*[v for v, _ in ordered[1:]], None]):
        if value in heavy:
            starts += [value] if after is None else [value, after]
    out = []
    begins = sorted({s for s in starts if s is not None})
    for begin, condition in zip([None, *begins], _ranges(column, begins)):
        if begin not in heavy:
            out.append(condition)
            continue
        # Its range holds what the sample did not show between it and the next value, too.
        seconds = Counter(r[1] for r in rows if r[0] == begin)
        none = seconds.pop(None, 0)
        inner = [(None, none)] * bool(none) + sorted(seconds.items())
        pieces = _ranges(second, _starts(inner, most))
        out += [f"{condition} and {piece}" if piece != "1 = 1" else condition for piece in pieces]
    return out
