"""Writing keyed entities over what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions.scalars import quoted
from entityloom.operators.collapse import collapse_by_key
from entityloom.operators.entities import KEY
from entityloom.operators.labels import folding
from entityloom.operators.normalise import ABSENT


class PropertyTypeChanged(TypeError):
    pass


def check_same_types(current: DataFrame, incoming: DataFrame) -> None:
    """Fails, before anything runs, if a property is of another type on either side.

    Names are compared as the session does: ``Name`` and ``name`` are one property unless
    ``spark.sql.caseSensitive`` is on.
    """
    fold = folding(current.sparkSession)
    stored = {fold(name): kind for name, kind in current.dtypes}
    changed = [
        f"{name}: {stored[fold(name)]} stored, {kind} incoming"
        for name, kind in incoming.dtypes
        if stored.get(fold(name), kind) != kind
    ]
    if changed:
        raise PropertyTypeChanged("; ".join(changed))


def spelled_as(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """``incoming`` with the names it shares with ``stored`` in that side's spelling,
    those in ``__absent__`` included."""
    fold = folding(stored.sparkSession)
    spelling = {fold(name): name for name in stored.columns}
    changed = {
        name: spelling[fold(name)]
        for name in incoming.columns
        if spelling.get(fold(name), name) != name
    }
    if not changed:
        return incoming

    def absent(names: Column) -> Column:
        pairs = F.create_map(*[F.lit(x) for pair in changed.items() for x in pair])
        return F.transform(names, lambda n: F.coalesce(F.try_element_at(pairs, n), n))

    return incoming.select(
        *[
            absent(F.col(ABSENT)).alias(ABSENT)
            if name == ABSENT
            else quoted(name).alias(changed.get(name, name))
            for name in incoming.columns
        ]
    )


def _with_absent(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the properties that only ``other`` has marked absent in each row."""
    lacking = [c for c in other.columns if c not in (*df.columns, ABSENT)]
    named = F.array(*[F.lit(c) for c in lacking]).cast("array<string>")
    if ABSENT in df.columns:
        named = F.array_union(F.coalesce(ABSENT, F.array().cast("array<string>")), named)
    rest = [quoted(c) for c in df.columns if c != ABSENT]
    return df.select(*rest, named.alias(ABSENT))


def upsert_entities(
    current: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[Column] = (),
    collapsed: bool = False,
) -> DataFrame:
    """The stored entities after ``incoming`` is written over ``current``.

    A repeated key replaces the whole entity.  ``current`` holds one row per key;
    ``incoming`` is brought to one row per key first, the first under
    ``order_by``, unless it is ``collapsed`` already.  A property of entities that only
    one side has is absent, not null, in the other's rows (``__absent__`` names it);
    rows that are no entities get null there.  A property whose type differs fails before
    the run.  A property spelled differently on the two sides is one, in the stored spelling,
    unless the session is case sensitive.  Where the incoming keys are below Spark's broadcast threshold, ``current`` is
    only scanned; beyond it both sides are shuffled by key.  ``incoming`` is used
    twice, so land it first if it is the end of a long chain.
    """
    names = [key] if isinstance(key, str) else list(key)
    check_same_types(current, incoming)
    incoming = spelled_as(current, incoming)
    new, keys = incoming, incoming.select(*names)
    if not collapsed:
        new, keys = collapse_by_key(incoming, names, order_by), keys.distinct()
    kept = current.join(keys, names, "left_anti")
    entities = KEY in current.columns and KEY in incoming.columns
    properties = [{*df.columns} - {ABSENT} for df in (current, incoming)]
    marked = ABSENT in current.columns or ABSENT in incoming.columns
    if entities and (marked or properties[0] != properties[1]):
        kept, new = _with_absent(kept, incoming), _with_absent(new, current)
    return kept.unionByName(new, allowMissingColumns=True)
