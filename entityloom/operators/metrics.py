"""Counts of a run, and the values it could not read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from entityloom.functions.scalars import quoted
from entityloom.operators.collapse import DROPPED, ROWS, entity_keys
from entityloom.operators.entities import KEY
from entityloom.operators.normalise import ABSENT, REJECTED

NAMES = ("rows", "bad_keys", "dropped_values", "entities", "collapsed")
BY_COLUMN = "dropped_by_column"


def _none() -> Column:
    return F.lit(0).cast("bigint")


def may_be_absent(df: DataFrame) -> list[str]:
    """The properties that ``__absent__`` may name, all that there are."""
    if ABSENT not in df.columns:
        return []
    return [c for c in df.columns if c not in (KEY, ABSENT, REJECTED, ROWS, DROPPED)]


def _dropped(names: Sequence[str]) -> list[Column]:
    """For each name, the rows in which it is absent."""
    return [F.count_if(F.array_contains(ABSENT, n)).alias(f"dropped {n}") for n in names]


def _counts(keyed: DataFrame) -> list[Column]:
    return [
        F.count("*").alias("rows"),
        F.count_if(F.col(f"{KEY}.name").isNull()).alias("bad_keys"),
    ]


def _whole(sums: DataFrame, names: Sequence[str]) -> DataFrame:
    """The row of a run from one row of sums: with the totals, and a map of the columns that
    had bad values."""
    each = [F.col(f"`dropped {n}`") for n in names]
    entries = [F.struct(F.lit(n).alias("key"), c.alias("value")) for n, c in zip(names, each)]
    empty = F.array().cast("array<struct<key:string,value:bigint>>")
    bad = F.filter(F.array(*entries), lambda e: e["value"] > 0) if entries else empty
    total = sum(each, _none())
    kept = F.col("rows") - F.col("bad_keys")
    return sums.select(
        "rows",
        "bad_keys",
        total.alias("dropped_values"),
        "entities",
        (kept - F.col("entities")).alias("collapsed"),
        F.map_from_entries(bad).alias(BY_COLUMN),
    )


def observe_keyed(keyed: DataFrame, observation: Observation) -> DataFrame:
    """``keyed``, counted on its way into whatever the caller runs.

    Costs no pass of its own.  Tasks that run again because an executor was lost
    may be counted twice; ``run_metrics`` and ``landed_metrics`` are exact.
    """
    return keyed.observe(observation, *_counts(keyed), *_dropped(may_be_absent(keyed)))


def run_metrics(keyed: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """One row: rows, bad keys, dropped values, entities, rows lost to a shared key, and a map
    from each column with dropped values to their number.

    With the landed ``entities`` at hand both tables are only counted.  Otherwise
    one pass counts ``keyed`` by key, each task adding up its own rows first.
    """
    names = may_be_absent(keyed)
    counts = [*_counts(keyed), *_dropped(names)]
    if entities is not None:
        parts = keyed.agg(*counts, _none().alias("entities")).unionByName(
            entities.agg(F.count("*").alias("entities")), allowMissingColumns=True
        )
    else:
        keys = [k.alias(f"k{i}") for i, k in enumerate(entity_keys())]
        one = F.when(F.col("k0").isNotNull(), 1).otherwise(0).alias("entities")
        parts = keyed.groupBy(*keys).agg(*counts).select("*", one)
    return _whole(_summed(parts, names), names)


def _summed(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    columns = ["rows", "bad_keys", "entities", *[f"dropped {n}" for n in names]]
    return parts.agg(*[F.coalesce(F.sum(f"`{c}`"), _none()).alias(c) for c in columns])


def landed_metrics(entities: DataFrame, quarantine: DataFrame) -> DataFrame:
    """The row of ``run_metrics`` from what a run has landed: entities that know how many rows
    they stand for (``collapse_counted``), and the rows without a usable key."""
    names = entities.schema[DROPPED].dataType.names if DROPPED in entities.columns else []
    of_entities = [F.sum(f"{DROPPED}.`{n}`").alias(f"dropped {n}") for n in names]
    good = entities.agg(
        F.sum(ROWS).alias("rows"), _none().alias("bad_keys"), F.count("*").alias("entities"), *of_entities
    )
    bad = quarantine.agg(
        F.count("*").alias("rows"),
        F.count("*").alias("bad_keys"),
        _none().alias("entities"),
        *_dropped(names),
    )
    return _whole(_summed(good.unionByName(bad), names), names)


def observed_metrics(seen: Observation, entities: DataFrame) -> DataFrame:
    """The row of ``run_metrics`` from counts taken by ``observe_keyed`` in a run that is over."""
    counts = seen.get
    found = entities.agg(F.count("*").alias("entities"))
    totals = [F.lit(n).cast("bigint").alias(c) for c, n in counts.items()]
    names = [c.removeprefix("dropped ") for c in counts if c.startswith("dropped ")]
    return _whole(found.select(*totals, "entities"), names)


def rejected_values(keyed: DataFrame) -> DataFrame:
    """A row for each value that could not be read: its entity's key, null where that is bad
    too, the property, the type it had and the one it should have had, and its text.

    ``keyed`` comes from ``normalise(.., keep_rejected=True)``.
    """
    each = keyed.select(F.col(KEY), F.explode(quoted(REJECTED)).alias("r"))
    return each.select(
        f"{KEY}.project",
        f"{KEY}.kind",
        F.col(f"{KEY}.name").alias("key_name"),
        "r.property",
        "r.source_type",
        "r.wanted_type",
        "r.raw_text",
    )
