"""A whole run: tables, lookups, filter, types, keys, one row per key, upsert."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.operators.collapse import DROPPED, ROWS, Order, collapse_by_key, collapse_counted
from entityloom.operators.entities import KEY, split_bad_keys, with_key
from entityloom.operators.fanout import check_fan_out
from entityloom.operators.lookups import AUTO, Lookup, widen
from entityloom.operators.metrics import (
    landed_metrics,
    observe_keyed,
    observed_metrics,
    rejected_values,
)
from entityloom.operators.normalise import REJECTED, Override, normalise
from entityloom.operators.upsert import upsert_entities
from entityloom.sources.shared import new_path
from entityloom.sources.tables import land


@dataclass(frozen=True)
class Profile:
    """What the rows of a job are: a base table, its lookups, the output columns."""

    base: str
    base_columns: Sequence[str]  # those the lookups and the output use
    lookups: Sequence[Lookup]
    output: Callable[[], list[Column]]
    filter_column: str | None = None  # base column a run may be restricted by
    trim: bool = False  # the base's text columns are blank padded

    def columns(self) -> dict[str, list[str]]:
        """The columns a run reads of each table."""
        read = {self.base: list(self.base_columns)}
        for spec in self.lookups:
            names = read.setdefault(spec.table, [])
            names += [c for c in (*spec.on, *spec.take.values(), *spec.where) if c not in names]
        return read

    def conditions(self) -> dict[str, Column]:
        """What the rows a run uses of a table meet: the literals of one of its lookups.

        Tables that some lookup reads whole are not named.
        """
        met: dict[str, Column] = {}
        whole = {self.base, *(spec.table for spec in self.lookups if not spec.where)}
        for spec in self.lookups:
            if spec.table in whole:
                continue
            literals = F.lit(True)
            for name, value in spec.where.items():
                column = F.rtrim(name) if spec.trim and isinstance(value, str) else F.col(name)
                literals = literals & (column == F.lit(value))
            met[spec.table] = met[spec.table] | literals if spec.table in met else literals
        return met

    def tables(self) -> list[str]:
        """The tables a run needs, each once."""
        return list(dict.fromkeys([self.base, *[spec.table for spec in self.lookups]]))

    def rows(
        self,
        tables: Mapping[str, DataFrame],
        only: object | None = None,
        hot_rows: int | str | None = AUTO,
        most_fan_out: float | None = None,
    ) -> DataFrame:
        """All rows, or those whose filter column equals ``only``.

        With ``most_fan_out`` the rows that the lookups make of each base row are counted
        first, and the run fails before anything is joined if they are more.
        """
        base = tables[self.base].select(*self.base_columns)
        if self.trim:
            texts = {f.name for f in base.schema if isinstance(f.dataType, T.StringType)}
            base = base.select(
                *[F.rtrim(c).alias(c) if c in texts else F.col(c) for c in base.columns]
            )
        known = {}
        if only is not None:
            if self.filter_column is None:
                raise ValueError("this profile has no filter column")
            base = base.where(F.col(self.filter_column) == F.lit(only))
            known[self.filter_column] = only
        if most_fan_out is not None:
            check_fan_out(base, tables, self.lookups, most_fan_out)
        wide = widen(base, tables, self.lookups, hot_rows, known)
        return wide.select(*self.output())


@dataclass(frozen=True)
class EntityRules:
    """How rows become entities."""

    key_columns: Sequence[str]
    project: str
    kind: str
    cast_keys: bool = False
    on_bad_key: str = "quarantine"
    overrides: Mapping[str, Override] = field(default_factory=dict)
    reads: Mapping[str, str] = field(default_factory=dict)
    decimal: str = "double"
    order_by: Callable[[], list[Column | Order]] = list
    keep_rejected: bool = False  # land what could not be read, with its text

    def keyed(self, rows: DataFrame) -> DataFrame:
        kept = self.keep_rejected and bool(self.reads)
        typed = normalise(rows, self.overrides, self.reads, self.decimal, kept)
        return with_key(
            typed,
            self.key_columns,
            self.project,
            self.kind,
            self.cast_keys,
            self.on_bad_key,
        )

    def entities(self, keyed: DataFrame, counted: bool = False) -> DataFrame:
        """One row per usable key; ``counted`` with the rows it stands for."""
        good, _ = split_bad_keys(keyed.drop(REJECTED))
        # Text key columns are equal just when the keys are, and naming them lets
        # a join on the same column serve the collapse without another shuffle.
        keys = None if self.cast_keys else self.key_columns
        if counted:
            return collapse_counted(good, keys, self.order_by(), list(self.reads))
        return collapse_by_key(good, keys, self.order_by())


@dataclass(frozen=True)
class RunResult:
    entities: DataFrame  # wide, one row per key
    quarantine: DataFrame
    metrics: DataFrame
    rejected: DataFrame | None = None  # values that could not be read


def run_folder(spark: SparkSession, folder: str | None) -> str:
    """A folder for one run's tables, below ``folder`` or the session's shared folder."""
    if folder is None:
        return new_path(spark, "run")
    return f"{folder.rstrip('/')}/run-{uuid.uuid4().hex}"


def run(
    rows: DataFrame,
    rules: EntityRules,
    folder: str | None = None,
    exact_counts: bool = False,
) -> RunResult:
    """Turn ``rows`` into landed entities, in a folder of the run's own.

    The entities are landed straight from the joins, so a join on the key column serves
    the collapse too, and the rows are counted on their way; the quarantine is landed from
    its own filtered branch, and so are the rejected values if the rules keep them.  Counts
    may be high after a task was repeated.  With ``exact_counts`` rows are collapsed by an
    aggregate instead, every landed entity knows how many rows it stands for, and the counts
    are exact whatever happened, without another write or shuffle; the order of the rules is
    then given by ``Order``.
    """
    place = run_folder(rows.sparkSession, folder)
    keyed = rules.keyed(rows)
    seen = Observation()
    if exact_counts:
        entities = land(rules.entities(keyed, counted=True), "entities", place)
    else:
        entities = land(rules.entities(observe_keyed(keyed, seen)), "entities", place)
    quarantine = land(split_bad_keys(keyed)[1].drop(REJECTED), "quarantine", place)
    rejected = None
    if REJECTED in keyed.columns:
        rejected = land(rejected_values(keyed), "rejected", place)
    if exact_counts:
        metrics = landed_metrics(entities, quarantine)
        return RunResult(entities.drop(ROWS, DROPPED), quarantine, metrics, rejected)
    return RunResult(entities, quarantine, observed_metrics(seen, entities), rejected)


def store(
    current: DataFrame | None, entities: DataFrame, folder: str | None = None
) -> DataFrame:
    """The next version of the stored entities, as a new table beside the old one.

    This writes every stored entity; ``sources.buckets`` rewrites only those that share a
    bucket with an incoming key.
    """
    place = run_folder(entities.sparkSession, folder)
    if current is None:
        return land(entities, "stored", place)
    return land(upsert_entities(current, entities, KEY, collapsed=True), "stored", place)
