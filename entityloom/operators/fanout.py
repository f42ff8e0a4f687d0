"""How many rows a chain of lookups makes of each base row, before the chain is run.

A lookup whose key repeats multiplies rows: a satellite is meant to, a code table without its
language literal is not.  Each lookup's multiplicity is the sum, over the keys of the rows it
meets, of how often the key stands there times how often the table has it.  Only counts by key
are joined, and each task adds up its own first, so a key with very many rows is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.functions.scalars import quoted
from entityloom.operators.lookups import Lookup, lookup_join, lookup_rows
from entityloom.together import together

_WEIGHT = "__weight"


class FanOutTooHigh(ValueError):
    pass


@dataclass(frozen=True)
class FanOut:
    """Rows a lookup meets, and rows there are after it if it alone were joined."""

    table: str
    on: str
    before: int
    after: int

    @property
    def factor(self) -> float:
        return self.after / self.before if self.before else 1.0


def _needed(columns: Sequence[str], lookups: Sequence[Lookup]) -> list[Lookup]:
    """The lookups that give ``columns``, those that these need in turn included, in order."""
    wanted, found = set(columns), []
    for spec in reversed(lookups):
        taken = {n: c for n, c in spec.take.items() if n in wanted}
        if taken:
            found.insert(0, replace(spec, take=taken))
            wanted |= set(spec.on.values())
    return found


def _key_counts(
    base: DataFrame, tables: Mapping[str, DataFrame], lookups: Sequence[Lookup], columns: list[str]
) -> DataFrame:
    """``columns`` of the rows a lookup meets, with the number of rows that have them."""
    needed = _needed(columns, lookups)
    used = list(dict.fromkeys([*columns, *[c for s in needed for c in s.on.values()]]))
    own = [quoted(c) for c in base.columns if c in used]
    rows = base.groupBy(*own).agg(F.count("*").alias(_WEIGHT))
    for spec in needed:
        rows = lookup_join(rows, tables[spec.table], replace(spec, unique=False))
    return rows.groupBy(*[quoted(c) for c in columns]).agg(F.sum(_WEIGHT).alias(_WEIGHT))


def fan_outs(
    base: DataFrame, tables: Mapping[str, DataFrame], lookups: Sequence[Lookup]
) -> list[FanOut]:
    """The multiplicity of each lookup.

    A lookup on columns of an earlier one meets the rows that the lookups it needs have made.
    Where its key and theirs are unrelated the product of all factors is what the chain makes
    of a base row; it is an estimate otherwise.
    """

    def measured(i: int, spec: Lookup) -> FanOut:
        columns = list(dict.fromkeys(spec.on.values()))
        met = _key_counts(base, tables, lookups[:i], columns)
        keys = [f"__k{k}" for k in range(len(spec.on))]
        table = lookup_rows(tables[spec.table], replace(spec, take={}))
        counted = table.groupBy(*keys).agg(F.count("*").alias("__times"))
        bare = [F.rtrim(quoted(c)) if _padded(met, c, spec) else quoted(c) for c in spec.on.values()]
        same = reduce(lambda a, b: a & b, [c == F.col(k) for c, k in zip(bare, keys)])
        times = F.coalesce("__times", F.lit(1))
        row = met.join(counted, same, "left").agg(
            F.coalesce(F.sum(_WEIGHT), F.lit(0)).alias("before"),
            F.coalesce(F.sum(F.col(_WEIGHT) * times), F.lit(0)).alias("after"),
        )
        before, after = row.first()
        return FanOut(spec.table, ", ".join(spec.on), before, after)

    jobs = [partial(measured, i, spec) for i, spec in enumerate(lookups)]
    return together(base.sparkSession, *jobs)


def _padded(rows: DataFrame, column: str, spec: Lookup) -> bool:
    return spec.trim and dict(rows.dtypes)[column] == "string"


def check_fan_out(
    base: DataFrame, tables: Mapping[str, DataFrame], lookups: Sequence[Lookup], most: float
) -> list[FanOut]:
    """The multiplicities; fails if a row would become more than ``most`` rows on average, or
    if a lookup that is no satellite has a repeated key among those the rows have."""
    found = fan_outs(base, tables, lookups)
    whole = reduce(lambda a, f: a * f.factor, found, 1.0)
    more = [(f, s) for f, s in zip(found, lookups) if f.after > f.before]
    repeated = [f for f, s in more if not s.satellite]
    if whole > most or repeated:
        each = "; ".join(f"{f.table} ({f.on}): {f.factor:.3g} rows for each" for f, _ in more)
        raise FanOutTooHigh(f"a row becomes {whole:.3g} rows, {most:g} allowed: {each}")
    return found
