"""Bounded reads over JDBC, split into parallel queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.functions.scalars import quoted
from entityloom.sources.cuts import balanced_conditions
from entityloom.sources.entity_rows import ClientSource
from entityloom.sources.tables import land
from entityloom.together import together


class RowCountDiffers(RuntimeError):
    pass


@dataclass(frozen=True)
class JdbcSource:
    """A database to read.  URL, user and password stay out of ``repr`` and logs."""

    driver: str
    url: str = field(repr=False)
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        given = {
            "driver": self.driver,
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
        }
        return {name: value for name, value in given.items() if value is not None}

    def rows(
        self,
        spark: SparkSession,
        relation: str,
        split: ValueRanges | Sequence[str] | None = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """Rows of a table; what is selected of them Spark pushes into the queries by itself."""
        return read_jdbc(spark, self, relation, split)


@dataclass(frozen=True)
class ValueRanges:
    """Equal ranges of a number, date or timestamp column.

    The bounds only place the cuts: the outer ranges are open, and nulls go to
    the first.
    """

    column: str
    lower: object
    upper: object
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class SampledCuts:
    """A split whose cuts come from the data.

    ``sample`` is a relation of a few of the table's rows, drawn by the database, with ``column``
    and ``second``: ``(select id, nbr from t tablesample system (1)) q``.  A value of ``column``
    with more rows than a part is cut by ``second``.
    """

    column: str
    parts: int
    sample: str
    second: str | None = None

    def conditions(self, spark: SparkSession, source: JdbcSource) -> list[str]:
        """One condition for each part; small and large tables get about ``parts``."""
        rows = read_jdbc(spark, source, self.sample, None)
        return balanced_conditions(rows, self.column, self.parts, self.second)


Split = ValueRanges | SampledCuts | Sequence[str]


def text_ranges(column: str, cuts: Sequence[str]) -> list[str]:
    """Conditions that split a text column at ``cuts``; each row meets exactly one.

    The cuts must ascend in the database's own order.  Cuts that ascend neither by
    characters nor without regard to case are refused; what else the database may order
    otherwise shows in the row counts (``land_tables(check_counts=True)``).  One hot value
    cannot be split this way; give conditions over a second column for it.
    """
    if len(set(cuts)) != len(cuts):
        raise ValueError("a cut occurs twice")
    if list(cuts) not in (sorted(cuts), sorted(cuts, key=str.casefold)):
        raise ValueError("the cuts do not ascend")
    if not cuts:
        return ["1 = 1"]
    text = ["'" + c.replace("'", "''") + "'" for c in cuts]
    between = [
        f"{column} >= {low} and {column} < {high}" for low, high in zip(text, text[1:])
    ]
    return [
        f"{column} < {text[0]} or {column} is null",
        *between,
        f"{column} >= {text[-1]}",
    ]


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    relation: str,
    split: ValueRanges | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a table, or of one statement given as ``(select ..) q``.

    ``split`` is a range split or a list of conditions, one query each.  A
    statement read without a split sees one database snapshot.  Filters and
    columns the caller applies are pushed into the queries.
    """
    if split is None or isinstance(split, ValueRanges):
        reader = spark.read.format("jdbc").options(**source.options())
        if split is not None:
            reader = reader.options(**split.options())
        return reader.option("dbtable", relation).load()
    properties = {k: v for k, v in source.options().items() if k != "url"}
    return spark.read.jdbc(
        source.url, relation, predicates=list(split), properties=properties
    )


def where_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``df`` restricted by those of ``values`` whose column it has."""
    for column, value in values.items():
        if column in df.columns:
            df = df.where(quoted(column) == F.lit(value))
    return df


def land_tables(
    spark: SparkSession,
    source: JdbcSource | ClientSource,
    relations: Mapping[str, str],
    splits: Mapping[str, Split] | None = None,
    equal: Mapping[str, object] | None = None,
    folder: str | None = None,
    columns: Mapping[str, Sequence[str]] | None = None,
    conditions: Mapping[str, Column] | None = None,
    check_counts: bool = False,
) -> dict[str, DataFrame]:
    """Each relation read once and kept as Parquet, by its name.

    ``source`` is a database, or a client that reads one (``entity_rows``).  Joins then run on
    one set of rows instead of asking the database again.  The tables are read side by side.  A relation with a column of ``equal`` is read
    only where it has that value; the database applies the condition.  ``columns`` and
    ``conditions`` name the columns and rows that are used of a relation; others are not
    read.  ``check_counts`` compares the rows of a split read with a count of the whole by
    the database, and fails if they differ: the split missed rows or met some twice, or the
    table changed meanwhile.
    """
    splits = splits or {}

    def asked(name: str) -> list[str] | None:
        """The columns used of a table, and those its rows are chosen by."""
        if name not in (columns or {}):
            return None
        return list(dict.fromkeys([*columns[name], *(equal or {})]))

    def used(name: str, rows: DataFrame) -> DataFrame:
        rows = where_equal(rows, equal or {})
        if name in (conditions or {}):
            rows = rows.where(conditions[name])
        return rows.select(*[quoted(c) for c in (columns or {}).get(name, rows.columns)])

    def landed(name: str, relation: str) -> DataFrame:
        split = splits.get(name)
        if isinstance(split, SampledCuts):
            split = split.conditions(spark, source)
        read = source.rows(spark, relation, split, asked(name))
        rows = land(used(name, read), name, folder)
        if check_counts and split is not None:
            expected = used(name, source.rows(spark, relation, None, asked(name))).count()
            if (found := rows.count()) != expected:
                raise RowCountDiffers(f"{name}: {found} rows landed, {expected} in the database")
        return rows

    jobs = [partial(landed, name, relation) for name, relation in relations.items()]
    return dict(zip(relations, together(spark, *jobs)))
