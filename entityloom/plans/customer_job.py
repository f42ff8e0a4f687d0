"""The customer run from end to end: read, widen, key, collapse, store."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from entityloom.operators.entities import LONG_KEY, to_long
from entityloom.plans.customer_profile import customer_profile, customer_rules
from entityloom.plans.entity_job import Profile, RunResult, run, run_folder, store
from entityloom.sources.buckets import BUCKETS, read_buckets, upsert_buckets
from entityloom.sources.entity_rows import ClientSource
from entityloom.sources.entity_store import write_entities
from entityloom.sources.jdbc import JdbcSource, Split, land_tables, read_jdbc
from entityloom.sources.tables import ParquetTables, land


@dataclass(frozen=True)
class CustomerJob:
    """Parameters of a run.

    ``only`` restricts it to one customer id.  ``schema`` is the database schema
    of the tables, ``splits`` how each is read in parallel, ``check_counts`` whether the
    rows landed are compared with a count by the database.  ``statement`` is a SELECT that
    yields the profile's rows itself: the database then joins, and one snapshot is read.
    ``trim`` is for blank-padded text columns.  ``folder`` takes the landed tables, each
    run's in a folder of its own; by default they go under the session's shared folder.
    ``most_fan_out`` bounds the rows that the lookups may make of a customer's.  ``store`` is a
    folder of entities in ``buckets`` (counting for a new one) that the run rewrites where its
    customers lie; without it all stored entities are written anew.  ``sink`` names a keyed
    store's class (``module:Class``, with ``sink_options``): the run's entities are put there too,
    a property a row, in order of their keys.
    """

    project: str
    kind: str = "Customer"
    owner: str = ""
    only: str | None = None
    schema: str | None = None
    splits: Mapping[str, Split] | None = None
    measure: Collection[str] = ()
    folder: str | None = None
    statement: str | None = None
    trim: bool = False
    check_counts: bool = False
    exact_counts: bool = False
    most_fan_out: float | None = None
    store: str | None = None
    buckets: int = BUCKETS
    sink: str | None = None
    sink_options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def profile(self) -> Profile:
        return customer_profile(self.owner, self.measure, self.trim)

    def tables(
        self, spark: SparkSession, source: JdbcSource | ClientSource | str
    ) -> Mapping[str, DataFrame]:
        """The ten tables, from a database, a client of one or a folder of Parquet tables.

        Of a database only the columns and rows that the profile uses are read.
        """
        profile = self.profile()
        names = profile.tables()
        if isinstance(source, str):
            return ParquetTables(spark, source, dict.fromkeys(names))
        prefix = f"{self.schema}." if self.schema else ""
        return land_tables(
            spark,
            source,
            {name: prefix + name for name in names},
            self.splits,
            {f"{self.owner}customer_id": self.only} if self.only and not self.trim else {},
            self.run_folder(spark),
            profile.columns(),
            profile.conditions(),
            self.check_counts,
        )

    def rows(self, spark: SparkSession, source: JdbcSource | ClientSource | str) -> DataFrame:
        """The profile's rows, from its tables or from one statement."""
        if self.statement is None:
            tables = self.tables(spark, source)
            return self.profile().rows(tables, self.only, most_fan_out=self.most_fan_out)
        if not isinstance(source, JdbcSource):
            raise ValueError("a statement needs a database")
        rows = read_jdbc(spark, source, f"({self.statement}) q")
        if self.only:
            rows = rows.where(rows["customer_id"] == self.only)
        return land(rows, "statement", self.run_folder(spark))

    def run(
        self,
        spark: SparkSession,
        source: JdbcSource | ClientSource | str,
        current: DataFrame | None = None,
    ) -> tuple[RunResult, DataFrame]:
        """The run's result, and the stored entities after it.

        ``current`` is what is stored before; a ``store`` knows that itself.
        """
        if self.store and current is not None:
            raise ValueError("the store holds what is current")
        rules = customer_rules(self.project, self.kind)
        result = run(self.rows(spark, source), rules, self.folder, self.exact_counts)
        if self.sink:
            long = to_long(result.entities)
            write_entities(long, self.sink, dict(self.sink_options), LONG_KEY)
        if self.store is None:
            return result, store(current, result.entities, self.folder)
        upsert_buckets(self.store, result.entities, self.buckets, folder=self.run_folder(spark))
        return result, read_buckets(spark, self.store)

    def run_folder(self, spark: SparkSession) -> str | None:
        """A folder for one step's tables below the job's, None where it has none."""
        return self.folder and run_folder(spark, self.folder)
