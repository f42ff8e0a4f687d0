"""Parquet tables, landed tables and query text as sources."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from entityloom.operators.labels import first_of_each_label
from entityloom.sources.shared import new_path, write_options


class ParquetTables(Mapping[str, DataFrame]):
    """Tables of one folder by name, ``<folder>/<name>.parquet``, opened on use.

    ``schemas`` gives each table's columns; None leaves them to the files.
    """

    def __init__(
        self, spark: SparkSession, folder: str, schemas: Mapping[str, str | None]
    ):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._schemas = schemas
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            reader = self._spark.read
            if schema := self._schemas[name]:
                reader = reader.schema(schema)
            self._open[name] = reader.parquet(f"{self._folder}/{name}.parquet")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)


def land(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a new Parquet table and read it back.

    Cuts the lineage and fixes one snapshot: later steps read the same rows
    however often they or their tasks run.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{name}" if folder else new_path(spark, name)
    df.write.options(**write_options(spark, path)).mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_landed(landed: DataFrame) -> None:
    """Delete the files of a landed table that is not needed any more."""
    context = landed.sparkSession.sparkContext
    for folder in {file.rpartition("/")[0] for file in landed.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def query_rows(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    text: str,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Rows of a caller's SELECT over ``tables``, with values bound to ``:name``.

    Values are typed parameters, never spliced into the text.  The text names a
    table in braces, ``select .. from {orders}``.
    """
    used = {name: tables[name] for name in tables if "{" + name + "}" in text}
    return first_of_each_label(spark.sql(text, args=dict(params or {}), **used))
