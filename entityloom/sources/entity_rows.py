"""Reading through a site's own client, in parallel, as a Python data source.

The counterpart of ``entity_store``: a client class is built with the options, on the driver
and in each task, and has

* ``partitions(columns, equal)``: what is read in parallel, a list of anything that can be pickled;
* ``read(partition, columns, equal)``: the partition's rows, as Arrow batches of these columns.

``columns`` are those the caller asks for, in order.  ``equal`` holds values that columns must
equal, pushed down from Spark's filters; a client may use them to read less and need not, as
Spark applies every filter again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from entityloom.sources.entity_store import named_class
from entityloom.sources.shipping import ship
from entityloom.sources.uris import open_folder

FORMAT = "entity_rows"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PARQUET_CLIENT = "entityloom.sources.entity_rows:ParquetClient"


@dataclass
class Part(InputPartition):
    value: object


class RowsReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.options, self.columns = options, columns
        self.equal: dict[str, object] = {}

    def _client(self):
        return named_class(self.options["client"])(self.options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if isinstance(one, EqualTo) and len(one.attribute) == 1:
                self.equal[one.attribute[0]] = one.value
            yield one  # Spark applies it too

    def partitions(self) -> Sequence[InputPartition]:
        return [Part(p) for p in self._client().partitions(self.columns, self.equal)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from self._client().read(partition.value, self.columns, self.equal)


class EntityRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        if "client" not in self.options:
            raise ValueError("option 'client' must name a class as 'module:Class'")
        return RowsReader(dict(self.options), schema.names)


@dataclass(frozen=True)
class ClientSource:
    """Tables that a client reads; it gets the table's name as the option ``relation``.

    ``schemas`` gives each table's columns as DDL.  Options may hold secrets and stay out of ``repr``.
    """

    client: str  # module:Class
    schemas: Mapping[str, str]
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def rows(
        self,
        spark: SparkSession,
        relation: str,
        split: object = None,
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """Rows of a table; the client reads those of ``columns`` that it has, in its own partitions."""
        if split is not None:
            raise ValueError("a client splits its reads itself")
        ship(spark)
        spark.dataSource.register(EntityRows)
        spark.conf.set(PUSHDOWN, "true")
        fields = T.StructType.fromDDL(self.schemas[relation])
        wanted = T.StructType([f for f in fields if columns is None or f.name in columns])
        options = {**self.options, "relation": relation, "client": self.client}
        return spark.read.format(FORMAT).schema(wanted).options(**options).load()


class ParquetClient:
    """Parquet files below a URI, a row group at a time.  Option ``folder``: the tables' folder;
    a table is a file or a folder of files, ``<folder>/<relation>`` with or without ``.parquet``."""

    def __init__(self, options: Mapping[str, str]):
        self.files, folder = open_folder(options["folder"])
        self.place = f"{folder.rstrip('/')}/{options['relation']}"

    def _paths(self) -> list[str]:
        found = self.files.get_file_info([self.place, f"{self.place}.parquet"])
        paths = [f.path for f in found if f.type == fs.FileType.File]
        for info in found:
            if info.type == fs.FileType.Directory:
                inside = self.files.get_file_info(fs.FileSelector(info.path))
                paths += [f.path for f in inside if re.search(r"/[^/._][^/]*\.parquet$", f.path)]
        return sorted(paths)

    def partitions(self, columns, equal) -> list[tuple[str, int]]:
        out = []
        for path in self._paths():
            with self.files.open_input_file(path) as file:
                groups = pq.ParquetFile(file).metadata
                out += [(path, g) for g in range(groups.num_row_groups) if _may_hold(groups, g, equal)]
        return out

    def read(self, partition, columns, equal) -> Iterator[pa.RecordBatch]:
        path, group = partition
        with self.files.open_input_file(path) as file:
            wanted = [*columns, *[c for c in equal if c not in columns]]
            for batch in pq.ParquetFile(file).iter_batches(row_groups=[group], columns=wanted):
                for name, value in equal.items():
                    same = pc.equal(batch.column(name), pa.scalar(value, batch.schema.field(name).type))
                    batch = batch.filter(same)
                yield batch.select(list(columns))


def _may_hold(groups: pq.FileMetaData, group: int, equal: Mapping[str, object]) -> bool:
    """Whether the row group's bounds leave room for the values."""
    names = {groups.schema.column(i).name: i for i in range(groups.num_columns)}
    for name, value in equal.items():
        stats = groups.row_group(group).column(names[name]).statistics
        if stats is not None and stats.has_min_max and isinstance(value, type(stats.min)):
            if value < stats.min or value > stats.max:
                return False
    return True
