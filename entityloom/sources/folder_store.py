"""A keyed store of Parquet files, for ``entity_store``: of a key's rows the last write counts.

Options: ``folder``, a URI that executors and driver reach; ``write``, the number of the write,
higher than those before it.  A put is a file named after the write, the task and the batch, so
an attempt that runs again writes the same files over.  On a local file system what a put makes is as
open to other users as ``folder``, so executors may run as several.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.operators.collapse import collapse_by_key
from entityloom.sources.uris import open_folder

STORE = "entityloom.sources.folder_store:FolderStore"
WRITE = "write"


class FolderStore:
    def __init__(self, options: dict[str, str]):
        self.files, folder = open_folder(options["folder"])
        self.above, self.folder = folder, f"{folder}/{WRITE}={int(options[WRITE])}"
        with self._as_open():
            self.files.create_dir(self.folder, recursive=True)
        self.task, self.puts = TaskContext.get().partitionId(), 0

    def put(self, batch: pa.RecordBatch) -> None:
        name = f"{self.folder}/part-{self.task:06d}-{self.puts:06d}.parquet"
        with self._as_open(), self.files.open_output_stream(name) as out:
            pq.write_table(pa.Table.from_batches([batch]), out)
        self.puts += 1

    @contextmanager
    def _as_open(self) -> Iterator[None]:
        """Files and folders made meanwhile are as open as the store's folder."""
        if not isinstance(self.files, fs.LocalFileSystem) or not os.path.isdir(self.above):
            yield
            return
        usual = os.umask(0o077)
        os.umask(usual & ~os.stat(self.above).st_mode)
        try:
            yield
        finally:
            os.umask(usual)

    def close(self) -> None:
        return None


def stored_rows(spark: SparkSession, folder: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The store's rows as they stand: for each of ``keys``, that of the last write."""
    rows = spark.read.schema(f"{schema}, {WRITE} int").parquet(folder)
    return collapse_by_key(rows, list(keys), [F.desc(WRITE)]).drop(WRITE)
