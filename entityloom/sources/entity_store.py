"""Sink for an external keyed store, as a Python data source.

``df.write.format("entity_store").option("store", "module:Class")`` builds one
``Class(options)`` per task attempt, calls ``put(batch)`` with Arrow batches and
then ``close()``.  Attempts may run twice, so a put must overwrite by key, or
stay unseen until ``Class.publish(options, tokens)`` is called once with what
``close()`` returned in the attempts that count.  If the write fails,
``Class.abort(options, tokens)``, where there is one, gets what had been closed by then.

``write_entities`` arranges the rows for such a store: ranges of keys, one task each, sorted, so
that puts go through the store's key space in order and all rows of a key come from one
task; and batches bounded by rows and bytes, as stores bound their requests.

Entities kept as Parquet need no such class: ``sources.buckets`` overwrites them by key.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    WriterCommitMessage,
)

from entityloom.functions.scalars import quoted
from entityloom.operators.collapse import entity_keys
from entityloom.operators.entities import KEY
from entityloom.sources.shipping import ship

FORMAT = "entity_store"
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20


def bounded(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in order, in parts of at most so many rows and bytes; a larger row is a part."""
    for begin in range(0, batch.num_rows, rows):
        waiting = [batch.slice(begin, rows)]
        while waiting:
            part = waiting.pop()
            if part.nbytes <= size or part.num_rows == 1:
                yield part
            else:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]


def named_class(text: str):
    """The class that ``module:Class`` names."""
    module, _, name = text.partition(":")
    return getattr(importlib.import_module(module), name)


@dataclass
class Written(WriterCommitMessage):
    token: str | None


class StoreWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def _store_class(self):
        return named_class(self.options["store"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store = self._store_class()(self.options)
        rows = int(self.options.get("batch_rows", BATCH_ROWS))
        size = int(self.options.get("batch_bytes", BATCH_BYTES))
        for batch in iterator:
            for part in bounded(batch, rows, size):
                store.put(part)
        return Written(store.close())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        abort = getattr(self._store_class(), "abort", None)
        if abort is not None:
            abort(self.options, [m.token for m in messages if m and m.token])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        publish = getattr(self._store_class(), "publish", None)
        if publish is not None:
            publish(self.options, [m.token for m in messages if m and m.token])


class EntityStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite):
        if "store" not in self.options:
            raise ValueError("option 'store' must name a class as 'module:Class'")
        return StoreWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(EntityStore)


def _arranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` in ranges of its keys, sorted; other rows as they are."""
    by: list[Column] = [quoted(k) for k in keys]
    if not by and KEY in df.columns:
        by = entity_keys()
    if not by:
        return df
    return df.repartitionByRange(*by).sortWithinPartitions(*by, *_rest(df, keys))


def _rest(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    # Rows of one key in the same order in every attempt, so that equal batches are put again.
    return [F.xxhash64(*[quoted(c) for c in df.columns if c not in keys])]


def write_entities(
    df: DataFrame,
    store: str,
    options: dict[str, str],
    keys: Sequence[str] = (),
    batch_rows: int = BATCH_ROWS,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Put every row of ``df`` into ``store`` (``module:Class``); whether a repeated write
    overwrites by key is the store's to do.

    Rows with an entity key, or with the columns ``keys``, are put in ranges of it.
    """
    register(df.sparkSession)
    bounds = {"batch_rows": str(batch_rows), "batch_bytes": str(batch_bytes)}
    writer = _arranged(df, keys).write.format(FORMAT).option("store", store)
    writer.options(**{**bounds, **options}).mode("append").save()
