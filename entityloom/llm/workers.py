"""Python functions of Arrow batches, on executors that need not have the library installed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from entityloom.llm.shipping import ship


def map_batches(rows: DataFrame, run, schema) -> DataFrame:
    """``rows.mapInArrow(run, schema)``; the library's sources are sent along, once for each application."""
    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)
