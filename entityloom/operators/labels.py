"""Result columns with equal labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entityloom.functions.scalars import quoted


def folding(spark: SparkSession) -> Callable[[str], str]:
    """How the session compares labels: ``Id`` and ``id`` are one unless
    ``spark.sql.caseSensitive`` is on."""
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    return str if exact else str.lower


def first_of_each_label(df: DataFrame) -> DataFrame:
    """Keep the earliest of the columns that share a label, as the session compares them."""
    fold = folding(df.sparkSession)
    labels = df.columns
    first: dict[str, int] = {}
    for position, label in enumerate(labels):
        first.setdefault(fold(label), position)
    if len(first) == len(labels):
        return df
    by_position = df.toDF(*[f"_{i}" for i in range(len(labels))])
    return by_position.select(
        *[quoted(f"_{i}").alias(labels[i]) for i in first.values()]
    )
