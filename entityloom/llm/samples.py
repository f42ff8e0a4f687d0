"""Bounded samples of labelled documents, and the split that training may see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(key: str, parts: int, rest: int):
    """True where the CRC-32 of the key's text leaves ``rest``; null keys count as empty."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts == rest


def share_of_hash(column: str):
    """Where a 64-bit hash lies between the smallest (0) and the largest (1)."""
    return F.col(column) / F.lit(2.0**64) + 0.5


def lowest(rows: DataFrame, hash_column: str, limit: int, count: int | None = None) -> DataFrame:
    """The ``limit`` rows of smallest hash, for distinct hashes.

    All but a few times ``limit`` rows are left out by their hash alone, so that what
    meets in one task does not grow with the number of tasks.  (Were fewer than ``limit``
    to pass, which four times as many expected makes next to impossible, the sample is smaller.)
    """
    count = rows.count() if count is None else count
    few = rows if count <= 8 * limit else rows.where(share_of_hash(hash_column) < 4 * limit / count)
    return few.orderBy(hash_column).limit(limit)


def labelled(docs: DataFrame, labels: DataFrame, key: str, label: str, limit: int) -> DataFrame:
    """``key, label, text`` of at most ``limit`` labelled documents, chosen by a hash of the key.

    Rows whose key or label is null are not used, nor keys labelled both ways.  Of several
    documents with one key the smallest text is taken.  The chosen keys are at most ``limit``,
    so they are broadcast.
    """
    clear = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
        .select("key", F.col("label").cast("int").alias("label"), F.xxhash64("key").alias("at"))
    )
    chosen = lowest(clear, "at", limit).drop("at")
    rows = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    # min() of a text is kept per task first, so many rows of one key are one row each.
    return (
        rows.join(F.broadcast(chosen), "key")
        .groupBy("key")
        .agg(F.first("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )
