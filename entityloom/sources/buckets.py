"""Stored entities as Parquet in buckets of their keys, so that a run rewrites only what it touches.

A store is one folder with a directory for each bucket, ``bucket_of_<n>=<i>``; the bucket of an
entity is a hash of its key, and ``n`` stays what it was when the store was begun.  A run reads,
upserts and replaces just the buckets its keys fall into, by Spark's own dynamic partition
overwrite.  What it will write is landed first, so nothing is read while it is replaced, and
after a failure the same run can be repeated.  One run writes a store at a time.

Files of untouched buckets keep the properties they were written with.  Each row knows these
(``__known__``, the same in a whole file), so a property that came later is absent in it, not null.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from entityloom.functions.scalars import quoted
from entityloom.operators.entities import KEY
from entityloom.operators.normalise import ABSENT
from entityloom.operators.upsert import upsert_entities
from entityloom.sources.shared import write_options
from entityloom.sources.tables import drop_landed, land

BUCKETS = 1024
KNOWN = "__known__"
_COLUMN = re.compile(r"bucket_of_([0-9]+)")


def bucket_of(buckets: int):
    """The bucket of an entity's key."""
    fields = [F.col(f"{KEY}.{field}") for field in ("project", "kind", "name")]
    return F.pmod(F.xxhash64(*fields), F.lit(buckets)).cast("int").alias(f"bucket_of_{buckets}")


def _files(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """The files of a store as they are; None where there is none yet."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _bucket_column(files: DataFrame) -> str:
    found = [c for c in files.columns if _COLUMN.fullmatch(c)]
    if len(found) != 1:
        raise ValueError("no store in buckets")
    return found[0]


def _entities(files: DataFrame) -> DataFrame:
    """The stored entities; what a row's file did not know is absent in it."""
    bucket = _bucket_column(files)
    properties = [c for c in files.columns if c not in (KEY, ABSENT, KNOWN, bucket)]
    every = F.array(*[F.lit(c) for c in properties]).cast("array<string>")
    none = F.array().cast("array<string>")
    later = F.when(F.size(KNOWN) == len(properties), none).otherwise(F.array_except(every, KNOWN))
    absent = F.array_union(F.coalesce(ABSENT, none), later).alias(ABSENT)
    return files.select(KEY, *[quoted(c) for c in properties], absent)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All entities of a store, with the properties of all its files.

    Without ``schema`` (that of the files, bucket column included) the footers are read to find it.
    The rows are those of now: after the next run's write the store must be read anew, as replaced
    files are gone.
    """
    files = _files(spark, path, schema)
    if files is None:
        raise ValueError(f"no store at {path}")
    return _entities(files)


def _replace(rows: DataFrame, path: str, bucket: str) -> None:
    """Write ``rows`` over the buckets they fall into, other buckets untouched."""
    properties = [c for c in rows.columns if c not in (KEY, ABSENT, bucket)]
    known = F.array(*[F.lit(c) for c in properties]).cast("array<string>").alias(KNOWN)
    absent = F.col(ABSENT) if ABSENT in rows.columns else F.array().cast("array<string>").alias(ABSENT)
    whole = rows.select(KEY, *[quoted(c) for c in properties], absent, known, bucket)
    # One task a bucket or several, as its size asks: a large bucket is split at run time.
    (
        whole.hint("rebalance", F.col(bucket))
        .write.options(**write_options(rows.sparkSession, path))
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(bucket)
        .parquet(path)
    )


def upsert_buckets(
    path: str,
    entities: DataFrame,
    buckets: int = BUCKETS,
    schema: T.StructType | None = None,
    folder: str | None = None,
) -> int:
    """Write ``entities``, one row per key, over the store at ``path``; how many buckets that touched.

    ``buckets`` counts only for a new store: take so many that one, with its properties, is a
    few files.  A property of another type than stored fails before anything is written.
    ``entities`` is read several times, so land it first if it is the end of a long chain.
    The numbers of the touched buckets, ``buckets`` integers at most, come to the driver.
    """
    spark = entities.sparkSession
    files = _files(spark, path, schema)
    if files is None:
        _replace(entities.select("*", bucket_of(buckets)), path, f"bucket_of_{buckets}")
        return entities.select(bucket_of(buckets)).distinct().count()
    bucket = _bucket_column(files)
    count = int(_COLUMN.fullmatch(bucket)[1])
    touched = [r[0] for r in entities.select(bucket_of(count)).distinct().collect()]
    if not touched:
        return 0
    current = _entities(files.where(F.col(bucket).isin(touched)))
    after = upsert_entities(current, entities, KEY, collapsed=True)
    landed = land(after.select("*", bucket_of(count)), "touched-buckets", folder)
    _replace(landed, path, bucket)
    drop_landed(landed)
    return len(touched)
