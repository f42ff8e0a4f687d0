"""Hot join keys: finding them, and a left outer join that spreads them.

A left outer join can be split on its left side at run time (AQE does that), but
not on its right side.  A satellite in which one key holds a large share of all
rows would therefore end in one task.  Here such keys get a salt on the right,
and the left row is repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.sources.tables import land

SALTS = "__salts"
COUNT = "__rows"
LEAST_HOT_ROWS = 10_000
MAX_BROADCAST_KEYS = 100_000

# Decimal digits of the integer types.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _types(df: DataFrame, columns: list[str]) -> list[T.DataType]:
    return [df.schema[c].dataType for c in columns]


def common_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type in which keys of the two are compared, if unequal keys stay unequal in it.

    None for text against numbers and the like, where several keys of a side may equal one
    of the other.
    """
    if left == right:
        return left
    if type(left) in _DIGITS and type(right) in _DIGITS:
        return max(left, right, key=lambda t: _DIGITS[type(t)])
    exact = [_as_decimal(t) for t in (left, right)]
    if None not in exact:
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    small = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    if isinstance(left, small) and isinstance(right, small):
        # A double holds every int; a float does not, so it is compared as a double too.
        return T.DoubleType()
    if {type(left), type(right)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return None


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[type(kind)], 0) if type(kind) in _DIGITS else None


def find_hot_keys(
    df: DataFrame, keys: list[str], min_rows: int | None = None
) -> DataFrame | None:
    """Every key of ``df`` with more than ``min_rows`` rows (by default an ordinary shuffle
    partition's), with the number of salts that cuts it into pieces of about that many.

    The rows are read once: the counts by key, taken per task before they are shuffled, are
    summed up on their way, and keys that cannot be hot are left out.  Were a task to run
    again, the sum and with it the bound may be higher; no row depends on it.  The table is
    landed and stays on the executors; None if no key is hot.
    """
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    counts = df.where(present).groupBy(*keys).agg(F.count("*").alias(COUNT))
    if min_rows:
        hot = land(counts.where(F.col(COUNT) > min_rows), "hot-keys")
        least = min_rows
    else:
        seen = Observation()
        counts = counts.observe(seen, F.sum(COUNT).alias("rows"))
        hot = land(counts.where(F.col(COUNT) > LEAST_HOT_ROWS), "hot-keys")
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Rows of an ordinary shuffle partition.
        least = max(LEAST_HOT_ROWS, (seen.get["rows"] or 0) // partitions)
    salts = F.pow(2, F.ceil(F.log2(F.col(COUNT) / least))).cast("bigint").alias(SALTS)
    hot = hot.where(F.col(COUNT) > least).select(*keys, salts)
    return None if hot.isEmpty() else hot


def spread_left_join(
    base: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left outer join on ``pairs`` of (base column, right column) names.

    The right key columns are dropped.  ``hot`` must come from ``right``'s own rows.  Keys of
    different types are brought to a common one first.  Without hot keys, or if there is no
    such type (text against numbers), this is the plain join.
    """
    match = [F.col(b) == F.col(r) for b, r in pairs]
    base_keys, right_keys = [b for b, _ in pairs], [r for _, r in pairs]
    kinds = [
        common_type(l, r) for l, r in zip(_types(base, base_keys), _types(right, right_keys))
    ]
    if hot is None or None in kinds:
        return base.join(right, match, "left").drop(*right_keys)
    widened = []
    for i, (b, r, kind) in enumerate(zip(base_keys, right_keys, kinds)):
        if right.schema[r].dataType != kind:
            right = right.withColumn(r, F.col(r).cast(kind))
            hot = hot.withColumn(r, F.col(r).cast(kind))
        if base.schema[b].dataType != kind:
            widened.append(f"__base{i}")
            base = base.withColumn(f"__base{i}", F.col(b).cast(kind))
            base_keys[i] = f"__base{i}"
    match = [F.col(b) == F.col(r) for b, r in zip(base_keys, right_keys)]

    few = hot.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS

    def salted_rows(df: DataFrame, names: list[str], label: str) -> DataFrame:
        renamed = [F.col(r).alias(f"__hot{i}") for i, r in enumerate(right_keys)]
        table = hot.select(*renamed, F.col(SALTS).alias(f"__{label}"))
        same = [F.col(n) == F.col(f"__hot{i}") for i, n in enumerate(names)]
        joined = df.join(F.broadcast(table) if few else table, same, "left")
        one = F.coalesce(f"__{label}", F.lit(1).cast("bigint"))
        return joined.select(*df.columns, one.alias(label))

    # The salt depends on row content and partition only, so a task that runs
    # again gives each row the same salt.  Copies of one row differ by partition.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *right.columns), F.col("__salts_r"))
    zero = F.lit(0).cast("bigint")
    salted = (
        salted_rows(right, right_keys, "__salts_r")
        .withColumn("__salt_r", F.when(F.col("__salts_r") > 1, salt).otherwise(zero))
        .withColumn("__hit", F.lit(True))
    )
    left = salted_rows(base, base_keys, "__salts_l").withColumn(
        "__salt_l", F.explode(F.sequence(zero, F.col("__salts_l") - 1))
    )
    joined = left.join(
        salted, [*match, F.col("__salt_l") == F.col("__salt_r")], "left"
    )
    # A hot key occurs on the right, so some salt matched: the repeats that met
    # nothing are surplus.  Other rows were not repeated and all stay.
    kept = joined.where((F.col("__salts_l") == 1) | F.col("__hit").isNotNull())
    helpers = ["__salts_l", "__salt_l", "__salts_r", "__salt_r", "__hit", *widened]
    return kept.drop(*right_keys, *helpers)
