"""A distributed LSD radix sort: rows get their places in a total order, by counting alone.

Rows lie in blocks.  A pass counts the rows of each (block, digit), sums the counts over all
smaller digits and, within a digit, over all earlier blocks: that is where the block's rows
with this digit begin.  A row's destination is this offset and its rank among the block's
rows with the same digit, in the order of the pass before, so every pass is stable.  The
destinations make the blocks of the next pass.

No task holds more than a block's rows of one digit, and no sum is taken on the driver: the
prefix over digits has at most ``2^DIGIT_BITS`` rows, that over blocks runs for each digit apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entityloom.llm.components import written

DIGIT_BITS = 16
BLOCK_ROWS = 1 << 20


def digits(bits: int, most: int = DIGIT_BITS) -> list[tuple[int, int]]:
    """(shift, width) of the digits of a key of so many bits, least significant first, evenly cut."""
    if bits <= 0:
        return []
    count = -(-bits // most)
    width = -(-bits // count)
    return [(shift, min(width, bits - shift)) for shift in range(0, bits, width)]


def digit(key: str, shift: int, width: int) -> Column:
    """The digit of a key read as an unsigned 64-bit number."""
    part = F.shiftrightunsigned(F.col(key).cast("bigint"), shift)
    return part.bitwiseAND(F.lit((1 << width) - 1)).alias("digit")


def counting_pass(state: DataFrame, key: str, shift: int, width: int, block_rows: int) -> DataFrame:
    """``state`` (with ``block`` and ``place``) after one stable counting sort by a digit."""
    dealt = state.select("*", digit(key, shift, width))
    counts = dealt.groupBy("digit", "block").agg(F.count("*").alias("rows"))
    totals = counts.groupBy("digit").agg(F.sum("rows").alias("total"))
    # One task, but at most 2^DIGIT_BITS rows, however large the table.
    smaller = W.orderBy("digit").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("digit", F.coalesce(F.sum("total").over(smaller), F.lit(0)).alias("start"))
    earlier = W.partitionBy("digit").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    offsets = counts.select("digit", "block", before).join(starts, "digit")
    offsets = offsets.select("digit", "block", (F.col("start") + F.col("before")).alias("offset"))
    rank = F.row_number().over(W.partitionBy("digit", "block").orderBy("place"))
    to = (F.col("offset") + rank - 1).alias("place")
    kept = [c for c in state.columns if c not in ("place", "block")]
    moved = dealt.join(offsets, ["digit", "block"]).select(*kept, to)
    return moved.withColumn("block", F.floor(F.col("place") / block_rows).cast("bigint"))


def radix_places(
    rows: DataFrame,
    keys: Sequence[tuple[str, int]],
    digit_bits: int = DIGIT_BITS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``rows`` with ``place``, 0, 1, 2, .. in the order of ``keys``.

    keys: (column, bits), the most significant first; a column is read as an unsigned number
    below ``2^bits`` and holds no null.  Rows equal in all keys follow each other in any order.
    ``rows`` has no columns named place, block or digit.  Each pass is written below the shared
    folder, so a lost executor costs one pass at most.
    """
    number = F.monotonically_increasing_id()
    state = rows.select("*", number.alias("place"))
    state = written(state.withColumn("block", F.shiftright("place", 33)), "radix")
    for key, bits in reversed(list(keys)):
        for shift, width in digits(bits, digit_bits):
            state = written(counting_pass(state, key, shift, width, block_rows), "radix")
    if not any(bits > 0 for _, bits in keys):  # all rows are equal: any order will do
        even = state.select("*", F.lit(0).alias("same"))
        state = written(counting_pass(even, "same", 0, 1, block_rows), "radix").drop("same")
    return state.drop("block")
