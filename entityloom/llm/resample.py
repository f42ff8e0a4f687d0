"""Importance resampling towards a target: documents that look like the target come first.

Hashed words and word pairs are counted over all documents and over the target texts.  A
bucket's gain is the smoothed log ratio of the two, a document's weight the mean gain of its
features; Gumbel noise by a hash of the id makes the highest scores a weighted draw without
replacement.  The gains are one array of ``buckets`` entries, so every task scores by array
lookups; the scores are ordered by a radix sort.

Edge cases: null and empty texts have no features and weight 0; a text is read in pieces, so
memory follows the text and not its number of words; a document without an id draws with the
id's text empty and comes after all others of its score; repeated rows are drawn as rows of
their own; an empty table gives no rows; without target texts the target is flat; other
columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import written
from entityloom.llm.radix import radix_places
from entityloom.llm.words import LOWER, NOT_ALNUM, pieces
from entityloom.llm.workers import map_batches

BUCKETS = 10_000
LONGEST = 2  # words of a feature
CHUNK = 1 << 20

# Bytes in lower case, everything that is no part of a word a blank.
_FOLD = bytes(0x20 if NOT_ALNUM[b] else int(LOWER[b]) for b in range(256))


def feature_codes(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text: words that begin there, CRC-32 of the runs of words that end there."""
    folded, start, tail = text.translate(_FOLD), 0, []
    while start < len(folded):
        end = folded.find(b" ", start + CHUNK)
        end = len(folded) if end < 0 else end
        new = folded[start:end].split()
        words = tail + new
        codes, runs = [], list(map(crc32, words))
        codes.append(runs[len(tail) :])
        joined = [b" " + w for w in words]
        for k in range(2, longest + 1):
            # A run of k words goes on from the run of k - 1 words that begins with it.
            runs = list(map(crc32, joined[k - 1 :], runs))
            codes.append(runs[max(0, len(tail) - k + 1) :])
        yield len(new), np.concatenate([np.array(c, np.int64) for c in codes])
        tail = words[len(words) - longest + 1 :] if longest > 1 else []
        start = end


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for piece in pieces(batch, column):
        for text in piece.column(column).cast(pa.large_binary()):
            yield text.as_py() or b""


def feature_counts(
    docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST
) -> DataFrame:
    """``bucket, n``: how often the features of all texts fall into each bucket that has any."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for one in _texts(batch, 0):
                for _, codes in feature_codes(one, longest):
                    total += np.bincount(codes % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    texts = docs.select(F.col(text).cast("string").alias("t"))
    counted = map_batches(texts, run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored ``1000 * ln`` of each bucket's smoothed share in the target over that in the documents."""
    size, s_all, t_all = len(docs), int(docs.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
            for s, t in zip(docs.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _as_array(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():  # at most one row for each bucket
        out[bucket] = n
    return out


def weighed(
    docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST
) -> DataFrame:
    """``key, n_words, n_features, weight`` of each row: the floored mean of its features' gains."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                out = []
                for one in piece.column(1).cast(pa.large_binary()):
                    n_words, n, total = 0, 0, 0
                    for words, codes in feature_codes(one.as_py() or b"", longest):
                        n_words, n = n_words + words, n + len(codes)
                        total += int(gain[codes % buckets].sum())
                    out.append((n_words, n, total // n if n else 0))
                made = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *made], ["key", "n_words", "n_features", "weight"]
                )

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("t"))
    return map_batches(rows, run, "key bigint, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the SHA-256 of ``<seed>:<key>``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``place`` by falling score, then rising key, null keys last."""
    seen = rows.agg(
        F.min("score"), F.max("score"), F.min("key"), F.max("key"), F.count_if(F.col("key").isNull())
    ).first()
    low, high, first, last, unnamed = [x or 0 for x in seen]
    key = F.coalesce(F.col("key"), F.lit(0))
    if first < 0:  # the sign bit turned over: unsigned order is signed order
        key, bits = key.bitwiseXOR(F.lit(-(1 << 63))), 64
    else:
        bits = last.bit_length()
    marked = rows.select(
        "*",
        (F.lit(high) - F.col("score")).alias("by_score"),
        F.col("key").isNull().cast("int").alias("by_null"),
        key.alias("by_key"),
    )
    keys = [("by_score", (high - low).bit_length()), ("by_null", int(unnamed > 0)), ("by_key", bits)]
    return radix_places(marked, keys).drop("by_score", "by_null", "by_key")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
) -> DataFrame:
    """``key, n_words, n_features, weight, score, rank`` of each row of ``docs``.

    ``percent`` of the documents with at least ``least_words`` words are drawn; ``rank`` is the
    place in the draw, null for the others.  ``target`` has its texts in ``text``.
    """
    counts = [_as_array(feature_counts(t, text, buckets, longest), buckets) for t in (docs, target)]
    rows = weighed(docs, gains(*counts), key, text, longest)
    rows = written(rows.select("*", (F.col("weight") + noise(F.col("key"), seed)).alias("score")), "weighed")
    able, rest = rows.where(F.col("n_words") >= least_words), rows.where(F.col("n_words") < least_words)
    drawn = percent * able.count() // 100
    place = F.col("place") + 1
    ranked = _ordered(able).select(*rows.columns, F.when(place <= drawn, place).alias("rank"))
    both = ranked.unionByName(rest.select("*", F.lit(None).cast("bigint").alias("rank")))
    return both.withColumnRenamed("key", key)
