"""Whole texts in Arrow batches: walking them in bounded pieces, cutting and hashing words.

Texts are read as UTF-8 bytes.  A piece holds about ``PIECE_BYTES`` of text, or one
longer text alone, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.llm.workers import map_batches

PIECE_BYTES = 2_000_000
LONG_WORD = 4096


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in any of the inclusive ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words(NamedTuple):
    """Words of several texts: bytes, byte ranges, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets between them; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def cut_words(texts: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of bytes that are no separators; no word spans two texts."""
    data, at = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    n = len(data)
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    heads = at[(at > 0) & (at < n)]
    opens[heads] |= inside[heads]
    closes[heads - 1] |= inside[heads - 1]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, at))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out; every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step for all words at once."""
    size = words.ends - words.starts
    out = mix(size.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    if not len(size):
        return out
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(words.data) + 1,), "<u8", padded, strides=(1,))
    live, step = np.flatnonzero(size <= LONG_WORD), 0
    while len(live):
        left = size[live] - step
        lane = lanes[words.starts[live] + step]
        short = np.minimum(left, 8)
        lane &= np.uint64(2**64 - 1) >> ((8 - short) * 8).astype(np.uint64)
        out[live] = mix(out[live] ^ lane)
        step += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(words.data[words.starts[i] : words.ends[i]], seed)
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive hashes, by doubling."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out, have, power, span = None, 0, hashes, 1
    todo = width
    while todo:
        if todo & 1:
            if out is None:
                out, have = power, span
            else:
                m = len(hashes) - (have + span) + 1
                out = mix(out[:m] * np.uint64(0x9E3779B97F4A7C15) + power[have : have + m])
                have += span
        todo >>= 1
        if todo:
            m = len(power) - span
            power = mix(power[:m] * np.uint64(0xD6E8FEB86659FD93) + power[span : span + m])
            span *= 2
    return out


def pieces(batch: pa.RecordBatch, column: int, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(lengths.astype(np.int64)) - 1) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with underscores until no column has it."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name += "_"
    return name


def append_result(
    docs: DataFrame,
    text: str,
    compute: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    fields: str,
    name: str,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` that ``compute`` makes of each text.

    ``compute()`` runs once in each task and returns the function of a piece's texts.
    """
    kind = T.StructType.fromDDL(fields)
    names = [f.name for f in kind]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])
    at = docs.columns.index(text)

    def run(batches):
        made = compute()
        for batch in batches:
            for piece in pieces(batch, at):
                columns = made(piece.column(at))
                struct = pa.StructArray.from_arrays(columns, names)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, struct], [*piece.schema.names, name]
                )

    return map_batches(docs, run, schema)


def results(docs: DataFrame, key: str, text: str, compute, fields: str) -> DataFrame:
    """The key of each row and the result of its text as columns."""
    kept = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    done = append_result(kept, "t", compute, fields, "r")
    return done.select(F.col("k").alias(key), "r.*")
