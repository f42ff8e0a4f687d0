"""Benchmark decontamination with suffix arrays of the training text.

Each piece of training text (a shard, a few megabytes) gets a suffix array of its
words; every benchmark suffix is found in it by binary search, all at once, one word
deeper at a step.  The suffixes that share a whole window with the benchmark are a range
of the array, so one search yields every occurrence and its place.  At the head of each
run of occurrences the match is followed on, which gives the longest verbatim match.

A training suffix can only meet a benchmark suffix if its next words are words of the
benchmark, so the array leaves out runs of known words shorter than the shortest window.
Words are compared by a 64-bit hash.

The benchmark is searched in blocks of at most ``BLOCK_BYTES`` (measured, not assumed; one
longer item is a block alone).  A block is broadcast, and the documents pass the blocks one
after the other in the same tasks, without a shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.llm.components import written
from entityloom.llm.words import NOT_ALNUM, cut_words, free_name, pieces, word_hashes
from entityloom.llm.workers import map_batches

WINDOW = 13
BLOCK_BYTES = 8_000_000
BLOCKS_AT_ONCE = 8  # broadcast together; beyond them the result so far is written
SIEVE_BITS = 20


class Block(NamedTuple):
    """Benchmark items as one run of word numbers, and their distinct windows."""

    known: np.ndarray  # sorted hashes of the words; a word's number is its place + 1
    sieve: np.ndarray  # which leading bits of a hash occur
    words: np.ndarray  # word numbers of all items, a zero after each
    item: np.ndarray  # item of each word
    item_first: np.ndarray  # where each item begins
    names: list[str | None]
    starts: np.ndarray  # where each distinct window first occurs in ``words``
    lengths: np.ndarray
    holders: list[np.ndarray]  # items of each distinct set of items
    holder: np.ndarray  # the set of each window


def build_block(names: list[str | None], texts: list[str | None], window: int) -> Block:
    cut = cut_words(pa.array(texts, pa.string()), NOT_ALNUM, lower=True)
    hashes = word_hashes(cut)
    known, numbers = np.unique(hashes, return_inverse=True)
    sizes = np.diff(cut.first)
    words = np.insert(numbers + 1, cut.first[1:], 0).astype(np.int64)
    item_first = cut.first[:-1] + np.arange(len(sizes))
    item = np.repeat(np.arange(len(sizes)), sizes + 1)
    found: dict[bytes, int] = {}
    starts, lengths, held = [], [], []
    for i, size in enumerate(sizes.tolist()):
        span = min(window, size)
        for at in range(size - span + 1 if size else 0):
            begin = int(item_first[i]) + at
            key = words[begin : begin + span].tobytes()
            if key not in found:
                found[key] = len(starts)
                starts.append(begin)
                lengths.append(span)
                held.append([])
            if not held[found[key]] or held[found[key]][-1] != i:
                held[found[key]].append(i)
    sets: dict[tuple[int, ...], int] = {}
    holder = np.array([sets.setdefault(tuple(x), len(sets)) for x in held], np.int64)
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    sieve[known >> np.uint64(64 - SIEVE_BITS)] = True
    return Block(
        known,
        sieve,
        np.concatenate([words, np.zeros(window + 1, np.int64)]),
        item,
        item_first,
        names,
        np.array(starts, np.int64),
        np.array(lengths, np.int64),
        [np.array(x, np.int64) for x in sets],
        holder,
    )


def numbered(hashes: np.ndarray, block: Block) -> np.ndarray:
    """Each word's number in the block, zero for words it does not have."""
    out = np.zeros(len(hashes), np.int64)
    maybe = np.flatnonzero(block.sieve[hashes >> np.uint64(64 - SIEVE_BITS)])
    some = hashes[maybe]
    at = np.minimum(np.searchsorted(block.known, some), len(block.known) - 1)
    out[maybe] = np.where(block.known[at] == some, at + 1, 0)
    return out


def known_runs(numbers: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``least`` known words of one document, each followed by a zero:
    the word numbers and the places they come from."""
    known = numbers > 0
    head = known.copy()
    head[1:] &= ~known[:-1]
    begins = first[:-1][first[:-1] < len(numbers)]
    head[begins] = known[begins]
    run = np.cumsum(head) - 1
    size = np.bincount(run[known], minlength=run[-1] + 1 if len(run) else 0)
    keep = np.flatnonzero(known)
    keep = keep[size[run[keep]] >= least]
    if not len(keep):
        return np.zeros(0, np.int64), keep
    breaks = np.flatnonzero(np.diff(run[keep])) + 1
    breaks = np.append(breaks, len(keep))
    return np.insert(numbers[keep], breaks, 0), np.insert(keep, breaks, -1)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of their next ``depth`` words, by prefix doubling;
    places of zeros (the ends of runs) are left out."""
    _, rank = np.unique(text, return_inverse=True)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        later = np.zeros(len(rank), np.int64)
        later[:-k] = rank[k:] + 1
        key = rank * (len(rank) + 2) + later
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        if rank[order[-1]] == len(rank) - 1:
            break
        k *= 2
    return order[text[order] > 0]


def lower_bound(values, low, high, target):
    """For each row the first place in [low, high) whose value is not below the target."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        below = values(middle) < target[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


def occurrences(text: np.ndarray, array: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a place in ``text`` and a window of the block that occurs there."""
    n = len(block.starts)
    low, high = np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    padded = np.concatenate([text, np.zeros(block.lengths.max() + 1, np.int64)])
    for step in range(block.lengths.max()):
        live = np.flatnonzero((block.lengths > step) & (low < high))
        if not len(live):
            break
        target = block.words[block.starts[live] + step]

        def nth(at, step=step):
            return padded[array[at] + step]

        new = lower_bound(nth, low[live], high[live], target)
        high[live] = lower_bound(nth, new, high[live], target + 1)
        low[live] = new
    hit = np.flatnonzero(low < high)
    count = high[hit] - low[hit]
    ends = np.cumsum(count)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
    return array[np.repeat(low[hit], count) + inside], np.repeat(hit, count)


class Found(NamedTuple):
    """For the documents of a shard: words, hit words, items, and the longest match."""

    n_words: np.ndarray
    ranges: list[list[int]]
    items: list[list[str]]
    longest: list[dict | None]


def search(hashes: np.ndarray, first: np.ndarray, block: Block) -> Found:
    """Every occurrence of the block's windows in one shard of documents."""
    n = len(first) - 1
    ranges: list[list[int]] = [[] for _ in range(n)]
    items: list[list[str]] = [[] for _ in range(n)]
    longest: list[dict | None] = [None] * n
    result = Found(np.diff(first), ranges, items, longest)
    if not len(block.starts) or not len(hashes):
        return result
    text, origin = known_runs(numbered(hashes, block), first, int(block.lengths.min()))
    if not len(text):
        return result
    place, window = occurrences(text, suffix_array(text, int(block.lengths.max())), block)
    if not len(place):
        return result
    where, length = origin[place], block.lengths[window]
    doc = np.searchsorted(first, where, side="right") - 1
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + length, -1)
    hit = np.cumsum(edge[:-1]) > 0
    opens, closes = hit.copy(), hit.copy()
    opens[1:] &= ~hit[:-1]
    closes[:-1] &= ~hit[1:]
    heads = first[(first > 0) & (first < len(hit))]
    opens[heads] |= hit[heads]
    closes[heads - 1] |= hit[heads - 1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    owner = np.searchsorted(first, begin, side="right") - 1
    for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist(), strict=True):
        ranges[d] += [a - int(first[d]), b - int(first[d])]
    pairs = np.unique(np.stack([doc, block.holder[window]], 1), axis=0)
    cuts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(pairs)], strict=True):
        held = np.unique(np.concatenate([block.holders[i] for i in pairs[a:b, 1]]))
        items[pairs[a, 0]] = sorted({name for i in held if (name := block.names[i]) is not None})
    follow(text, place, window, doc, where - first[doc], block, longest)
    return result


def follow(text, place, window, doc, at, block: Block, longest: list) -> None:
    """From the head of each run of occurrences on one diagonal, the match's whole length."""
    order = np.lexsort([place, place - block.starts[window]])
    diagonal = (place - block.starts[window])[order]
    head = np.ones(len(order), bool)
    head[1:] = (np.diff(diagonal) != 0) | (np.diff(place[order]) > 1)
    lead = order[head]
    a, b = place[lead], block.starts[window[lead]]
    size = block.lengths[window[lead]].copy()
    live = np.arange(len(lead))
    while len(live):
        x, y = a[live] + size[live], b[live] + size[live]
        inside = (x < len(text)) & (y < len(block.words))
        live, x, y = live[inside], x[inside], y[inside]
        same = (text[x] == block.words[y]) & (text[x] > 0)
        live = live[same]
        size[live] += 1
    best = np.lexsort([b, at[lead], -size, doc[lead]])
    some = doc[lead][best]
    for i in best[np.flatnonzero(np.diff(some, prepend=-1))].tolist():
        item = int(block.item[b[i]])
        longest[int(doc[lead[i]])] = {
            "item": block.names[item],
            "item_start": int(b[i] - block.item_first[item]),
            "doc_start": int(at[lead[i]]),
            "n_words": int(size[i]),
        }


MATCH = "struct<item:string,item_start:long,doc_start:long,n_words:long>"
STATE = f"n_words long, ranges array<long>, items array<string>, longest {MATCH}"
ARROW_MATCH = pa.struct(
    [("item", pa.string()), *((x, pa.int64()) for x in ("item_start", "doc_start", "n_words"))]
)


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark's distinct rows in parts of about ``block_bytes``, by a hash of the row."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    rows = rows.where("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [rows.where(part == i) for i in range(n)]


def merged(old: list[int], new: list[int]) -> list[int]:
    """The union of two lists of ranges, each written begin, end, begin, end, ..."""
    out: list[int] = []
    spans = [*zip(old[::2], old[1::2], strict=True), *zip(new[::2], new[1::2], strict=True)]
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    name: str = "match",
) -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` of what the benchmark has in common:

    ``n_words``; ``ranges`` of hit words (begin, end, begin, end, ...); ``items`` with windows
    that occur, as sorted distinct strings (items without an id hit words but have no name
    here); ``longest``, the longest verbatim match and its places (null if none).

    Words are runs of ASCII letters and digits and of characters above ASCII, A-Z lower-cased.
    A window is ``window`` words of an item, or all of a shorter one; items without words
    have none.  Null and empty texts have no words; repeated rows are judged alike.
    """
    name = free_name(name, docs.columns)
    docs = docs.withColumn(text, F.col(text).cast("string"))
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(STATE))])
    out, live = docs, []
    for turn, part in enumerate(blocks(benchmark, item, item_text, block_bytes)):
        rows = part.toPandas().astype(object)
        rows = rows.where(rows.notna(), None).sort_values(["item", "text"], na_position="first")
        sent = docs.sparkSession.sparkContext.broadcast(
            build_block(rows["item"].tolist(), rows["text"].tolist(), window)
        )

        def run(batches, sent=sent, turn=turn):
            for batch in batches:
                for piece in pieces(batch, at):
                    cut = cut_words(piece.column(at), NOT_ALNUM, lower=True)
                    found = search(word_hashes(cut), cut.first, sent.value)
                    ranges, items, longest = found.ranges, found.items, found.longest
                    columns = piece.columns
                    if turn:
                        before = columns.pop().to_pylist()
                        for i, old in enumerate(before):
                            ranges[i] = merged(old["ranges"], ranges[i])
                            items[i] = sorted({*old["items"], *items[i]})
                            both = [x for x in (old["longest"], longest[i]) if x]
                            longest[i] = max(both, key=lambda x: x["n_words"], default=None)
                    state = pa.StructArray.from_arrays(
                        [
                            pa.array(found.n_words, pa.int64()),
                            pa.array(ranges, pa.list_(pa.int64())),
                            pa.array(items, pa.list_(pa.string())),
                            pa.array(longest, ARROW_MATCH),
                        ],
                        ["n_words", "ranges", "items", "longest"],
                    )
                    names = [f.name for f in schema]
                    yield pa.RecordBatch.from_arrays([*columns, state], names)

        live.append(sent)
        out = map_batches(out, run, schema)
        if turn % BLOCKS_AT_ONCE == BLOCKS_AT_ONCE - 1:
            # What is found so far is written, so that no more blocks than these are held at once.
            out = written(out, "matched")
            for one in live:
                one.destroy()
            live = []
    return out


def n_hit(match: str):
    """Hit words, from the struct that ``matched`` adds: the sum of the ranges' lengths."""
    signed = F.transform(
        F.col(match)["ranges"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)
    )
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(match: str, share: int = 20):
    """True if a document has hit words and they are at least one in ``share``."""
    return (n_hit(match) > 0) & (n_hit(match) * share >= F.col(match)["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay.

    Null and empty texts have no words and stay; equal rows stay or go together.
    """
    name = free_name("match", docs.columns)
    found = matched(docs, benchmark, text, name=name, **options)
    return found.where(~contaminated(name)).drop(name)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"):
    """One row per row of ``docs``: ``key, n_words, n_hit, n_items, items_sha256, contaminated``."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    found = matched(rows, benchmark, "t", name="m")
    return found.select(
        F.col("k").alias(key),
        F.col("m.n_words").alias("n_words"),
        n_hit("m").alias("n_hit"),
        F.size("m.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "m.items"), 256).alias("items_sha256"),
        contaminated("m").alias("contaminated"),
    )
