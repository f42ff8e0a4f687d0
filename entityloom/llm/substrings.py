"""Substring dedup: suffix automata of reference shards find spans that occur elsewhere.

A window is ``window`` consecutive words.  Every word covered by a window whose words also
start anywhere else in the corpus goes, all copies alike.

Every text is both reference and query, so broadcasting the automaton of each shard to all
texts would cost the square of the corpus.  Instead reference and query meet by content:

1. Each window is named by an *anchor*, the smallest hash of its ``ANCHOR`` -word runs, so equal
   windows have equal anchors.  Consecutive windows of one anchor are a *segment*; each window
   lies in exactly one.  Only hashes and places travel.
2. An anchor that occurs once has no repeated window.  If all segments of an anchor are equal
   and hold it once, all their windows are repeated.
3. The rest are *mixed*: near copies, and the ends of shared passages.  Their distinct segments
   are the reference shards: shards of about ``SHARD_WORDS`` words, sorted by anchor, each get a
   suffix automaton that knows how often each state's words end somewhere.  The shard's segments
   stream through it, and matching statistics (the longest suffix read so far that ends
   in two places) of ``window`` or more mark the maximal spans.
4. An anchor whose distinct segments are more than ``CROWD``, or have more than ``CROWD_WORDS``
   words (long runs of one line), is no shard of bounded size: its windows are counted by a 128-bit hash, combined in each task before they are shuffled.

Texts are known by a 128-bit hash, so exact copies, however many, are marked once.  The
shuffle of the texts themselves is one, used for step 3 and for the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import written
from entityloom.llm.words import SPACES, cut_words, mix, pieces, window_hashes, word_hashes
from entityloom.llm.workers import map_batches

WINDOW = 35
ANCHOR = 12
SHARD_WORDS = 50_000
CROWD = 1_000
CROWD_WORDS = 100_000
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(hashes: np.ndarray, first: np.ndarray, window: int):
    """Anchor, hash, first word, words, and whether the anchor occurs more than once, of each
    maximal run of windows with one anchor in one text."""
    empty = np.zeros(0, np.uint64)
    if len(hashes) < window:
        return empty, empty, *(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, bool)
    short = min(ANCHOR, window)
    runs = window_hashes(hashes, short)
    anchors = sliding_min(runs, window - short + 1)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    good = np.arange(len(anchors)) + window <= first[doc[: len(anchors)] + 1]
    head = np.ones(len(anchors), bool)
    head[1:] = (anchors[1:] != anchors[:-1]) | (doc[1 : len(anchors)] != doc[: len(anchors) - 1])
    at = np.flatnonzero(good)
    head = head[at]
    begin = at[head]
    size = np.diff(np.append(np.flatnonzero(head), len(at))) + window - 1
    anchor = anchors[begin]
    # A polynomial over the words' hashes; equal words in equal order, equal sums.
    up, down = powers(BASE, len(hashes)), powers(INVERSE, len(hashes))
    total = np.concatenate([empty, np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])])
    value = mix((total[begin + size] - total[begin]) * down[begin] + size.astype(np.uint64))
    # How often a segment holds its anchor.  A place lies in the last segment that begins
    # before it and in earlier ones until one ends before it.
    live = np.arange(len(runs))
    near = np.searchsorted(begin, live, side="right") - 1
    again = np.zeros(len(begin), np.int64)
    while len(live):
        inside = (near >= 0) & (live + short <= (begin + size)[near])
        live, near = live[inside], near[inside]
        np.add.at(again, near[runs[live] == anchor[near]], 1)
        near = near - 1
    return anchor, value, begin, size, again > 1


def automaton_spans(
    texts: list[list[int]], window: int
) -> list[list[tuple[int, int]]]:
    """For each text the maximal spans covered by windows that end in two or more places.

    One suffix automaton of all texts, with the number of end places of each state, through
    which each text is streamed.
    """
    step: list[dict[int, int]] = [{}]
    link, length, ends = [-1], [0], [0]
    for text in texts:
        last = 0
        for c in text:
            known = step[last].get(c)
            if known is not None and length[known] == length[last] + 1:
                last = known
            else:
                p = last
                if known is None:
                    now = len(step)
                    step.append({})
                    length.append(length[last] + 1)
                    link.append(0)
                    ends.append(0)
                    while p >= 0 and c not in step[p]:
                        step[p][c] = now
                        p = link[p]
                    q = step[p][c] if p >= 0 else 0
                else:
                    now, q = -1, known
                if p >= 0:
                    if length[q] == length[p] + 1:
                        link[now] = q
                    else:
                        clone = len(step)
                        step.append(dict(step[q]))
                        length.append(length[p] + 1)
                        link.append(link[q])
                        ends.append(0)
                        while p >= 0 and step[p].get(c) == q:
                            step[p][c] = clone
                            p = link[p]
                        link[q] = clone
                        if now >= 0:
                            link[now] = clone
                        else:
                            now = clone
                last = now
            ends[last] += 1
    order = sorted(range(1, len(step)), key=length.__getitem__)
    for s in reversed(order):
        if link[s] > 0:
            ends[link[s]] += ends[s]
    longest = [0] * len(step)
    for s in order:
        longest[s] = length[s] if ends[s] > 1 else longest[link[s]]
    out = []
    for text in texts:
        spans: list[tuple[int, int]] = []
        state = 0
        for i, c in enumerate(text):
            state = step[state][c]
            reach = i + 1 if ends[state] > 1 else longest[state]
            if reach >= window:
                begin = i + 1 - reach
                if spans and begin <= spans[-1][1]:
                    spans[-1] = (min(begin, spans[-1][0]), i + 1)
                else:
                    spans.append((begin, i + 1))
        out.append(spans)
    return out


def runs_of(keyed: DataFrame, window: int) -> DataFrame:
    """``anchor, segment, ka, kb, start, size, again`` of every segment of every text."""
    kept = keyed.select("text", "ka", "kb")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                cut = cut_words(piece.column(0), SPACES)
                anchor, value, begin, size, again = segments(word_hashes(cut), cut.first, window)
                doc = np.searchsorted(cut.first, begin, side="right") - 1
                owner = pa.array(doc)
                columns = [
                    pa.array(anchor.view(np.int64)),
                    pa.array(value.view(np.int64)),
                    piece.column(1).take(owner),
                    piece.column(2).take(owner),
                    pa.array((begin - cut.first[doc]).astype(np.int32)),
                    pa.array(size.astype(np.int32)),
                    pa.array(again),
                ]
                names = ["anchor", "segment", "ka", "kb", "start", "size", "again"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(
        kept,
        run,
        "anchor long, segment long, ka long, kb long, start int, size int, again boolean",
    )


def words_of(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``anchor, segment, crowded, words``: the word hashes of each wanted segment, once.

    wanted: ``ka, kb, parts`` with the anchor, hash, start and size of segments of a text, and
    whether the anchor is crowded.
    """
    joined = keyed.join(wanted, ["ka", "kb"]).select("text", "parts", "ka", "kb", "key")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                cut = cut_words(piece.column(0), SPACES)
                hashes = word_hashes(cut)
                anchors, values, crowds, words = [], [], [], []
                for first, parts in zip(
                    cut.first[:-1].tolist(), piece.column(1).to_pylist(), strict=True
                ):
                    for p in parts:
                        at = first + p["start"]
                        anchors.append(p["anchor"])
                        values.append(p["segment"])
                        crowds.append(p["crowded"])
                        words.append(hashes[at : at + p["size"]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors, pa.int64()),
                        pa.array(values, pa.int64()),
                        pa.array(crowds, pa.bool_()),
                        pa.array(words, pa.binary()),
                    ],
                    ["anchor", "segment", "crowded", "words"],
                )

    schema = "anchor long, segment long, crowded boolean, words binary"
    return map_batches(joined, run, schema).dropDuplicates(["anchor", "segment"])


SPAN = "anchor long, segment long, at int, n int"


def span_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    anchor, segment, at, n = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [
        pa.array(anchor, pa.int64()),
        pa.array(segment, pa.int64()),
        pa.array(at, pa.int32()),
        pa.array(n, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "segment", "at", "n"])


def shard_spans(reference: DataFrame, window: int) -> DataFrame:
    """Repeated spans of mixed segments that occur once each, from automata of shards."""
    spread = reference.repartition("anchor").sortWithinPartitions("anchor", "segment")

    def solved(shard):
        spans = automaton_spans([np.frombuffer(w, np.uint64).tolist() for *_, w in shard], window)
        return span_batch(
            [
                (anchor, segment, a, b - a)
                for (anchor, segment, _), found in zip(shard, spans, strict=True)
                for a, b in found
            ]
        )

    def run(batches):
        shard: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for anchor, segment, words in rows:
                if size >= SHARD_WORDS and shard[-1][0] != anchor:
                    yield solved(shard)
                    shard, size = [], 0
                shard.append((anchor, segment, words))
                size += len(words) // 8
        if shard:
            yield solved(shard)

    return map_batches(spread.select("anchor", "segment", "words"), run, SPAN)


def crowd_spans(reference: DataFrame, window: int) -> DataFrame:
    """Repeated spans of segments of crowded anchors, by counting their windows."""

    def run(batches):
        for batch in batches:
            out = []
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for anchor, segment, words in rows:
                hashes = np.frombuffer(words, np.uint64)
                one = window_hashes(hashes, window)
                two = window_hashes(mix(hashes + np.uint64(1)), window)
                n = len(one)
                out.append((np.full(n, anchor), np.full(n, segment), one, two, np.arange(n)))
            if out:
                anchor, segment, one, two, at = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor, pa.int64()),
                        pa.array(segment, pa.int64()),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["anchor", "segment", "wa", "wb", "at"],
                )

    schema = "anchor long, segment long, wa long, wb long, at int"
    windows = map_batches(reference.select("anchor", "segment", "words"), run, schema)
    again = windows.groupBy("wa", "wb").count().where("count > 1").select("wa", "wb")
    # Written, so that the join has a plain shuffle on either side and Spark can split the
    # places of one very common window at run time.
    again = written(again, "repeated-windows")
    hit = windows.join(again, ["wa", "wb"], "left_semi")
    return hit.select("anchor", "segment", "at", F.lit(window).alias("n"))


def marks(keyed: DataFrame, window: int) -> DataFrame:
    """``ka, kb, spans``: spans of repeated words (start and end) of each text that has any."""
    runs = runs_of(keyed, window)
    anchors = (
        runs.groupBy("anchor")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.min("segment").alias("low"),
            F.max("segment").alias("high"),
            F.max("again").alias("again"),
        )
        .where("total > 1 or again")
        .select("anchor", (F.expr("low <> high") | F.col("again")).alias("mixed"))
    )
    # Written once, exact copies as one row: what follows reads it in several ways, and the
    # texts need not be cut again.
    found = runs.drop("again").join(anchors, "anchor")
    found = found.groupBy("anchor", "segment", "ka", "kb", "start", "size", "mixed")
    hits = written(found.agg(F.count(F.lit(1)).alias("copies")), "repeated-segments")

    def spans_of(rows: DataFrame, begin, end) -> DataFrame:
        return rows.select("ka", "kb", begin.alias("start"), end.alias("end"))

    start, whole = F.col("start"), F.col("start") + F.col("size")
    pure = spans_of(hits.where("not mixed"), start, whole)
    mixed = hits.where("mixed")
    distinct = mixed.groupBy("anchor", "segment").agg(
        F.sum("copies").alias("times"),
        F.min(F.struct("ka", "kb", "start", "size")).alias("place"),
    )
    distinct = written(distinct, "distinct-segments")
    copied = distinct.where("times > 1").select("anchor", "segment")
    copies = spans_of(mixed.join(copied, ["anchor", "segment"]), start, whole)
    # One place of each distinct segment is enough to fetch its words, and the only place of
    # a segment that occurs once.
    placed = distinct.select("anchor", "segment", "times", "place.*")
    crowds = distinct.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("count"), F.sum("place.size").alias("words")
    )
    crowds = crowds.where((F.col("count") > CROWD) | (F.col("words") > CROWD_WORDS))
    crowds = written(crowds.select("anchor", F.lit(True).alias("crowded")), "crowded-anchors")
    # Numbers alone meet by anchor here; the words of a crowded one never come together.
    marked = placed.join(crowds, "anchor", "left")
    crowded = F.coalesce("crowded", F.lit(False)).alias("crowded")
    wanted = marked.groupBy("ka", "kb").agg(
        F.collect_list(F.struct("anchor", "segment", "start", "size", crowded)).alias("parts")
    )
    words = words_of(keyed, wanted)
    repeated = shard_spans(words.where("not crowded"), window)
    repeated = repeated.unionByName(crowd_spans(words.where("crowded"), window))
    lone = placed.where("times = 1").join(repeated, ["anchor", "segment"])
    at = F.col("start") + F.col("at")
    every = pure.unionByName(copies).unionByName(spans_of(lone, at, at + F.col("n")))
    return every.groupBy("ka", "kb").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``key, n_words, n_removed, kept``: each text without the words of repeated windows.

    Words are runs of bytes other than ASCII white space, unchanged; ``kept`` joins those that
    stay by one space.  Null and empty texts have no words and keep the empty text.  Windows
    are judged on the input, every row counts (also repeated rows and rows with a null key), and
    a window may repeat within its own text.
    """
    keyed = docs.select(
        F.xxhash64(F.col(text).cast("string")).alias("ka"),
        F.xxhash64(F.lit("b"), F.col(text).cast("string")).alias("kb"),
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
    )
    found = keyed.join(marks(keyed, window), ["ka", "kb"], "left").select("text", "spans", "key")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                cut = cut_words(piece.column(0), SPACES)
                raw = cut.data.tobytes()
                n, removed, kept = np.diff(cut.first), [], []
                bounds = zip(cut.first[:-1].tolist(), cut.first[1:].tolist(), strict=True)
                for (a, b), spans in zip(bounds, piece.column(1).to_pylist(), strict=True):
                    stay = np.ones(b - a, bool)
                    for span in spans or ():
                        stay[span["start"] : span["end"]] = False
                    removed.append(int(b - a - stay.sum()))
                    at = np.flatnonzero(stay) + a
                    words = zip(cut.starts[at].tolist(), cut.ends[at].tolist(), strict=True)
                    kept.append(b" ".join([raw[s:e] for s, e in words]))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(2),
                        pa.array(n, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["key", "n_words", "n_removed", "kept"],
                )

    out = map_batches(found, run, f"key {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("key", key)


def removal_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of ``remove_repeats``."""
    return remove_repeats(docs, key, text).select(
        key, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
