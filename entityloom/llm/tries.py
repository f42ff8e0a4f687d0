"""Numbers for the nodes of a trie of all words of a table.

The words are sorted by range.  A task goes through its words in order and keeps the path of
the last one: a word shares the nodes of its common prefix with the word before it and opens
new ones below, so each node gets one number and no prefix is ever spelled out.  A task's
first word cannot know which of its nodes an earlier task has opened; it numbers all of them,
and those on the common prefix with the task before are replaced afterwards.  For that the
first and the last word of each task come to the driver, and nothing else.
"""

from __future__ import annotations

import os.path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import written
from entityloom.llm.workers import map_batches

PART_BITS = 40  # node numbers: the task, then a count within it
BATCH_NODES = 1 << 18


def _numbered(batches):
    part = TaskContext.get().partitionId() << PART_BITS
    free, order, path, last = part, part, np.zeros(0, np.int64), ""
    words, kept, lists, room = [], [], [], 0

    def batch():
        sizes = [len(x) for x in lists]
        nodes = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(lists))
        )
        ids = [pa.array([w[i] for w in kept], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *ids, nodes], ["word", "place", "n", "nodes"]
        )

    for rows in batches:
        for word, n in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            # The empty prefix is a node too: the root.
            common = len(os.path.commonprefix((last, word))) + 1 if len(path) else 0
            new = np.arange(free, free + len(word) + 1 - common, dtype=np.int64)
            path, free, last = np.concatenate([path[:common], new]), free + len(new), word
            words.append(word)
            kept.append((order, n))
            lists.append(path)
            order, room = order + 1, room + len(path)
            if room > BATCH_NODES:
                yield batch()
                words, kept, lists, room = [], [], [], 0
    if words:
        yield batch()


def shared_paths(ends: list[tuple[int, str, str, list[int]]]) -> dict[int, np.ndarray]:
    """Of each task, the numbers that earlier tasks gave to the first nodes of its first word.

    ends: (task, first word, last word, the last word's nodes), in the order of the tasks.
    """
    out: dict[int, np.ndarray] = {}
    last, path = None, np.zeros(0, np.int64)
    for part, first, final, nodes in ends:
        if last is not None:
            out[part] = path[: len(os.path.commonprefix((last, first))) + 1]
        own = np.array(nodes, np.int64)
        at = own - (part << PART_BITS)
        old = out.get(part, path[:0])
        known = at < len(old)
        own[known] = old[at[known]]
        last, path = final, own
    return out


def trie_nodes(words: DataFrame) -> DataFrame:
    """``word, place, n, nodes``: the node of each prefix of each word, the empty one first.

    words: ``word, n``, distinct, not null, not empty.  Two words have the same number at a
    depth exactly if they begin with the same so many code points.  ``place`` rises in
    code-point order.
    """
    ranged = words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
    kind = "word string, place bigint, n bigint, nodes array<bigint>"
    rows = written(map_batches(ranged, _numbered, kind), "trie")
    part = F.shiftright("place", PART_BITS).alias("part")
    # min_by and max_by keep one word of each task; a task's words come in the order of place.
    ends = rows.groupBy(part).agg(
        F.min_by("word", "place").alias("first"),
        F.max_by("word", "place").alias("final"),
        F.max_by("nodes", "place").alias("nodes"),
    )
    old = shared_paths([tuple(r) for r in ends.orderBy("part").collect()])
    if not any(len(x) for x in old.values()):
        return rows
    parts = np.array(sorted(old), np.int64)
    counts = np.array([len(old[p]) for p in parts.tolist()], np.int64)
    begins = np.concatenate([[0], np.cumsum(counts)])
    flat = np.concatenate([old[p] for p in parts.tolist()])

    def mend(batches):
        for batch in batches:
            lists = batch.column(3)
            own = lists.flatten().to_numpy(zero_copy_only=False).copy()
            at, k = own & ((1 << PART_BITS) - 1), np.searchsorted(parts, own >> PART_BITS)
            k = np.minimum(k, len(parts) - 1)
            known = (parts[k] == own >> PART_BITS) & (at < counts[k])
            own[known] = flat[begins[k[known]] + at[known]]
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            nodes = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], nodes], batch.schema.names)

    return map_batches(rows, mend, kind)
