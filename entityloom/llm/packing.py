"""Packing texts into training sequences by order-preserving dynamic programming.

The documents of a partition, each followed by an end token, form one stream.  Windows
of at most ``size`` tokens cover it without gaps.  Cutting at a document's end is free,
cutting a document after a sentence costs ``sentence_cut`` tokens of padding, anywhere else
``hard_cut``.  The dynamic programme finds the cuts of least padding plus penalties:

    best(j) = penalty(j) - j + min over i of (best(i) + i) + windows * size + ...

where j's predecessor i is at most one window back, or two with a full window and a hard
cut between.  Each case is a minimum over a sliding range of positions, kept in a monotone
queue, so the time is linear in the number of possible cuts.

A stream is solved in stretches of ``horizon`` tokens; all windows but the last are
kept and the last one's tokens start the next stretch.  A sequence whose length is a power
of two needs no padding, so what is left at a partition's end is cut into such lengths.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.words import LOWER, PIECE_BYTES, byte_set, pieces, text_bytes
from entityloom.llm.workers import map_batches

PUNCTUATION = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
ASCII_LETTERS = byte_set((0x61, 0x7A))

CACHE_WORDS = 400_000
HORIZON = 1 << 20
SENTENCE_ENDS = frozenset(".!?")
CLOSERS = frozenset(".!?\"')")
PLAIN = re.compile("[a-zà-öø-ÿÀ-ÖØ-Þ]+")
# How byte-level vocabularies write a byte: printable ones as themselves, others from 256 up.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
HIDDEN = [b for b in range(256) if b not in PRINTABLE]
BYTE_CHARS = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(HIDDEN)}


def spread(texts: pa.Array) -> pa.Array:
    """The texts in ASCII lower case, with a space where letters and punctuation meet.

    The tokenizer lower-cases, drops white space and starts a new token where a run of
    letters ends, so its ids stay the same while far fewer words are distinct.  No space
    goes between an apostrophe and a letter, where its rule for contractions looks.
    """
    data, at = text_bytes(texts)
    low = LOWER[data]
    if not len(low):
        return pa.array([""] * len(texts), pa.string())
    letter = ASCII_LETTERS[low]
    latin = np.zeros(len(low), bool)  # the second byte of a Latin-1 letter
    latin[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] != 0x97) & (low[1:] != 0xB7)
    mark = PUNCTUATION[low]
    cut = np.zeros(len(low), bool)
    cut[1:] = (letter | latin)[:-1] & mark[1:]
    cut[1:] |= (mark & (low != 0x27))[:-1] & letter[1:]
    cut[at[at < len(low)]] = False
    places = np.flatnonzero(cut)
    wide = np.insert(low, places, 0x20)
    at = at + np.searchsorted(places, at)
    buffers = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(wide)]
    return pa.Array.from_buffers(pa.string(), len(texts), buffers)


class Encoder:
    """Token ids of whole texts, each distinct word encoded once.

    The tokenizer's rules never join tokens across ASCII white space, so a text's ids are
    those of its words in turn.  Texts that may hold a special token are encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sentence_end = np.zeros(max([end_id, *vocabulary.values()]) + 1, bool)
        for token, at in vocabulary.items():
            plain = token.removesuffix("</w>")
            ends = SENTENCE_ENDS & set(plain) and CLOSERS.issuperset(plain)
            self.sentence_end[at] = bool(ends)
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = np.array([self.end_id], np.uint32)  # code 0 is the end of a document
        self.at = np.zeros(1, np.int64)
        self.size = np.ones(1, np.int64)

    def encode_word(self, word: str) -> list[int]:
        """A word of plain letters is one unit for the model; others take every step."""
        if PLAIN.fullmatch(word):
            mapped = "".join(map(BYTE_CHARS.__getitem__, word.lower().encode()))
            return [token.id for token in self.tokenizer.model.tokenize(mapped)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        got = [self.encode_word(w) for w in words]
        self.codes.update(zip(words, range(len(self.size), len(self.size) + len(got)), strict=True))
        size = np.fromiter(map(len, got), np.int64, len(got))
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        ids = np.fromiter((i for x in got for i in x), np.uint32, int(size.sum()))
        self.flat = np.concatenate([self.flat, ids])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end tokens included, and the number of each text's."""
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            whole = [
                self.tokenizer.encode(t or "", add_special_tokens=False).ids + [self.end_id]
                for t in texts.to_pylist()
            ]
            size = np.array([len(x) for x in whole], np.int64)
            return np.array([i for x in whole for i in x], np.uint32), size
        if len(self.codes) > CACHE_WORDS:
            self.clear()
        split = pc.ascii_split_whitespace(spread(texts))
        first = split.offsets.to_numpy().astype(np.int64)
        flat = split.values[first[0] : first[-1]]
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn([w for w in words if w not in self.codes])
        lookup = np.array(list(map(self.codes.__getitem__, words)), np.int32)
        which = lookup[coded.indices.to_numpy()] if len(words) else lookup
        first -= first[0]
        which = np.insert(which, first[1:], 0)
        size = self.size[which]
        ends = np.cumsum(size)
        shift = (self.at[which] - (ends - size)).astype(np.int32)
        ids = self.flat[np.repeat(shift, size) + np.arange(ends[-1], dtype=np.int32)]
        last = ends[first[1:] + np.arange(len(texts))]
        return ids, np.diff(last, prepend=0)


def best_cuts(
    places: np.ndarray, penalties: np.ndarray, size: int, hard_cut: int
) -> list[int]:
    """Ends of windows of least cost over a stream from 0 to ``places[-1]``.

    places: where the stream may be cut, ascending; the last is its end.  Places more than a
    window apart get hard cuts between them.
    """
    gaps = np.diff(places, prepend=0)
    wide = np.flatnonzero(gaps > size)
    if len(wide):
        extra = [np.arange(places[i] - gaps[i] + size, places[i], size) for i in wide]
        more = np.concatenate(extra)
        order = np.argsort(np.concatenate([places, more]), kind="stable")
        places = np.concatenate([places, more])[order]
        penalties = np.concatenate([penalties, np.full(len(more), hard_cut)])[order]
    at = [0, *places.tolist()]
    penalty = [0, *penalties.tolist()]
    keyed = [0] * len(at)  # best(i) + i
    back = [(0, 0)] * len(at)
    near: deque[int] = deque([0])
    far: deque[int] = deque()
    waiting = 0  # the first place that has not left the near range
    for j in range(1, len(at)):
        here = at[j]
        while at[waiting] < here - size:
            value = keyed[waiting]
            while far and keyed[far[-1]] >= value:
                far.pop()
            far.append(waiting)
            if near and near[0] == waiting:
                near.popleft()
            waiting += 1
        while far and at[far[0]] < here - 2 * size:
            far.popleft()
        i = near[0]
        cost, back[j] = keyed[i] + size, (i, 0)
        if far and (other := keyed[far[0]] + 2 * size + hard_cut) < cost:
            cost, back[j] = other, (far[0], 1)
        cost += penalty[j]  # best(j) + j
        keyed[j] = cost
        while near and keyed[near[-1]] >= cost:
            near.pop()
        near.append(j)
    ends, j = [], len(at) - 1
    while j:
        i, full = back[j]
        ends.append(at[j])
        if full:
            ends.append(at[i] + size)
        j = i
    return ends[::-1]


ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this Python worker; what it has learnt serves its later tasks too."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, end_id) not in ENCODERS:
        ENCODERS[path, end_id] = Encoder(path, end_id)
    return ENCODERS[path, end_id]


class Packer:
    """Packs one partition's stream; rows come out as columns of pieces."""

    def __init__(self, encoder, size, sentence_cut, hard_cut, horizon, partition, keep_ids):
        self.encoder, self.size = encoder, size
        self.sentence_cut, self.hard_cut, self.horizon = sentence_cut, hard_cut, horizon
        self.next_id, self.keep_ids = partition << 33, keep_ids
        self.ids: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.done, self.held = 0, 0  # tokens of the first document already packed; tokens held

    def add(self, keys: pa.Array, texts: pa.Array) -> None:
        ids, sizes = self.encoder(texts)
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.keys.append(keys)
        self.held += len(ids)

    def pack(self, last: bool) -> dict | None:
        """The pieces of all windows but the stretch's last one, or of all."""
        if not self.held:
            return None
        ids = np.concatenate(self.ids)
        sizes, keys = np.concatenate(self.sizes), pa.concat_arrays(self.keys)
        ends = np.cumsum(sizes) - self.done
        begins = ends - sizes  # the first document's is negative if it has begun before
        after = np.flatnonzero(self.encoder.sentence_end[ids]) + 1
        after = after[after < len(ids)]
        after = after[ids[after] != self.encoder.end_id]  # its document ends with the next id
        places = np.concatenate([ends, after])
        costs = np.zeros(len(places), np.int64)
        costs[len(ends) :] = self.sentence_cut
        places, keep = np.unique(places, return_index=True)
        cuts = best_cuts(places, costs[keep], self.size, self.hard_cut)
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = [begin + x for x in powers(cuts[-1] - begin, self.size)]
        elif len(cuts) > 1:
            cuts.pop()
        else:
            return None
        total = cuts[-1]
        cuts = np.array(cuts, np.int64)
        edges = np.unique(np.concatenate([cuts, ends[ends < total], [0]]))
        starts, lengths = edges[:-1], np.diff(edges)
        doc = np.searchsorted(ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        opened = np.concatenate([[0], cuts])[window]
        raw = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
        bounds = (edges * 4).tolist()
        out = {
            "key": keys.take(pa.array(doc)),
            "start": starts - begins[doc],
            "length": lengths,
            "ids_crc32": np.array(
                [zlib.crc32(raw[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], np.int64
            ),
            "doc_tokens": sizes[doc],
            "sequence_id": self.next_id + window,
            "offset": starts - opened,
        }
        if self.keep_ids:
            values = pa.array(ids[:total].astype(np.int32))
            out["ids"] = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)
        self.next_id += len(cuts)
        first = int(np.searchsorted(ends, total, side="right"))
        self.ids, self.sizes = [ids[total:]], [sizes[first:]]
        self.keys, self.held = [keys.slice(first)], len(ids) - total
        self.done = int(total - begins[first]) if first < len(sizes) else 0
        return out


def powers(rest: int, size: int) -> list[int]:
    """Ends of pieces of ``rest`` tokens that need no padding: powers of two, largest first."""
    if rest == size:
        return [rest]
    ends, at = [], 0
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    end_id: int = 2,
    sentence_cut: int = 8,
    hard_cut: int = 32,
    horizon: int = HORIZON,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a sequence: ``key, start, length, ids_crc32,
    doc_tokens, sequence_id, offset`` and, if asked for, the ``ids``.

    tokenizer: path of a tokenizer file that every executor can read.  Null and empty texts
    are their end token alone; repeated rows are packed each.  No token is dropped or
    repeated.  Sequences hold at most ``size`` tokens, their offsets have no gaps, and
    sequence ids are unique.  Documents keep the order of their partition.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches):
        packer = Packer(
            encoder(tokenizer, end_id),
            size,
            sentence_cut,
            hard_cut,
            horizon,
            TaskContext.get().partitionId(),
            keep_ids,
        )

        def made(last):
            columns = packer.pack(last)
            if columns:
                yield pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for piece in pieces(batch, 1, PIECE_BYTES):
                packer.add(piece.column(0), piece.column(1))
                if packer.held >= horizon:
                    yield from made(False)
        yield from made(True)

    kept = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    packed = map_batches(kept, run, f"key {kind}, {schema}")
    return packed.withColumnRenamed("key", key)
