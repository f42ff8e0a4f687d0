"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads each word (letters and bytes above ASCII, ASCII lower-cased) byte by byte
from both ends and gives every byte position a probability for each language; words longer
than ``SPAN`` bytes are read in spans of whole characters, in training too.  A document's probabilities are the mean of the
logarithms over all its positions, made to sum to one.  State starts anew with each word, so equal
words have equal positions and are computed once, however often they occur; every
position of the whole text counts.

Training is backpropagation through time in numpy, on a bounded sample of labelled
documents (``SAMPLE_DOCS`` a language, ``MOST_DOCS`` in all, and of a text longer than
``SAMPLE_CHARS`` characters ``SAMPLE_PARTS`` parts spread over it, so many characters together).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.llm.samples import held_out, share_of_hash
from entityloom.llm.words import NOT_ALNUM, append_result, cut_words, free_name, word_hashes

SPAN = 16
HIDDEN = 16
SAMPLE_DOCS = 150
MOST_DOCS = 5_000
MOST_LANGUAGES = 1_000
SAMPLE_CHARS = 20_000
SAMPLE_PARTS = 8
EPOCH_WORDS = 24_000
EPOCHS = 8
BATCH = 256
CACHE_WORDS = 400_000
UNKNOWN = "und"
SEPARATORS = NOT_ALNUM.copy()
SEPARATORS[0x30:0x3A] = True  # digits say nothing about a language
LETTER = regex.compile(r"\p{L}")  # no ½, ², ① or Ⅳ


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def spans_of(word: bytes) -> list[bytes]:
    """A word in spans of at most ``SPAN`` bytes that split no UTF-8 character."""
    if len(word) <= SPAN:
        return [word]
    out, at = [], 0
    while at < len(word):
        end = at + SPAN
        while at < end < len(word) and word[end] & 0xC0 == 0x80:
            end -= 1
        end = end if end > at else at + SPAN
        out.append(word[at:end])
        at = end
    return out


class Direction:
    """One gated recurrent layer: update gate z, reset gate r, candidate c."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.inputs = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.state = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        self.hidden = hidden

    def run(self, data: np.ndarray, keep: bool = False):
        """States after each byte, (time, words, hidden); all words have the same length."""
        h, n = self.hidden, data.shape[1]
        now = np.zeros((n, h), np.float32)
        states, trace = np.empty((len(data), n, h), np.float32), []
        for t, step in enumerate(data):
            given = self.inputs[step]
            gates = sigmoid(given[:, : 2 * h] + now @ self.state[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(given[:, 2 * h :] + (r * now) @ self.state[:, 2 * h :])
            if keep:
                trace.append((now, z, r, c))
            now = now + z * (c - now)
            states[t] = now
        return states, trace

    def back(self, data, trace, grad_states):
        """Gradients of inputs and state weights, backwards through time."""
        h = self.hidden
        d_inputs, d_state = np.zeros_like(self.inputs), np.zeros_like(self.state)
        carry = np.zeros_like(grad_states[0])
        for t in range(len(data) - 1, -1, -1):
            before, z, r, c = trace[t]
            d = grad_states[t] + carry
            dc = d * z * (1 - c * c)
            dz = d * (c - before) * z * (1 - z)
            d_reset = dc @ self.state[:, 2 * h :].T
            dr = d_reset * before * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            d_state[:, : 2 * h] += before.T @ gates
            d_state[:, 2 * h :] += (r * before).T @ dc
            np.add.at(d_inputs, data[t], np.concatenate([gates, dc], axis=1))
            carry = d * (1 - z) + d_reset * r + gates @ self.state[:, : 2 * h].T
        return d_inputs, d_state


class Network:
    """Forward and backward layers and a softmax at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.layers = [Direction(rng, hidden), Direction(rng, hidden)]
        self.out = rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [w for x in self.layers for w in (x.inputs, x.state)] + [self.out, self.bias]

    def joined(self, data: np.ndarray, keep: bool = False):
        ahead, trace = self.layers[0].run(data, keep)
        behind, back_trace = self.layers[1].run(data[::-1], keep)
        return np.concatenate([ahead, behind[::-1]], axis=2), trace, back_trace

    def log_probabilities(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))

    def gradients(self, data: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        states, trace, back_trace = self.joined(data, keep=True)
        d = np.exp(self.log_probabilities(states))
        d[:, np.arange(len(label)), label] -= 1
        d /= d.shape[0] * d.shape[1]
        flat, wide = d.reshape(-1, d.shape[2]), states.reshape(-1, states.shape[2])
        d_states = (flat @ self.out.T).reshape(states.shape)
        h = self.layers[0].hidden
        first = self.layers[0].back(data, trace, d_states[:, :, :h])
        second = self.layers[1].back(data[::-1], back_trace, d_states[::-1, :, h:])
        return [*first, *second, wide.T @ flat, flat.sum(axis=0)]

    def positions(self, words: list[bytes]) -> np.ndarray:
        """Sums over the byte positions of each word's log probabilities."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        spans: dict[int, list[tuple[int, bytes]]] = {}
        for i, word in enumerate(words):
            for span in spans_of(word):
                spans.setdefault(len(span), []).append((i, span))
        for size, rows in spans.items():
            for at in range(0, len(rows), 8192):
                part = rows[at : at + 8192]
                data = np.frombuffer(b"".join(x for _, x in part), np.uint8)
                states, _, _ = self.joined(np.ascontiguousarray(data.reshape(-1, size).T))
                np.add.at(out, [i for i, _ in part], self.log_probabilities(states).sum(axis=0))
        return out


def train(words: list[tuple[bytes, int]], languages: list[str], seed: int = 7) -> Network:
    """Adam over batches of words of equal length, drawn from ``(word, language)``."""
    net, rng = Network(languages, seed=seed), np.random.default_rng(seed)
    by_length: dict[int, tuple[list[bytes], list[int]]] = {}
    for word, label in words:
        for span in spans_of(word):
            data, labels = by_length.setdefault(len(span), ([], []))
            data.append(span)
            labels.append(label)
    sets = [
        (np.frombuffer(b"".join(data), np.uint8).reshape(-1, size).T, np.array(labels))
        for size, (data, labels) in sorted(by_length.items())
    ]
    share = np.array([len(labels) for _, labels in sets], float)
    steps = EPOCHS * max(1, min(len(words), EPOCH_WORDS) // BATCH)
    means = [np.zeros_like(w) for w in net.weights()]
    squares = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        data, labels = sets[rng.choice(len(sets), p=share / share.sum())]
        pick = rng.integers(0, len(labels), BATCH)
        rate = 0.02 * (1 - 0.9 * step / steps)
        for w, g, m, s in zip(
            net.weights(), net.gradients(data[:, pick], labels[pick]), means, squares, strict=True
        ):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return net


def training_rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``text, lang`` of at most ``SAMPLE_DOCS`` documents of each of the ``MOST_LANGUAGES``
    commonest languages (fewer where there are many languages), chosen by a hash of the row.

    A first pass counts the languages; then all but a few times as many rows as are wanted are
    left out by their hash alone, before anything is shuffled.
    """
    rows = docs.select(
        F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(key), F.col(text)).alias("at"),
    ).where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    found = counts.collect()
    if not found:
        return rows.select("text", "lang").limit(0)
    each = max(1, min(SAMPLE_DOCS, MOST_DOCS // len(found)))
    shares = [x for r in found for x in (F.lit(r["lang"]), F.lit(4.0 * each / r["count"]))]
    share = F.element_at(F.create_map(*shares), F.col("lang"))
    few = rows.where(share.isNotNull() & (share_of_hash("at") < share))
    size, part = F.length("text"), SAMPLE_CHARS // SAMPLE_PARTS
    starts = [F.floor((size - part) * i / (SAMPLE_PARTS - 1)) + 1 for i in range(SAMPLE_PARTS)]
    parts = [F.col("text").substr(x.cast("int"), F.lit(part)) for x in starts]
    some = F.when(size <= SAMPLE_CHARS, F.col("text")).otherwise(F.concat_ws(" ", *parts))
    few = few.withColumn("text", some)
    few = few.dropDuplicates(["lang", "at"])  # repeated rows have one hash
    ordered = Window.partitionBy("lang").orderBy("at")
    ranked = few.withColumn("rank", F.row_number().over(ordered))
    return ranked.where(F.col("rank") <= each).select("text", "lang")


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """The network trained on a bounded sample of ``docs``; None if no row can be used.

    Learns from ``text`` and non-null ``lang``; ``key`` only chooses the sample.
    """
    rows = training_rows(docs, key, text, lang).toPandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return None
    pairs = []
    for value, group in sorted(rows.groupby("lang"), key=lambda x: x[0]):
        cut = cut_words(pa.array(group["text"].tolist(), pa.string()), SEPARATORS, lower=True)
        raw = cut.data.tobytes()
        spans = zip(cut.starts.tolist(), cut.ends.tolist(), strict=True)
        words = [x for a, b in spans for x in spans_of(raw[a:b])]
        # The same number of spans a language, so that none is likelier by its size.
        rng = np.random.default_rng(11)
        some = rng.integers(0, len(words), EPOCH_WORDS) if words else []
        pairs += [(words[i], languages.index(value)) for i in some]
    return train(pairs, languages) if pairs else None


class Reader:
    """Predicts whole texts; position sums of known words are kept, sorted by hash."""

    def __init__(self, net: Network):
        self.net = net
        self.known = np.zeros(0, np.uint64)
        self.sums = np.zeros((0, len(net.languages)), np.float32)

    def of_words(self, cut, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of position sums and, for each word, its row."""
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        at[at == len(self.known)] = 0
        new = self.known[at] != unique if len(self.known) else np.ones(len(unique), bool)
        sums = np.empty((len(unique), self.sums.shape[1]), np.float32)
        sums[~new] = self.sums[at[~new]]
        if new.any():
            raw = cut.data.tobytes()
            chosen = first[new]
            spans = zip(cut.starts[chosen].tolist(), cut.ends[chosen].tolist(), strict=True)
            sums[new] = self.net.positions([raw[a:b] for a, b in spans])
            if len(self.known) + new.sum() > CACHE_WORDS:
                self.known, self.sums = unique, sums
            else:
                every = np.concatenate([self.known, unique[new]])
                order = np.argsort(every)
                self.known = every[order]
                self.sums = np.concatenate([self.sums, sums[new]])[order]
        return sums, back

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        cut = cut_words(texts, SEPARATORS, lower=True)
        sums, row = self.of_words(cut, word_hashes(cut))
        n = len(texts)
        size = np.concatenate([[0], np.cumsum(cut.ends - cut.starts)])[cut.first]
        positions = np.diff(size)
        total = np.zeros((n, sums.shape[1]))
        doc = np.repeat(np.arange(n), np.diff(cut.first))
        for i in range(sums.shape[1]):
            total[:, i] = np.bincount(doc, sums[row, i], n)
        mean = total / np.maximum(positions, 1)[:, None]
        odds = np.exp(mean - mean.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        letters = [
            count > 0 and LETTER.search(text or "") is not None
            for count, text in zip(positions.tolist(), texts.to_pylist(), strict=True)
        ]
        lang = [
            self.net.languages[i] if good else UNKNOWN
            for i, good in zip(best.tolist(), letters, strict=True)
        ]
        score = np.where(letters, odds[np.arange(n), best], 0.0)
        return [pa.array(lang, pa.string()), pa.array(score)]


FIELDS = "lang_pred string, score double"


def unknown(texts: pa.Array) -> list[pa.Array]:
    n = len(texts)
    return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n))]


def identify(docs: DataFrame, net: Network | None, text: str = "text", name: str = "language"):
    """All columns of ``docs`` and a struct of ``lang_pred`` and ``score`` (0 to 1).

    ``und`` with score 0 where the text is null or has no letter, and everywhere if ``net``
    is None.  ``name`` gets underscores if a column has that name already.
    """
    name = free_name(name, docs.columns)

    def make():
        return unknown if net is None else Reader(net)

    typed = docs.withColumn(text, F.col(text).cast(T.StringType()))
    return append_result(typed, text, make, FIELDS, name)


def keep_identified(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sure: float = 0.0
) -> DataFrame:
    """``docs`` without rows in no language (``und``) or below the score ``sure``.

    Texts in several languages score low and are clean all the same, so by default only
    texts in no language go: null and empty ones and those without a letter.  Repeated rows stay
    or go together; a null key counts as empty text where rows are held out.
    """
    name = free_name("language", docs.columns)
    done = identify(docs, fit(docs.where(~held_out(key, 4, 2)), key, text, lang), text, name)
    kept = (F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["score"] >= sure)
    return done.where(kept).drop(name)


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """``key, held_out, lang_pred, score`` for every row; learns from rows not held out."""
    net = fit(docs.where(~held_out(key, 4, 2)), key, text, lang)
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    done = identify(rows, net, "t", "r")
    return done.select(
        F.col("k").alias(key), held_out("k", 4, 2).alias("held_out"), "r.lang_pred", "r.score"
    )
