"""Quality by a sparse ensemble of rules over a text's statistics.

Small regression trees are boosted on statistics of labelled texts; every path from a root
to a node is a rule (a conjunction of bounds on statistics).  A logistic regression with an
L1 penalty then weighs all rules at once, which leaves most of them without weight.  The
rest is compiled into one Spark column expression over the statistics.

Training uses the statistics of at most ``SAMPLE_DOCS`` labelled documents.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.samples import held_out, labelled
from entityloom.llm.words import SPACES, byte_set, cut_words, results, text_bytes, word_hashes

SAMPLE_DOCS = 20_000
TREES = 40
DEPTH = 3
LEAST_ROWS = 20
BINS = 32
PENALTY = 1e-3

UPPER = byte_set((0x41, 0x5A))
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
DIGITS = byte_set((0x30, 0x39))
SYMBOLS = byte_set((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x5B, 0x60), (0x7B, 0x7E))
SENTENCE_ENDS = byte_set((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
LINE_BREAKS = byte_set((0x0A, 0x0A))

STATISTICS = (
    "words bytes_per_word upper digits symbols bangs pipes ends distinct adjacent_repeats"
    " top_word lines words_per_line repeated_lines non_ascii commas_per_end"
).split()


def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def distinct_and_top(hashes: np.ndarray, first: np.ndarray):
    """For each text: distinct words, and how often the commonest one occurs."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort([hashes, doc])
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    begins = np.flatnonzero(new)
    run = np.diff(np.append(begins, len(d)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, d[begins], run)
    return np.bincount(d[begins], minlength=n), top


def statistics(texts: pa.Array) -> list[pa.Array]:
    """The statistics of each text; shares of nothing are zero."""
    data, at = text_bytes(texts)
    size = np.diff(at)
    cut = cut_words(texts, SPACES)
    n_words = np.diff(cut.first)
    hashes = word_hashes(cut)
    repeats = np.zeros(len(hashes), bool)
    repeats[1:] = hashes[1:] == hashes[:-1]
    heads = cut.first[:-1][n_words > 0]
    repeats[heads] = False
    distinct, top = distinct_and_top(hashes, cut.first)
    lines = cut_words(texts, LINE_BREAKS)
    n_lines = np.diff(lines.first)
    distinct_lines, _ = distinct_and_top(word_hashes(lines), lines.first)
    letters, ends = per_text(LETTERS[data], at), per_text(SENTENCE_ENDS[data], at)

    def share(part, whole):
        return part / np.maximum(whole, 1)

    values = [
        n_words,
        share(size, n_words),
        share(per_text(UPPER[data], at), letters),
        share(per_text(DIGITS[data], at), size),
        share(per_text(SYMBOLS[data], at), size),
        share(per_text(data == 0x21, at), n_words),
        share(per_text(data == 0x7C, at), n_words),
        share(ends, n_words),
        share(distinct, n_words),
        share(np.diff(np.concatenate([[0], np.cumsum(repeats)])[cut.first]), n_words),
        share(top, n_words),
        n_lines,
        share(n_words, n_lines),
        share(n_lines - distinct_lines, n_lines),
        share(per_text(data >= 0x80, at), size),
        share(per_text(data == 0x2C, at), ends),
    ]
    return [pa.array(np.asarray(v, np.float64)) for v in values]


class Rule(NamedTuple):
    """Bounds (statistic, above: > or <=, value) that all hold."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, rows: np.ndarray) -> np.ndarray:
        out = np.ones(len(rows), bool)
        for stat, above, value in self.bounds:
            out &= (rows[:, stat] > value) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for stat, above, value in self.bounds:
            side = F.col(STATISTICS[stat])
            out = out & (side > F.lit(value) if above else side <= F.lit(value))
        return out


def grow(rows, codes, edges, target, bounds=(), depth=0):
    """Leaves of a least-squares tree as (rule, row numbers), and the rules of all nodes."""
    nodes = [Rule(bounds)] if bounds else []
    best = None
    if depth < DEPTH and len(rows) >= 2 * LEAST_ROWS:
        total, n = target[rows].sum(), len(rows)
        for stat in range(codes.shape[1]):
            count = np.cumsum(np.bincount(codes[rows, stat], minlength=BINS))
            part = np.cumsum(np.bincount(codes[rows, stat], target[rows], BINS))
            good = (count >= LEAST_ROWS) & (n - count >= LEAST_ROWS)
            gain = np.where(
                good, part**2 / np.maximum(count, 1) + (total - part) ** 2 / np.maximum(n - count, 1), -1
            )
            at = int(gain.argmax())
            if gain[at] > total**2 / n + 1e-9 and (best is None or gain[at] > best[0]):
                best = (gain[at], stat, at)
    if best is None:
        return [(Rule(bounds), rows)], nodes
    _, stat, at = best
    value = float(edges[stat][at])
    low = codes[rows, stat] <= at
    leaves = []
    for side, above in ((low, False), (~low, True)):
        below, rules = grow(
            rows[side], codes, edges, target, (*bounds, (stat, above, value)), depth + 1
        )
        leaves += below
        nodes += rules
    return leaves, nodes


def boosted_rules(stats: np.ndarray, labels: np.ndarray, seed: int = 5) -> list[Rule]:
    """The rules of all nodes of ``TREES`` boosted trees, each once."""
    rng = np.random.default_rng(seed)
    edges = []
    codes = np.zeros(stats.shape, np.int64)
    for i in range(stats.shape[1]):
        cut = np.unique(np.quantile(stats[:, i], np.linspace(0, 1, BINS)[1:-1]))
        edges.append(np.append(cut, np.full(BINS - len(cut), np.inf)))
        codes[:, i] = np.searchsorted(cut, stats[:, i], side="left")
    raw = np.zeros(len(labels))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        rows = np.flatnonzero(rng.random(len(labels)) < 0.5)
        wrong = labels - 1 / (1 + np.exp(-raw))
        leaves, nodes = grow(rows, codes, edges, wrong)
        rules.update(dict.fromkeys(nodes))
        for rule, members in leaves:
            if len(members):
                chance = 1 / (1 + np.exp(-raw[members]))
                step = wrong[members].sum() / max((chance * (1 - chance)).sum(), 1e-6)
                raw[rule.holds(stats)] += 0.3 * float(np.clip(step, -4, 4))
    return [r for r in rules if all(np.isfinite(b[2]) for b in r.bounds)]


def lasso(matrix: np.ndarray, labels: np.ndarray, penalty: float = PENALTY, steps: int = 400):
    """Bias and weights of an L1 logistic regression, by accelerated proximal steps."""
    n, m = matrix.shape
    top = np.ones(m)
    for _ in range(20):  # the largest eigenvalue bounds the step
        top = matrix.T @ (matrix @ top)
        size = np.linalg.norm(top)
        top /= max(size, 1e-12)
    scale = 4.0 / (1.1 * size / n + 1)
    weights, bias = np.zeros(m), 0.0
    ahead, ahead_bias, t = weights.copy(), bias, 1.0
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-np.clip(matrix @ ahead + ahead_bias, -30, 30))) - labels
        step = ahead - scale * (matrix.T @ wrong) / n
        new = np.sign(step) * np.maximum(np.abs(step) - scale * penalty, 0)
        new_bias = ahead_bias - scale * wrong.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / after * (new - weights)
        ahead_bias = new_bias + (t - 1) / after * (new_bias - bias)
        weights, bias, t = new, new_bias, after
    return float(bias), weights


class Ensemble(NamedTuple):
    bias: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The chance of good quality, over columns named as the statistics."""
        raw = F.lit(self.bias)
        for rule, weight in self.rules:
            raw = raw + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-raw))


def train(stats: np.ndarray, labels: np.ndarray) -> Ensemble:
    rules = boosted_rules(stats, labels)
    if not rules:
        mean = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
        return Ensemble(float(np.log(mean / (1 - mean))), [])
    matrix = np.stack([r.holds(stats) for r in rules], axis=1).astype(float)
    # Of rules that hold for the same texts the first stays.
    _, keep = np.unique(matrix, axis=1, return_index=True)
    keep.sort()
    rules, matrix = [rules[i] for i in keep], np.ascontiguousarray(matrix[:, keep])
    bias, weights = lasso(matrix, labels)
    return Ensemble(bias, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])


FIELDS = ", ".join(f"{name} double" for name in STATISTICS)


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics of each whole text; null counts as empty."""
    return results(docs, key, text, lambda: statistics, FIELDS)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality"):
    """An ensemble from labelled documents; without any, one that scores 0.5."""
    rows = labelled(docs, labels, key, label, SAMPLE_DOCS)
    marked = rows.select(F.struct("key", "label").alias("key"), "text")
    got = text_statistics(marked, "key", "text").select("key.*", *STATISTICS).toPandas()
    if got.empty:
        return Ensemble(0.0, [])
    got = got.sort_values("key")
    return train(got[STATISTICS].to_numpy(), got["label"].to_numpy().astype(float))


def scores(docs: DataFrame, ensemble: Ensemble, key: str = "doc_id", text: str = "text"):
    """``key, score`` for every row; empty texts are judged by their statistics, all zero."""
    stats = text_statistics(docs.select(F.col(key).alias("k_"), F.col(text).alias("t_")), "k_", "t_")
    return stats.select(F.col("k_").alias(key), ensemble.column().alias("score"))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"):
    """``key, held_out, score, predicted`` of every row; learns from labels that are not held out.

    Null and empty texts have the statistics of a text without words and get their score; repeated
    rows get the same one each; a null key counts as empty text where rows are held out.
    """
    ensemble = fit(docs, labels.where(~held_out(key, 5, 0)), key)
    return scores(docs, ensemble, key, text).select(
        key,
        held_out(key, 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
