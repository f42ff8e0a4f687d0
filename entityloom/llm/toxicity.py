"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms (words of letters and digits, ASCII lower-cased, their
first ``PREFIXES`` bytes, which stand for all forms of a stem, and pairs of neighbouring
words), each hashed into one of ``2 ** BITS`` slots.  The machine adds a
bias, a weight for each slot and, for each pair of slots, the product of their factors, so it
learns pairs whose meaning differs from the sum of their parts:

    score = b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)

Slots get weights as they are found to matter, in training alone: first those whose documents
are toxic more or less often than others by ``LEAST_Z`` standard errors, and those in
``LEAST_SHARE`` of all training documents; then, where the fitted machine is wrong, those whose
documents it misjudges by as much, and the two slots of every pair whose joint documents it
misjudges by ``LEAST_PAIR_Z``, so that terms that mean something only together are found however
neutral each is.  (Weights for all slots, held back by decay alone, were tried: they fit the
training documents' noise.)  Slots in fewer than ``LEAST_DOCS`` documents have none.  Training is mini-batch Adam in numpy on at most ``SAMPLE_DOCS`` labelled
documents, of which only the slots, ``DOC_SLOTS`` of a text at most, travel to the driver.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.samples import held_out, labelled
from entityloom.llm.words import (
    NOT_ALNUM,
    Words,
    cut_words,
    pieces,
    results,
    window_hashes,
    word_hashes,
)
from entityloom.llm.workers import map_batches

BITS = 20
PREFIXES = (4, 5, 6)
FACTORS = 6
SAMPLE_DOCS = 8_000
LEAST_DOCS = 4
LEAST_Z = 5.0
LEAST_SHARE = 0.25
LEAST_PAIR_Z = 8.0
LEAST_JOINT = 8
PAIR_SLOTS = 1_500
CANDIDATE_PAIRS = 5_000
PAIRS = 200
ROUNDS = 3
DOC_SLOTS = 16_384
EPOCHS = 20
BATCH = 64


class Machine(NamedTuple):
    """Slots' places in the weights (0: none) and the weights."""

    place: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every term of every text, and the number of its text."""
    cut = cut_words(texts, NOT_ALNUM, lower=True)
    hashes = word_hashes(cut)
    doc = np.repeat(np.arange(len(texts)), np.diff(cut.first))
    found, owner = [hashes], [doc]
    same = doc[1:] == doc[:-1]
    found.append(window_hashes(hashes, 2)[same])
    owner.append(doc[1:][same])
    size = cut.ends - cut.starts
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        heads = Words(cut.data, cut.starts[long], cut.starts[long] + n, cut.first)
        found.append(word_hashes(heads, seed=n))
        owner.append(doc[long])
    every = np.concatenate(found) >> np.uint64(64 - BITS)
    return every.astype(np.int64), np.concatenate(owner)


def distinct(found: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each of ``n`` texts, one text after the other, and how many."""
    key = np.unique((owner << BITS) | found)
    return key & ((1 << BITS) - 1), np.bincount(key >> BITS, minlength=n)


def spread(slots: np.ndarray) -> np.ndarray:
    """Numbers by which slots are chosen without regard to their place."""
    return slots.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def bounded(slots: np.ndarray, sizes: np.ndarray, most: int | None = None):
    """``distinct``'s result with at most ``most`` slots of a text, those of the smallest hash."""
    most, ends, kept = most or DOC_SLOTS, np.cumsum(sizes), []
    for begin, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        some = slots[begin:end]
        if len(some) > most:
            some = np.sort(some[np.argsort(spread(some), kind="stable")[:most]])
        kept.append(some)
    return np.concatenate([*kept, slots[:0]]), np.minimum(sizes, most)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows, ``sizes`` of them each."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def raw_scores(places: np.ndarray, sizes: np.ndarray, machine: Machine):
    """Scores before the logistic, and the sums of factors."""
    linear = sums(machine.linear[places], sizes)
    factors = machine.factors[places]
    total = sums(factors, sizes)
    pairs = 0.5 * (total**2 - sums(factors**2, sizes)).sum(axis=1)
    return machine.bias + linear + pairs, total


def odds_apart(labels: np.ndarray, docs: list[np.ndarray], chance: np.ndarray):
    """For each slot its documents, and by how many standard errors they are more often toxic
    than their ``chance``."""
    every, sizes = np.concatenate([*docs, np.zeros(0, np.int64)]), [len(d) for d in docs]
    seen = np.bincount(every, minlength=1 << BITS)
    more = np.bincount(every, np.repeat(labels - chance, sizes), 1 << BITS)
    spread = np.bincount(every, np.repeat(np.maximum(chance * (1 - chance), 0.01), sizes), 1 << BITS)
    return seen, more / np.sqrt(np.maximum(spread, 1e-9))


def _pairs(slots: np.ndarray) -> np.ndarray:
    """All pairs of a document's slots, the smaller first, as one number each."""
    i, j = np.triu_indices(len(slots), 1)
    return (slots[i].astype(np.int64) << BITS) | slots[j]


def telling_pairs(
    labels: np.ndarray, docs: list[np.ndarray], chance: np.ndarray, seen: np.ndarray
) -> list[tuple[int, int, float]]:
    """Pairs of slots whose joint documents the chances get wrong, and by how much, the worst first.

    Of documents judged wrongly, and there of rarer slots (a common one says with another what
    the other says alone), at most ``PAIR_SLOTS`` chosen by hash, all pairs are counted; those
    in ``LEAST_JOINT`` of them are then held against all documents.
    """
    rare = (seen >= LEAST_DOCS) & (seen < LEAST_SHARE * len(docs))
    first: dict[bytes, int] = {}
    for i, d in enumerate(docs):
        first.setdefault(d.tobytes(), i)  # a copy says nothing new
    alone = sorted(first.values())
    wrong = [i for i in alone if abs(labels[i] - chance[i]) > 0.5]
    codes = []
    for i in wrong:
        some = docs[i][rare[docs[i]]].astype(np.int64)
        if len(some) > PAIR_SLOTS:
            some = np.sort(some[np.argsort(spread(some), kind="stable")[:PAIR_SLOTS]])
        codes.append(some)
    found = np.zeros(1 << 24, np.int32)
    for some in codes:
        np.add.at(found, _pairs(some) * 0x5851F42D % ((1 << 61) - 1) & 0xFFFFFF, 1)
    often: list[np.ndarray] = []
    for some in codes:
        every = _pairs(some)
        often.append(every[found[every * 0x5851F42D % ((1 << 61) - 1) & 0xFFFFFF] >= LEAST_JOINT])
    keys, times = np.unique(np.concatenate([*often, np.zeros(0, np.int64)]), return_counts=True)
    keys, times = keys[times >= LEAST_JOINT], times[times >= LEAST_JOINT]
    a, b = keys >> BITS, keys & ((1 << BITS) - 1)
    # Those that meet most beyond what their slots' own numbers explain.
    usual = len(wrong) * np.minimum(seen[a], seen[b]) / len(docs)
    keys = np.sort(keys[np.argsort(usual - times, kind="stable")[:CANDIDATE_PAIRS]])
    if not len(keys):
        return []
    part = np.zeros(1 << BITS, bool)
    part[keys >> BITS] = part[keys & ((1 << BITS) - 1)] = True
    more, spread, joint = np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys))
    for i in alone:
        every = _pairs(docs[i][part[docs[i]]])
        at = np.searchsorted(keys, every)
        at = at[keys[np.minimum(at, len(keys) - 1)] == every]
        more[at] += labels[i] - chance[i]
        spread[at] += max(chance[i] * (1 - chance[i]), 0.01)
        joint[at] += 1
    apart = more / np.sqrt(np.maximum(spread, 1e-9))
    good = np.flatnonzero((np.abs(apart) >= LEAST_PAIR_Z) & (joint >= LEAST_JOINT))
    good = good[np.argsort(-np.abs(apart[good]), kind="stable")[:PAIRS]]
    return [(int(keys[i] >> BITS), int(keys[i] & ((1 << BITS) - 1)), float(apart[i])) for i in good]


def chances(docs: list[np.ndarray], machine: Machine) -> np.ndarray:
    known = [p[p > 0] for p in (machine.place[d] for d in docs)]
    sizes = np.array([len(p) for p in known])
    raw, _ = raw_scores(np.concatenate([*known, np.zeros(0, np.int64)]).astype(np.int64), sizes, machine)
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def train(labels: np.ndarray, docs: list[np.ndarray], seed: int = 3) -> Machine:
    """Fits a machine to documents given as arrays of distinct slots.

    It begins with the slots that tell something alone or are common.  Where its chances are
    wrong for the documents of another slot, or of two slots together, these join it, and it
    is fitted anew.
    """
    mean = np.full(len(docs), float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)))
    seen, apart = odds_apart(labels, docs, mean)
    used = (seen >= LEAST_DOCS) & ((np.abs(apart) >= LEAST_Z) | (seen >= LEAST_SHARE * len(docs)))
    pairs: list[tuple[int, int, float]] = []
    for _ in range(ROUNDS):
        machine = descend(labels, docs, used, seen, apart, pairs, seed)
        chance = chances(docs, machine)
        _, beyond = odds_apart(labels, docs, chance)
        more = (seen >= LEAST_DOCS) & (np.abs(beyond) >= LEAST_Z) & ~used
        known = {p[:2] for p in pairs}
        new = [p for p in telling_pairs(labels, docs, chance, seen) if p[:2] not in known]
        for i, j, _ in new:
            more[i], more[j] = not used[i], not used[j]
        if not more.any() and not new:
            break
        used, pairs = used | more, pairs + new
        # What tells nothing by its odds tells by what the machine missed.
        apart = np.where(more & (np.abs(beyond) >= LEAST_Z), beyond, apart)
    else:
        machine = descend(labels, docs, used, seen, apart, pairs, seed)
    return machine


def descend(
    labels: np.ndarray,
    docs: list[np.ndarray],
    slots: np.ndarray,
    seen: np.ndarray,
    apart: np.ndarray,
    pairs: list[tuple[int, int, float]],
    seed: int,
) -> Machine:
    """A machine of the given slots (true in ``slots``), by mini-batches."""
    rng = np.random.default_rng(seed)
    mean = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    used = np.flatnonzero(slots)
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    # Slots that say little alone are held back, and the others start from their odds.
    telling = np.abs(apart[used]) >= LEAST_Z
    decay = np.concatenate([[0.0], np.where(telling, 1e-4, 3e-2)])
    toxic = np.bincount(
        np.concatenate([*[d for d, label in zip(docs, labels, strict=True) if label], docs[0][:0]]),
        minlength=1 << BITS,
    )
    odds = (toxic[used] + mean) / (seen[used] - toxic[used] + 1 - mean) * (1 - mean) / mean
    start = np.concatenate([[0.0], np.where(telling, np.clip(np.log(odds) / 2, -2, 2), 0.0)])
    params = [
        np.array([np.log(mean / (1 - mean))]),
        start.copy(),
        rng.normal(0, 0.01, (len(used) + 1, FACTORS)),
    ]
    params[2][0] = 0
    # Pairs start on their way: their factors point the same way, or apart.
    hold = np.full((len(used) + 1, 1), 3e-3)
    for k, (i, j, much) in enumerate(pairs):
        hold[[place[i], place[j]]] = 1e-5
        params[2][place[i], k % FACTORS] += 0.5
        params[2][place[j], k % FACTORS] += 0.5 if much > 0 else -0.5
    known = [p[p > 0] for p in (place[d] for d in docs)]
    means = [np.zeros_like(p) for p in params]
    squares = [np.zeros_like(p) for p in params]
    step, steps = 0, EPOCHS * -(-len(docs) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            sizes = np.array([len(known[i]) for i in pick])
            places = np.concatenate([known[i] for i in pick])
            machine = Machine(place, params[0][0], params[1], params[2])
            raw, total = raw_scores(places, sizes, machine)
            wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[pick]) / len(pick)
            each = np.repeat(wrong, sizes)
            cross = each[:, None] * (np.repeat(total, sizes, axis=0) - params[2][places])
            n = len(params[1])
            grads = [
                np.array([wrong.sum()]),
                np.bincount(places, each, n) + decay * params[1],
                np.stack([np.bincount(places, cross[:, f], n) for f in range(FACTORS)], 1)
                + hold * params[2],
            ]
            step += 1
            rate = 0.03 * (1 - 0.9 * step / steps)
            for p, g, m, s in zip(params, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return Machine(
        place, float(params[0][0]), params[1].astype(np.float32), params[2].astype(np.float32)
    )


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic"):
    """A machine from labelled documents, or None if there are none."""
    rows = labelled(docs, labels, key, label, SAMPLE_DOCS)

    def run(batches):
        for batch in (p for b in batches for p in pieces(b, 2)):
            found, sizes = bounded(*distinct(*terms(batch.column("text")), batch.num_rows))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))
            columns = [batch.column("key"), batch.column("label"), lists]
            yield pa.RecordBatch.from_arrays(columns, ["key", "label", "slots"])

    kind = rows.schema["key"].dataType.simpleString()
    made = map_batches(rows, run, f"key {kind}, label int, slots array<int>")
    got = made.toArrow().sort_by("key")
    if not got.num_rows:
        return None
    lists = got["slots"].combine_chunks()
    docs_slots = [x.values.to_numpy() for x in lists]
    return train(got["label"].to_numpy().astype(float), docs_slots)


def scores(docs: DataFrame, machine: Machine | None, key: str = "doc_id", text: str = "text"):
    """``key, score``: the chance that a text is toxic, for every row.

    Null and empty texts get the bias's score; without a machine every score is 0.
    """

    def make():
        def run(texts):
            if machine is None:
                return [pa.array(np.zeros(len(texts)))]
            found, owner = terms(texts)
            known = machine.place[found] > 0
            places, sizes = distinct(machine.place[found[known]], owner[known], len(texts))
            raw, _ = raw_scores(places, sizes, machine)
            return [pa.array(1 / (1 + np.exp(-np.clip(raw, -700, 700))))]

        return run

    return results(docs, key, text, make, "score double")


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"):
    """``key, held_out, score, predicted`` of every row; learns from labels that are not held out.

    Null and empty texts get the bias's score, repeated rows the same one each; a null key counts
    as empty text where rows are held out.
    """
    machine = fit(docs, labels.where(~held_out(key, 5, 0)), key)
    return scores(docs, machine, key, text).select(
        key,
        held_out(key, 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
