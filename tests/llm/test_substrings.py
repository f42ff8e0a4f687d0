"""Substring dedup against a brute-force version."""

import hashlib
import random

import pytest

from entityloom.llm import substrings
from tests.llm import brute


def corpus(seed, window):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É,", "a"]
    passages = [[rng.choice(words) for _ in range(rng.randint(3, 4 * window))] for _ in range(6)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                part = list(rng.choice(passages))
                if rng.random() < 0.5:
                    part[rng.randrange(len(part))] = rng.choice(words)
                text += part
            else:
                text += [rng.choice(words) for _ in range(rng.randint(1, 2 * window))]
        docs.append((i, " ".join(text)))
    docs += [(60, None), (61, ""), (62, " \n "), (63, "a " * 100), (64, "a b " * 60)]
    docs += [docs[3], docs[3], (None, docs[4][1]), (65, "a\tb\n" * 3 * window)]
    return docs


@pytest.mark.parametrize("crowd", [1000, 1])
@pytest.mark.parametrize(("anchor", "window"), [(2, 6), (6, 6), (5, 12)])
def test_equals_brute_force(spark, monkeypatch, anchor, window, crowd):
    monkeypatch.setattr(substrings, "ANCHOR", anchor)
    monkeypatch.setattr(substrings, "CROWD", crowd)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 200)
    docs = corpus(anchor, window)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame = frame.selectExpr("*", "1 as segment", "2 as start").repartition(3)
    got = substrings.remove_repeats(frame, window=window).collect()
    rows = [
        (r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in got
    ]
    want = brute.substring_dedup(docs, window)
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert any(r[2] for r in rows) and any(r[1] > r[2] for r in rows)


def test_automaton_spans_equal_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        texts = [[rng.randrange(3) for _ in range(rng.randint(0, 25))] for _ in range(4)]
        found = substrings.automaton_spans(texts, 4)
        docs = [(i, " ".join(map(str, t))) for i, t in enumerate(texts)]
        want = brute.substring_dedup(docs, 4)
        for spans, (_, _, removed, _) in zip(found, want, strict=True):
            assert sum(b - a for a, b in spans) == removed


def test_no_documents(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.removal_digest(frame).collect() == []


def test_long_runs_of_one_line_are_no_shard(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CROWD_WORDS", 500, raising=False)
    sharded, shard_spans = [], substrings.shard_spans

    def kept(reference, window):
        rows = reference.selectExpr("anchor", "length(words) div 8 as n")
        sharded.extend(rows.groupBy("anchor").sum("n").collect())
        return shard_spans(reference, window)

    monkeypatch.setattr(substrings, "shard_spans", kept)
    rng = random.Random(3)
    docs = [(i, f"{rng.random()} " + "| " * (200 + i) + f"{rng.random()} end") for i in range(12)]
    docs += [(20 + i, " ".join(["x"] * i + [f"w{j}" for j in range(60)])) for i in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = substrings.remove_repeats(frame).collect()
    rows = [
        (r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in got
    ]
    assert sorted(rows) == sorted(brute.substring_dedup(docs, substrings.WINDOW))
    assert all(n <= 500 for _, n in sharded)
