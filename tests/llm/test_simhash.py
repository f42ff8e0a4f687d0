"""SimHash groups against all pairs of fingerprints."""

import random

import numpy as np

from entityloom.llm import simhash
from tests.llm import brute


def clusters(seed):
    rng, out = random.Random(seed), set()
    for _ in range(6):
        now = rng.getrandbits(64)
        for _ in range(60):
            near = now
            for _ in range(rng.randint(0, 4)):
                near ^= 1 << rng.randrange(64)
            out.add(near)
            now = near if rng.random() < 0.5 else now
    return np.array(sorted(out), np.uint64)


def test_links_connect_exactly_what_is_near():
    for seed in range(10):
        fps, bits = clusters(seed), simhash.SPREAD[: seed % 5]
        buckets, sent = simhash.reached(fps, bits)
        found = set()
        for b in np.unique(buckets):
            a, c = simhash.met(sent[buckets == b], int(b), bits)
            found |= set(zip(a.tolist(), c.tolist(), strict=True))
        assert all((a ^ b).bit_count() <= 3 for a, b in found)
        keys = fps.tolist()
        near = brute.least_reachable(keys, lambda i, j: (keys[i] ^ keys[j]).bit_count() <= 3)
        linked = brute.least_reachable(
            keys, lambda i, j: (keys[i], keys[j]) in found or (keys[j], keys[i]) in found
        )
        assert near == linked


def test_groups_of_texts_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(0, 120, 4):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 200]))]
        docs.append((i, " ".join(text)))
        for k in range(1, 4):
            some = list(text)
            some[rng.randrange(len(some))] = rng.choice(words)
            docs.append((i + k, "\t".join(some).upper()))
    docs += [(200, None), (201, " \n"), (202, ""), (7, "w1 w1"), (7, "w1 w1"), (None, "w1 w1")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame = frame.selectExpr("*", "1 as fp", "'x' as component_id")
    got = simhash.simhash_groups(frame).collect()
    fps = [brute.simhash(t) for _, t in docs]
    keys = [10**9 if k is None else k for k, _ in docs]
    least = brute.least_reachable(keys, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    want = [(k, f"{f:016x}", c) for (k, _), f, c in zip(docs, fps, least, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(frame).collect() == []


def test_columns_named_as_inside_pass_unchanged(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (4, "p q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "5 as least", "6 as n", "7 as fp", "8 as component_id", "9 as times", "'f' as fingerprint"
    )
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.least, r.n, r.fp, r.times) for r in kept.collect()) == [
        (i, 5, 6, 7, 9) for i in (0, 1, 4)
    ]
