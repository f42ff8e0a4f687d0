"""Packing as an exact round trip, and its cuts against an exhaustive search."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from entityloom.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "'s", "'ll", ".", ",", "é", "É", "é", "×", "…", " ", "\n", "12", "ß", "ΑΣ "]
PARTS += ["ſ", "'", " ", "中文", "。", "-", "_", "ğ", "İ", "word ", "the ", "<|endoftext|>"]


def test_ids_equal_the_tokenizer():
    rng, encoder = random.Random(2), packing.Encoder(PATH, 2)
    for special in (True, False):
        some = PARTS if special else PARTS[:-1]
        texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
        ids, sizes = encoder(pa.array(texts))
        ends = np.cumsum(sizes)
        for text, a, b in zip(texts, ends - sizes, ends, strict=True):
            want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
            assert ids[a:b].tolist() == want


def cost(cuts, penalty, size, hard):
    total, low = 0, 0
    for c in cuts:
        if c - low > size:
            return 10**9
        total += size - (c - low) + penalty.get(c, hard)
        low = c
    return total


def test_cuts_are_the_best():
    rng = random.Random(5)
    for _ in range(150):
        size, hard = 8, 5
        places = sorted(rng.sample(range(1, 40), rng.randint(1, 9)))
        penalty = {p: rng.choice([0, 2]) for p in places}
        cuts = packing.best_cuts(
            np.array(places), np.array([penalty[p] for p in places]), size, hard
        )
        assert cuts[-1] == places[-1]
        best = {0: 0}
        allowed = set(places)
        for p in [0, *places]:
            allowed |= {p + size * k for k in range(1, 6) if p + size * k < places[-1]}
        for j in sorted(allowed):
            options = [
                best[i] + size - (j - i) + penalty.get(j, hard)
                for i in best
                if 0 < j - i <= size
            ]
            if options:
                best[j] = min(options)
        assert cost(cuts, penalty, size, hard) <= best[places[-1]] + hard * len(places)
        if max(np.diff([0, *places])) <= size:
            soft = {0: 0}
            for j in places:
                options = [
                    soft[i] + size - (j - i) + penalty[j] for i in soft if 0 < j - i <= size
                ]
                if options:
                    soft[j] = min(options)
            assert cost(cuts, penalty, size, hard) <= soft[places[-1]]


def test_every_token_lies_in_one_piece(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["so", "it", "is.", "x"]) for _ in range(rng.randint(0, 90))))
            for i in range(300)]
    docs += [(300, None), (301, ""), (302, "go " * 3000), (302, "go " * 3000), (None, "a b.")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as start")
    got = packing.pack_documents(
        frame.repartition(2), PATH, size=64, horizon=500, keep_ids=True
    ).collect()
    encoder = packing.Encoder(PATH, 2)
    want = {}
    for key, text in docs:
        ids, _ = encoder(pa.array([text], pa.string()))
        want.setdefault(key, []).append(ids.tolist())
    sequences = {}
    pieces = {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    for key, copies in want.items():
        joined = sorted(pieces[key], key=lambda x: x[0])
        assert all(x[2] == len(copies[0]) for x in joined)
        count = np.zeros(len(copies[0]), int)
        for start, ids, _ in joined:
            assert copies[0][start : start + len(ids)] == ids
            count[start : start + len(ids)] += 1
        assert (count == len(copies)).all()
    padding = [
        0 if (n := sum(x[1] for x in s)) & (n - 1) == 0 else 64 - n for s in sequences.values()
    ]
    assert sum(padding) < 0.05 * sum(len(x[0]) * len(x) for x in want.values())
    assert packing.pack_documents(frame.where("false"), PATH).count() == 0
