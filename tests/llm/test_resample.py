"""Importance resampling and the radix sort against brute-force versions."""

import random

import pytest

from entityloom.llm import resample
from entityloom.llm.radix import digits, radix_places
from tests.llm import brute

WORDS = ["one", "Two", "three", "É", "f4", "five", "six", "seven"]


def texts(seed, count, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(WORDS) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(0, most))) for _ in range(count)]


def check(spark, docs, target, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame = frame.selectExpr("*", "1 as place", "2 as digit", "3 as block", "4 as score", "5 as key")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(frame, goal, **options).drop("n_words").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.resampled(docs, target), key=repr)
    return got


def test_equals_brute_force(spark):
    docs = list(enumerate(texts(1, 200))) + [(900, None), (901, ""), (902, "?!"), (903, "one " * 3000)]
    docs += [docs[3], docs[3], (2**62, docs[5][1]), (None, "one two " * 20), (None, None)]
    assert any(r.rank for r in check(spark, docs, texts(2, 9)))


def test_negative_ids_and_many_ties(spark, monkeypatch):
    docs = [(i - 40, text) for i, text in enumerate(texts(3, 90))]
    monkeypatch.setattr(resample, "noise", lambda key, seed: key * 0)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    goal = spark.createDataFrame([("one two",)], "text string")
    rows = [r for r in resample.resampled(frame, goal, percent=60).collect() if r.n_words >= 20]
    order = sorted(rows, key=lambda r: (-r.weight, r.doc_id))
    assert [r.rank for r in order] == [i + 1 if i < len(rows) * 60 // 100 else None for i in range(len(rows))]


def test_pieces_do_not_change_features(monkeypatch):
    text = (" ".join(texts(4, 3, 200)) + "x" * 100).encode()
    for longest in (1, 2, 3):
        whole = list(resample.feature_codes(text, longest))
        with monkeypatch.context() as m:
            m.setattr(resample, "CHUNK", 16)
            cut = list(resample.feature_codes(text, longest))
        assert len(cut) > 5 and len(whole) == 1
        assert sorted(c for _, codes in cut for c in codes) == sorted(whole[0][1])
        assert sum(n for n, _ in cut) == whole[0][0]


def test_no_target_and_no_documents(spark):
    check(spark, list(enumerate(texts(5, 30))), [None, ""])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resampled(none, none).collect() == []


@pytest.mark.parametrize("digit_bits", [1, 3, 16])
@pytest.mark.parametrize("block_rows", [4, 1000])
def test_radix_sort(spark, digit_bits, block_rows):
    rng = random.Random(digit_bits)
    rows = [(rng.randrange(5), rng.choice([-1, 0, 7, rng.randrange(1 << 10)]), i) for i in range(150)]
    if digit_bits < 16:
        rows = [(a, b & 63, i) for a, b, i in rows]
    bits = 64 if digit_bits == 16 else 6
    frame = spark.createDataFrame(rows, "a long, b long, i long").repartition(4)
    got = radix_places(frame, [("a", 3), ("b", bits)], digit_bits, block_rows).collect()
    assert sorted(r.place for r in got) == list(range(len(rows)))
    in_order = [(r.a, r.b % 2**64) for r in sorted(got, key=lambda r: r.place)]
    assert in_order == sorted((a, b % 2**64) for a, b, _ in rows)


def test_digits_cover_all_bits():
    for bits in range(0, 65):
        cut = digits(bits, 16)
        assert sum(width for _, width in cut) == bits
        assert all(width <= 16 for _, width in cut)
    assert digits(0) == []
