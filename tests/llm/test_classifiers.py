"""Toxicity and quality: held-out accuracy, the learned form, defined edges."""

import random

import numpy as np
import pyarrow as pa

from entityloom.llm import quality, samples, toxicity

SF = "/root/testdata/sf0.1"


def judged(spark, scored, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r[label] for r in rows])
    good = [r.score for r in rows if r[label]]
    bad = [r.score for r in rows if not r[label]]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert all(0 <= r.score <= 1 for r in rows)
    return right, auc


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    right, auc = judged(spark, toxicity.scored(docs, labels), "toxic")
    assert right > 0.97 and auc > 0.97


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    right, auc = judged(spark, quality.scored(docs, labels), "quality")
    assert right > 0.93 and auc > 0.9


def test_pairs_are_learned_that_no_sum_can_express():
    rng, docs, labels = random.Random(0), [], []
    for _ in range(1500):
        some = [10 + rng.randrange(40) for _ in range(6)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(np.unique(some + [1] * a + [2] * b))
        labels.append(float(a == b))
    machine = toxicity.train(np.array(labels), docs)
    sizes = np.array([len(d) for d in docs])
    places = machine.place[np.concatenate(docs)]
    raw, _ = toxicity.raw_scores(places, sizes, machine)
    assert np.mean((raw > 0) == np.array(labels)) > 0.95


def test_rules_say_the_same_in_numpy_and_in_spark(spark):
    rng = np.random.default_rng(1)
    stats = rng.random((2000, len(quality.STATISTICS)))
    labels = ((stats[:, 2] > 0.5) & (stats[:, 4] <= 0.7)).astype(float)
    ensemble = quality.train(stats, labels)
    assert 0 < len(ensemble.rules) < 200
    raw = ensemble.bias + sum(w * r.holds(stats) for r, w in ensemble.rules)
    frame = spark.createDataFrame(
        [(i, *map(float, row)) for i, row in enumerate(stats[:300])],
        ["i", *quality.STATISTICS],
    )
    got = frame.select("i", ensemble.column().alias("s")).toPandas().sort_values("i")["s"]
    assert np.allclose(got, 1 / (1 + np.exp(-raw[:300])))
    assert np.mean((raw > 0) == labels) > 0.97


def test_statistics_of_edges():
    texts = pa.array([None, "", "a a b\n\na a b\n", "É!! |", "x" * 10_000], pa.string())
    rows = dict(zip(quality.STATISTICS, quality.statistics(texts), strict=True))
    assert rows["words"].to_pylist() == [0, 0, 6, 2, 1]
    assert rows["distinct"].to_pylist() == [0, 0, 2 / 6, 1, 1]
    assert rows["adjacent_repeats"].to_pylist() == [0, 0, 2 / 6, 0, 0]
    assert rows["repeated_lines"].to_pylist() == [0, 0, 0.5, 0, 0]


def test_edges_are_defined(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (None, "x"), (3, "y"), (3, "y")], "doc_id long, text string"
    ).selectExpr("*", "0 as score", "1 as words", "2 as key", "3 as label")
    labels = spark.createDataFrame(
        [(1, 1, 1), (2, None, 0), (None, 1, 1), (3, 0, 0), (3, 0, 0), (9, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        assert module.scored(docs, labels).count() == 5
        assert module.scored(docs, labels.where("false")).count() == 5
        assert module.scored(docs.where("false"), labels).count() == 0
        got = samples.labelled(docs, labels, "doc_id", label, 10)
        assert {r.key for r in got.collect()} <= {1, 2, 3}


def test_held_out_rows_are_not_learned_from(spark):
    rows = spark.range(200).select("id", samples.held_out("id", 5, 0).alias("out")).collect()
    import zlib

    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def documents_of(rule, count=8000, seed=0):
    """Slots of documents with words 1, 2, 3 by chance, and whether the rule calls them toxic."""
    rng, docs, labels = np.random.default_rng(seed), [], []
    for _ in range(count):
        some = set((rng.zipf(1.3, 120) % 20_000 + 100).tolist())
        some |= {w for w in (1, 2, 3, 50, 50) if rng.random() < 0.05}
        docs.append(np.array(sorted(some), np.int32))
        labels.append(float(rule(some, rng)))
    return np.array(labels), docs


def chance_of(machine, words):
    """The mean chance of other documents that have just these of the words."""
    _, docs = documents_of(lambda some, rng: False, count=200, seed=9)
    changed = [np.array(sorted({*d.tolist()} - {1, 2, 3, 50} | {*words}), np.int32) for d in docs]
    return float(toxicity.chances(changed, machine).mean())


def test_rare_words_that_are_toxic_only_together():
    # About 20 of 8,000 documents have both; a tenth is toxic for another reason.
    labels, docs = documents_of(lambda some, rng: {1, 2} <= some or (50 in some and not {1, 2} & some))
    machine = toxicity.train(labels, docs)
    assert chance_of(machine, [1, 2]) > 0.9 and chance_of(machine, [1]) < 0.1
    assert chance_of(machine, [2]) < 0.1 and chance_of(machine, [50]) > 0.5


def test_words_neutral_alone_that_are_toxic_together():
    # Alone each is as often toxic as any document, for no reason that could be learned.
    labels, docs = documents_of(
        lambda some, rng: {1, 2} <= some or (rng.random() < 0.1 and not {1, 2} & some)
    )
    machine = toxicity.train(labels, docs)
    assert chance_of(machine, [1, 2]) > 0.8
    assert max(chance_of(machine, s) for s in ([1], [2], [1, 3], [])) < 0.2


def test_a_word_that_takes_harm_away():
    labels, docs = documents_of(lambda some, rng: 1 in some and 3 not in some)
    machine = toxicity.train(labels, docs)
    assert chance_of(machine, [1]) > 0.8
    assert chance_of(machine, [1, 3]) < 0.3 and chance_of(machine, [3]) < 0.1


def test_raw_scores_are_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    n = 40
    machine = toxicity.Machine(
        np.arange(1 << toxicity.BITS, dtype=np.int32),
        0.3,
        rng.normal(size=n + 1),
        rng.normal(size=(n + 1, toxicity.FACTORS)),
    )
    docs = [np.sort(rng.choice(n, k, replace=False) + 1) for k in (0, 1, 2, 7, 20)]
    raw, _ = toxicity.raw_scores(np.concatenate(docs), np.array([len(d) for d in docs]), machine)
    for got, doc in zip(raw, docs, strict=True):
        want = machine.bias + sum(machine.linear[i] for i in doc)
        want += sum(machine.factors[i] @ machine.factors[j] for i in doc for j in doc if i < j)
        assert abs(got - want) < 1e-9


def test_a_text_sends_a_bounded_number_of_slots():
    slots = np.arange(0, 1000, 2)
    few, sizes = toxicity.bounded(np.concatenate([slots, slots[:5]]), np.array([500, 0, 5]), 50)
    assert sizes.tolist() == [50, 0, 5] and few[50:].tolist() == slots[:5].tolist()
    assert (np.diff(few[:50]) > 0).all() and set(few[:50]) <= set(slots)


def test_repeated_rows_and_very_long_texts(spark):
    long = "insult group " * 200_000
    docs = spark.createDataFrame([(1, long), (1, long), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        rows = module.scored(docs, labels).collect()
        assert len(rows) == 3 and len({r.score for r in rows if r.doc_id == 1}) == 1
