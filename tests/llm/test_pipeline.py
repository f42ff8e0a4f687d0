"""The pipeline: each stage against plain versions of what it must keep."""

import random

import corpus_pipeline
import __spark_entry__
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def fixture(spark):
    rng = random.Random(3)
    benchmark = [
        (r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    ]
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in base]
    rows.append((1001, rows[0][1], "en", None, 5))
    rows.append((1002, benchmark[0][1], None, "x", None))
    rows.append((1003, None, "en", None, None))
    rows.append((1004, "12 34 56 !!", "en", "x", 11))
    rows.append((1005, "write to some.one@mail.example.com or +1 (555) 555-1234 please", "en", "x", 1))
    rows.append((None, "a document without an id", "en", "x", 24))
    rows += [rows[5], rows[5]]
    rng.shuffle(rows)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema), rows, benchmark


def test_stages_keep_and_drop_what_they_should(spark):
    docs, rows, benchmark = fixture(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "simhash", "decontamination", "personal", "packing"]

    read = stages["language"](spark, docs, FOLDER)
    assert read.columns == docs.columns
    kept = [tuple(r) for r in read.collect()]
    assert sorted(kept, key=str) == sorted(
        (r for r in rows if r[1] and any(c.isalpha() for c in r[1])), key=str
    )

    lone = stages["simhash"](spark, docs, FOLDER)
    assert lone.columns == docs.columns
    keyed = [r for r in rows if r[0] is not None]
    fps = [brute.simhash(r[1]) for r in keyed]
    least = brute.least_reachable(
        [r[0] for r in keyed], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3
    )
    ids = sorted(r.doc_id for r in lone.collect() if r.doc_id is not None)
    assert ids == sorted(set(least))
    assert lone.where("doc_id is null").count() == 1

    clean = stages["decontamination"](spark, docs, FOLDER)
    assert clean.columns == docs.columns
    bad = [w[5] for w in brute.contamination([(i, r[1]) for i, r in enumerate(rows)], benchmark)]
    want = [r for r, b in zip(rows, bad, strict=True) if not b]
    assert len(want) < len(rows)
    assert sorted(map(tuple, clean.collect()), key=str) == sorted(want, key=str)

    masked = stages["personal"](spark, docs, FOLDER)
    assert masked.columns == docs.columns
    found = {r.doc_id: r for r in masked.where("doc_id >= 1000").collect()}
    assert found[1005].text == "write to <EMAIL> or <PHONE> please"
    assert found[1005].n_chars == len(found[1005].text)
    texts = {r[0]: r[1] for r in rows}
    for r in masked.collect():
        if not any(brute.personal(texts[r.doc_id]).values()):
            assert r.text == texts[r.doc_id]

    pieces = stages["packing"](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in rows}


def test_every_stage_takes_an_empty_table(spark):
    docs, _, _ = fixture(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_run_gives_one_gapless_piece_after_another(spark):
    rows = __spark_entry__.queries()["pipeline"](spark, FOLDER).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_every_stage_passes_columns_named_as_inside(spark):
    docs, _, _ = fixture(spark)
    inside = ["least", "n", "fp", "language", "masked", "r", "k", "t", "key", "n_hit", "spans", "contaminated"]
    wide = docs.selectExpr("*", *[f"'{name}' as `{name}`" for name in inside])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, FOLDER)
        assert found.columns == wide.columns, name
        assert found.count() > 0
        assert {tuple(r) for r in found.select(*inside).distinct().collect()} == {tuple(inside)}
    assert corpus_pipeline.STAGES[-1][1](spark, wide, FOLDER).count() > 0


def test_every_stage_takes_very_long_and_repeated_texts(spark):
    docs, _, _ = fixture(spark)
    rng = random.Random(8)
    words = "the of and to in house river stands old near town people water long year".split()
    long = " ".join(rng.choice(words) for _ in range(400_000)) + " "
    more = [(5000, long), (5001, long + "x y z"), (5001, long + "x y z"), (5002, long + "a@b.org")]
    frame = spark.createDataFrame(more, "doc_id long, text string")
    frame = frame.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as bigint) as n_chars")
    wide = docs.select(*frame.columns).unionByName(frame)
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, wide, FOLDER)
        counts[name] = found.where("doc_id >= 5000").select("doc_id").distinct().count()
    assert counts["language"] == counts["decontamination"] == counts["personal"] == counts["packing"] == 3
    assert counts["simhash"] == 1
