"""Exact dedup against a brute-force version."""

import random

import pytest
from pyspark.sql import functions as F

from entityloom.llm.exact import exact_groups, without_copies
from tests.llm import brute


def corpus():
    rng = random.Random(5)
    parts = ["".join(rng.choice("ab é𝄞") for _ in range(rng.randint(0, 9))) for _ in range(8)]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(120)]
    docs += [(200 + i, " ".join(text)) for i, (_, text) in enumerate(docs[:40])]
    docs += [(300, None), (301, ""), (302, " \t\n"), (303, "ab" * 5000), (304, "ab" * 5000 + "a")]
    docs += [(305, " " + "ab" * 5000), docs[3], docs[3], (None, docs[4][1]), (None, None)]
    docs += [(-7, docs[9][1]), (306, "x\x0by\x0cz\r"), (307, "xyz"), (308, "xy z")]
    return docs


def poor(block):
    """A hash by which very different blocks travel together."""
    return F.length(block).cast("bigint") % 3


@pytest.mark.parametrize("route", [F.xxhash64, poor])
@pytest.mark.parametrize("block", [3, 64, 4096])
def test_equals_brute_force(spark, block, route):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame = frame.selectExpr("*", "1 as row", "2 as name", "3 as level", "4 as key", "5 as chars", "6 as t")
    got = exact_groups(frame, block=block, route=route).collect()
    rows = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got]
    assert sorted(rows, key=repr) == sorted(brute.exact_groups(docs), key=repr)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert exact_groups(frame).collect() == []
    assert without_copies(frame).collect() == []


def test_rows_that_stay_keep_their_columns(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, f"s{i}") for i, d in enumerate(docs)], "doc_id long, text string, mark string")
    got = without_copies(frame).collect()
    assert {tuple(r) for r in got} <= {(*d, f"s{i}") for i, d in enumerate(docs)}
    keeps = {(r[1], r[3]) for r in brute.exact_groups(docs)}
    assert sorted((r.doc_id for r in got), key=repr) == sorted((k for k, _ in keeps), key=repr)


@pytest.mark.parametrize("block", [4096, 65_536])
def test_very_long_texts(spark, block):
    long = "é𝄞 abc\n" * 400_000
    rows = [(1, long), (2, long + "x"), (3, long.replace("\n", " ")), (4, "y" + long[1:])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(frame, block=block).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}
