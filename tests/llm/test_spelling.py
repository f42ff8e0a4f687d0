"""Spelling variants and tries against brute-force versions."""

import random
import re
import zlib
from collections import Counter

import pytest

from entityloom.llm import spelling, tries
from tests.llm import brute


def vocabulary(seed, letters, count):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(count)}
    return {w: rng.choice([3, 3, 4, 6, 8, 9, 20, 50]) for w in words}


@pytest.mark.parametrize(("letters", "count"), [("ab", 90), ("abcé", 250), ("abcdefghijklmnop", 250)])
def test_equals_brute_force(spark, letters, count):
    counts = vocabulary(len(letters), letters, count)
    counts |= {"z" * 3000: 4, "z" * 2999: 9, "z" * 1500 + "y" + "z" * 1499: 3, "ba" * 700: 5}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling.spelling_variants(frame).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.spelling(counts), key=repr)


def test_nodes_are_prefixes(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="23")
    counts = vocabulary(1, "abc", 120)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = tries.trie_nodes(frame).collect()
    by_prefix, by_node = {}, {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for depth, node in enumerate(r.nodes):
            by_prefix.setdefault(r.word[:depth], set()).add(node)
            by_node.setdefault(node, set()).add(r.word[:depth])
    assert all(len(x) == 1 for x in [*by_prefix.values(), *by_node.values()])
    assert [r.word for r in sorted(rows, key=lambda r: r.place)] == sorted(counts)
    assert len({r.place >> tries.PART_BITS for r in rows}) > 3


def test_long_chains_end_at_the_root(spark):
    words = ["a" * (5 + i) for i in range(20)]
    counts = {w: 3 * 2**i for i, w in enumerate(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: r.root for r in spelling.spelling_variants(frame).collect()}
    assert set(got.values()) == {words[-1]}


def test_counts_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 50)
    monkeypatch.setattr(spelling, "MOST_HELD", 5)
    rng = random.Random(4)
    words = ["Alpha", "béta", "gamma×", "DELTA", "Épsilon", "zetaß", "ab", "ŁETA", "eta1theta", "x" * 300]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    docs += [(60, None), (61, ""), docs[0], (None, "Alpha Alpha"), (62, "-" * 500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as k")
    want = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    got = spelling.word_counts(frame.repartition(3), damage=7).collect()
    assert {r.word: r.n for r in got} == want
    assert len(got) == len(want)
    # Pieces end between letters, so this must not depend on them.
    monkeypatch.setattr(spelling, "CHUNK", 1 << 20)
    assert sorted(got) == sorted(spelling.word_counts(frame, damage=7).collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.word_counts(docs)
    assert spelling.spelling_variants(words).collect() == []
    with pytest.raises(ValueError, match="factor"):
        spelling.spelling_variants(words, factor=1)
