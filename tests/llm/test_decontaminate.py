"""Benchmark decontamination against a brute-force version."""

import random

from entityloom.llm import decontaminate
from tests.llm import brute

VOCABULARY = ["a", "bb", "The", "the", "é", "É", "x1", "zz"]


def draw(rng, longest):
    return " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, longest)))


def fixture(seed):
    rng = random.Random(seed)
    items = [(i, draw(rng, 40)) for i in range(12)] + [(3, "a bb"), (50, None), (51, "!?")]
    items += [(60, items[0][1]), (None, "the zz zz a")]
    docs = [(i, draw(rng, 120)) for i in range(60)]
    for i in range(60, 90):
        words = draw(rng, 60).split()
        words[len(words) // 2 : len(words) // 2] = (rng.choice(items)[1] or "").split()
        docs.append((i, ",\n".join(words)))
    docs += [(90, None), (91, ""), (5, docs[5][1]), (None, items[2][1]), (92, "a " * 5000)]
    return docs, items


def rows(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matched(d, b, window=5, name="m", **options)
    cols = ["doc_id", "m.n_words", decontaminate.n_hit("m"), "m.items"]
    out = found.select(*cols, decontaminate.contaminated("m"), "m.longest").collect()
    return sorted((tuple(r) for r in out), key=repr)


def test_equals_brute_force_in_one_block_and_in_many(spark):
    for seed in (1, 2):
        docs, items = fixture(seed)
        named = [x for x in items if x[0] is not None]
        want = brute.contamination(docs, items, 5)
        got = rows(spark, docs, items)
        assert rows(spark, docs, items, block_bytes=60)[0][:3] == got[0][:3]
        assert sorted((r[0], r[1], r[2], r[4]) for r in got if r[0] is not None) == sorted(
            (w[0], w[1], w[2], w[5]) for w in want if w[0] is not None
        )
        names = {r[0]: r[3] for r in got}
        for w in brute.contamination(docs, named, 5):
            assert len(names[w[0]]) == w[3]
        blocks = rows(spark, docs, items, block_bytes=60)
        assert [r[:5] for r in blocks] == [r[:5] for r in got]


def test_longest_match_has_its_place(spark):
    item = "one two three four five six seven eight"
    docs = [(1, "x one two three four five y three four five six seven eight"), (2, "nothing")]
    got = rows(spark, docs, [(9, item)])
    assert got[0][5].asDict() == {"item": "9", "item_start": 2, "doc_start": 7, "n_words": 6}
    assert got[1][5] is None


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "x"), (2, "q r s", None), (3, None, "y")], "id int, text string, match string"
    )
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    left = decontaminate.clean(docs, bench)
    assert left.columns == ["id", "text", "match"]
    assert sorted(r.id for r in left.collect()) == [2, 3]
    assert decontaminate.clean(docs, bench.where("false")).count() == 3
    assert decontaminate.clean(docs.where("false"), bench).count() == 0


def test_many_blocks_are_held_a_few_at_a_time(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(16))) for i in range(30)]
    docs = [(i, " ".join(rng.choice(items)[1].split()[:14] + [rng.choice(words)] * 3)) for i in range(20)]
    frames = [spark.createDataFrame(x, f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id"))]

    def judged(block_bytes):
        found = decontaminate.matched(*frames, block_bytes=block_bytes, name="m")
        return sorted((r.doc_id, r.m.n_words, r.m.ranges, r.m.items, r.m.longest.n_words) for r in found.collect())

    whole = judged(1 << 20)
    live, most, landed = set(), [], []
    send = type(spark.sparkContext).broadcast

    def counted(self, value):
        sent = send(self, value)
        end = sent.destroy
        live.add(id(sent))
        most.append(len(live))

        def destroy(*a):
            live.discard(id(sent))
            end(*a)

        sent.destroy = destroy
        return sent

    write = decontaminate.written
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", 3)
    monkeypatch.setattr(decontaminate, "written", lambda df, name: landed.append(name) or write(df, name))
    assert judged(100) == whole
    assert len(most) > 6 and max(most) <= 3 and landed
