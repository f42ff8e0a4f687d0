"""The store in buckets: only touched buckets are rewritten, and nothing is lost."""

from __future__ import annotations

import random

import pytest

from entityloom.operators.entities import KEY, to_long, with_key
from entityloom.operators.normalise import ABSENT, normalise
from entityloom.operators.upsert import PropertyTypeChanged, upsert_entities
from entityloom.sources.buckets import read_buckets, upsert_buckets


def things(spark, rows, schema, reads=None):
    df = spark.createDataFrame(rows, schema)
    return with_key(normalise(df, reads=reads), ["id"], "p", "K")


def shown(df):
    return sorted(map(tuple, to_long(df).collect()), key=repr)


def files(folder):
    return {
        path.relative_to(folder): path.stat().st_mtime_ns
        for path in folder.rglob("*.parquet")
    }


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    folder = tmp_path / "store"
    first = things(spark, [(f"k{i}", i) for i in range(200)], "id string, n int")
    assert upsert_buckets(str(folder), first, buckets=32) == 32
    before = files(folder)
    few = things(spark, [("k7", -7), ("new", 1)], "id string, n int")
    touched = upsert_buckets(str(folder), few)
    after = files(folder)
    changed = {path.parts[0] for path, _ in set(before.items()) ^ set(after.items())}
    assert 1 <= touched <= 2 and len(changed) == touched
    same = {p for p in before if p.parts[0] not in changed}
    assert same and all(before[p] == after[p] for p in same)
    stored = {r.id: r.n for r in read_buckets(spark, str(folder)).collect()}
    assert stored == {**{f"k{i}": i for i in range(200)}, "k7": -7, "new": 1}
    assert upsert_buckets(str(folder), few.where("false")) == 0
    assert files(folder) == after


def test_the_store_equals_upserts_of_everything(spark, tmp_path):
    folder, rng, whole = str(tmp_path / "store"), random.Random(3), None
    shapes = [("id string, n string", None), ("id string, m string", {"m": "int"}), ("id string, N string", None)]
    for step, (schema, reads) in enumerate(shapes):
        rows = [(f"k{rng.randrange(40)}", rng.choice([None, "1", "no"])) for _ in range(15)]
        one = things(spark, list(dict(rows).items()), schema, reads)
        whole = one if whole is None else upsert_entities(whole, one, KEY, collapsed=True)
        upsert_buckets(folder, one, buckets=8)
        assert shown(read_buckets(spark, folder)) == shown(whole), step
    assert {c.lower() for c in read_buckets(spark, folder).columns} == {KEY, ABSENT, "id", "n", "m"}


def test_a_changed_type_is_refused_before_anything_is_written(spark, tmp_path):
    folder = tmp_path / "store"
    upsert_buckets(str(folder), things(spark, [("a", 1)], "id string, n int"), buckets=4)
    before = files(folder)
    with pytest.raises(PropertyTypeChanged):
        upsert_buckets(str(folder), things(spark, [("a", "x")], "id string, n string"))
    assert files(folder) == before


def test_no_store(spark, tmp_path):
    with pytest.raises(ValueError, match="no store"):
        read_buckets(spark, str(tmp_path / "none"))
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="no store in buckets"):
        read_buckets(spark, str(tmp_path / "other"))


def test_a_given_schema_needs_no_footers(spark, tmp_path):
    folder = str(tmp_path / "store")
    upsert_buckets(folder, things(spark, [("a", 1), ("b", 2)], "id string, n int"), buckets=4)
    schema = spark.read.parquet(folder).schema
    assert read_buckets(spark, folder, schema).count() == 2
    assert upsert_buckets(folder, things(spark, [("a", 5)], "id string, n int"), schema=schema) == 1
    assert {r.id: r.n for r in read_buckets(spark, folder, schema).collect()} == {"a": 5, "b": 2}


@pytest.mark.parametrize("exact", ["false", "true"])
def test_names_that_differ_in_case(spark, conf, exact):
    conf(spark__sql__caseSensitive=exact)
    stored = things(spark, [("a", "1"), ("b", None)], "id string, Name string")
    incoming = things(
        spark, [("b", "7"), ("c", "x"), ("d", None)], "id string, name string", {"name": "int"}
    )
    if exact == "false":
        with pytest.raises(PropertyTypeChanged, match="name"):
            upsert_entities(stored, incoming, KEY)
        stored = things(spark, [("a", 1), ("b", None)], "id string, Name int")
    after = upsert_entities(stored, incoming, KEY)
    found = {(r.key_name, r.property): r.value_type for r in to_long(after).collect() if r.property != "id"}
    if exact == "true":
        assert found == {
            ("a", "Name"): "string", ("b", "name"): "long", ("d", "name"): "null"
        }
    else:
        assert found == {("a", "Name"): "long", ("b", "Name"): "long", ("d", "Name"): "null"}
        assert {r.id: r.Name for r in after.collect()} == {"a": 1, "b": 7, "c": None, "d": None}
