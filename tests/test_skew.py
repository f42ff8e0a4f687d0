"""Hot keys: detection, and that spreading them never changes a result."""

from __future__ import annotations

import time
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityloom.operators.lookups import Lookup, widen
from entityloom.operators.skew import SALTS, find_hot_keys, spread_left_join
from entityloom.sources.tables import land
from entityloom.together import together
from tests.conftest import plan_of

KEYS = st.one_of(st.none(), st.integers(0, 4))


def salts(hot):
    """Number of salts by key."""
    rows = hot.collect() if hot is not None else []
    return {tuple(r)[:-1]: r[SALTS] for r in rows}


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def left_join(base, right):
    """Brute force: pairs with an equal, non-null key, else the base row alone."""
    out = []
    for key, tag in base:
        hits = [v for k, v in right if key is not None and k == key]
        out += [(key, tag, v) for v in hits] or [(key, tag, None)]
    return Counter(out)


@settings(
    max_examples=12, deadline=None, suppress_health_check=list(HealthCheck)
)
@given(
    base=st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=12),
    right=st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=25),
)
def test_spread_join_equals_brute_force(spark, base, right):
    b = spark.createDataFrame(base, "id int, tag int")
    r = spark.createDataFrame(right, "k int, v int")
    hot = find_hot_keys(r, ["k"], min_rows=2)
    counts = Counter(k for k, _ in right if k is not None)
    assert {k for (k,) in salts(hot)} == {k for k, n in counts.items() if n > 2}
    joined = spread_left_join(b, r, [("id", "k")], hot)
    assert joined.columns == ["id", "tag", "v"]
    assert rows(joined) == left_join(base, right)


def test_one_key_with_a_third_of_all_rows(spark):
    right = spark.range(9000).selectExpr(
        "case when id % 3 = 0 then 7 else id end as k", "id as v"
    )
    base = spark.range(100).selectExpr("id", "id as tag")
    hot = find_hot_keys(right, ["k"], min_rows=1000)
    assert salts(hot) == {(7,): 4}
    plain = spread_left_join(base, right, [("id", "k")])
    spread = spread_left_join(base, right, [("id", "k")], hot)
    assert rows(spread) == rows(plain)
    assert spread.where("id = 7").count() == 3001


def test_equal_hot_rows_spread_over_tasks(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    right = spark.range(0, 8000, 1, 8).selectExpr("7 as k", "'same' as v")
    base = spark.range(20).selectExpr("cast(id as int) as id")
    hot = find_hot_keys(right, ["k"], min_rows=1000)
    joined = spread_left_join(base, right, [("id", "k")], hot)
    sizes = joined.where("v is not null").groupBy(
        F.spark_partition_id()
    )
    assert sizes.count().count() > 2
    assert joined.where("id = 7").count() == 8000


@pytest.mark.parametrize(
    "types", ["k1 int, k2 string", "k1 date, k2 bigint", "k1 decimal(9,2), k2 smallint"]
)
def test_composite_keys(spark, types):
    t1, t2 = [part.split(" ")[1] for part in types.replace(", ", "|").split("|")]
    first = "date '2024-01-01'" if t1 == "date" else "1"
    right = spark.range(50).selectExpr(
        f"cast({first} as {t1}) k1", f"cast(id % 2 as {t2}) k2", "id as v"
    )
    base = spark.range(3).selectExpr(
        f"cast({first} as {t1}) b1", f"cast(id as {t2}) b2", "id as tag"
    )
    hot = find_hot_keys(right, ["k1", "k2"], min_rows=10)
    assert len(salts(hot)) == 2
    pairs = [("b1", "k1"), ("b2", "k2")]
    spread = spread_left_join(base, right, pairs, hot)
    assert rows(spread) == rows(spread_left_join(base, right, pairs))
    assert spread.count() == 51


@pytest.mark.parametrize(
    "base_type, right_type",
    [
        ("bigint", "smallint"),
        ("smallint", "bigint"),
        ("double", "smallint"),
        ("string", "int"),
        ("int", "string"),
        ("double", "double"),
        ("decimal(9,2)", "decimal(9,2)"),
        ("decimal(9,2)", "decimal(12,4)"),
        ("timestamp", "timestamp"),
    ],
)
def test_keys_of_other_types_lose_nothing(spark, base_type, right_type):
    def column(type_name, name, value="id"):
        if type_name == "timestamp":
            return f"timestamp_micros({value}) as {name}"
        return f"cast({value} as {type_name}) as {name}"

    right = spark.range(30).selectExpr(column(right_type, "k", "1"), "id as v")
    base = spark.createDataFrame([(1,), (2,), (None,)], "id int").selectExpr(
        column(base_type, "id")
    )
    if base_type in ("double", "bigint"):
        extra = {"double": "1.5D", "bigint": "100000L"}[base_type]
        base = base.union(spark.sql(f"select {extra}"))
    hot = find_hot_keys(right, ["k"], min_rows=10)
    spread = spread_left_join(base, right, [("id", "k")], hot)
    assert rows(spread) == rows(spread_left_join(base, right, [("id", "k")]))
    assert spread.count() == 30 + base.count() - 1


@pytest.mark.parametrize("key_type", ["string", "date", "bigint", "smallint", "double"])
def test_nothing_hot(spark, key_type):
    empty = spark.createDataFrame([], f"k {key_type}")
    nulls = spark.createDataFrame([(None,)] * 5, f"k {key_type}")
    assert find_hot_keys(empty, ["k"], min_rows=1) is None
    assert find_hot_keys(nulls, ["k"], min_rows=1) is None


@pytest.mark.parametrize("broadcast", [True, False])
def test_every_one_of_many_hot_keys_is_spread(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("entityloom.operators.skew.MAX_BROADCAST_KEYS", 10)
    right = spark.range(100_000).selectExpr("id % 5000 as k", "id as v")
    hot = find_hot_keys(right, ["k"], min_rows=10)  # each key holds 0.02 % of the rows
    assert hot.count() == 5000 and {r[SALTS] for r in hot.collect()} == {2}
    base = spark.range(6000).selectExpr("id")
    joined = spread_left_join(base, right, [("id", "k")], hot)
    assert joined.count() == 101_000
    assert joined.where("v is null").count() == 1000
    assert joined.selectExpr("sum(v)").first()[0] == sum(range(100_000))


def test_a_broadcast_satellite_is_not_scanned(spark, conf, monkeypatch):
    base = spark.range(4).selectExpr("id")
    table = spark.range(50).selectExpr("id % 3 as k", "id as v")
    spec = Lookup("t", on={"k": "id"}, take={"v": "v"}, satellite=True)
    asked = []
    monkeypatch.setattr(
        "entityloom.operators.lookups.find_hot_keys", lambda *a: asked.append(a)
    )
    widen(base, {"t": table}, [spec])
    assert not asked
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    widen(base, {"t": table}, [spec])
    assert len(asked) == 1


def test_widen_spreads_satellites(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string")
    tax = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 1)], "id string, v int")
    spec = Lookup("tax", on={"id": "id"}, take={"v": "v"}, satellite=True)
    spread = widen(base, {"tax": tax}, [spec], hot_rows=10)
    plain = widen(base, {"tax": tax}, [spec], hot_rows=None)
    assert rows(spread) == rows(plain)
    assert spread.count() == 43


def test_jobs_run_together_under_the_callers_group(spark):
    def group():
        return spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    spark.sparkContext.setJobGroup("mine", "a group")
    try:
        assert together(spark, group, lambda: 2, spark.range(3).count) == ["mine", 2, 3]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert together(spark) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)


def test_a_failure_cancels_the_other_jobs(spark):
    def endless():
        return spark.range(4).selectExpr("java_method('java.lang.Thread', 'sleep', 60000L)").collect()

    def fails():
        time.sleep(2)
        raise ZeroDivisionError

    start = time.perf_counter()
    with pytest.raises(ZeroDivisionError):
        together(spark, endless, fails)
    assert time.perf_counter() - start < 40


@pytest.mark.parametrize(
    "base_type, right_type",
    [
        ("decimal(9,2)", "decimal(12,4)"),
        ("decimal(12,4)", "decimal(9,2)"),
        ("int", "decimal(12,4)"),
        ("double", "smallint"),
        ("date", "timestamp"),
        ("timestamp", "date"),
    ],
)
def test_keys_of_other_types_are_spread(spark, base_type, right_type):
    def column(type_name, name):
        day = "date_add(date '2024-01-01', cast(id % 3 as int))"
        value = day if type_name in ("date", "timestamp") else "id % 3"
        return f"cast({value} as {type_name}) as {name}"

    right = spark.range(90).selectExpr(column(right_type, "k"), "id as v")
    base = spark.range(6).selectExpr(column(base_type, "id"), "id as tag")
    hot = find_hot_keys(right, ["k"], min_rows=10)
    spread = spread_left_join(base, right, [("id", "k")], hot)
    assert spread.columns == ["id", "tag", "v"] and dict(spread.dtypes)["id"] == base_type
    assert rows(spread) == rows(spread_left_join(base, right, [("id", "k")]))
    assert "salt" in plan_of(spread) and spread.count() == 180


def test_hot_keys_need_one_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("entityloom.operators.skew.LEAST_HOT_ROWS", 100)
    spark.range(4000).selectExpr("if(id % 2 = 0, 6, id) as k").write.parquet(f"{tmp_path}/t")
    read = []

    def landed(df, name):
        plan = plan_of(df)
        read.append(plan.count("FileScan"))
        return land(df, name)

    monkeypatch.setattr("entityloom.operators.skew.land", landed)
    hot = find_hot_keys(spark.read.parquet(f"{tmp_path}/t"), ["k"])
    assert read == [1] and salts(hot) == {(6,): 2}  # 2000 of 4000 rows, 1000 to a partition
