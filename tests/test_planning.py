"""What is known before a run: rows a chain of lookups makes, and parts of a split read."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from entityloom.operators.fanout import FanOutTooHigh, check_fan_out, fan_outs
from entityloom.operators.lookups import Lookup, widen
from entityloom.plans.customer_profile import customer_profile
from entityloom.plans.customer_queries import DERIVED, master_tables
from entityloom.plans.registry import SCHEMAS
from entityloom.sources import jdbc
from entityloom.sources.cuts import balanced_conditions
from entityloom.sources.tables import ParquetTables
from tests.conftest import DATA

TEXTS = Lookup("texts", on={"code": "code"}, take={"text": "text"}, where={"lang": "en"})


def code_tables(spark):
    base = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "q")], "id int, code string")
    texts = spark.createDataFrame(
        [("a", "A", "en"), ("a", "À", "fr"), ("b", "B", "en"), ("c", "C", "en")], "code string, text string, lang string"
    )
    parts = spark.createDataFrame([("A", i) for i in range(3)] + [("B", 0)], "of string, part int")
    return base, {"texts": texts, "parts": parts}


def test_a_lookup_in_several_languages_is_reported(spark):
    base, tables = code_tables(spark)
    assert [(f.before, f.after) for f in check_fan_out(base, tables, [TEXTS], 1)] == [(5, 5)]
    every = Lookup("texts", on={"code": "code"}, take={"text": "text"})
    with pytest.raises(FanOutTooHigh, match=r"texts \(code\): 1.4 rows for each"):
        check_fan_out(base, tables, [every], 5)


def test_later_lookups_meet_what_earlier_ones_made(spark):
    base, tables = code_tables(spark)
    every = Lookup("texts", on={"code": "code"}, take={"text": "text"})
    parts = Lookup("parts", on={"of": "text"}, take={"part": "part"}, satellite=True)
    found = fan_outs(base, tables, [every, parts])
    assert [(f.before, f.after) for f in found] == [(5, 7), (7, 11)]
    assert widen(base, tables, [every, parts]).count() == 11
    assert [f.factor for f in fan_outs(base.where("false"), tables, [every])] == [1.0]
    with pytest.raises(FanOutTooHigh, match="1.8 rows"):
        check_fan_out(base, tables, [TEXTS, parts], 1.5)


def test_the_customer_profile(spark):
    tables = master_tables(ParquetTables(spark, DATA, SCHEMAS))
    profile = customer_profile(measure=DERIVED)
    base = tables["cust_unit"].select(*profile.base_columns)
    whole = 1.0
    for one in fan_outs(base, tables, profile.lookups):
        whole *= one.factor
    rows = profile.rows(tables).count()
    assert 0.8 < whole * base.count() / rows < 1.25
    with pytest.raises(FanOutTooHigh, match="tax_exemption_type_lang"):
        profile.rows(tables, most_fan_out=1000)  # tax descriptions in every language
    assert "rows for each" in str(pytest.raises(FanOutTooHigh, profile.rows, tables, most_fan_out=1).value)


def parts_of(df, conditions):
    met = [F.expr(c).cast("int") for c in conditions]
    times = sum([F.coalesce(m, F.lit(0)) for m in met], F.lit(0))
    sizes = df.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(f"p{i}") for i, m in enumerate(met)]).first()
    assert df.where(times != 1).isEmpty()
    return list(sizes)


@pytest.mark.parametrize("kind", ["string", "long", "date", "timestamp", "decimal(9,2)"])
@pytest.mark.parametrize("sampled", [1.0, 0.3])
def test_parts_are_even_on_skewed_keys(spark, kind, sampled):
    rng = random.Random(2)
    rows = [(3 if i % 3 == 0 else rng.choice([None, 1, 2, *range(4, 400)]), i) for i in range(6000)]
    value = {"date": "date_add(date '2020-01-01', v)", "timestamp": "timestamp_seconds(v * 1000)"}
    df = spark.createDataFrame(rows, "v int, other long")
    df = df.select(F.expr(value.get(kind, f"cast(v as {kind})")).alias("v"), "other").cache()
    sizes = parts_of(df, balanced_conditions(df.sample(sampled, 1), "v", 10, "other"))
    assert sum(sizes) == 6000 and 10 <= len(sizes) <= 21
    assert max(sizes) <= 2 * 600 * (1 if sampled == 1 else 1.2)
    alone = parts_of(df, balanced_conditions(df, "v", 10))
    assert 1900 < max(alone) < 2100  # one value cannot be cut without a second column


def test_few_values_and_none(spark):
    df = spark.createDataFrame([("it's", 1), (None, 2)], "v string, o int")
    assert sum(parts_of(df, balanced_conditions(df, "v", 3, "o"))) == 2
    assert balanced_conditions(df.where("false"), "v", 3, "o") == ["1 = 1"]
    same = df.selectExpr("'a' as v", "o")
    assert sorted(parts_of(same, balanced_conditions(same, "v", 2, "o")))[-2:] == [1, 1] or len(
        balanced_conditions(same, "v", 2, "o")
    ) == 2
    with pytest.raises(TypeError, match="no cuts by"):
        balanced_conditions(df.selectExpr("o = 1 as v").union(df.selectExpr("o = 2 as v")), "v", 2)
    days = spark.createDataFrame([(datetime.date(2024, 1, i),) for i in range(1, 9)], "v date")
    assert max(parts_of(days, balanced_conditions(days, "v", 4))) == 2


def test_balanced_conditions_split_a_landed_read(spark, monkeypatch, tmp_path):
    whole = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 90)) as k", "id")
    conditions = balanced_conditions(whole, "k", 8, "id")
    sizes = []

    def fake_read(spark, source, relation, split):
        if split is None:
            return whole
        parts = [whole.where(c) for c in split]
        sizes.extend(p.count() for p in parts)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    source = jdbc.JdbcSource("d", "u")
    landed = jdbc.land_tables(
        spark, source, {"t": "t"}, {"t": conditions}, folder=str(tmp_path), check_counts=True
    )
    assert landed["t"].count() == 3000
    assert max(sizes) <= 2 * 3000 / 8


def test_cuts_are_drawn_from_the_database(spark, monkeypatch, tmp_path):
    whole = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 90)) as k", "id")
    asked, sizes = [], []

    def fake_read(spark, source, relation, split):
        asked.append((relation, split and len(split)))
        if split is None:
            return whole.sample(0.25, 5) if "tablesample" in relation else whole
        parts = [whole.where(c) for c in split]
        sizes.extend(p.count() for p in parts)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    sample = "(select k, id from t tablesample system (25)) q"
    cuts = jdbc.SampledCuts("k", 8, sample, "id")
    landed = jdbc.land_tables(
        spark, jdbc.JdbcSource("d", "u"), {"t": "t"}, {"t": cuts}, folder=str(tmp_path), check_counts=True
    )
    assert landed["t"].count() == 4000 and sum(sizes) == 4000
    assert max(sizes) <= 2.4 * 4000 / 8  # twice the mean, and the sample's error
    assert asked == [(sample, None), ("t", len(sizes)), ("t", None)]
