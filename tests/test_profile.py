"""The thirty-column profile on hand-made rows, and the joins it is made of."""

from __future__ import annotations

import os
from collections import defaultdict

import pytest

from entityloom.operators.lookups import (
    DuplicateLookupKey,
    Lookup,
    lookup_join,
    small_tables,
    widen,
)
from entityloom.plans.customer_job import CustomerJob
from entityloom.plans.customer_profile import customer_profile, customer_rules
from entityloom.plans.entity_job import run, store
from entityloom.operators.entities import LONG_KEY, to_long
from entityloom.sources.folder_store import STORE, stored_rows
from entityloom.sources.jdbc import JdbcSource, RowCountDiffers
from entityloom.sources.tables import drop_landed, land
from tests import master_fixture as M
from tests.conftest import plan_of

COLUMNS = """customer_id customer_name customer_status_code customer_status_desc
customer_status_date customer_store_nbr non_profit_indicator accept_orders_indicator
credit_terms_code credit_terms_desc sales_tax_exempt_id new_sales_code new_sales_desc
new_cust_override_code new_cust_override_desc company_nbr first_sale_date
tax_exemption_code tax_exemption_desc cust_reln_mgr_id customer_added_date
credit_limit_dollar_amt customer_division_id source_system_code source_system_desc
primary_ship_dc_nbr credit_risk_code credit_risk_desc customer_segment_code
customer_segment_desc""".split()


def by_customer(rows):
    found = defaultdict(list)
    for r in rows:
        found[r["customer_id"]].append(r)
    return found


@pytest.mark.parametrize("make", [M.frames, M.literal_frames])
def test_profile_rows(spark, make):
    df = customer_profile().rows(make(spark))
    assert df.columns == COLUMNS
    found = by_customer(df.collect())
    shown = {
        c: sorted(
            (
                (r.sales_tax_exempt_id, r.tax_exemption_desc, r.customer_segment_desc)
                for r in rows
            ),
            key=str,
        )
        for c, rows in found.items()
    }
    assert shown == {c: sorted(rows, key=str) for c, rows in M.EXPECTED.items()}


def test_plain_customer_has_every_value(spark):
    row = by_customer(customer_profile().rows(M.frames(spark)).collect())["000123"][0]
    assert row.asDict() == {
        "customer_id": "000123",
        "customer_name": "plain, leading zeros",
        "customer_status_code": "A",
        "customer_status_desc": "active",
        "customer_status_date": "2020-02-29",
        "customer_store_nbr": "S1",
        "non_profit_indicator": "N",
        "accept_orders_indicator": "Y",
        "credit_terms_code": "T1",
        "credit_terms_desc": "30 days",
        "sales_tax_exempt_id": "X-1",
        "new_sales_code": "N1",
        "new_sales_desc": "new sale",
        "new_cust_override_code": "O1",
        "new_cust_override_desc": "override",
        "company_nbr": 10,
        "first_sale_date": "2019-01-02",
        "tax_exemption_code": "E1",
        "tax_exemption_desc": "school",
        "cust_reln_mgr_id": "M1",
        "customer_added_date": "1999-12-31",
        "credit_limit_dollar_amt": M.Decimal("2500.50"),
        "customer_division_id": "B1",
        "source_system_code": 7,
        "source_system_desc": "web shop",
        "primary_ship_dc_nbr": 3,
        "credit_risk_code": "R1",
        "credit_risk_desc": "low",
        "customer_segment_code": 2,
        "customer_segment_desc": "restaurants",
    }


def test_misses_nulls_and_defaults(spark):
    found = by_customer(customer_profile().rows(M.frames(spark)).collect())
    for customer in ("miss", "null"):
        row = found[customer][0]
        assert {row[c] for c in COLUMNS if c.endswith("_desc")} == {None}
    assert found["fr"][0].customer_status_desc is None
    assert found["seg1"][0].customer_segment_code is None
    empty = found["empty"][0]
    assert empty.customer_status_date is None and empty.first_sale_date is None
    assert empty.customer_added_date is None
    assert empty.credit_limit_dollar_amt == 0


def test_owner_prefix_and_measured_codes(spark):
    prefixed = customer_profile(owner="acme_", measure=["credit_risk_lang", "nowhere"])
    same = customer_profile().rows(M.frames(spark))
    other = prefixed.rows(M.frames(spark, owner="acme_"))
    assert sorted(other.collect(), key=str) == sorted(same.collect(), key=str)


def test_filter_before_equals_filter_after(spark):
    profile, tables = customer_profile(), M.frames(spark)
    for customer in ("tax2", "000123", "unknown"):
        before = profile.rows(tables, only=customer).collect()
        after = profile.rows(tables).where(f"customer_id = '{customer}'").collect()
        assert sorted(before, key=str) == sorted(after, key=str)
    assert profile.rows(tables, only="unknown").count() == 0


@pytest.mark.parametrize("make", [M.frames, M.literal_frames])
def test_bad_code_in_the_wanted_list_fails(spark, make):
    tables = make(spark, {"cust_codes_language_desc": [(33, "zz", "bad", "en")]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        customer_profile().rows(tables).collect()


def test_bad_code_may_match_nothing(spark):
    codes = M.frames(spark, {"cust_codes_language_desc": [(33, "zz", "bad", "en")]})[
        "cust_codes_language_desc"
    ]
    base = spark.createDataFrame([(7,), (8,)], "code int")
    spec = Lookup(
        "codes",
        on={"code_value": "code"},
        where={"code_table_ref_id": 33, "language_type_code": "en"},
        take={"text": "code_desc"},
        code_type="smallint",
        on_bad_code="null",
    )
    assert sorted(map(tuple, lookup_join(base, codes, spec).collect())) == [
        (7, "web shop"),
        (8, None),
    ]


def test_unique_is_checked_after_the_literals(spark):
    status = M.frames(spark)["customer_status_lang"]
    base = spark.createDataFrame([("A",)], "code string")
    on, take = {"customer_status_code": "code"}, {"text": "display_short_desc"}
    english = Lookup("t", on, take, {"language_type_code": "en"}, unique=True)
    assert lookup_join(base, status, english).count() == 1
    with pytest.raises(DuplicateLookupKey):
        lookup_join(base, status, Lookup("t", on, take, unique=True))


def test_blank_padded_keys(spark):
    table = spark.createDataFrame([("A  ", "en ", "x ")], "k string, lang string, v string")
    base = spark.createDataFrame([("A",)], "id string")
    spec = Lookup("t", {"k": "id"}, {"v": "v"}, {"lang": "en"}, trim=True)
    assert lookup_join(base, table, spec).first() == ("A", "x ")
    padded = spark.createDataFrame([("A ",), ("A   ",), ("A",), (None,), ("B ",)], "id string")
    found = [tuple(r) for r in lookup_join(padded, table, spec).collect()]
    assert sorted(found, key=str) == sorted(
        [("A ", "x "), ("A   ", "x "), ("A", "x "), (None, None), ("B ", None)], key=str
    )


def test_padded_profile_equals_the_plain_one(spark):
    def padded(table):
        texts = {f.name for f in table.schema if f.dataType.simpleString() == "string"}
        return table.selectExpr(
            *[f"rpad({c}, 40, ' ') as {c}" if c in texts else c for c in table.columns]
        )

    plain = customer_profile().rows(M.frames(spark))
    wide = {name: padded(table) for name, table in M.frames(spark).items()}
    rows = customer_profile(trim=True).rows(wide)

    def stripped(df):
        return sorted(
            (tuple(v.rstrip() if isinstance(v, str) else v for v in r) for r in df.collect()),
            key=str,
        )

    assert stripped(rows) == stripped(plain)
    assert customer_profile(trim=True).rows(wide, only="tax2").count() == 2


def test_taken_names_must_be_new(spark):
    table = spark.createDataFrame([("A", "x")], "k string, v string")
    base = spark.createDataFrame([("A",)], "id string")
    with pytest.raises(ValueError, match="t: the rows have a column id already"):
        lookup_join(base, table, Lookup("t", {"k": "id"}, {"ID": "v"}))


def test_unique_lookups_keep_the_row_count(spark):
    base = spark.createDataFrame([("A",), ("F",), (None,), ("A",)], "code string")
    status = M.frames(spark)["customer_status_lang"]
    spec = Lookup(
        "t",
        {"customer_status_code": "code"},
        {"text": "display_short_desc"},
        {"language_type_code": "en"},
    )
    assert widen(base, {"t": status}, [spec]).count() == 4


def test_size_is_measured(spark):
    tables = {
        "empty": spark.createDataFrame([], "k int, v string"),
        "small": spark.createDataFrame([(1, "x"), (None, None)], "k int, v string"),
        "wide": spark.createDataFrame([(1, "x" * 500)], "k int, v string"),
        "long": spark.range(50).selectExpr("id as k", "'y' as v"),
    }
    assert small_tables(tables, 40, 400) == {"empty", "small"}
    assert small_tables({}) == set()


@pytest.mark.parametrize("exact", [False, True])
def test_whole_run(spark, exact):
    rows = customer_profile().rows(M.frames(spark))
    result = run(rows, customer_rules("demo"), exact_counts=exact)
    metrics = result.metrics.first().asDict()
    assert metrics == {
        "rows": 10,
        "bad_keys": 0,
        "dropped_values": 0,
        "entities": 8,
        "collapsed": 2,
        "dropped_by_column": {},
    }
    assert result.quarantine.count() == 0
    entities = {r["__key__"]["name"]: r for r in result.entities.collect()}
    assert set(entities) == set(M.EXPECTED)
    assert entities["000123"]["__key__"] == ("demo", "Customer", "000123")
    assert entities["000123"]["credit_limit_dollar_amt"] == 2500.5
    assert entities["tax2"]["sales_tax_exempt_id"] == "X-2"
    types = dict(result.entities.dtypes)
    assert types["credit_limit_dollar_amt"] == "double"
    assert types["source_system_code"] == types["company_nbr"] == "bigint"
    assert types["customer_status_date"] == "string"


def test_storing_twice_is_storing_once(spark):
    entities = run(customer_profile().rows(M.frames(spark)), customer_rules("demo")).entities
    first = store(None, entities)
    again = store(first, entities)
    assert sorted(again.collect(), key=str) == sorted(first.collect(), key=str)


def test_customer_job_from_a_folder(spark, tmp_path):
    source = str(tmp_path / "in")
    for name, table in M.frames(spark, owner="acme_").items():
        table.write.parquet(f"{source}/{name}.parquet")
    one = CustomerJob("demo", owner="acme_", only="tax2", folder=str(tmp_path / "all"))
    result, stored = one.run(spark, source)
    assert result.metrics.first().collapsed == 1
    assert [r["__key__"].name for r in stored.collect()] == ["tax2"]
    every = CustomerJob("demo", owner="acme_", folder=str(tmp_path / "all"))
    _, stored = every.run(spark, source, current=stored)
    assert {r["__key__"].name for r in stored.collect()} == set(M.EXPECTED)
    assert stored.count() == len(M.EXPECTED)
    before = len(os.listdir(tmp_path / "all"))
    drop_landed(result.quarantine)
    drop_landed(stored)
    assert before == len(os.listdir(tmp_path / "all"))
    assert len(list((tmp_path / "all").glob("*/stored"))) == 1


def test_customer_job_into_a_store_in_buckets(spark, tmp_path):
    source, place = str(tmp_path / "in"), str(tmp_path / "store")
    for name, table in M.frames(spark).items():
        table.write.parquet(f"{source}/{name}.parquet")
    options = {"folder": str(tmp_path / "all"), "store": place, "buckets": 16, "exact_counts": True}
    every = CustomerJob("demo", **options)
    result, stored = every.run(spark, source)
    assert result.metrics.first().entities == len(M.EXPECTED)
    first = stored.collect()
    assert {r["__key__"].name for r in first} == set(M.EXPECTED)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    one = CustomerJob("demo", only="tax2", **options)
    _, again = one.run(spark, source)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    assert len({p.parent for p in {*before.items()} ^ {*after.items()} for p in p[:1]}) == 1
    assert sorted(again.collect(), key=str) == sorted(first, key=str)
    with pytest.raises(ValueError, match="holds what is current"):
        every.run(spark, source, current=stored)


def test_customer_job_into_an_external_store(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for name, table in M.frames(spark).items():
        table.write.parquet(f"{source}/{name}.parquet")
    stored = []
    for write, only in enumerate((None, "tax2", None)):
        options = {"folder": folder, "write": str(write), "password": "secret"}
        job = CustomerJob("demo", only=only, sink=STORE, sink_options=options)
        assert "secret" not in repr(job)
        result, _ = job.run(spark, source)
        schema = ", ".join(f"{c} {t}" for c, t in to_long(result.entities).dtypes)
        stored.append(sorted(map(str, stored_rows(spark, folder, schema, LONG_KEY).collect())))
    assert stored[0] == stored[1] == stored[2]
    assert sorted(map(str, to_long(result.entities).collect())) == stored[0]


@pytest.mark.parametrize("exact", [False, True])
def test_run_shuffles_the_base_once(spark, conf, monkeypatch, exact):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plans = {}

    def landing(df, name, folder=None):
        plans[name] = plan_of(df)
        return land(df, name, folder)

    monkeypatch.setattr("entityloom.plans.entity_job.land", landing)
    tables = M.frames(spark)
    codes = [name for name in tables if "lang" in name]
    rows = customer_profile(measure=codes).rows(tables)
    run(rows, customer_rules("demo"), exact_counts=exact)
    exchanges = [
        line
        for line in plans["entities"].splitlines()
        if "Exchange hashpartitioning(customer_id" in line
    ]
    assert len(exchanges) == 1


def test_job_reads_only_what_it_uses(spark, monkeypatch, tmp_path):
    tables, asked = M.frames(spark), {}

    def fake_read(spark, source, relation, split):
        asked.setdefault(relation, []).append(split)
        return tables[relation.removeprefix("s.")].selectExpr("*", "'unused' as more")

    monkeypatch.setattr("entityloom.sources.jdbc.read_jdbc", fake_read)
    source = JdbcSource("a.Driver", "jdbc:x")
    split = ["customer_id < 'm'", "customer_id >= 'm'"]
    job = CustomerJob("demo", schema="s", splits={"cust_unit": split}, check_counts=True)
    landed = job.tables(spark, source)
    assert asked["s.cust_unit"] == [split, None]
    assert all("more" not in t.columns for t in landed.values())
    codes = landed["cust_codes_language_desc"].select("code_table_ref_id").distinct()
    assert {r[0] for r in codes.collect()} <= {1, 33}
    assert {r[0] for r in landed["customer_status_lang"].select("language_type_code").collect()} == {"en"}
    result, _ = job.run(spark, source)
    assert result.metrics.first().entities == len(M.EXPECTED)

    def missing(spark, source, relation, split):
        rows = tables[relation.removeprefix("s.")]
        return rows.limit(1) if split else rows

    monkeypatch.setattr("entityloom.sources.jdbc.read_jdbc", missing)
    with pytest.raises(RowCountDiffers, match="cust_unit: 1 rows landed, 8 in the database"):
        job.tables(spark, source)


def test_job_of_one_statement(spark, monkeypatch):
    rows = customer_profile().rows(M.frames(spark))
    asked = []

    def fake_read(spark, source, relation, split=None):
        asked.append(relation)
        return rows

    monkeypatch.setattr("entityloom.plans.customer_job.read_jdbc", fake_read)
    source = JdbcSource("a.Driver", "jdbc:x")
    job = CustomerJob("demo", statement="select 1")
    result, stored = job.run(spark, source)
    assert asked == ["(select 1) q"] and stored.count() == len(M.EXPECTED)
    assert CustomerJob("demo", statement="select 1", only="tax2").rows(spark, source).count() == 2
    with pytest.raises(ValueError, match="needs a database"):
        job.run(spark, "/a/folder")


def test_profile_names_its_tables():
    assert sorted(customer_profile().tables()) == sorted(M.SCHEMAS)
