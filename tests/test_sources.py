"""Sources, sinks and the plans of the large queries."""

from __future__ import annotations

import json
import os
import re
from types import SimpleNamespace

import pytest

from entityloom.operators.entities import KEY
from entityloom.plans.catalogue import QUERIES, SCHEMAS
from entityloom.plans.customer_profile import customer_profile, customer_rules
from entityloom.plans.customer_queries import master_tables
from entityloom.plans.order_profile import order_profile, with_code_tables
from entityloom.sources.entity_store import write_entities
from entityloom.sources.files import split_directory, write_by_date
from entityloom.sources.jdbc import (
    JdbcSource,
    ValueRanges,
    land_tables,
    read_jdbc,
    text_ranges,
    where_equal,
)
from entityloom.sources.shared import new_path, shared_folder
from entityloom.sources.tables import ParquetTables, land, query_rows
from tests.conftest import DATA, plan_of


def test_secrets_stay_out_of_repr():
    source = JdbcSource("a.Driver", "jdbc:x://host/db?token=t0p", "someone", "pa55")
    assert repr(source) == "JdbcSource(driver='a.Driver', fetch_size=10000)"
    assert source.options()["password"] == "pa55"
    assert "user" not in JdbcSource("a.Driver", "jdbc:x").options()


def test_range_split_options():
    assert ValueRanges("id", 1, 100, 4).options() == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "4",
    }


@pytest.mark.parametrize("cuts", [[], ["m"], ["b", "it's", "x"]])
def test_text_ranges_meet_each_row_once(spark, cuts):
    df = spark.createDataFrame(
        [(v,) for v in ["", "a", "b", "it's", "m", "x", "zz", None]], "v string"
    )
    conditions = text_ranges("v", cuts)
    assert len(conditions) == len(cuts) + 1
    read = [r[0] for c in conditions for r in df.where(c).collect()]
    assert sorted(read, key=str) == sorted((r[0] for r in df.collect()), key=str)
    with pytest.raises(ValueError):
        text_ranges("v", ["a", "a"])
    with pytest.raises(ValueError, match="ascend"):
        text_ranges("v", ["x", "b"])
    assert len(text_ranges("v", ["a", "B", "c"])) == 4


@pytest.mark.parametrize("split", [None, ValueRanges("id", 1, 9, 2), ["id < 5", "id >= 5"]])
def test_jdbc_read_reaches_the_driver(spark, split):
    source = JdbcSource("no.such.Driver", "jdbc:none://nowhere/db")
    with pytest.raises(Exception, match="no.such.Driver"):
        read_jdbc(spark, source, "(select 1 as id) q", split)


class Context:
    """What shared_folder sees of a session that names no folder."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, default="hdfs://names:1/", **conf):
    context = Context(master)
    context._jsc = SimpleNamespace(hadoopConfiguration=lambda: {"fs.defaultFS": default})
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_landing_over_jdbc_reads_every_relation(spark, monkeypatch, tmp_path):
    asked = []

    def fake_read(spark, source, relation, split):
        asked.append((relation, split))
        return spark.sql("select 'a' as id, 1 as v union all select 'b', 2")

    monkeypatch.setattr("entityloom.sources.jdbc.read_jdbc", fake_read)
    source = JdbcSource("a.Driver", "jdbc:x")
    tables = land_tables(
        spark,
        source,
        {"one": "s.one", "two": "(select 1) q"},
        splits={"two": ["id < 'b'", "id >= 'b'"]},
        equal={"id": "b", "other": 3},
        folder=str(tmp_path),
    )
    assert sorted(asked, key=str) == [
        ("(select 1) q", ["id < 'b'", "id >= 'b'"]),
        ("s.one", None),
    ]
    assert {name: t.collect() for name, t in tables.items()} == {
        "one": [("b", 2)],
        "two": [("b", 2)],
    }
    assert where_equal(tables["one"], {}).count() == 1


def test_shared_folder_is_the_sessions(spark):
    named = session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
    assert shared_folder(named) == "hdfs://shared/folder"
    assert new_path(named, "x").startswith("hdfs://shared/folder/entityloom/x-")
    assert new_path(named, "x") != new_path(named, "x")
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        assert shared_folder(spark) == folder.rstrip("/")


def test_only_local_sessions_do_without_a_shared_folder():
    local = session("local[2]")
    folder = shared_folder(local)
    assert os.path.isdir(folder) and shared_folder(local) == folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    on_disk = {"spark.checkpoint.dir": "file:///tmp/x"}
    with pytest.raises(RuntimeError, match="may not see"):
        shared_folder(session("yarn", **on_disk))
    assert shared_folder(session("local-cluster[2,1,1024]", **on_disk)) == "file:///tmp/x"
    bare = {"spark.checkpoint.dir": "/shared/x"}
    assert shared_folder(session("yarn", **bare)) == "/shared/x"
    with pytest.raises(RuntimeError, match="may not see"):
        shared_folder(session("yarn", "file:///", **bare))
    mounted = {**on_disk, "spark.entityloom.sharedFiles": "true"}
    assert shared_folder(session("yarn", **mounted)) == "file:///tmp/x"


def test_landing_writes_once(spark, tmp_path):
    df = spark.sql("select id, uuid() as u from range(5)")
    landed = land(df, "ids")
    assert sorted(landed.collect()) == sorted(landed.collect())
    assert landed.schema.fieldNames() == ["id", "u"]
    land(df, "named", str(tmp_path / "here"))
    with pytest.raises(Exception, match="already exists"):
        land(df, "named", str(tmp_path / "here"))


def test_query_text_with_bound_values(spark):
    tables = {"t": spark.createDataFrame([("a' or 1=1", 1), ("b", 2)], "k string, v int")}
    text = "select v, k as V from {t} where k = :key"
    assert query_rows(spark, tables, text, {"key": "a' or 1=1"}).collect() == [(1,)]
    assert query_rows(spark, tables, text, {"key": "' or ''='"}).collect() == []


def test_dated_directories():
    assert split_directory("/out/a/YYYY/MM/DD/") == ("/out/a", ["YYYY", "MM", "DD"])
    assert split_directory("/out/a") == ("/out/a", [])
    for bad in ("/out/YYYY/a/", "/out/MM/MM"):
        with pytest.raises(ValueError):
            split_directory(bad)


def test_files_by_date(spark, tmp_path):
    df = spark.sql(
        "select id, if(id = 0, null, 'x') as v,"
        " timestamp '2024-02-03 04:05:06' + make_interval(0, id) as ts from range(3)"
    )
    root = write_by_date(df, f"{tmp_path}/out/YYYY/MM/DD/HH/mm/", "ts")
    found = spark.read.json(root)
    assert found.count() == 3
    parts = ["year", "month", "day", "hour", "minute"]
    assert found.select(*parts).distinct().count() == 3
    assert (tmp_path / "out/year=2024/month=02/day=03/hour=04/minute=05").is_dir()
    text = "".join(r[0] for r in spark.read.text(root).collect())
    assert '"v":null' in text
    plain = write_by_date(df, f"{tmp_path}/plain/", "ts")
    assert spark.read.json(plain).columns == ["id", "ts", "v"]


class KeyedFiles:
    """A store for tests: one file a key, so that a repeated put overwrites."""

    def __init__(self, options):
        self.folder, self.fail = options["folder"], options.get("fail")

    def put(self, batch):
        for row in batch.to_pylist():
            if self.fail == row["key_name"]:
                raise RuntimeError("no more room")
            with open(f"{self.folder}/{row['key_name']}-{row['property']}", "w") as file:
                json.dump(row["value"], file)

    def close(self):
        return None

    @staticmethod
    def abort(options, tokens):
        with open(f"{options['folder']}/aborted", "w") as file:
            json.dump(tokens, file)


STORE = "tests.test_sources:KeyedFiles"


def kept(folder):
    return {p.name: json.loads(p.read_text()) for p in folder.iterdir()}


def test_entity_store_puts_by_key(spark, tmp_path):
    rows = [("a", "n", "1"), ("a", "x", None), ("b", "n", "2")]
    first = spark.createDataFrame(rows, "key_name string, property string, value string")
    for _ in range(2):
        write_entities(first.repartition(2), STORE, {"folder": str(tmp_path)})
        assert kept(tmp_path) == {"a-n": "1", "a-x": None, "b-n": "2"}
    second = spark.createDataFrame([("b", "n", "3")], first.schema)
    write_entities(second, STORE, {"folder": str(tmp_path)})
    assert kept(tmp_path)["b-n"] == "3"
    write_entities(first.where("false"), STORE, {"folder": str(tmp_path)})
    with pytest.raises(Exception, match="no more room"):
        write_entities(second, STORE, {"folder": str(tmp_path), "fail": "b"})
    assert (tmp_path / "aborted").exists()
    with pytest.raises(Exception, match="module:Class"):
        first.write.format("entity_store").mode("append").save()


def test_tables_are_a_mapping(spark):
    tables = ParquetTables(spark, DATA + "/", {"nation": None, "region": "r_name string"})
    assert list(tables) == ["nation", "region"] and len(tables) == 2
    assert tables["region"].columns == ["r_name"]
    assert tables["nation"] is tables["nation"]
    with pytest.raises(KeyError):
        tables["orders"]


def test_flagship_reads_only_what_it_needs(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["entity_profile"](spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    assert "EqualTo(l_linenumber,1)" in plan
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "p_brand" not in plan  # the brand list drops out at planning
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_filter_reaches_the_scan(spark):
    assert "EqualTo(o_custkey,42)" in plan_of(QUERIES["filter_param"](spark, DATA))


def test_known_value_reaches_the_satellites(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables = with_code_tables(ParquetTables(spark, DATA, SCHEMAS))
    plan = plan_of(order_profile().rows(tables, only=42))
    assert re.search(r"Filter.*o_custkey#\d+L = 42", plan)
    assert re.search(r"Filter.*c_custkey#\d+L = 42", plan)


def test_satellites_share_one_shuffle_of_the_base(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables = master_tables(ParquetTables(spark, DATA, SCHEMAS))
    codes = [name for name in tables if "lang" in name]
    rules = customer_rules("demo")
    rows = customer_profile(measure=codes).rows(tables)
    plan = plan_of(rules.entities(rules.keyed(rows)))
    on_customer = [
        line
        for line in plan.splitlines()
        if "Exchange hashpartitioning(customer_id" in line
    ]
    assert len(on_customer) == 1
    assert plan.count("SortMergeJoin") == 2


def test_normalising_and_keys_do_not_shuffle(spark):
    for name in ("entity_wide", "entity_long", "norm_other_text", "drop_bad_value"):
        plan = plan_of(QUERIES[name](spark, DATA))
        assert "Exchange" not in plan and "Python" not in plan, name
    assert KEY == "__key__"
