"""Stores and readers of a site's own: batches, repeated attempts, columns and filters pushed."""

from __future__ import annotations

import json
import threading
import time
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from entityloom.plans.customer_job import CustomerJob
from entityloom.plans.customer_profile import customer_profile
from entityloom.plans.customer_queries import DERIVED, master_tables
from entityloom.sources import folder_store
from entityloom.sources.entity_rows import PUSHDOWN, ClientSource, ParquetClient, RowsReader
from entityloom.sources.entity_store import StoreWriter, bounded, write_entities
from entityloom.sources.folder_store import STORE, stored_rows
from entityloom.sources.jdbc import land_tables
from entityloom.sources.shipping import SHIPPED, ship
from entityloom.sources.tables import ParquetTables
from entityloom.sources.uris import open_folder
from entityloom.plans.registry import SCHEMAS
from tests.conftest import DATA

SCHEMA = "key_name string, property string, value string"


def test_batches_are_bounded():
    batch = pa.RecordBatch.from_pydict({"a": ["x" * (i % 50) for i in range(1000)], "n": list(range(1000))})
    parts = list(bounded(batch, 70, 600))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert all(p.num_rows <= 70 and (p.nbytes <= 600 or p.num_rows == 1) for p in parts)
    huge = pa.RecordBatch.from_pydict({"a": ["x" * 5000, "y"]})
    assert [p.num_rows for p in bounded(huge, 70, 600)] == [1, 1]


class Noted:
    """Notes every put, and fails once at a given key."""

    def __init__(self, options):
        self.options, self.puts = options, 0

    def put(self, batch):
        rows = batch.to_pylist()
        with open(f"{self.options['folder']}/log-{rows[0]['key_name']}", "a") as file:
            file.write(json.dumps([[r["key_name"], r["property"], r["value"]] for r in rows]) + "\n")

    def close(self):
        return None


def test_puts_go_in_ranges_of_sorted_keys(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(f"k{i % 40:02d}", f"p{i // 40}", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    write_entities(df, "tests.test_clients:Noted", {"folder": str(tmp_path)}, ["key_name"], batch_rows=7)
    puts = [json.loads(x) for p in tmp_path.iterdir() for x in p.read_text().splitlines()]
    assert sorted(tuple(r) for put in puts for r in put) == sorted(rows)
    assert all(len(put) <= 7 and [r[0] for r in put] == sorted(r[0] for r in put) for put in puts)
    # Puts are ranges: sorted by their first keys they do not overlap but at an end.
    puts.sort(key=lambda put: (put[0][0], put[-1][0]))
    assert all(a[-1][0] <= b[0][0] for a, b in zip(puts, puts[1:]))


def test_the_last_write_of_a_key_counts(spark, tmp_path):
    folder, keys = f"file:{tmp_path}/store", ["key_name", "property"]
    rows = [(f"k{i}", "p", str(i)) for i in range(100)]
    first = spark.createDataFrame(rows, SCHEMA)
    second = first.where("key_name < 'k5'").withColumn("value", F.lit("new")).union(
        spark.createDataFrame([("z", "p", None)], SCHEMA)
    )
    for number, df in enumerate((first, second)):
        write_entities(df, STORE, {"folder": folder, "write": str(number)}, keys, batch_rows=9)
    found = {r[0]: r[2] for r in stored_rows(spark, folder, SCHEMA, keys).collect()}
    want = {k: "new" if k < "k5" else v for k, _, v in rows} | {"z": None}
    assert found == want
    # The write again, as after a lost driver: the same files.
    write_entities(second, STORE, {"folder": folder, "write": "1"}, keys, batch_rows=9)
    assert {r[0]: r[2] for r in stored_rows(spark, folder, SCHEMA, keys).collect()} == want


class Failing(folder_store.FolderStore):
    """Loses its task after three puts until a marker is there."""

    def __init__(self, options):
        super().__init__(options)
        self.marker = f"{options['marker']}/{self.task}"

    def put(self, batch):
        super().put(batch)
        if self.puts == 3:
            try:
                open(self.marker).close()
            except FileNotFoundError:
                open(self.marker, "w").close()
                raise RuntimeError("the machine is gone") from None


def test_a_failing_task_leaves_one_row_per_key(spark, tmp_path, monkeypatch):
    folder, keys = f"{tmp_path}/store", ["key_name", "property"]
    (tmp_path / "seen").mkdir()
    df = spark.createDataFrame([(f"k{i}", "p", str(i)) for i in range(300)], SCHEMA)
    options = {"folder": folder, "write": "0", "marker": f"{tmp_path}/seen"}
    for _ in range(20):  # a local session does not try a task again, so the write is repeated
        try:
            write_entities(df, "tests.test_clients:Failing", options, keys, batch_rows=10)
            break
        except Exception as error:
            assert "the machine is gone" in str(error)
    else:
        raise AssertionError("never came through")
    assert list((tmp_path / "seen").iterdir())
    found = stored_rows(spark, folder, SCHEMA, keys).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, df.collect()))
    # Nothing is in the files twice: the second attempt wrote over the first.
    assert spark.read.parquet(folder).count() == 300


def test_an_attempt_writes_the_same_files_again(tmp_path, monkeypatch):
    class Task:
        @staticmethod
        def get():
            return Task()

        def partitionId(self):
            return 4

    monkeypatch.setattr(folder_store, "TaskContext", Task)
    options = {"folder": str(tmp_path), "write": "2", "store": STORE, "batch_rows": "3"}
    batch = pa.RecordBatch.from_pydict({"key_name": list("abcdefgh")})
    for _ in range(2):
        StoreWriter(options).write(iter([batch]))
    names = sorted(p.name for p in (tmp_path / "write=2").iterdir())
    assert names == [f"part-000004-{i:06d}.parquet" for i in range(3)]


class Watched(ParquetClient):
    """Notes what it is asked for."""

    def __init__(self, options):
        super().__init__(options)
        self.log = options["log"]

    def partitions(self, columns, equal):
        parts = super().partitions(columns, equal)
        with open(self.log, "a") as file:
            file.write(json.dumps([list(columns), dict(equal), len(parts)]) + "\n")
        return parts


def watched(tmp_path, folder, schemas):
    options = {"folder": str(folder), "log": f"{tmp_path}/log"}
    return ClientSource("tests.test_clients:Watched", schemas, options)


def asked(tmp_path):
    return [json.loads(x) for x in (tmp_path / "log").read_text().splitlines()]


def test_columns_and_values_reach_the_client(spark, tmp_path):
    spark.range(0, 1000, 1, 4).selectExpr("id", "id div 10 as g", "cast(id as string) as s").sortWithinPartitions(
        "g"
    ).write.parquet(f"{tmp_path}/t/things")
    source = watched(tmp_path, tmp_path / "t", {"things": "id long, g long, s string"})
    assert "log" not in repr(source)
    rows = source.rows(spark, "things", columns=["id", "g"]).where("g = 7 and id > 71")
    assert sorted(r.id for r in rows.collect()) == list(range(72, 80))
    columns, equal, parts = asked(tmp_path)[-1]
    assert columns == ["id", "g"] and equal == {"g": 7}
    assert parts == 1  # the other files' bounds leave the value out
    assert source.rows(spark, "things").count() == 1000
    assert asked(tmp_path)[-1][2] == 4
    with pytest.raises(ValueError, match="splits its reads itself"):
        source.rows(spark, "things", ["1 = 1"])


def test_filters_are_applied_by_spark_too():
    reader = RowsReader({"client": "x:y"}, ["a"])
    filters = ["anything"]
    assert list(reader.pushFilters(filters)) == filters and reader.equal == {}


def test_a_customer_run_through_a_client(spark, tmp_path):
    tables = master_tables(ParquetTables(spark, DATA, SCHEMAS))
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/m/{name}")
    schemas = {
        name: ", ".join(f"`{c}` {t}" for c, t in df.dtypes) for name, df in tables.items()
    }
    job = CustomerJob("demo", measure=DERIVED, only="000000000042", folder=f"{tmp_path}/run")
    rows = job.rows(spark, watched(tmp_path, tmp_path / "m", schemas))
    plain = customer_profile(measure=DERIVED).rows(tables, only="000000000042")
    assert rows.count() > 0
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, plain.collect()))
    requests = asked(tmp_path)
    assert len(requests) >= 10
    read = customer_profile(measure=DERIVED).columns()
    for columns, equal, _ in requests:
        assert any(set(columns) <= {*names, "customer_id"} for names in read.values())
        if "customer_id" in columns:
            assert equal["customer_id"] == "000000000042"


def test_landing_through_a_client_prunes(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 3 as g", "'x' as s").write.parquet(f"{tmp_path}/t/things")
    source = watched(tmp_path, tmp_path / "t", {"things": "id long, g long, s string"})
    landed = land_tables(
        spark, source, {"mine": "things"}, equal={"g": 1}, folder=f"{tmp_path}/out", columns={"mine": ["id"]}
    )
    assert landed["mine"].columns == ["id"] and landed["mine"].count() == 17
    assert asked(tmp_path)[-1][:2] == [["id", "g"], {"g": 1}]
    assert spark.conf.get(PUSHDOWN) == "true"


def test_folders_as_spark_writes_them(tmp_path):
    for uri in (f"file:{tmp_path}", f"file://{tmp_path}", str(tmp_path)):
        files, path = open_folder(uri)
        assert path == str(tmp_path) and files.type_name == "local"


def test_no_thread_goes_on_before_the_library_was_sent():
    """The tables of a client are opened by several threads, each plans with what was sent by then."""
    sending, sent = threading.Event(), []

    def add(path):
        sending.set()
        time.sleep(0.5)
        sent.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-of-threads", addPyFile=add))
    first = threading.Thread(target=ship, args=[spark])
    first.start()
    assert sending.wait(10)
    ship(spark)
    seen = list(sent)
    first.join()
    SHIPPED.discard("app-of-threads")
    assert len(seen) == 1 and sent == seen
