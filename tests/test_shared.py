"""Landing on a cluster whose machines mount one folder of the local file system."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa
import pytest

from entityloom.plans.catalogue import QUERIES, SQL
from entityloom.sources import shared
from entityloom.sources.folder_store import FolderStore
from entityloom.sources.shared import UMASK, new_folder, new_path, shared_folder, write_options
from tests.compare import compare

TABLES = {
    "region": "select i::int as r_regionkey, 'REGION ' || i as r_name from range(5) t(i)",
    "nation": """
        select i::int as n_nationkey, 'NATION ' || i as n_name, (i % 5)::int as n_regionkey
        from range(25) t(i)""",
    "customer": """
        select i as c_custkey, 'Customer ' || i as c_name, (i % 25)::int as c_nationkey,
               (i * 7 - 90.5)::double as c_acctbal,
               ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][i % 5 + 1]
                 as c_mktsegment
        from range(1, 61) t(i)""",
    "part": """
        select i as p_partkey, 'part ' || i as p_name, 'Brand#' || i % 4 as p_brand,
               ['STANDARD TIN', 'SMALL TIN', 'MEDIUM ZINC', 'ECONOMY TIN'][i % 4 + 1] as p_type,
               i::int as p_size, i::double as p_retailprice
        from range(8) t(i)""",
    "orders": """
        select i as o_orderkey, i % 47 + 1 as o_custkey, ['F', 'O', 'P'][i % 3 + 1] as o_orderstatus,
               (i * 1.5)::double as o_totalprice,
               timestamp '1999-11-01' + to_days((i * 3)::int) as o_orderdate,
               ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][i % 5 + 1]
                 as o_orderpriority
        from range(300) t(i)""",
    "lineitem": """
        select i // 2 as l_orderkey, i % 8 as l_partkey, i % 3 as l_suppkey,
               (i % 2 + 1)::int as l_linenumber, 1.0::double as l_quantity,
               (i * 2.5)::double as l_extendedprice, 0.0::double as l_discount, 0.0::double as l_tax,
               'N' as l_returnflag, 'O' as l_linestatus, timestamp '2000-01-01' as l_shipdate
        from range(560) t(i)""",
    "labels": """
        select i as doc_id, (i % 2)::int as quality, (i % 3 // 2)::int as toxic
        from range(1, 40) t(i)""",
    "conversations": """
        select i // 3 as conv_id, i % 3 as turn,
               case i % 4 when 0 then '7' when 1 then 'user' when 2 then 'agent' end as role,
               'text ' || i as text
        from range(150) t(i)""",
}


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    con = duckdb.connect()
    for name, sql in TABLES.items():
        con.execute(f"copy ({sql}) to '{folder}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return str(folder), con


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    """The session as on a cluster; its shared folder is the test's, on the local file system."""
    settings = type(spark.conf)
    get = settings.get

    def of_cluster(self, key, *default):
        return str(tmp_path / "mounted") if key == "spark.checkpoint.dir" else get(self, key, *default)

    monkeypatch.setattr(settings, "get", of_cluster)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://machine:7077")
    return tmp_path / "mounted"


def test_a_shared_folder_is_tried_once(spark, cluster, monkeypatch):
    assert shared_folder(spark) == str(cluster)
    assert list((cluster / "entityloom").iterdir()) == []  # the trial table is gone
    monkeypatch.setattr(shared.uuid, "uuid4", lambda: pytest.fail("tried again"))
    assert shared_folder(spark) == str(cluster)


def test_a_folder_that_cannot_be_written_is_refused(spark, cluster):
    cluster.write_text("no folder")
    with pytest.raises(RuntimeError, match="may not see") as refused:
        new_path(spark, "x")
    assert refused.value.__cause__ is not None


def test_a_folder_that_loses_rows_is_refused(spark, cluster, monkeypatch):
    reader = type(spark.read)
    whole = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths: whole(self, *paths).where("id = 0"))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="may not see"):
            shared_folder(spark)


LANDING = [
    "client_rows",
    "customer_entities",
    "customer_profile",
    "customer_profile_client",
    "customer_profile_one",
    "entity_profile",
    "entity_sink",
    "external_store",
    "files_by_date",
    "run_exact_metrics",
    "run_rejected",
    "upsert_buckets",
    "satellite_fanout",
]


@pytest.mark.parametrize("name", LANDING)
def test_queries_land_on_a_cluster(spark, cluster, tables, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")  # satellites are scanned for hot keys
    folder, con = tables
    rows, problems = compare(QUERIES[name](spark, folder), con, SQL[name])
    assert not problems
    assert rows > 0
    assert any((cluster / "entityloom").iterdir())


@pytest.fixture
def anothers(cluster):
    """A shared folder whose ``entityloom`` takes no folders of this user (here it is a file,
    as tests may run as root, whom another user's folder lets in)."""
    cluster.mkdir()
    (cluster / "entityloom").touch()
    return cluster


def own_folder(spark, folder):
    group = spark.sparkContext._jvm.org.apache.hadoop.security.UserGroupInformation
    return folder / f"entityloom-{group.getCurrentUser().getShortUserName()}"


def test_another_users_folder_is_left_alone(spark, anothers):
    own = own_folder(spark, anothers)
    assert new_path(spark, "x").startswith(f"{own}/x-")
    assert list(own.iterdir()) == []  # what was tried is gone
    assert (anothers / "entityloom").read_bytes() == b""


BESIDE_ANOTHER = [
    "customer_entities",
    "customer_profile",
    "customer_profile_client",
    "customer_profile_one",
    "entity_profile",
    "entity_sink",
    "external_store",
    "files_by_date",
    "run_exact_metrics",
    "run_rejected",
    "upsert_buckets",
    "satellite_fanout",
]


@pytest.mark.parametrize("name", BESIDE_ANOTHER)
def test_queries_land_beside_another_users_folder(spark, anothers, tables, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")  # satellites are scanned for hot keys
    folder, con = tables
    rows, problems = compare(QUERIES[name](spark, folder), con, SQL[name])
    assert not problems
    assert rows > 0
    assert any(own_folder(spark, anothers).iterdir())


@pytest.fixture
def of_others(spark, cluster, monkeypatch):
    """A shared folder that all may write to; the executors run as other users than the driver
    (one machine's threads do not, so what tells that is replaced)."""
    cluster.mkdir()
    cluster.chmod(0o777)
    monkeypatch.setattr(shared, "_by_others", lambda files, table: True)
    return cluster


def folder_modes(folder) -> set[str]:
    """The modes of all folders in the tables below the shared folder."""
    tables = (folder / "entityloom").iterdir()
    return {oct(os.stat(at).st_mode & 0o777) for table in tables for at, _, _ in os.walk(table)}


def test_folders_are_as_open_as_the_shared_one(spark, of_others):
    of_others.chmod(0o2770)
    path = new_path(spark, "x")
    assert write_options(spark, path)[UMASK] == "002"
    assert write_options(spark, "/elsewhere/x") == {}
    assert folder_modes(of_others) == set()  # the trial table is gone
    new_folder(spark, "y")
    assert folder_modes(of_others) == {"0o775"}


def test_folders_of_one_user_are_as_usual(spark, cluster):
    cluster.mkdir()
    cluster.chmod(0o777)
    assert write_options(spark, new_path(spark, "x")) == {}
    new_folder(spark, "y")
    assert folder_modes(cluster) == {"0o755"}


def test_a_closed_folder_opens_nothing(spark, of_others):
    of_others.chmod(0o755)
    assert write_options(spark, new_path(spark, "x")) == {}


OF_OTHERS = [
    "customer_profile",
    "customer_profile_client",
    "customer_profile_one",
    "entity_profile",
    "entity_sink",
    "external_store",
    "files_by_date",
    "run_exact_metrics",
    "run_rejected",
    "upsert_buckets",
    "satellite_fanout",
]


@pytest.mark.parametrize("name", OF_OTHERS)
def test_queries_land_for_executors_of_other_users(spark, of_others, tables, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")  # satellites are scanned for hot keys
    folder, con = tables
    rows, problems = compare(QUERIES[name](spark, folder), con, SQL[name])
    assert not problems
    assert rows > 0
    assert folder_modes(of_others) == {"0o777"}


def test_a_stores_files_can_be_written_over_by_another_user(tmp_path, monkeypatch):
    monkeypatch.setattr("entityloom.sources.folder_store.TaskContext", Task)
    tmp_path.chmod(0o777)
    usual = os.umask(0o022)
    store = FolderStore({"folder": str(tmp_path), "write": "0"})
    store.put(pa.RecordBatch.from_pydict({"a": [1]}))
    made = sorted(tmp_path.rglob("*"))
    assert [oct(at.stat().st_mode & 0o777) for at in made] == ["0o777", "0o666"]
    assert os.umask(usual) == 0o022


class Task:
    @classmethod
    def get(cls):
        return cls()

    def partitionId(self):
        return 0
