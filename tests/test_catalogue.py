"""Every registered query against SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from entityloom.plans.catalogue import QUERIES, SCHEMAS, SQL
from tests.compare import compare, connect
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, problems = compare(QUERIES[name](spark, DATA), con, SQL[name])
    assert not problems
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_flagship(spark):
    assert len(contract.entry(spark).columns) == 9


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_declared_schema_is_the_files_schema(spark, name):
    found = spark.read.parquet(f"{DATA}/{name}.parquet").schema
    declared = spark.createDataFrame([], SCHEMAS[name]).schema
    assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in found]
