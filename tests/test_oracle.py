"""Every registered query against the SQL that states it, on the smallest tables."""

import os
import sys

import pytest
from conftest import ROOT

sys.path.insert(0, str(ROOT))
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as spark_entry  # noqa: E402
from landfall.plans import catalog  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("nation", "customer", "orders", "lineitem", "part"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF)
    relation = duck.sql(spark_entry.oracle_sql()[name])
    spark_types = {column: TYPES[kind] for column, kind in df.dtypes}
    assert spark_types == dict(zip(relation.columns, map(str, relation.types)))
    columns = sorted(df.columns)
    found = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    picked = relation.project(", ".join(f'"{c}"' for c in columns))
    assert found == sorted(repr(row) for row in picked.fetchall())


def test_entry(spark):
    assert len(spark_entry.entry(spark).columns) == 13
