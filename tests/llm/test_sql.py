"""Queries of this folder that SQL can express, against that SQL."""

import os

import pytest

from landfall.llm import registry

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = registry.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    relation = duck.sql(registry.ORACLES[name])
    assert sorted(relation.columns) == columns
    want = relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(repr(tuple(r)) for r in found.select(*columns).collect()) == sorted(map(repr, want))
