"""Registered queries against their SQL on the smallest tables.

A few by default; all of them with LEXIQUARRY_ALL=1.
"""

import os
import re

import pytest

import __spark_entry__ as entry

SF = os.environ.get("LEXIQUARRY_SF", "/root/testdata/sf0.001")
SOME = (
    "txt05_preprocess",
    "ing09_upsert_documents",
    "idx05_build_index",
    "sch08_search_shard",
    "sch12_search_batch",
    "trm07_suggest",
    "trm16_apply_batch",
    "str01_ingest_stream",
)
NAMES = sorted(entry.oracle_sql()) if os.environ.get("LEXIQUARRY_ALL") else SOME

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        name = file.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return connection


def test_every_query_has_its_sql():
    """Those of the part for training text have SQL only where SQL can express them."""
    without = entry.queries().keys() - entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, database, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    expected = database.sql(entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    want = sorted(expected.select(", ".join(columns)).fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
