"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE_SQL
from workload.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["events", "orders", "lineitem"]


def rows_of(names, rows):
    """Rows with columns in name order, in an order that does not depend on the engine."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def tables_in(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def compare(spark, duck, folder, name):
    df = entry_points.queries()[name](spark, folder)
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == expected
    assert expected


@pytest.fixture(scope="module")
def duck():
    return tables_in(SF_DIR)


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The same tables with a third of the rows on one day, and some without a time or a value."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name, key, time, hot, number in (
        ("events", "event_id", "ts", "2024-01-17 12:00:00", "value"),
        ("orders", "o_orderkey", "o_orderdate", "1997-05-05", "o_totalprice"),
        ("lineitem", "l_orderkey", "l_shipdate", "1997-05-05", "l_extendedprice"),
    ):
        duckdb.connect().execute(
            f"""COPY (SELECT * REPLACE (
                    CASE WHEN {key} % 3 = 0 THEN TIMESTAMP '{hot}'
                         WHEN {key} % 50 = 1 THEN NULL ELSE {time} END AS {time},
                    CASE WHEN {key} % 7 <> 0 THEN {number} END AS {number})
                FROM '{SF_DIR}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)"""
        )
    return folder


def test_each_query_has_an_oracle():
    assert REGISTRY.keys() == ORACLE_SQL.keys()
    assert REGISTRY.keys() <= entry_points.queries().keys()
    assert ORACLE_SQL.keys() <= entry_points.oracle_sql().keys()


@pytest.mark.parametrize("name", REGISTRY)
def test_query_matches_oracle(spark, duck, name):
    compare(spark, duck, SF_DIR, name)


@pytest.mark.parametrize("name", REGISTRY)
def test_query_matches_oracle_on_skewed_tables_with_gaps(spark, skewed_dir, name):
    compare(spark, tables_in(skewed_dir), skewed_dir, name)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["pickup_date", "pickup_count"]
    assert df.count() > 0
