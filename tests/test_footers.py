"""Footers as rows, and the sorting of files by them."""

import json
import time

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import moraine as m
from moraine.settings import PARQUET_SETTINGS
from moraine.sources import conformed, footers
from tests.landing import PATTERN, expected_orders, write_drift_folder
from workload.staging import ORDERS_SCHEMA


def written(spark, folder, sql):
    spark.sql(sql).coalesce(1).write.parquet(str(folder))
    return str(next(folder.glob("*.parquet")))


def test_a_row_for_each_row_group_and_column(spark, tmp_path):
    path = f"{tmp_path}/a.parquet"
    duckdb.connect().execute(
        f"COPY (SELECT i, i::VARCHAR AS t, NULL::DATE AS d FROM range(5000) r(i))"
        f" TO '{path}' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
    )
    rows = footers.read_footers(spark, [path]).orderBy("row_group", "column").collect()
    assert [(r.row_group, r.column) for r in rows] == [(g, c) for g in range(3) for c in "dit"]
    numbers = [r for r in rows if r.column == "i"]
    assert [(r.rows, r.least, r.most, r.nulls) for r in numbers] == [
        (2048, "0", "2047", 0),
        (2048, "2048", "4095", 0),
        (904, "4096", "4999", 0),
    ]
    assert {r.physical_type for r in rows} == {"INT64", "BYTE_ARRAY", "INT32"}
    assert all(r.nulls == r.rows and r.least is None for r in rows if r.column == "d")
    assert footers.read_footers(spark, [path], ["I"]).count() == 3


def test_times_are_text_that_casts_back(spark, tmp_path, settings):
    for key, value in PARQUET_SETTINGS.items():
        settings(key, value)
    day = "2024-01-05 23:30:00.000001"
    for kind in ("timestamp", "timestamp_ntz", "date"):
        path = written(spark, tmp_path / kind, f"SELECT CAST('{day}' AS {kind}) AS v")
        row = footers.read_footers(spark, [path])
        stated = row.select(F.col("least").cast(kind).alias("v")).first().v
        assert stated == spark.read.parquet(path).first().v


def test_files_without_rows_and_damaged_files_have_one_row(spark, tmp_path):
    empty = written(spark, tmp_path / "empty", "SELECT 1 AS v WHERE false")
    (tmp_path / "bad.parquet").write_text("no parquet")
    paths = [empty, str(tmp_path / "bad.parquet"), str(tmp_path / "gone.parquet")]
    rows = {r.path: r for r in footers.read_footers(spark, paths).collect()}
    assert len(rows) == 3 and rows[empty].rows == 0 and rows[empty].problem is None
    assert rows[paths[1]].problem.startswith("ArrowInvalid")
    assert rows[paths[2]].problem.startswith("FileNotFoundError")


def test_kinds_carry_the_schema_of_spark_once_a_task(spark, tmp_path):
    path = written(spark, tmp_path / "a", "SELECT 1 AS v, timestamp_ntz '2024-01-01' AS t")
    rows = footers.footer_kinds(spark, [path]).collect()
    assert T.StructType.fromJson(json.loads(rows[0].row_schema)).simpleString() == "struct<v:int,t:timestamp_ntz>"
    assert footers.footer_kinds(spark, []).count() == 0


def test_odd_names_and_uris(spark, tmp_path):
    target = tmp_path / "odd ä%20 [1]"
    target.mkdir()
    source = written(spark, tmp_path / "a", "SELECT 7 AS v")
    with open(source, "rb") as file:
        (target / "x +%41.parquet").write_bytes(file.read())
    listed = m.collect_paths(m.list_landing_files(spark, conformed.literal_path(str(target))))
    for paths in (listed, [str(target / "x +%41.parquet")], [p.replace("file:/", "file:///") for p in listed]):
        assert [r.problem for r in footers.footer_kinds(spark, paths).collect()] == [None]


@pytest.fixture
def mounted(spark, tmp_path):
    """A folder under a mount table, which only the JVM's file systems know."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    key = "fs.viewfs.mounttable.lake.link./landing"
    write_drift_folder(str(tmp_path / "landing"))
    hadoop.set(key, f"file://{tmp_path}/landing")
    yield "viewfs://lake/landing"
    hadoop.unset(key)


def test_mounted_folders_are_resolved(spark, mounted, tmp_path):
    paths = m.collect_paths(m.list_landing_files(spark, mounted, PATTERN))
    assert all(path.startswith("viewfs://lake/") for path in paths) and len(paths) == 5
    places = footers.resolved(spark, paths)
    assert all(place.startswith("file:") for place in places.values())
    files = m.conform_union(spark, paths, ORDERS_SCHEMA)
    assert files.df.count() == len(expected_orders()) and files.rejected == 1


def test_file_systems_that_tasks_cannot_open(spark, mounted, monkeypatch):
    """The driver reads the footers; what comes out is the same."""
    monkeypatch.setattr("moraine.sources.conformed.readable_by_tasks", lambda paths: False)
    paths = m.collect_paths(m.list_landing_files(spark, mounted, PATTERN))
    files = m.conform_union(spark, paths, ORDERS_SCHEMA)
    assert files.df.count() == len(expected_orders()) and files.rejected == 1
    assert not footers.readable_by_tasks(["viewfs://lake/x"]) and footers.readable_by_tasks(["s3a://b/x", "/x", "hdfs://n/x"])


def test_store_options(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    given = {"fs.s3a.endpoint": "http://store:9000", "fs.s3a.access.key": "a", "fs.s3a.secret.key": "b", "fs.s3a.connection.ssl.enabled": "false"}
    before = {key: hadoop.get(key) for key in given}
    for key, value in given.items():
        hadoop.set(key, value)
    try:
        found = footers.store_options(spark)
        assert found["endpoint_override"] == "store:9000" and found["scheme"] == "http"
        assert (found["access_key"], found["secret_key"]) == ("a", "b")
    finally:
        for key, value in before.items():
            hadoop.unset(key) if value is None else hadoop.set(key, value)


def test_thousands_of_files_in_three_kinds(spark, tmp_path):
    sources = [written(spark, tmp_path / kind, f"SELECT cast(1 AS {kind}) AS v") for kind in ("int", "double", "string")]
    contents = [open(source, "rb").read() for source in sources]
    for n in range(3000):
        (tmp_path / f"{n:05}.parquet").write_bytes(contents[n % 3])
    paths = [f"{tmp_path}/{n:05}.parquet" for n in range(3000)]
    m.conform_union(spark, paths[:30], T.StructType([T.StructField("v", T.DoubleType())]))
    start = time.perf_counter()
    files = m.conform_union(spark, paths, T.StructType([T.StructField("v", T.DoubleType())]))
    assert time.perf_counter() - start < 15 and len(files.groups) == 3
    assert files.df.agg(F.sum("v")).first()[0] == 3000
