"""Listing, probing, grouping and conforming drifting files."""

import os

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import moraine as m
from moraine.sources import conformed
from moraine.sources.conformed import conform_union, group_by_types
from tests.landing import PATTERN, expected_orders, write_drift_folder
from tests.plans import line_of, plan_of, scans
from workload.staging import ORDERS_SCHEMA


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing"))
    write_drift_folder(path)
    return path


def paths_in(spark, folder):
    return m.collect_paths(m.list_landing_files(spark, folder, PATTERN))


def test_listing_selects_by_name_and_reads_no_contents(spark, folder):
    listing = m.list_landing_files(spark, folder, PATTERN)
    names = [os.path.basename(path) for path in m.collect_paths(listing)]
    assert names == [f"orders_1995-0{i}.parquet" for i in range(1, 6)]
    assert line_of(plan_of(listing), "ReadSchema:") == ["struct<path:string>"]
    assert m.list_landing_files(spark, folder).count() == 8


def test_listing_goes_into_subfolders_only_when_asked(spark, tmp_path):
    for month in ("2024-01", "2024-02"):
        spark.range(3).write.parquet(str(tmp_path / f"month={month}"))
    pattern = r"/month=\d{4}-\d{2}/[^/]+\.parquet$"
    assert m.list_landing_files(spark, str(tmp_path), pattern, recursive=True).count() >= 2
    assert m.list_landing_files(spark, str(tmp_path), pattern).columns == ["path"]


def test_conform_union_of_drifting_files(spark, folder):
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    got = files.df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
    rows = [tuple(r) for r in got.orderBy("o_orderkey", "o_orderdate").collect()]
    assert rows == expected_orders()
    assert files.df.schema == ORDERS_SCHEMA
    rejects = files.rejects.collect()
    assert [os.path.basename(r.path) for r in rejects] == ["orders_1995-05.parquet"]
    assert rejects[0].reason.startswith("FAILED_READ_FILE")


def test_one_scan_per_set_of_types_not_per_file(spark, folder):
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    assert [len(group.paths) for group in files.groups] == [2, 1, 1]
    plan = plan_of(files.df)
    assert scans(plan) == 3
    assert "extra_col" not in plan and "Python" not in plan


def test_pruning_and_filters_reach_the_scans(spark, folder):
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    plan = plan_of(files.df.where("o_orderkey = 17").select("o_orderstatus"))
    assert len(line_of(plan, "PushedFilters:")) == 3
    assert all("EqualTo(o_orderkey,17)" in line for line in line_of(plan, "PushedFilters:"))
    read = [sorted(line[len("struct<") : -1].split(",")) for line in line_of(plan, "ReadSchema:")]
    assert read == [["o_orderkey:bigint", "o_orderstatus:string"]] * 3


def test_day_filter_on_the_union_prunes_each_scan(spark, folder):
    files = conform_union(
        spark, paths_in(spark, folder), ORDERS_SCHEMA, event_date=("o_orderdate", "day")
    )
    plan = plan_of(m.partition_equals(files.df, "day", "1995-02-03").select("o_orderkey"))
    pushed = line_of(plan, "PushedFilters:")
    assert len(pushed) == 3
    assert all("GreaterThanOrEqual(o_orderdate,1995-02-03T00:00)" in line for line in pushed)
    assert all("LessThan(o_orderdate,1995-02-04T00:00)" in line for line in pushed)


def test_many_files_of_one_schema_are_one_scan_and_no_probe(spark, tmp_path, monkeypatch):
    spark.range(60).repartition(30).write.parquet(str(tmp_path / "a"))
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path / "a"), r"\.parquet$"))
    probes = []
    real = conformed._merged_schema
    monkeypatch.setattr(
        conformed, "_merged_schema", lambda s, p: probes.append(len(p)) or real(s, p)
    )
    schema = T.StructType([T.StructField("id", T.LongType())])
    files = conform_union(spark, paths, schema)
    assert len(paths) == 30 and probes == []
    assert scans(plan_of(files.df)) == 1
    assert files.df.agg(F.sum("id")).first()[0] == sum(range(60))


def probes_of(spark, monkeypatch, folder, kinds):
    """Write a file for each kind, conform them, and count the schema jobs."""
    folder.mkdir()
    for kind in set(kinds):
        spark.sql(f"SELECT cast(1 as {kind}) AS v").coalesce(1).write.parquet(str(folder / f"_{kind}"))
    for n, kind in enumerate(kinds):
        source = next((folder / f"_{kind}").glob("*.parquet"))
        (folder / f"{n:03}.parquet").write_bytes(source.read_bytes())
    paths = [str(folder / f"{n:03}.parquet") for n in range(len(kinds))]
    probes, real = [], conformed._merged_schema
    monkeypatch.setattr(conformed, "_merged_schema", lambda s, p: probes.append(len(p)) or real(s, p))
    files = conform_union(spark, paths, T.StructType([T.StructField("v", T.DoubleType())]))
    assert files.df.agg(F.sum("v")).first()[0] == len(kinds)
    return sorted(len(group.paths) for group in files.groups), len(probes)


def test_number_of_probes_follows_the_kinds_of_files(spark, monkeypatch, tmp_path):
    drift = ["int"] * 30 + ["bigint"] * 20 + ["double"] * 10
    assert probes_of(spark, monkeypatch, tmp_path / "a", drift) == ([10, 20, 30], 0)


def test_files_of_other_writers_take_a_probe_for_each_kind(spark, monkeypatch, tmp_path):
    paths = []
    for n in range(12):
        kind = ("INTEGER", "DOUBLE", "VARCHAR")[n % 3]
        paths.append(f"{tmp_path}/{n}.parquet")
        duckdb.connect().execute(f"COPY (SELECT CAST({n} AS {kind}) AS v) TO '{paths[-1]}' (FORMAT parquet)")
    probes, real = [], conformed._merged_schema
    monkeypatch.setattr(conformed, "_merged_schema", lambda s, p: probes.append(len(p)) or real(s, p))
    files = conform_union(spark, paths, T.StructType([T.StructField("v", T.DoubleType())]))
    assert probes == [1, 1, 1] and files.df.agg(F.sum("v")).first()[0] == sum(range(12))


def test_no_footer_is_opened_by_the_driver(spark, folder, monkeypatch):
    monkeypatch.delattr(conformed, "_footer_reader")
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    assert files.df.count() == len(expected_orders()) and files.rejected == 1


def test_kinds_that_alternate_take_fewer_jobs_than_files(spark, monkeypatch, tmp_path):
    assert probes_of(spark, monkeypatch, tmp_path / "a", ["int", "double"] * 48) == ([48, 48], 0)


def test_columns_outside_the_schema_do_not_split_groups(spark, tmp_path):
    spark.range(2).selectExpr("id", "1 as note").write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("id", "'x' as note").write.parquet(str(tmp_path / "b"))
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path), r"\.parquet$", recursive=True))
    schema = T.StructType([T.StructField("id", T.LongType())])
    files = conform_union(spark, paths, schema)
    assert len(files.groups) == 1 and files.df.count() == 4


def test_decimals_of_growing_precision_share_a_scan(spark, tmp_path):
    for name, kind in (("a", "decimal(5,2)"), ("b", "decimal(20,2)"), ("c", "decimal(9,4)")):
        spark.range(1, 3).selectExpr(f"cast(id + 0.25 as {kind}) as fee").write.parquet(str(tmp_path / name))
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path), r"\.parquet$", recursive=True))
    schema = T.StructType([T.StructField("fee", T.DoubleType())])
    files = conform_union(spark, paths, schema)
    assert files.rejects.count() == 0
    assert sorted(r.fee for r in files.df.collect()) == [1.25] * 3 + [2.25] * 3


def test_timestamps_of_both_kinds(spark, tmp_path):
    for name, kind in (("a", "timestamp_ntz"), ("b", "timestamp"), ("c", "date"), ("d", "string")):
        spark.sql(f"SELECT cast({kind.split('_')[0] if kind != 'string' else ''} '2024-01-05' as {kind}) AS ts").write.parquet(
            str(tmp_path / name)
        )
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path), r"\.parquet$", recursive=True))
    schema = T.StructType([T.StructField("ts", T.TimestampType())])
    files = conform_union(spark, paths, schema, event_date=("ts", "day"))
    assert files.rejects.count() == 0 and len(files.groups) == 4
    rows = files.df.select(F.unix_seconds("ts"), F.col("day").cast("string")).collect()
    assert [tuple(r) for r in rows] == [(1704412800, "2024-01-05")] * 4


def test_glob_over_drifting_types_raises_before_the_scan(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("cast(id as double) as id").write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):
        m.scan_glob(spark, str(tmp_path / "*"))


def test_glob_reads_columns_only_some_files_have(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("id", "id as more").write.parquet(str(tmp_path / "b"))
    df = m.scan_glob(spark, str(tmp_path / "*"))
    assert df.columns == ["id", "more"] and df.where("more is null").count() == 2


def test_glob_with_a_known_schema_reads_no_footers_first(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    (tmp_path / "a" / "z.parquet").write_text("not parquet")
    schema = T.StructType([T.StructField("id", T.LongType())])
    df = m.scan_glob(spark, str(tmp_path / "a" / "part*"), schema)
    assert df.schema == schema and df.count() == 2
    assert m.scan_glob(spark, str(tmp_path / "a"), schema).columns == ["id"]


def test_file_that_no_cast_can_save_is_rejected(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(2).selectExpr("array(id) as id").write.parquet(str(tmp_path / "b"))
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path), r"\.parquet$", recursive=True))
    schema = T.StructType([T.StructField("id", T.LongType())])
    files = conform_union(spark, paths, schema)
    assert files.df.count() == 2
    reasons = {r.reason.split(":")[0] for r in files.rejects.collect()}
    assert reasons == {"DATATYPE_MISMATCH.CAST_WITHOUT_SUGGESTION"}
    with pytest.raises(ValueError, match="rejected"):
        conform_union(spark, paths, schema, on_reject="raise")


def test_file_with_names_that_clash_is_rejected(spark, tmp_path, settings):
    settings("spark.sql.caseSensitive", "true")
    spark.range(1).selectExpr("id as fee", "id as Fee").coalesce(1).write.parquet(str(tmp_path / "a"))
    settings("spark.sql.caseSensitive", "false")
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path / "a"), r"\.parquet$"))
    files = conform_union(spark, paths, T.StructType([T.StructField("fee", T.LongType())]))
    assert files.df.count() == 0
    assert {r.reason.split(":")[0] for r in files.rejects.collect()} == {"COLUMN_ALREADY_EXISTS"}


def test_case_sensitive_sessions_lose_no_data(spark, folder, settings):
    settings("spark.sql.caseSensitive", "true")
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    assert files.df.where("o_totalprice is null").count() == 0
    assert files.df.count() == len(expected_orders())


FAULTS = [
    "com.amazonaws.AWSServiceThrottledException: SlowDown 503",
    "org.apache.hadoop.fs.s3a.AWSStatus500Exception: Internal Error",
    "javax.net.ssl.SSLException: handshake",
    "java.net.SocketException: Connection reset",
    "java.net.SocketTimeoutException: gone",
    "java.nio.file.AccessDeniedException: gone",
    "org.apache.hadoop.hdfs.BlockMissingException: no block",
    "software.amazon.awssdk.core.exception.SdkClientException: Unable to load credentials",
    "java.io.FileNotFoundException: gone",
    "org.apache.parquet.crypto.ParquetCryptoRuntimeException: No keys available",
    "java.io.IOException: something nobody has thought of",
]


@pytest.mark.parametrize("fault", FAULTS)
def test_faults_that_are_not_the_files_are_raised(spark, monkeypatch, fault):
    def broken(_, paths):
        raise AnalysisException(
            f"[FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER] Could not read footer.\nCaused by: {fault}"
        )

    monkeypatch.setattr(conformed, "_merged_schema", broken)
    with pytest.raises(AnalysisException, match="Could not read footer"):
        conform_union(spark, ["a", "b"], ORDERS_SCHEMA)


def test_faults_met_while_footers_are_sorted_are_raised(spark, folder):
    paths = [*paths_in(spark, folder)]
    folder_path = os.path.dirname(paths[0]).removeprefix("file:")
    with pytest.raises(Exception, match="gone.parquet"):
        conformed._footer_reader(spark)(f"{folder_path}/gone.parquet")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        conform_union(spark, [*paths, f"{folder_path}/gone.parquet"], ORDERS_SCHEMA)


def test_damaged_files_are_set_aside(spark, tmp_path):
    spark.range(5000).selectExpr("id", "xxhash64(id) as v").coalesce(1).write.parquet(str(tmp_path / "sound"))
    sound = next((tmp_path / "sound").glob("*.parquet"))
    data = sound.read_bytes()
    damaged = {
        "empty": b"",
        "tiny": b"PAR",
        "text": b"hello, this is no parquet file",
        "cut": data[: len(data) // 2],
        "magic": data[:-4] + b"XXXX",
        "length": data[:-8] + b"\xff\xff\xff\x7f" + data[-4:],
    }
    for name, content in damaged.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    paths = [str(sound), *(str(tmp_path / f"{name}.parquet") for name in damaged)]
    files = conform_union(spark, paths, T.StructType([T.StructField("id", T.LongType())]))
    assert files.rejected == files.rejects.count() == len(damaged) and files.df.count() == 5000
    assert {r.reason.split(":")[0] for r in files.rejects.collect()} == {
        "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER"
    }


def test_corrupt_footer_is_seen_even_when_scans_ignore_corrupt_files(spark, folder, settings):
    settings("spark.sql.files.ignoreCorruptFiles", "true")
    files = conform_union(spark, paths_in(spark, folder), ORDERS_SCHEMA)
    assert files.rejects.count() == 1 and files.df.count() == len(expected_orders())


def test_damage_behind_a_sound_footer_fails_the_job(spark, tmp_path, settings):
    settings("spark.sql.files.ignoreCorruptFiles", "true")
    spark.range(100_000).selectExpr("id", "xxhash64(id) as v").coalesce(1).write.parquet(str(tmp_path / "sound"))
    file = next((tmp_path / "sound").glob("*.parquet"))
    data = bytearray(file.read_bytes())
    data[4:200_000] = bytes(199_996)
    damaged = tmp_path / "damaged"
    damaged.mkdir()
    (damaged / "a.parquet").write_bytes(data)
    schema = T.StructType([T.StructField("v", T.LongType())])
    files = conform_union(spark, [str(damaged / "a.parquet")], schema)
    assert files.rejects.count() == 0
    with pytest.raises(Exception):
        files.df.agg(F.sum("v")).collect()


def test_no_files_give_an_empty_frame_of_the_schema(spark):
    files = conform_union(spark, [], ORDERS_SCHEMA, event_date=("o_orderdate", "day"))
    assert files.df.columns == [*ORDERS_SCHEMA.fieldNames(), "day"]
    assert files.df.count() == 0 and files.rejects.count() == 0


def test_file_without_any_wanted_column_gives_rows_of_nulls(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    paths = m.collect_paths(m.list_landing_files(spark, str(tmp_path / "a"), r"\.parquet$"))
    files = conform_union(spark, paths, T.StructType([T.StructField("fee", T.LongType())]))
    assert [r.fee for r in files.df.collect()] == [None] * 3


def test_paths_with_wildcard_characters_are_taken_as_they_are(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "a"))
    source = next((tmp_path / "a").glob("*.parquet"))
    target = tmp_path / "odd"
    target.mkdir()
    (target / "orders [1] {a} *.parquet").write_bytes(source.read_bytes())
    paths = m.collect_paths(m.list_landing_files(spark, str(target), r"\.parquet$"))
    files = conform_union(spark, paths, T.StructType([T.StructField("id", T.LongType())]))
    assert files.df.count() == 3 and files.rejects.count() == 0


def test_literal_rows(spark):
    from moraine.presets import SALES_ROWS, SALES_SCHEMA

    df = m.literal_rows(spark, SALES_ROWS, SALES_SCHEMA)
    assert df.schema == SALES_SCHEMA and [tuple(r) for r in df.collect()] == SALES_ROWS


KINDS = [T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]
NAMES = ["a", "b", "c"]
spelled = st.sampled_from([str.lower, str.upper])
file_schemas = st.lists(
    st.dictionaries(
        st.sampled_from([*NAMES, "extra"]), st.tuples(spelled, st.sampled_from(KINDS)), min_size=1
    ),
    min_size=1,
    max_size=12,
)


def struct_of(columns):
    return T.StructType([T.StructField(case(name), kind) for name, (case, kind) in columns.items()])


@given(file_schemas, st.booleans())
def test_groups_hold_every_file_once_and_agree_on_types(schemas, case_sensitive):
    wanted = T.StructType([T.StructField(name, T.DoubleType()) for name in NAMES])
    probed = [(struct_of(columns), [str(i)]) for i, columns in enumerate(schemas)]
    groups = group_by_types(probed, wanted, case_sensitive)
    assert sorted(p for g in groups for p in g.paths) == sorted(str(i) for i in range(len(schemas)))
    for group in groups:
        for path in group.paths:
            for field in struct_of(schemas[int(path)]):
                if field.name.lower() in NAMES:
                    of_group = group.fields[field.name.lower()]
                    assert of_group.dataType == field.dataType
                    assert not case_sensitive or of_group.name == field.name


@hypothesis_settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(file_schemas)
def test_conform_union_equals_conforming_each_file(spark, tmp_path_factory, schemas):
    """Any mix of files gives the rows that come of reading and casting them one by one."""
    folder = tmp_path_factory.mktemp("mixed")
    casts = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR"}
    expected, paths = [], []
    for i, columns in enumerate(schemas):
        selected = ", ".join(
            f"CAST({10 * i} + n AS {casts[type(kind).__name__]}) AS \"{case(name)}\""
            for name, (case, kind) in columns.items()
        )
        paths.append(f"{folder}/{i}.parquet")
        duckdb.connect().execute(
            f"COPY (SELECT {selected} FROM range(3) AS r(n)) TO '{paths[-1]}' (FORMAT parquet)"
        )
        expected += [
            tuple(float(10 * i + n) if name in columns else None for name in NAMES) for n in range(3)
        ]
    wanted = T.StructType([T.StructField(name, T.DoubleType()) for name in NAMES])
    files = conform_union(spark, paths, wanted)
    assert files.rejects.count() == 0
    assert sorted(map(tuple, files.df.collect()), key=repr) == sorted(expected, key=repr)
