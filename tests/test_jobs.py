"""Whole jobs, run and rerun."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import moraine as m
from moraine import presets
from tests.landing import PATTERN, expected_orders, write_drift_folder
from tests.plans import plan_of, scans
from workload.staging import ORDERS_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


def run_ingest(spark, folder, table, location, **options):
    return m.ingest(
        spark, folder, PATTERN, ORDERS_SCHEMA, table, location, "o_orderdate", "order_date", **options
    )


def test_ingest_again_leaves_the_same_table(spark, database, tmp_path):
    write_drift_folder(str(tmp_path / "raw"))
    name, location = f"{database}.orders", str(tmp_path / "table")
    results = []
    for again in (False, True):
        result = run_ingest(
            spark, str(tmp_path / "raw"), name, location, replace_despite_rejects=again
        )
        results.append(sorted(tuple(r) for r in result.table.fillna("").collect()))
        assert result.rejects.count() == 1
    assert results[0] == results[1] and len(results[0]) == len(expected_orders())
    days = {row[4].date() for row in expected_orders()}
    assert result.partitions.count() == len(days)
    counted = m.daily_counts_sql(spark, name, "order_date", "n")
    assert counted.agg(F.sum("n")).first()[0] == len(expected_orders())
    assert result.table.columns[-1] == "order_date"


def test_partitions_are_not_replaced_while_a_file_is_rejected(spark, database, tmp_path):
    folder, name = tmp_path / "raw", f"{database}.orders"
    folder.mkdir()
    for i in (1, 2):
        raw = spark.createDataFrame([(i, dt.datetime(2024, 1, 5))], "o_orderkey bigint, o_orderdate timestamp_ntz")
        raw.coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        next((tmp_path / f"p{i}").glob("*.parquet")).rename(folder / f"orders_2024-0{i}.parquet")
    where = (spark, str(folder), name, str(tmp_path / "t"))
    assert run_ingest(*where).rejected == 0
    (folder / "orders_2024-02.parquet").write_text("not parquet")
    with pytest.raises(m.IncompletePartitions, match="2024-01-05"):
        run_ingest(*where)
    assert sorted(r.o_orderkey for r in spark.table(name).collect()) == [1, 2]
    with pytest.raises(m.IncompletePartitions):
        m.backfill(spark, f"{folder}/*.parquet", name, "o_orderdate", "order_date", on_reject="quarantine")
    assert sorted(r.o_orderkey for r in spark.table(name).collect()) == [1, 2]
    result = run_ingest(*where, replace_despite_rejects=True)
    assert [r.o_orderkey for r in result.table.collect()] == [1] and result.rejected == 1


@pytest.mark.parametrize("zone, offset_day", [("UTC", 4), ("Asia/Tokyo", 5)])
def test_one_event_time_one_date(spark, database, tmp_path, zone, offset_day):
    texts = ["2024-01-05 10:00:00", "2024-01-05 garbage", "99:00:00", "2024-01-05T02:00:00+05:00", None]
    raw = spark.createDataFrame(list(enumerate(texts)), "o_orderkey bigint, o_orderdate string")
    raw.coalesce(1).write.parquet(str(tmp_path / "raw" / "month=2024-01"))
    seconds = [(10, 1704448800), (11, None), (12, 1704412799)]
    for name, kind in (("02", "bigint"), ("03", "double"), ("04", "int")):
        raw = spark.createDataFrame(seconds, "o_orderkey bigint, s bigint")
        raw = raw.selectExpr("o_orderkey", f"cast(s as {kind}) as o_orderdate")
        raw.coalesce(1).write.parquet(str(tmp_path / "raw" / f"month=2024-{name}"))
    result = m.ingest(
        spark, str(tmp_path / "raw"), r"/month=\d{4}-\d{2}/[^/]+\.parquet$", ORDERS_SCHEMA,
        f"{database}.orders", str(tmp_path / "t"), "o_orderdate", "order_date",
        zone=zone, recursive=True, null_dates="keep",
    )
    rows = result.table.select("o_orderkey", F.unix_seconds("o_orderdate"), "order_date").collect()
    day = {r[0]: (r[2].day if r[2] else None) for r in rows}
    assert all((r[1] is None) == (r[2] is None) for r in rows) and len(rows) == 14
    assert {k: day[k] for k in range(5)} == {0: 5, 1: None, 2: None, 3: offset_day, 4: None}
    assert day[10] == 5 and day[11] is None and day[12] == (4 if zone == "UTC" else 5)


def test_backfill_without_a_shuffle_and_with_files_left_out(spark, database, tmp_path, monkeypatch):
    from moraine.catalog import tables
    from moraine.plans import backfill as job

    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, ts timestamp_ntz")
    rows.coalesce(1).write.parquet(str(tmp_path / "raw"))
    (tmp_path / "raw" / "zz.parquet").write_text("not parquet")
    name, glob = f"{database}.t", f"{tmp_path}/raw/*.parquet"
    m.declare_table(spark, f"{tmp_path}/raw/part*", name, str(tmp_path / "t"), "ts")
    hinted = []
    real = tables.cluster_for_write
    monkeypatch.setattr(tables, "cluster_for_write", lambda *a: hinted.append(1) or real(*a))
    with pytest.raises(ValueError, match="rejected"):
        job.backfill(spark, glob, name, "ts")
    counts = job.backfill(spark, glob, name, "ts", on_reject="quarantine", cluster=False, task_bytes="1m")
    assert counts.count() == 1 and not hinted
    job.backfill(spark, glob, name, "ts", on_reject="quarantine", replace_despite_rejects=True)
    assert hinted


def test_ingest_accounts_for_every_row(spark, database, tmp_path):
    rows = [(i, None if i % 5 == 0 else dt.datetime(2024, 1, 1 + i % 3)) for i in range(100)]
    raw = spark.createDataFrame(rows, "o_orderkey bigint, o_orderdate timestamp_ntz")
    raw.write.parquet(str(tmp_path / "raw" / "month=2024-01"))
    for nulls, count in (("drop", 80), ("keep", 100)):
        result = m.ingest(
            spark, str(tmp_path / "raw"), r"/month=\d{4}-\d{2}/[^/]+\.parquet$", ORDERS_SCHEMA,
            f"{database}.orders_{nulls}", str(tmp_path / nulls), "o_orderdate", "order_date",
            null_dates=nulls, recursive=True,
        )
        assert result.table.count() == count
        undated = result.table.where("order_date is null")
        assert undated.count() == count - 80
        assert undated.where("month is not null or day is not null").count() == 0


def test_ingest_of_an_empty_folder_declares_an_empty_table(spark, database, tmp_path):
    (tmp_path / "raw").mkdir()
    result = run_ingest(spark, str(tmp_path / "raw"), f"{database}.orders", str(tmp_path / "t"))
    assert result.table.count() == result.partitions.count() == result.rejects.count() == 0
    write_drift_folder(str(tmp_path / "raw"))
    result = run_ingest(spark, str(tmp_path / "raw"), f"{database}.orders", str(tmp_path / "t"))
    assert result.table.count() == len(expected_orders())


def test_ingest_of_a_missing_folder_raises(spark, database, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_ingest(spark, str(tmp_path / "nowhere"), f"{database}.orders", str(tmp_path / "t"))
    assert not spark.catalog.tableExists(f"{database}.orders")


def test_ingest_with_partitions_by_names_in_any_case(spark, database, tmp_path):
    write_drift_folder(str(tmp_path / "raw"))
    result = run_ingest(
        spark, f"file://{tmp_path}/raw", f"{database}.orders", f"file://{tmp_path}/t",
        partition_by=("YEAR", "Month"),
    )
    assert result.table.columns[-2:] == ["year", "month"]
    assert result.partitions.count() == 4 and result.table.count() == len(expected_orders())


def test_ingest_with_text_partitions(spark, database, tmp_path):
    write_drift_folder(str(tmp_path / "raw"))
    name = f"{database}.orders"
    result = run_ingest(spark, str(tmp_path / "raw"), name, str(tmp_path / "t"), date_type="string")
    assert result.table.schema["order_date"].dataType.simpleString() == "string"
    assert m.partition_equals(result.table, "order_date", "1995-01-05").count() == len(
        [r for r in expected_orders() if r[4].date() == dt.date(1995, 1, 5)]
    )


def test_ingest_can_be_told_to_stop_on_an_unreadable_file(spark, database, tmp_path):
    write_drift_folder(str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="1 of 5 files rejected"):
        run_ingest(
            spark, str(tmp_path / "raw"), f"{database}.o", str(tmp_path / "t"), on_reject="raise"
        )
    assert not spark.catalog.tableExists(f"{database}.o")


def test_ingest_takes_dates_from_the_stored_clock(spark, database, tmp_path, settings):
    settings("spark.sql.session.timeZone", "America/New_York")
    raw = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5, 23, 30)), (2, dt.datetime(2024, 1, 6, 0, 30))],
        "o_orderkey bigint, o_orderdate timestamp_ntz",
    )
    raw.write.parquet(str(tmp_path / "raw" / "month=2024-01"))
    result = m.ingest(
        spark, str(tmp_path / "raw"), r"/month=\d{4}-\d{2}/[^/]+\.parquet$", ORDERS_SCHEMA,
        f"{database}.orders", str(tmp_path / "t"), "o_orderdate", "order_date",
        zone="Asia/Tokyo", recursive=True,
    )
    rows = {r.o_orderkey: r.order_date for r in result.table.collect()}
    assert rows == {1: dt.date(2024, 1, 5), 2: dt.date(2024, 1, 6)}


def test_instants_stay_instants_where_timestamp_means_zone_less(spark, database, tmp_path, settings):
    settings("spark.sql.timestampType", "TIMESTAMP_NTZ")
    write_drift_folder(str(tmp_path / "raw"))
    name = f"{database}.orders"
    result = run_ingest(spark, str(tmp_path / "raw"), name, str(tmp_path / "t"))
    assert result.table.schema["o_orderdate"].dataType.typeName() == "timestamp"
    assert result.table.count() == len(expected_orders())
    events = m.normalize_ntz(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    assert events.schema["ts"].dataType.typeName() == "timestamp"


def test_backfill_needs_a_table(spark, database):
    with pytest.raises(ValueError, match="declare it first"):
        m.backfill(spark, f"{SF_DIR}/events.parquet", f"{database}.nowhere", "ts")


def test_backfill_keeps_undated_rows_unless_told_otherwise(spark, database, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 1, 5))]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, "id int, ts timestamp_ntz").write.parquet(path)
    name = f"{database}.t"
    m.declare_table(spark, path, name, str(tmp_path / "t"), "ts")
    kept = [tuple(r) for r in m.backfill(spark, f"{path}/*.parquet", name, "ts").collect()]
    assert kept == [(None, 1), (dt.date(2024, 1, 1), 2)]
    other = f"{database}.u"
    m.declare_table(spark, path, other, str(tmp_path / "u"), "ts")
    dropped = m.backfill(spark, f"{path}/*.parquet", other, "ts", null_dates="drop")
    assert [tuple(r) for r in dropped.collect()] == [(dt.date(2024, 1, 1), 2)]


def test_backfill_reads_files_that_drift(spark, database, tmp_path):
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id bigint, ts timestamp_ntz").write.parquet(
        str(tmp_path / "raw" / "a")
    )
    spark.createDataFrame([(2.0, dt.datetime(2024, 1, 2))], "id double, ts timestamp_ntz").write.parquet(
        str(tmp_path / "raw" / "b")
    )
    name = f"{database}.t"
    m.declare_table(spark, str(tmp_path / "raw" / "a"), name, str(tmp_path / "t"), "ts")
    m.backfill(spark, str(tmp_path / "raw" / "*" / "*.parquet"), name, "ts")
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2]


def test_declared_table_has_the_columns_of_the_files(spark, database, tmp_path):
    name = f"{database}.events"
    schema = m.declare_table(spark, f"{SF_DIR}/events.parquet", name, str(tmp_path / "t"), "ts")
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"),
        ("value", "double"), ("props", "string"), ("year", "string"), ("month", "string"),
        ("day", "string"), ("pickup_date", "date"),
    ]
    assert spark.table(name).count() == 0


def test_saved_rows(spark, database, tmp_path):
    name = f"{database}.sales_data"
    for _ in range(2):
        df = m.save_rows(
            spark, presets.SALES_ROWS, presets.SALES_SCHEMA, name, str(tmp_path / "sales")
        )
        assert sorted(tuple(r) for r in df.collect()) == presets.SALES_ROWS
    assert df.schema == presets.SALES_SCHEMA


def trip_files(spark, folder):
    """Trip files of two months: one as the schema says, one narrower and spelled otherwise."""
    def row(i, month):
        return {
            "VendorID": i, "tpep_pickup_datetime": dt.datetime(2021, month, 1 + i, 8),
            "passenger_count": float(i), "PULocationID": i, "payment_type": 1, "fare_amount": 2.5,
        }
    early = spark.createDataFrame(
        [tuple(row(i, 1).values()) for i in range(4)],
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, passenger_count double,"
        " PULocationID bigint, payment_type bigint, fare_amount double",
    ).withColumn("Airport_fee", F.lit(1.25))
    late = early.select(
        F.col("VendorID").cast("int"),
        (F.col("tpep_pickup_datetime") + F.expr("interval 31 days")).alias("tpep_pickup_datetime"),
        F.col("passenger_count").cast("bigint"),
        F.lit(0.75).alias("cbd_congestion_fee"),
    )
    for df, month in ((early, "2021-01"), (late, "2021-02")):
        df.toPandas().astype({"tpep_pickup_datetime": "datetime64[us]"}).to_parquet(
            f"{folder}/yellow_tripdata_{month}.parquet"
        )


def test_trip_files_from_folder_to_counts(spark, database, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    trip_files(spark, raw)
    (raw / "yellow_tripdata_2021-3.parquet").write_text("other name")
    name = f"{database}.trips"
    result = m.ingest(
        spark, str(raw), presets.TRIP_FILE_PATTERN, presets.TRIP_SCHEMA, name, str(tmp_path / "t"),
        presets.TRIP_TIME_COLUMN, date_type="string",
    )
    assert result.table.columns == [
        *presets.TRIP_SCHEMA.fieldNames(), "year", "month", "day", presets.TRIP_DATE_COLUMN
    ]
    assert len(presets.TRIP_SCHEMA) == 20
    rows = result.table.orderBy("tpep_pickup_datetime").collect()
    assert [r.airport_fee for r in rows] == [1.25] * 4 + [None] * 4
    assert [r.cbd_congestion_fee for r in rows] == [None] * 4 + [0.75] * 4
    assert [r.passenger_count for r in rows] == [0.0, 1.0, 2.0, 3.0] * 2
    counts = [tuple(r) for r in m.daily_counts_sql(spark, name).collect()]
    assert counts[0] == ("2021-01-01", 1) and len(counts) == 8
    preview = m.typed_preview(
        spark, f"{raw}/yellow_tripdata_2021-01.parquet", presets.TRIP_TIME_COLUMN,
        {k: v for k, v in presets.TRIP_PREVIEW_TYPES.items() if k != "RatecodeID" and k != "DOLocationID"},
    )
    assert preview.schema["passenger_count"].dataType.simpleString() == "int"
    assert preview.first().pickup_date == dt.date(2021, 1, 1)


def test_preview_scans_once_without_a_shuffle(spark):
    kinds = {"l_quantity": "int"}
    df = m.typed_preview(spark, f"{SF_DIR}/lineitem.parquet", "l_shipdate", kinds)
    plan = plan_of(df.select("l_quantity", "pickup_date", "month"))
    assert scans(plan) == 1 and "Exchange" not in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_top_rows_need_no_full_sort(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = plan_of(m.preview(events, 5, ("event_id",)))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert [r.event_id for r in m.preview(events, 5, ("EVENT_ID",)).collect()] == [0, 1, 2, 3, 4]


def test_daily_counts_push_the_null_test_and_count_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    plan = plan_of(m.daily_counts(m.derive_date_columns(events, "ts")))
    assert "PushedFilters: [IsNotNull(ts)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
    assert "partial_count(1)" in plan
