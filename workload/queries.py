"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import moraine as m
from moraine.functions.names import column
from moraine.presets import SALES_ROWS, SALES_SCHEMA
from moraine.settings import PARQUET_SETTINGS, scoped_settings
from workload.scratch import mount_folders, new_database, new_folder
from workload.staging import (
    MONTH_FILES,
    ORDERS_FILES,
    ORDERS_SCHEMA,
    events_by_day,
    lake,
    landing_zone,
    table,
    time_text,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def with_micros(df: DataFrame, time: str = "ts") -> DataFrame:
    """All columns, the time as microseconds, so that engines agree on its spelling."""
    return df.withColumn(time, F.unix_micros(F.col(time).cast("timestamp")))


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- sources ------------------------------------------------------------------------------------


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_micros(m.scan_parquet(spark, f"{sf_dir}/events.parquet"))


@query
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = f"{lake(spark, sf_dir).folder}/files-events/pickup_date=*/*.parquet"
    return with_micros(m.scan_glob(spark, files))


@query
def list_landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = m.list_landing_files(spark, landing_zone(spark, sf_dir), ORDERS_FILES, recursive=True)
    return files.select(F.regexp_extract("path", r"month=([\d-]+)/", 1).alias("month")).distinct()


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").cast("string").alias("sale_date"),
    )
    return m.union_by_name([orders, m.literal_rows(spark, SALES_ROWS, SALES_SCHEMA)])


@query
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir)


@query
def save_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample rows next to rows of the largest order of each priority."""
    database, folder = new_database(spark, "rows")
    largest = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.max("o_totalprice").alias("amount"), F.max(F.to_date("o_orderdate")).alias("day")
    )
    # One row for each of the few priorities; what is saved is written out in the program.
    rows = [(r.o_orderpriority, r.amount, str(r.day)) for r in largest.collect()]
    saved = [*SALES_ROWS, *rows]
    return m.save_rows(spark, saved, SALES_SCHEMA, f"{database}.sales", f"{folder}/files-sales")


# --- projections --------------------------------------------------------------------------------


@query
def normalize_ntz(spark: SparkSession, sf_dir: str) -> DataFrame:
    instants = m.normalize_ntz(table(spark, sf_dir, "events"), "UTC")
    return with_micros(instants)


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which the errors have lost their time."""
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    return table(spark, sf_dir, "events").withColumn("ts", known)


@query
def derive_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = m.derive_date_columns(events_with_gaps(spark, sf_dir), "ts", null_dates="keep")
    return with_micros(dated)


@query
def text_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as text, some with an offset and some spoilt, dated by both ways there are."""
    orders = table(spark, sf_dir, "orders")
    written = orders.select("o_orderkey", time_text(F.col("o_orderdate"), F.col("o_orderkey")).alias("at"))
    dated = m.derive_date_columns(written, "at", "order_date", null_dates="keep")
    kinds = {"o_orderkey": "long", "at": "timestamp", "order_date": "date"}
    kinds |= {"year": "string", "month": "string", "day": "string"}
    schema = T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in kinds.items()])
    conformed = m.conform_to_schema(dated, schema, event_date=("at", "conformed_date"))
    return conformed.withColumn("micros", F.unix_micros("at")).drop("at")


@query
def missing_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is not there is not replaced by another one: the error says so."""
    events = table(spark, sf_dir, "events")
    try:
        m.derive_date_columns(events.withColumnRenamed("ts", "event_time"), "ts")
        outcome = "dated"
    except ValueError as error:
        outcome = "raised" if "ts" in str(error) else "raised something else"
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return counted.withColumn("outcome", F.lit(outcome))


@query
def date_parts_substr(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = m.date_parts_by_substring(F.to_date("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", *[part.alias(name) for name, part in parts.items()]
    )


@query
def safe_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # Days 1 to 50 of months 1 to 7: some of these texts are dates and some are not.
    text = F.concat(
        F.year("l_shipdate").cast("string"),
        F.lit("-"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0"),
    )
    texts = lines.select("l_orderkey", "l_partkey", text.alias("date_text"))
    parsed = m.safe_date(F.col("date_text"), T.StringType(), "yyyy-MM-dd")
    return texts.withColumn("parsed_date", parsed)


@query
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        (F.col("value") * 1e8).alias("large_value"),
        F.col("user_id").alias("user_no"),
    )
    kinds = {"value": "int", "large_value": "int", "user_no": "int"}
    return m.cast_columns(events, kinds)


@query
def conform_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = T.StructType(
        [
            T.StructField("O_TOTALPRICE", T.DoubleType()),
            T.StructField("o_custkey", T.DoubleType()),
            T.StructField("o_discount", T.DoubleType()),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_orderkey", T.StringType()),
        ]
    )
    return m.conform_to_schema(table(spark, sf_dir, "orders"), wanted)


@query
def align_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{lake(spark, sf_dir).database}.events"
    events = events_by_day(spark, sf_dir)
    shuffled = events.select(*[column(c).alias(c.upper()) for c in sorted(events.columns)])
    aligned = m.align_to_table(shuffled, name)
    # The position of a column is part of the result, so it is checked along with the rows.
    order = F.lit(",".join(aligned.columns)).alias("column_order")
    return with_micros(aligned.select("*", order))


@query
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    clicks = events.where(F.col("event_type") == "click")
    return with_micros(m.union_by_name([events, clicks.select(*reversed(events.columns))]))


# --- filters and checks -------------------------------------------------------------------------


@query
def drop_null_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = events_with_gaps(spark, sf_dir).withColumn("pickup_date", F.to_date("ts"))
    return with_micros(m.drop_null_dates(dated, "pickup_date"))


@query
def partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.table(f"{lake(spark, sf_dir).database}.events")
    return with_micros(m.partition_equals(events, "pickup_date", "2024-01-05"))


@query
def timestamp_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return with_micros(m.partition_equals(events, "ts", "2024-01-05"))


@query
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.daily_counts(m.derive_date_columns(table(spark, sf_dir, "events"), "ts"))


@query
def daily_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.daily_counts_sql(spark, f"{lake(spark, sf_dir).database}.events")


@query
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_micros(m.preview(table(spark, sf_dir, "events"), 10, ("event_id",)))


# --- conformed files ----------------------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str):
    listing = m.list_landing_files(spark, landing_zone(spark, sf_dir), MONTH_FILES, recursive=True)
    return m.conform_union(spark, m.collect_paths(listing), ORDERS_SCHEMA)


def with_order_micros(df: DataFrame) -> DataFrame:
    instant = F.unix_micros("o_orderdate").alias("order_micros")
    return df.select("*", instant).drop("o_orderdate")


@query
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_order_micros(landed(spark, sf_dir).df)


@query
def quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = landed(spark, sf_dir).rejects
    return rejects.select(
        F.regexp_extract("path", r"/(\w+)/month=", 1).alias("feed"),
        F.regexp_extract("path", r"month=([\d-]+)/", 1).alias("month"),
        F.regexp_extract("reason", r"^(\w+)", 1).alias("reason"),
    ).distinct()


# --- sinks and catalog --------------------------------------------------------------------------


@query
def save_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = new_database(spark, "sales")
    m.save_external_table(sales(spark, sf_dir), f"{database}.sales", f"{folder}/files-sales")
    return spark.table(f"{database}.sales")


def declared_events(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """A new external table over the files of all events by day; they are not written again."""
    database, _ = new_database(spark, purpose)
    name, location = f"{database}.events", f"{lake(spark, sf_dir).folder}/files-events"
    schema = events_by_day(spark, sf_dir).schema
    m.create_external_table(spark, name, schema, location, {"pickup_date": "date"})
    return name


@query
def create_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = declared_events(spark, sf_dir, "declared")
    m.repair_partitions(spark, name)
    return with_micros(spark.table(name))


@query
def declare_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = new_database(spark, "inferred")
    name, events = f"{database}.events", f"{sf_dir}/events.parquet"
    m.declare_table(spark, events, name, f"{folder}/files-events", "ts")
    m.backfill(spark, events, name, "ts")
    return with_micros(spark.table(name))


@query
def partitioned_write_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, events = new_folder(spark, "by-day"), events_by_day(spark, sf_dir)
    m.write_partitions(events, path, ["pickup_date"])
    return with_micros(spark.read.schema(events.schema).parquet(path))


@query
def partitioned_write_ymd(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "by-ymd")
    dated = m.derive_date_columns(table(spark, sf_dir, "events"), "ts", null_dates="keep")
    m.write_partitions(dated, path, ["year", "month", "day"])
    # Read back with the written schema: partition folders alone would make "01" the number 1.
    return with_micros(spark.read.schema(dated.schema).parquet(path))


@query
def partitioned_save_as_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = new_database(spark, "managed")
    name = f"{database}.events"
    m.save_managed_table(events_by_day(spark, sf_dir), name, ["pickup_date"])
    return with_micros(spark.table(name))


@query
def managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = new_database(spark, "managed")
    name, events = f"{database}.events", events_by_day(spark, sf_dir)
    m.create_managed_table(spark, name, events.schema, {"pickup_date": "date"})
    m.overwrite_partitions(events, name)
    return with_micros(spark.table(name))


@query
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = new_database(spark, "overwritten")
    name, events = f"{database}.events", events_by_day(spark, sf_dir)
    m.save_external_table(events, name, f"{folder}/files-events", ["pickup_date"])
    second = m.partition_equals(events, "pickup_date", "2024-01-02")
    m.overwrite_partitions(second.withColumn("value", F.col("value") * 2), name)
    return with_micros(spark.table(name))


@query
def failing_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert that fails on a few rows raises, and the table is what it was."""
    database, folder = new_database(spark, "failing")
    name, events = f"{database}.events", events_by_day(spark, sf_dir)
    m.save_external_table(events, name, f"{folder}/files-events", ["pickup_date"])
    broken = F.when(F.col("event_type") == "error", F.raise_error(F.lit("a broken row")).cast("double"))
    try:
        m.overwrite_partitions(events.withColumn("value", broken.otherwise(F.col("value") * 2)), name)
        outcome = "inserted"
    except Exception as error:  # whichever Spark wraps it in
        if "a broken row" not in str(error):
            raise
        outcome = "raised"
    return with_micros(spark.table(name)).withColumn("outcome", F.lit(outcome))


@query
def parquet_write_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files state of times and dates that were written with the library's settings.

    The dates lie before 1582, where calendars differ.
    """
    folder = new_folder(spark, "options")
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.add_months(F.to_date("ts"), -6000).alias("old_date"),
        F.add_months(F.to_date("ts"), -6000).cast("timestamp").alias("old_time"),
    )
    with scoped_settings(spark, PARQUET_SETTINGS):
        m.write_partitions(events.withColumn("part", F.lit(0)), folder, ["part"])
    listed = m.list_landing_files(spark, folder, r"\.parquet$", recursive=True)
    stated = m.read_footers(spark, m.collect_paths(listed))
    unit = F.regexp_extract("logical_type", r"timeUnit=(\w+)", 1)
    return stated.groupBy("column", "physical_type", unit.alias("time_unit")).agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.substring(F.min("least"), 1, 10).alias("first_day"),
        F.substring(F.max("most"), 1, 10).alias("last_day"),
    )


@query
def repair_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = declared_events(spark, sf_dir, "repaired")
    m.repair_partitions(spark, name)
    return m.daily_counts(spark.table(name))


@query
def show_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.show_partitions(spark, f"{lake(spark, sf_dir).database}.events")


@query
def show_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = lake(spark, sf_dir).database
    names = sorted(row.tableName for row in m.show_tables(spark, database).collect())
    counts = [
        spark.table(f"{database}.{name}")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return m.union_by_name(counts)


@query
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = m.describe_table(spark, f"{lake(spark, sf_dir).database}.events")
    # The listing ends with a section that names the partition columns a second time.
    columns = described.where(~F.col("col_name").startswith("#")).distinct()
    return columns.select("col_name", "data_type")


@query
def drop_keeps_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = declared_events(spark, sf_dir, "dropped")
    schema = spark.table(name).schema
    location = m.drop_external_table(spark, name)
    return m.daily_counts(spark.read.schema(schema).parquet(location))


# --- whole jobs ---------------------------------------------------------------------------------


@query
def typed_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"l_quantity": "int", "l_partkey": "int", "l_extendedprice": "int"}
    preview = m.typed_preview(spark, f"{sf_dir}/lineitem.parquet", "l_shipdate", kinds)
    return preview.drop("l_shipdate")


@query
def ingest_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = new_database(spark, "ingested")
    result = m.ingest(
        spark,
        folder=landing_zone(spark, sf_dir),
        pattern=MONTH_FILES,
        schema=ORDERS_SCHEMA,
        table=f"{database}.orders",
        location=f"{folder}/files-orders",
        time_column="o_orderdate",
        date_column="order_date",
        partition_by=("year", "month"),
        recursive=True,
        # Files hold one month each, so a scan task meets few partitions: no shuffle is needed.
        cluster=False,
    )
    return with_order_micros(result.table)


@query
def mounted_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed, ingested, declared and read back on a file system that only Spark's side knows."""
    database, folder = new_database(spark, "mounted")
    mount = f"viewfs://{database.replace('_', '-')}"
    links = {"landing": landing_zone(spark, sf_dir), "tables": folder}
    mount_folders(spark, mount, links)
    result = m.ingest(
        spark,
        folder=f"{mount}/landing",
        pattern=MONTH_FILES,
        schema=ORDERS_SCHEMA,
        table=f"{database}.orders",
        location=f"{mount}/tables/files-orders",
        time_column="o_orderdate",
        date_column="order_date",
        partition_by=("year", "month"),
        recursive=True,
        cluster=False,
    )
    where = m.describe_table(spark, f"{database}.orders", extended=True).where("col_name = 'Location'")
    scheme = F.lit(where.first().data_type.split(":")[0]).alias("scheme")
    return with_order_micros(result.table).select("*", scheme)


@query
def backfill_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, folder = new_database(spark, "backfilled")
    name, events = f"{database}.events", f"{sf_dir}/event*.parquet"
    m.declare_table(spark, events, name, f"{folder}/files-events", "ts")
    return m.backfill(spark, events, name, "ts")
