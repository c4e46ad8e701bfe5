"""Data the queries start from, derived by Spark from the given tables, whole.

Each stage is written once per application and source folder, into the shared scratch folder, and
read by every query that needs it.
"""

from __future__ import annotations

from dataclasses import dataclass
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine import cluster_for_write, derive_date_columns, save_external_table, write_partitions
from workload.scratch import new_database, new_folder

# A month of a feed is a folder; its files are recognised by their path.
MONTH_FILES = r"/month=\d{4}-\d{2}/[^/]+\.parquet$"
ORDERS_FILES = r"/orders" + MONTH_FILES

# Up to so many shuffle partitions a map task writes rows straight to a file for each. With more it
# holds them in memory to sort them by partition, and spills them where they do not fit.
_UNSORTED = ("spark.shuffle.sort.bypassMergeThreshold", "200")

# The month under which orders without a date are delivered.
NO_MONTH = "0000-00"

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)

_staged: dict[tuple[str, str, str], object] = {}
_staging = Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, what: str, make):
    key = (spark.sparkContext.applicationId, str(sf_dir), what)
    with _staging:
        if key not in _staged:
            _staged[key] = make()
        return _staged[key]


def time_text(time: Column, key: Column) -> Column:
    """A time as text: one in fifty is spoilt, of the others every second one has an offset."""
    clock = "yyyy-MM-dd'T'HH:mm:ss"
    ahead = F.date_format(time + F.expr("INTERVAL 5 HOURS"), clock)
    return (
        F.when(key % 50 == 7, F.concat(F.date_format(time, "yyyy-MM-dd"), F.lit(" garbage")))
        .when(key % 2 == 0, F.concat(ahead, F.lit("+05:00")))
        .otherwise(F.date_format(time, clock))
    )


def landing_zone(spark: SparkSession, sf_dir: str) -> str:
    """Folder of monthly ``orders`` drops whose schema changes over the years.

    ``orders`` holds every order once: as is before 1996; in 1996 with a double customer key, no
    priority and the time as text, with an offset or without, or spoilt; in 1997 with other column
    order, a text customer key, another spelling of one column, an extra one and the time in seconds;
    as is again from 1998, with the orders that have no date. ``resend`` repeats the pending orders
    with their price wrapped in an array, which no cast can undo. ``archive`` has folders that are
    not months.
    """
    return _once(spark, sf_dir, "landing", lambda: _write_landing_zone(spark, sf_dir))


def _write_landing_zone(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "landing")
    month = F.coalesce(F.date_format("o_orderdate", "yyyy-MM"), F.lit(NO_MONTH))
    orders = table(spark, sf_dir, "orders").withColumn("month", month)
    day, custkey = F.col("o_orderdate"), F.col("o_custkey")
    new_1996, new_1997, new_1998 = (
        F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1996, 1997, 1998)
    )
    drops = [
        ("orders", orders.where(day < new_1996)),
        (
            "orders",
            orders.where((day >= new_1996) & (day < new_1997))
            .withColumn("o_custkey", custkey.cast("double"))
            .withColumn("o_orderdate", time_text(day, F.col("o_orderkey")))
            .drop("o_orderpriority"),
        ),
        (
            "orders",
            orders.where((day >= new_1997) & (day < new_1998)).select(
                "o_orderpriority",
                F.unix_seconds(day.cast("timestamp")).alias("o_orderdate"),
                F.col("o_totalprice").alias("O_TotalPrice"),
                F.lit(1).alias("extra_col"),
                "o_orderstatus",
                custkey.cast("string").alias("o_custkey"),
                "o_orderkey",
                "month",
            ),
        ),
        ("orders", orders.where((day >= new_1998) | day.isNull())),
        (
            "resend",
            orders.where(F.col("o_orderstatus") == "P").withColumn(
                "o_totalprice", F.array("o_totalprice")
            ),
        ),
    ]
    for feed, rows in drops:
        write_partitions(rows, f"{folder}/{feed}", ["month"], mode="append")
    by_year = orders.groupBy(F.year(day).alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    write_partitions(by_year, f"{folder}/archive", ["month"], mode="append", cluster=False)
    return folder


@dataclass
class Lake:
    """A database with the given fact tables as partitioned external tables."""

    database: str
    folder: str


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = derive_date_columns(table(spark, sf_dir, "events"), "ts", null_dates="keep")
    return dated.drop("year", "month", "day")


def by_month(spark: SparkSession, sf_dir: str, name: str, time_column: str) -> DataFrame:
    dated = derive_date_columns(
        table(spark, sf_dir, name), time_column, "event_date", null_dates="keep"
    )
    return dated.drop("event_date", "day")


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Events by day, orders and lineitem by month.

    The tables have few partitions each, so their rows are brought together by as many shuffle
    partitions as need no sort: whole fact tables go through, and would spill in the sort.
    """
    return _once(spark, sf_dir, "lake", lambda: _write_lake(spark, sf_dir))


def _write_lake(spark: SparkSession, sf_dir: str) -> Lake:
    database, folder = new_database(spark, "lake")
    frames = {
        "events": (events_by_day(spark, sf_dir), ["pickup_date"]),
        "orders": (by_month(spark, sf_dir, "orders", "o_orderdate"), ["year", "month"]),
        "lineitem": (by_month(spark, sf_dir, "lineitem", "l_shipdate"), ["year", "month"]),
    }
    partitions = int(spark.sparkContext.getConf().get(*_UNSORTED))
    for name, (rows, partition_by) in frames.items():
        rows = cluster_for_write(rows, partition_by, partitions)
        save_external_table(
            rows, f"{database}.{name}", f"{folder}/files-{name}", partition_by, cluster=False
        )
    return Lake(database, folder)
