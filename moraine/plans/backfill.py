"""Files -> existing table -> rows per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moraine.catalog.tables import WRITE_TASK_BYTES, overwrite_partitions, partition_columns
from moraine.operators.checks import daily_counts_sql, table_name
from moraine.operators.projection import with_date_parts
from moraine.plans.rejected import guard_partitions
from moraine.sources.conformed import conform_union
from moraine.sources.damage import naming_damage
from moraine.sources.landing import collect_paths, list_landing_files

_DATE_PARTS = ("year", "month", "day")


def backfill(
    spark: SparkSession,
    glob: str,
    table: str,
    time_column: str,
    date_column: str = "pickup_date",
    zone: str = "UTC",
    null_dates: str = "keep",
    count_column: str = "pickup_count",
    on_reject: str = "raise",
    cluster: bool = True,
    task_bytes: str = WRITE_TASK_BYTES,
    replace_despite_rejects: bool = False,
) -> DataFrame:
    """Fill a table that is already declared from the files a glob matches; return rows per day.

    The table's own columns are the schema the files are conformed to, so files may differ from each
    other; one that cannot be read stops the job. With ``on_reject="quarantine"`` it is left out, and
    then partitions that are there already are only replaced with ``replace_despite_rejects``. Rows
    without a date are kept, in the table's default partition, unless ``null_dates="drop"``. Set
    ``cluster=False`` where the files are clustered by partition already, to spare the shuffle.
    """
    if not spark.catalog.tableExists(table_name(table)):
        raise ValueError(f"table {table} does not exist; declare it first")
    derived = {date_column.lower(), *_DATE_PARTS}
    schema = T.StructType(
        [f for f in spark.table(table_name(table)).schema if f.name.lower() not in derived]
    )
    if not derived.issuperset(partition_columns(spark, table)):
        raise ValueError(f"table {table} is partitioned by columns that no date gives")
    paths = collect_paths(list_landing_files(spark, glob))
    files = conform_union(
        spark, paths, schema, zone, event_date=(time_column, date_column), on_reject=on_reject
    )
    rows = with_date_parts(files.df, date_column, null_dates)
    if files.rejected and not replace_despite_rejects:
        guard_partitions(rows, files, table, time_column, date_column, zone, null_dates)
    with naming_damage(spark, files):
        overwrite_partitions(rows, table, cluster=cluster, task_bytes=task_bytes)
    return daily_counts_sql(spark, table, date_column, count_column)
