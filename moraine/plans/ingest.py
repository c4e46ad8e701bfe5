"""Raw landing files -> partitioned external table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moraine.catalog.tables import (
    WRITE_TASK_BYTES,
    create_external_table,
    overwrite_partitions,
    show_partitions,
)
from moraine.functions.names import require
from moraine.operators.projection import with_date_parts
from moraine.plans.rejected import guard_partitions
from moraine.sources.conformed import conform_union
from moraine.sources.damage import naming_damage
from moraine.sources.landing import collect_paths, list_landing_files


@dataclass
class IngestResult:
    """What an ingest left behind: the table, its partitions, and the files it could not use."""

    table: DataFrame
    partitions: DataFrame
    rejects: DataFrame
    rejected: int = 0


def ingest(
    spark: SparkSession,
    folder: str,
    pattern: str,
    schema: T.StructType,
    table: str,
    location: str,
    time_column: str,
    date_column: str = "pickup_date",
    partition_by: Sequence[str] | None = None,
    date_type: str = "date",
    zone: str = "UTC",
    null_dates: str = "drop",
    recursive: bool = False,
    on_reject: str = "quarantine",
    cluster: bool = True,
    task_bytes: str = WRITE_TASK_BYTES,
    replace_despite_rejects: bool = False,
) -> IngestResult:
    """List, conform, union, date and write; safe to run again.

    ``partition_by`` names the partition columns, the event date by default; ``("year", "month")``
    makes larger partitions for feeds with few rows a day. Partitions the files have rows for are
    replaced, all others stay, so list every file that contributes to a partition. If files were
    rejected, partitions that are there already are not replaced without them: that raises, unless
    ``replace_despite_rejects`` says so.
    """
    partition_by = tuple(partition_by or (date_column,))
    paths = collect_paths(list_landing_files(spark, folder, pattern, recursive))
    files = conform_union(
        spark, paths, schema, zone, event_date=(time_column, date_column), on_reject=on_reject
    )
    rows = with_date_parts(files.df, date_column, null_dates)
    if date_type != "date":
        rows = rows.withColumn(date_column, rows[date_column].cast(date_type))
    partitions = [require(rows.columns, name) for name in partition_by]
    kinds = {name: rows.schema[name].dataType.simpleString() for name in partitions}
    create_external_table(spark, table, rows.schema, location, kinds)
    if files.rejected and not replace_despite_rejects:
        guard_partitions(rows, files, table, time_column, date_column, zone, null_dates)
    with naming_damage(spark, files):
        overwrite_partitions(rows, table, cluster=cluster, task_bytes=task_bytes)
    return IngestResult(
        spark.table(table), show_partitions(spark, table), files.rejects, files.rejected
    )
