"""Session settings: scoped changes, and the Parquet settings a writer session should carry."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# How Parquet timestamps and dates are written.
PARQUET_SETTINGS = {
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
}

# An overwrite replaces the partitions it has rows for and no others, on Parquet tables as well as
# on tables in Hive format.
PARTITION_OVERWRITE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "hive.exec.dynamic.partition": "true",
    "hive.exec.dynamic.partition.mode": "nonstrict",
}


def use_parquet_settings(spark: SparkSession) -> None:
    """Apply the Parquet settings to the caller's session for good."""
    for key, value in PARQUET_SETTINGS.items():
        spark.conf.set(key, value)


@contextmanager
def scoped_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set session settings for the length of a block and put the former values back after it."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Files or folders a task looks up one after the other.
LOOKUPS_PER_TASK = 200


@contextmanager
def packed_lookups(spark: SparkSession, paths: int = 0) -> Iterator[None]:
    """Within the block, a task looks up many files or folders; Spark's default is one task for each.

    A look-up is quick, so with many paths the tasks themselves would be most of the cost. There are
    still enough tasks to keep all cores busy, and more if the cluster has yet to grow to its size.
    """
    tasks = max(4 * spark.sparkContext.defaultParallelism, paths // LOOKUPS_PER_TASK)
    with scoped_settings(
        spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}
    ):
        yield
