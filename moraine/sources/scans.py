"""Plain scans, and literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moraine.settings import packed_lookups


def scan_parquet(spark: SparkSession, uri: str) -> DataFrame:
    """One Parquet file or folder, at any URI the session's file systems know."""
    return spark.read.parquet(uri)


def scan_glob(spark: SparkSession, glob: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files a glob matches, as one frame.

    The footers of all files are compared first (on the executors). A column only some files have
    is NULL for the others; files that disagree about a type raise here, and not half-way through
    the scan. Read those with ``conform_union``. Where the schema is known, giving it spares the
    look at the footers.
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    with packed_lookups(spark):
        return reader.parquet(glob)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A frame of rows written out in a program, with their schema."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)
