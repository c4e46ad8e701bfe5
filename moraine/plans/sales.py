"""Literal rows -> external table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moraine.catalog.tables import save_external_table
from moraine.operators.checks import table_name
from moraine.sources.scans import literal_rows


def save_rows(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType, table: str, path: str
) -> DataFrame:
    """Save rows written out in a program as a table, and return the table."""
    save_external_table(literal_rows(spark, rows, schema), table, path)
    return spark.table(table_name(table))
