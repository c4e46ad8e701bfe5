"""One file with date parts and narrowed types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moraine.functions.dates import date_parts_by_substring, local_date
from moraine.functions.names import column, require
from moraine.functions.zones import session_zone
from moraine.operators.projection import cast_columns
from moraine.sources.scans import scan_parquet


def typed_preview(
    spark: SparkSession,
    uri: str,
    time_column: str,
    types: Mapping[str, T.DataType | str],
    date_column: str = "pickup_date",
    zone: str = "UTC",
) -> DataFrame:
    """The file's rows, lazily; the caller shows, limits or writes them."""
    df = scan_parquet(spark, uri)
    time_name = require(df.columns, time_column)
    day = local_date(
        column(time_name), df.schema[time_name].dataType, zone, session_zone(spark)
    )
    dated = cast_columns(df, types).withColumn(date_column, day)
    return dated.withColumns(date_parts_by_substring(column(date_column)))
