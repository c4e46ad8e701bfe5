"""Row filters."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.dates import TEXT_TYPES
from moraine.functions.names import column, require


def drop_null_dates(df: DataFrame, date_column: str) -> DataFrame:
    """Only the rows that have a date. The test is pushed into a Parquet scan below it."""
    return df.where(column(require(df.columns, date_column)).isNotNull())


def partition_equals(df: DataFrame, date_column: str, day: str | datetime.date) -> DataFrame:
    """The rows of one day, named by its ISO text or as a date.

    The comparison is made between dates, so it prunes to one directory on a table partitioned by
    this column; a text that is not a date raises here instead of matching nothing. A column of times
    is compared with the day's beginning and the next one's, an instant's in the session's zone.
    """
    if isinstance(day, str):
        day = datetime.date.fromisoformat(day)
    name = require(df.columns, date_column)
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        begin, end = (F.lit(d.isoformat()).cast(kind) for d in (day, day + datetime.timedelta(days=1)))
        return df.where((column(name) >= begin) & (column(name) < end))
    if isinstance(kind, TEXT_TYPES):
        return df.where(column(name) == F.lit(day.isoformat()))
    return df.where(column(name) == F.lit(day))
