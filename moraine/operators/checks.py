"""Checks run on a table after it was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.functions.names import column, quoted, require


def daily_counts(
    df: DataFrame, date_column: str = "pickup_date", count_column: str = "pickup_count"
) -> DataFrame:
    """Rows per day, in date order with NULL first.

    Counts are formed within each input task before the shuffle, so one very full day costs one
    partial row per task.
    """
    day = require(df.columns, date_column)
    counts = df.groupBy(column(day)).agg(F.count(F.lit(1)).alias(count_column))
    return counts.orderBy(column(day).asc_nulls_first())


def table_name(name: str) -> str:
    """A one- to three-part table name, each part quoted for use in SQL text."""
    return ".".join(quoted(part.strip("`")) for part in name.split("."))


def daily_counts_sql(
    spark: SparkSession,
    table: str,
    date_column: str = "pickup_date",
    count_column: str = "pickup_count",
) -> DataFrame:
    """The same check as SQL text over a catalog table."""
    day, rows = quoted(date_column), quoted(count_column)
    return spark.sql(
        f"SELECT {day}, count(1) AS {rows} FROM {table_name(table)} GROUP BY 1 ORDER BY {day}"
    )


def preview(df: DataFrame, rows: int = 10, order_by: tuple[str, ...] = ()) -> DataFrame:
    """The first rows. With ``order_by`` it is a top-k over the whole frame, without a full sort."""
    if order_by:
        df = df.orderBy(*[column(require(df.columns, name)) for name in order_by])
    return df.limit(rows)
