"""Files -> declared, empty external table with their schema."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from moraine.catalog.tables import create_external_table
from moraine.operators.projection import derive_date_columns, normalize_ntz
from moraine.sources.scans import scan_glob


def declare_table(
    spark: SparkSession,
    glob: str,
    table: str,
    location: str,
    time_column: str,
    date_column: str = "pickup_date",
    date_type: str = "date",
) -> T.StructType:
    """Declare a day-partitioned table whose columns are those of the files plus the date parts.

    Only footers are read. Zone-less timestamps become instants in the table.
    """
    files = normalize_ntz(scan_glob(spark, glob))
    dated = derive_date_columns(files, time_column, date_column, null_dates="keep")
    create_external_table(spark, table, dated.schema, location, {date_column: date_type})
    return spark.table(table).schema
