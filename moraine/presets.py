"""The public monthly taxi trip-record files and the sample sales rows.

Names, types and rows here have to be exactly these for the tables to come out right.
"""

from __future__ import annotations

from pyspark.sql import types as T

TRIP_FILE_PATTERN = r"yellow_tripdata_\d{4}-\d{2}\.parquet$"
TRIP_TIME_COLUMN = "tpep_pickup_datetime"
TRIP_DATE_COLUMN = "pickup_date"

_TRIP_COLUMNS = {
    "VendorID": T.LongType(),
    "tpep_pickup_datetime": T.TimestampType(),
    "tpep_dropoff_datetime": T.TimestampType(),
    "passenger_count": T.DoubleType(),
    "trip_distance": T.DoubleType(),
    "RatecodeID": T.DoubleType(),
    "store_and_fwd_flag": T.StringType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "payment_type": T.LongType(),
    "fare_amount": T.DoubleType(),
    "extra": T.DoubleType(),
    "mta_tax": T.DoubleType(),
    "tip_amount": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "improvement_surcharge": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "airport_fee": T.DoubleType(),
    "cbd_congestion_fee": T.DoubleType(),
}
TRIP_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in _TRIP_COLUMNS.items()])

# Column types of the one-file preview, narrower than those of the table.
TRIP_PREVIEW_TYPES = {
    "VendorID": "bigint",
    "passenger_count": "int",
    "RatecodeID": "int",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
}

SALES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("sale_date", T.StringType()),
    ]
)
SALES_ROWS = [
    ("TX001", 15000.0, "2025-05-04"),
    ("TX002", 22000.0, "2025-05-05"),
]
