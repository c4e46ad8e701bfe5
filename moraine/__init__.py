"""Build and query partitioned lake tables from monthly raw files with drifting schemas.

Every function takes a ``SparkSession`` or a ``DataFrame`` from the caller; none of them creates or
stops a session, and none of them reads credentials.
"""

from moraine.catalog.tables import (
    IncompletePartitions,
    TableMismatch,
    cluster_for_write,
    create_external_table,
    create_managed_table,
    describe_table,
    drop_external_table,
    overwrite_partitions,
    repair_partitions,
    save_external_table,
    save_managed_table,
    show_partitions,
    show_tables,
    write_partitions,
)
from moraine.functions.dates import date_parts, date_parts_by_substring, safe_date
from moraine.operators.checks import daily_counts, daily_counts_sql, preview
from moraine.operators.filters import drop_null_dates, partition_equals
from moraine.operators.projection import (
    align_to_columns,
    align_to_table,
    cast_columns,
    conform_to_schema,
    derive_date_columns,
    normalize_ntz,
    union_by_name,
)
from moraine.plans.backfill import backfill
from moraine.plans.declare import declare_table
from moraine.plans.ingest import ingest
from moraine.plans.preview import typed_preview
from moraine.plans.sales import save_rows
from moraine.sources.conformed import conform_union
from moraine.sources.damage import DamagedFiles
from moraine.sources.footers import read_footers
from moraine.sources.landing import collect_paths, list_landing_files
from moraine.sources.scans import literal_rows, scan_glob, scan_parquet

__all__ = [
    "DamagedFiles",
    "IncompletePartitions",
    "TableMismatch",
    "align_to_columns",
    "align_to_table",
    "backfill",
    "cast_columns",
    "cluster_for_write",
    "collect_paths",
    "conform_to_schema",
    "conform_union",
    "create_external_table",
    "create_managed_table",
    "daily_counts",
    "daily_counts_sql",
    "date_parts",
    "date_parts_by_substring",
    "declare_table",
    "derive_date_columns",
    "describe_table",
    "drop_external_table",
    "drop_null_dates",
    "ingest",
    "list_landing_files",
    "literal_rows",
    "normalize_ntz",
    "overwrite_partitions",
    "partition_equals",
    "preview",
    "read_footers",
    "repair_partitions",
    "safe_date",
    "save_external_table",
    "save_managed_table",
    "save_rows",
    "scan_glob",
    "scan_parquet",
    "show_partitions",
    "show_tables",
    "typed_preview",
    "union_by_name",
    "write_partitions",
]
