"""Catalog tables over Parquet: declare, write, list, repair, drop.

Tables are declared ``USING PARQUET``, which needs no Hive support and behaves the same with an
in-memory catalog and with a shared metastore.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.names import by_lower_name, column, quoted, require
from moraine.operators.checks import table_name
from moraine.operators.projection import align_to_table
from moraine.settings import PARTITION_OVERWRITE_SETTINGS, packed_lookups, scoped_settings

# Shuffled bytes a write task takes on, and so about the largest file it writes.
WRITE_TASK_BYTES = "128m"

# Beyond this many shuffle partitions Spark records only average sizes of map output, in which
# adaptive execution cannot see a large partition to split.
_EXACT_SIZES = ("spark.shuffle.minNumPartitionsToHighlyCompress", "2000")

# Files a write task keeps open side by side. A clustered task has rows of few partitions, so this
# spares it a sort by partition; rows of any further partitions are sorted and written after.
OPEN_FILES = "8"


class TableMismatch(ValueError):
    """A table of this name exists and is not the one asked for."""


# --- declaring tables ---------------------------------------------------------------------------


def _declare(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_types: Mapping[str, str],
    location: str | None,
) -> None:
    partitions = by_lower_name(partition_types)
    data = [T.StructField(f.name, f.dataType) for f in schema if f.name.lower() not in partitions]
    columns = [T.StructType(data).toDDL()] if data else []
    columns += [f"{quoted(col)} {kind}" for col, kind in partition_types.items()]
    statement = f"CREATE TABLE IF NOT EXISTS {table_name(name)} ({', '.join(columns)}) USING PARQUET"
    if partition_types:
        statement += f" PARTITIONED BY ({', '.join(quoted(col) for col in partition_types)})"
    if location is not None:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    # In the statement TIMESTAMP means an instant, as it does in a schema.
    with scoped_settings(spark, {"spark.sql.timestampType": "TIMESTAMP_LTZ"}):
        spark.sql(statement)

    table = spark.table(table_name(name)).schema
    wanted = [(f.name.lower(), f.dataType.simpleString()) for f in data]
    wanted += [
        (col.lower(), T.DataType.fromDDL(kind).simpleString())
        for col, kind in partition_types.items()
    ]
    found = [(f.name.lower(), f.dataType.simpleString()) for f in table]
    if wanted != found:
        raise TableMismatch(f"table {name} has columns {found}, not {wanted}")
    if partition_columns(spark, name) != [col.lower() for col in partition_types]:
        raise TableMismatch(f"table {name} is partitioned by {partition_columns(spark, name)}")


def create_external_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partition_types: Mapping[str, str] | None = None,
) -> None:
    """Declare an external table at a location, if it is not there yet.

    ``partition_types`` maps partition columns to SQL types; the other columns come from ``schema``.
    An existing table must have the same location, columns and partitioning, else this raises: a
    second caller with another idea of the table would otherwise write into the wrong place. Files
    already at the location must be laid out by the same partition columns, in the same order.
    """
    _check_layout(spark, location, list(partition_types or ()))
    _declare(spark, name, schema, partition_types or {}, location)
    facts = _table_facts(spark, name)
    if _qualified(spark, facts["Location"]) != _qualified(spark, location):
        raise TableMismatch(f"table {name} is at {facts['Location']}, not at {location}")


def create_managed_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_types: Mapping[str, str] | None = None,
) -> None:
    """Declare a table whose files the catalog owns, if it is not there yet."""
    _declare(spark, name, schema, partition_types or {}, None)
    if _table_facts(spark, name)["Type"] != "MANAGED":
        raise TableMismatch(f"table {name} exists and is not managed")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The table's partition columns in lower case."""
    listed = spark.catalog.listColumns(table_name(table))
    return [col.name.lower() for col in listed if col.isPartition]


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """The registered partitions as columns and texts, None for the default partition's value."""
    out = []
    for row in show_partitions(spark, table).collect():
        pairs = [part.split("=", 1) for part in row.partition.split("/")]
        out.append({name: _unescaped(value) for name, value in pairs})
    return out


def _unescaped(value: str) -> str | None:
    if value in ("__HIVE_DEFAULT_PARTITION__", "null"):
        return None
    return re.sub("%([0-9A-Fa-f]{2})", lambda found: chr(int(found.group(1), 16)), value)


def _table_facts(spark: SparkSession, table: str) -> dict[str, str]:
    rows = describe_table(spark, table, extended=True).collect()
    names = [row.col_name for row in rows]
    details = rows[names.index("# Detailed Table Information") + 1 :]
    return {row.col_name: row.data_type for row in details}


def _file_system(spark: SparkSession, location: str):
    """The Hadoop path of a location, and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _qualified(spark: SparkSession, location: str) -> str:
    """The location with scheme and authority, as the catalog stores it."""
    path, file_system = _file_system(spark, location)
    return file_system.makeQualified(path).toString().rstrip("/")


def layouts(spark: SparkSession, location: str) -> list[list[str]]:
    """The different sequences of partition columns by which files at a location lie in folders.

    Folders are listed by the tasks of one job where there are many, and only what differs comes to
    the driver. Hidden files do not count. A file that lies in no partition folder has an empty one.
    """
    path, file_system = _file_system(spark, location)
    if not file_system.exists(path):
        return []
    root = _qualified(spark, location)
    literal = re.sub(r"([\\\[\]{}*?])", r"\\\1", root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    with packed_lookups(spark):
        files = reader.load(literal).select("path")
    inside = F.split(F.col("path").substr(F.lit(len(root) + 2), F.length("path")), "/")
    folders = F.slice(inside, 1, F.size(inside) - 1)
    names = F.transform(
        F.filter(folders, lambda folder: folder.contains("=")),
        lambda folder: F.lower(F.substring_index(folder, "=", 1)),
    )
    # Each task sends on a few different sequences: one task is enough to bring them together.
    with scoped_settings(
        spark, {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    ):
        found = files.select(F.array_join(names, "/").alias("names")).distinct().collect()
    return sorted(row.names.split("/") if row.names else [] for row in found)


def _check_layout(spark: SparkSession, location: str, partition_by: Sequence[str]) -> None:
    """One layout per location: raise if any of its folders are partitions by other columns."""
    wanted = [name.lower() for name in partition_by]
    others = [found for found in layouts(spark, location) if found != wanted]
    if others:
        raise TableMismatch(
            f"{location} already holds folders by {others}, not by {list(partition_by)}"
        )


# --- writing ------------------------------------------------------------------------------------


def cluster_partitions(spark: SparkSession) -> int:
    """As many shuffle partitions as Spark records exact sizes for.

    The more there are, the seldomer two table partitions share one, whose files would come out
    smaller. Parallelism does not hang on it: small ones are packed and large ones split afterwards.
    """
    return int(spark.sparkContext.getConf().get(*_EXACT_SIZES))


def cluster_for_write(
    df: DataFrame, partition_by: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Bring rows of one partition together before they are written.

    Without it every task opens a file in every partition it has rows for. The hint shuffles by the
    partition columns, then adaptive execution packs small partitions into one task and splits a
    large one over many, so a day with a third of all rows does not become one task. ``partitions``
    are those of the shuffle, by default as ``cluster_partitions`` says.
    """
    columns = [column(require(df.columns, name)) for name in partition_by]
    return df.hint("rebalance", partitions or cluster_partitions(df.sparkSession), *columns)


def _write_settings(task_bytes: str) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": task_bytes,
        "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES,
    }


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "overwrite",
    cluster: bool = True,
    task_bytes: str = WRITE_TASK_BYTES,
) -> None:
    """Write Parquet files under ``column=value`` folders; no catalog is involved.

    Overwriting replaces everything at the path; appending needs the same layout there. Set
    ``cluster=False`` where the frame is already clustered by the partition columns, to spare the
    shuffle.
    """
    names = [require(df.columns, name) for name in partition_by]
    if mode == "append":
        _check_layout(df.sparkSession, path, names)
    with scoped_settings(
        df.sparkSession,
        {**_write_settings(task_bytes), "spark.sql.sources.partitionOverwriteMode": "static"},
    ):
        rows = cluster_for_write(df, names) if cluster else df
        rows.write.mode(mode).partitionBy(*names).parquet(path)


def overwrite_partitions(
    df: DataFrame, table: str, cluster: bool = True, task_bytes: str = WRITE_TASK_BYTES
) -> None:
    """Replace the partitions the frame has rows for; the table's other partitions stay.

    Columns are brought into the table's order first, since the insert goes by position. A replaced
    partition is replaced whole, so the frame must hold all rows of every partition it touches.
    Rerunning with the same frame leaves the same table.
    """
    spark = df.sparkSession
    name = table_name(table)
    partitions = partition_columns(spark, table)
    if not partitions:
        raise ValueError(f"table {table} has no partitions; overwriting would replace all of it")
    rows = align_to_table(df, name)
    with scoped_settings(spark, {**_write_settings(task_bytes), **PARTITION_OVERWRITE_SETTINGS}):
        if cluster:
            rows = cluster_for_write(rows, partitions)
        rows.write.mode("overwrite").insertInto(name)


class IncompletePartitions(ValueError):
    """Partitions would be replaced by rows of which some are known to be missing."""


def refuse_to_replace(df: DataFrame, table: str, rejected: int) -> None:
    """Raise if the frame has rows for partitions that the table already has."""
    spark = df.sparkSession
    names = partition_columns(spark, table)
    kept = spark.table(table_name(table)).select(*[column(n) for n in names]).distinct()
    own = align_to_table(df, table_name(table)).select(*[column(n) for n in names]).distinct()
    both = own.alias("own").join(
        kept.alias("kept"),
        reduce(
            Column.__and__,
            [F.col(f"own.{quoted(n)}").eqNullSafe(F.col(f"kept.{quoted(n)}")) for n in names],
        ),
        "left_semi",
    )
    found = [",".join(f"{n}={row[n]}" for n in names) for row in both.collect()]
    if found:
        raise IncompletePartitions(
            f"{rejected} files were rejected, and rows for partitions that table {table} already has"
            f" may be missing: {sorted(found)}"
        )


def _save(
    df: DataFrame, name: str, partition_by: Sequence[str], cluster: bool, path: str | None
) -> None:
    columns = [require(df.columns, col) for col in partition_by]
    # All of the table is replaced, also where the session overwrites partition by partition.
    with scoped_settings(
        df.sparkSession,
        {**_write_settings(WRITE_TASK_BYTES), "spark.sql.sources.partitionOverwriteMode": "static"},
    ):
        rows = cluster_for_write(df, columns) if columns and cluster else df
        writer = rows.write.mode("overwrite").format("parquet")
        if columns:
            writer = writer.partitionBy(*columns)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(table_name(name))


def save_external_table(
    df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), cluster: bool = True
) -> None:
    """Write the frame as an external table at a path, replacing what the table was."""
    _save(df, name, partition_by, cluster, path)


def save_managed_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster: bool = True
) -> None:
    """Write the frame as a table whose files the catalog owns, replacing what the table was."""
    _save(df, name, partition_by, cluster, None)


# --- looking after tables -----------------------------------------------------------------------


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(namespace, tableName, isTemporary)`` for each table of the database."""
    return spark.sql("SHOW TABLES" + (f" IN {table_name(database)}" if database else ""))


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    """``(partition)`` for each registered partition, as ``column=value`` text."""
    return spark.sql(f"SHOW PARTITIONS {table_name(table)}")


def describe_table(spark: SparkSession, table: str, extended: bool = False) -> DataFrame:
    """``(col_name, data_type, comment)``; extended adds location, type and the like."""
    return spark.sql(f"DESCRIBE TABLE {'EXTENDED ' if extended else ''}{table_name(table)}")


def repair_partitions(spark: SparkSession, table: str, drop_missing: bool = False) -> None:
    """Register partition folders found at the table's location.

    With ``drop_missing`` partitions whose folder is gone are removed from the catalog too.
    """
    spark.sql(f"MSCK REPAIR TABLE {table_name(table)} {'SYNC' if drop_missing else 'ADD'} PARTITIONS")


def drop_external_table(spark: SparkSession, table: str) -> str:
    """Remove an external table from the catalog, leave its files, and return where they are.

    A managed table is refused, since dropping it would delete its files.
    """
    facts = _table_facts(spark, table)
    if facts["Type"] != "EXTERNAL":
        raise TableMismatch(f"table {table} is {facts['Type']}; dropping it would delete its files")
    spark.sql(f"DROP TABLE {table_name(table)}")
    return facts["Location"]
