"""Many files with drifting schemas -> one frame with one schema.

A scan per file would make the plan grow with the number of files. Here the files are sorted into as
few groups as their types allow, each group is one scan, and the union has one branch per group.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.names import by_lower_name
from moraine.operators.projection import conform_to_schema, union_by_name
from moraine.settings import packed_lookups
from moraine.sources.footers import footer_kinds, readable_by_tasks, resolved

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
    ]
)

# Error conditions that speak about the types and names in the files. They come from footers that were
# read, so no network or access fault is behind them.
_SCHEMA_ERRORS = (
    "CANNOT_MERGE_SCHEMAS",
    "COLUMN_ALREADY_EXISTS",
    "PARQUET_TYPE_",
    "DATATYPE_MISMATCH",
)
_CONDITION = re.compile(r"\[([A-Z][A-Z0-9_.]+)\]\s*([^\n]*)")

# What the Parquet reader says of a file that is no Parquet file, was cut off or has a broken footer.
# Only these set a file aside. Anything else (throttling, a lost node, missing rights or credentials, a
# file that has gone) fails the job, which is to be run again.
_DAMAGE = re.compile(
    "is not a Parquet file[^\n]*|corrupted file: the footer index[^\n]*"
    "|can not read FileMetaData: (?:Message size|Required field|don't know what|Unrecognized type"
    "|String length|Unexpected end|Don't know|MaxMessageSize|Socket is closed by peer)[^\n]*"
)
_BAD_FOOTER = "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER"

# Files that Spark tries side by side, each in a job of its own.
_PROBES = 16


@dataclass
class SchemaGroup:
    """Files that one scan can read: no two of them give a column different types."""

    fields: dict[str, T.StructField]
    paths: list[str] = field(default_factory=list)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.fields.values()))


@dataclass
class ConformedFiles:
    """The conformed rows, and the files left out of them with the reason."""

    df: DataFrame
    rejects: DataFrame
    groups: list[SchemaGroup]
    rejected: int = 0


def _schema_error(error: Exception) -> str | None:
    """``CONDITION: message`` if the error is about the files' types or names, else None."""
    for name, message in _CONDITION.findall(str(error)):
        if name.startswith(_SCHEMA_ERRORS):
            return f"{name}: {message}".strip()
    return None


def _damage(error: Exception) -> str | None:
    """The reason, if the error says that a file is damaged and cannot be read by anyone."""
    found = _DAMAGE.search(str(error))
    return f"{_BAD_FOOTER}: {found.group()}" if found else None


def literal_path(path: str) -> str:
    """A path in which no character is taken for a wildcard."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


# A file that turns out to be gone or damaged during a scan fails the job, whatever the session says:
# files are left out only by way of the rejects.
_READ_ALL = {"ignoreCorruptFiles": "false", "ignoreMissingFiles": "false"}


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """The schema of all the files; their footers are read in one distributed job."""
    reader = spark.read.options(mergeSchema="true", **_READ_ALL)
    return reader.parquet(*[literal_path(path) for path in paths]).schema


def _readable(schema: T.StructType) -> T.StructType | str:
    try:
        by_lower_name(schema.fieldNames())
    except ValueError as error:
        return f"COLUMN_ALREADY_EXISTS: {error}"
    return schema


def _probe(spark: SparkSession, paths: Sequence[str]) -> T.StructType | str:
    """The schema of all the files, or why there is none."""
    try:
        return _readable(_merged_schema(spark, paths))
    except (PySparkException, Py4JJavaError) as error:
        reason = _schema_error(error) or _damage(error)
        if reason is None:
            raise
        return reason


def _footer_reader(spark: SparkSession) -> Callable[[str], tuple[bool, str]]:
    """Tells whether a file has a sound footer, and the types it states or else what is wrong with it."""
    # Looked up once: each name is a call to the JVM.
    jvm, configuration = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    file_of = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath
    open_file = jvm.org.apache.parquet.hadoop.ParquetFileReader.open

    def footer(path: str) -> tuple[bool, str]:
        try:
            reader = open_file(file_of(path_of(path), configuration))
            try:
                facts = reader.getFooter().getFileMetaData()
                own = facts.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
                return True, f"{facts.getSchema().toString()}{own or ''}"
            finally:
                reader.close()
        except Py4JJavaError as error:
            reason = _damage(error)
            if reason is None:
                raise
            return False, reason

    return footer


def probe_schemas(
    spark: SparkSession, paths: Sequence[str]
) -> tuple[list[tuple[T.StructType, list[str]]], list[tuple[str, str]]]:
    """Sets of files with the schema that reads them, and the files nothing can read.

    The tasks of one job sort the footers by what they state. A kind of footer that holds the schema
    of a Spark writer needs no more; for any other, a job over one file gives the schema. Files that
    the tasks cannot make sense of are each tried by Spark, which says what is wrong. The number of
    jobs goes with the kinds of files and the rejects, not with the files.
    """
    found: list[tuple[T.StructType, list[str]]] = []
    rejects: list[tuple[str, str]] = []
    files = sorted(set(paths))
    if not files:
        return found, rejects
    kinds, suspects = _sorted_footers(spark, files)
    schemas = {own[0]: _readable(stated) for stated, own in kinds if stated is not None}
    # Threads carry on the caller's job group and scheduler pool.
    asked = [own[0] for stated, own in kinds if stated is None] + suspects
    probe = inheritable_thread_target(spark)(_probe)
    with ThreadPoolExecutor(_PROBES) as pool:
        schemas |= zip(asked, pool.map(lambda path: probe(spark, [path]), asked), strict=True)
    for own in [own for _, own in kinds] + [[path] for path in suspects]:
        schema = schemas[own[0]]
        if isinstance(schema, T.StructType):
            found.append((schema, own))
        else:
            rejects.extend((path, schema) for path in own)
    return found, rejects


def _sorted_footers(
    spark: SparkSession, files: Sequence[str]
) -> tuple[list[tuple[T.StructType | None, list[str]]], list[str]]:
    """Files by kind of footer, with the schema if it is written there, and files to be tried."""
    places = resolved(spark, files)
    if not readable_by_tasks(list(places.values())):
        return _sorted_by_driver(spark, files)
    kinds: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType | None] = {}
    suspects = []
    for row in footer_kinds(spark, files).collect():  # a row for each file, as the paths were
        if row.kind is None:
            suspects.append(row.path)
            continue
        kinds.setdefault(row.kind, []).append(row.path)
        if row.row_schema:
            schemas[row.kind] = T.StructType.fromJson(json.loads(row.row_schema))
    by_first = sorted((sorted(own), kind) for kind, own in kinds.items())
    return [(schemas.get(kind), own) for own, kind in by_first], sorted(suspects)


def _sorted_by_driver(
    spark: SparkSession, files: Sequence[str]
) -> tuple[list[tuple[T.StructType | None, list[str]]], list[str]]:
    """The same on file systems that only the JVM opens: the driver reads footers, if files differ."""
    whole = _probe(spark, files)
    if isinstance(whole, T.StructType):
        return [(whole, list(files))], []
    kinds: dict[str, list[str]] = {}
    suspects = []
    footer = inheritable_thread_target(spark)(_footer_reader(spark))
    with ThreadPoolExecutor(_PROBES) as pool:
        for path, (sound, stated) in zip(files, pool.map(footer, files), strict=True):
            if sound:
                kinds.setdefault(stated, []).append(path)
            else:
                suspects.append(path)
    return [(None, own) for own in kinds.values()], suspects


def _needed_fields(file_schema: T.StructType, schema: T.StructType) -> dict[str, T.StructField]:
    wanted = {name.lower() for name in schema.fieldNames()}
    needed = {f.name.lower(): f for f in file_schema if f.name.lower() in wanted}
    if not needed and len(file_schema):
        # Nothing of the schema is in the file; one column keeps its rows countable.
        first = file_schema[0]
        needed = {first.name.lower(): first}
    return {name: T.StructField(f.name, f.dataType, True) for name, f in needed.items()}


def group_by_types(
    probed: Sequence[tuple[T.StructType, list[str]]],
    schema: T.StructType,
    case_sensitive: bool = False,
) -> list[SchemaGroup]:
    """Merge probed runs whose needed columns have the same types; other columns do not count."""
    groups: list[SchemaGroup] = []
    for file_schema, paths in probed:
        needed = _needed_fields(file_schema, schema)
        for group in groups:
            shared = needed.keys() & group.fields.keys()
            if all(
                needed[name].dataType == group.fields[name].dataType
                and (not case_sensitive or needed[name].name == group.fields[name].name)
                for name in shared
            ):
                group.fields |= {n: f for n, f in needed.items() if n not in group.fields}
                group.paths.extend(paths)
                break
        else:
            groups.append(SchemaGroup(dict(needed), list(paths)))
    return groups


def conform_union(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    zone: str = "UTC",
    event_date: tuple[str, str] | None = None,
    on_reject: str = "quarantine",
) -> ConformedFiles:
    """Read all files, bend each to ``schema``, and union them.

    A file whose footer cannot be read, or that has a column no cast can turn into the wanted type,
    is listed in ``rejects``; with ``on_reject="raise"`` it stops the job instead. See
    ``conform_to_schema`` for ``zone`` and ``event_date``.
    """
    if on_reject not in ("quarantine", "raise"):
        raise ValueError(f"on_reject must be 'quarantine' or 'raise', not {on_reject!r}")
    with packed_lookups(spark, len(paths)):
        return _conform_union(spark, paths, schema, zone, event_date, on_reject)


def _conform_union(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    zone: str,
    event_date: tuple[str, str] | None,
    on_reject: str,
) -> ConformedFiles:
    probed, rejects = probe_schemas(spark, paths)
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"

    readable = []
    castable: dict[str, str | None] = {}
    for file_schema, run in probed:
        needed = T.StructType(list(_needed_fields(file_schema, schema).values()))
        key = needed.json()
        if key not in castable:
            castable[key] = _cast_error(spark, needed, schema, zone, event_date)
        reason = castable[key]
        if reason is None:
            readable.append((file_schema, run))
        else:
            rejects.extend((path, reason) for path in run)

    if rejects and on_reject == "raise":
        path, reason = min(rejects)
        raise ValueError(f"{len(rejects)} of {len(set(paths))} files rejected, first {path}: {reason}")

    groups = group_by_types(readable, schema, case_sensitive)
    frames = []
    for group in groups:
        reader = spark.read.schema(group.schema).options(**_READ_ALL)
        files = reader.parquet(*[literal_path(path) for path in group.paths])
        frames.append(conform_to_schema(files, schema, zone, event_date))
    if not frames:
        frames = [conform_to_schema(_empty_frame(spark, schema), schema, zone, event_date)]
    return ConformedFiles(
        df=union_by_name(frames),
        rejects=spark.createDataFrame(sorted(rejects), REJECT_SCHEMA),
        groups=groups,
        rejected=len(rejects),
    )


def _empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _cast_error(
    spark: SparkSession,
    file_schema: T.StructType,
    schema: T.StructType,
    zone: str,
    event_date: tuple[str, str] | None,
) -> str | None:
    """Why rows of this file schema cannot be cast, found by analysis on an empty frame."""
    try:
        conform_to_schema(_empty_frame(spark, file_schema), schema, zone, event_date)
    except (PySparkException, Py4JJavaError) as error:
        reason = _schema_error(error)
        if reason is None:
            raise
        return reason
    return None
