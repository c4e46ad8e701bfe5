"""Parquet footers as rows: what files state of themselves, read by the tasks and not by the driver.

Spark gives a schema of files that agree and no way to ask for one of each file. So tasks open the
footers with pyarrow, side by side over all executors; this is the library's only Python in tasks, and
it sees paths and metadata, never rows. File systems that only the JVM can open are not for it:
``readable_by_tasks`` tells, and callers then go another way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Where Spark writes the schema of a file's rows.
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"

# Schemes that pyarrow opens, by the names it has for them.
_SCHEMES = {
    **{"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3"},
    **{"gs": "gs", "abfs": "abfs", "abfss": "abfss"},
}

KIND_SCHEMA = "path string, kind string, row_schema string, problem string"

FOOTER_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("problem", T.StringType()),
        T.StructField("written_by", T.StringType()),
        T.StructField("row_group", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("physical_type", T.StringType()),
        T.StructField("logical_type", T.StringType()),
        T.StructField("nulls", T.LongType()),
        T.StructField("least", T.StringType()),
        T.StructField("most", T.StringType()),
    ]
)


def _scheme(path: str) -> str:
    return path.split(":", 1)[0].lower() if ":/" in path else ""


def resolved(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Paths as their file systems resolve them: a mount table's links become what they lead to.

    One look-up for each folder, since links are folders.
    """
    folders: dict[str, str] = {}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for path in paths:
        if _scheme(path) in _SCHEMES:
            out[path] = path
            continue
        folder, _, name = path.rpartition("/")
        if folder not in folders:
            own = spark._jvm.org.apache.hadoop.fs.Path(folder)
            folders[folder] = own.getFileSystem(hadoop).resolvePath(own).toString()
        out[path] = f"{folders[folder].rstrip('/')}/{name}"
    return out


def readable_by_tasks(paths: Sequence[str]) -> bool:
    """Whether all the paths are on file systems that tasks can open themselves."""
    return all(_scheme(path) in _SCHEMES for path in paths)


def store_options(spark: SparkSession) -> dict[str, str]:
    """What the session says of an S3 store: endpoint, keys and region, as pyarrow names them."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    names = {
        "endpoint_override": "fs.s3a.endpoint",
        "access_key": "fs.s3a.access.key",
        "secret_key": "fs.s3a.secret.key",
        "session_token": "fs.s3a.session.token",
        "region": "fs.s3a.endpoint.region",
    }
    found = {name: hadoop.get(key) for name, key in names.items()}
    options = {name: value for name, value in found.items() if value}
    if "endpoint_override" in options:
        secure = hadoop.getBoolean("fs.s3a.connection.ssl.enabled", True)
        options["scheme"] = "https" if secure else "http"
        options["endpoint_override"] = options["endpoint_override"].split("://")[-1]
    return options


def _open(path: str, store: Mapping[str, str]):
    """A footer's metadata. Raises ``pa.ArrowInvalid`` for a damaged file, else ``OSError``."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    kind = _SCHEMES[_scheme(path)]
    if kind == "file":
        system, own = fs.LocalFileSystem(), path
        if ":/" in path:
            # Paths come as file systems spell them: no character stands for another.
            own = "/" + path.split(":", 1)[1].lstrip("/")
    elif kind == "s3":
        system, own = fs.S3FileSystem(**store), path.split("://", 1)[1]
    else:
        system, own = fs.FileSystem.from_uri(path)
    with system.open_input_file(own) as file:
        return pq.read_metadata(file)


def _tried(path: str, store: Mapping[str, str]):
    """The metadata, or what is wrong; callers ask Spark itself about files with a problem."""
    try:
        return _open(path, store), None
    except (pa.ArrowException, OSError, ValueError, KeyError) as error:
        return None, f"{type(error).__name__}: {error}".strip()


def _paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = [(path, place) for path, place in resolved(spark, sorted(set(paths))).items()]
    return spark.createDataFrame(rows, "path string, place string")


def footer_kinds(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, kind, row_schema, problem)``, a row for each file.

    Files of one kind state the same columns and types. ``row_schema`` is the schema that Spark left
    in the file, as JSON; each task gives it with the first file of a kind only. A file that could not
    be opened, or is no sound Parquet file, has a problem and no kind.
    """
    store = store_options(spark)

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            out = []
            for path, place in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                footer, problem = _tried(place, store)
                if footer is None:
                    out.append((path, None, None, problem))
                    continue
                own = (footer.metadata or {}).get(ROW_METADATA, b"")
                stated = str(footer.schema).partition("\n")[2]  # the first line names an object
                kind = hashlib.sha256(stated.encode() + own).hexdigest()
                first = kind not in seen
                seen.add(kind)
                out.append((path, kind, own.decode() if own and first else None, None))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("path", "kind", "row_schema", "problem"), row, strict=True)) for row in out],
                schema=pa.schema([(n, pa.string()) for n in ("path", "kind", "row_schema", "problem")]),
            )

    return _paths(spark, paths).mapInArrow(kinds, KIND_SCHEMA)


def _spelled(value) -> str | None:
    """A statistic as text that casts back to the value; bytes have none."""
    if value is None or isinstance(value, bytes):
        return None
    return value.isoformat(" ") if hasattr(value, "hour") else str(value)


def _ends(facts) -> tuple[str | None, str | None]:
    if facts is None or not facts.has_min_max:
        return None, None
    try:
        return _spelled(facts.min), _spelled(facts.max)
    except pa.ArrowNotImplementedError:  # INT96 has no order
        return None, None


def read_footers(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A row for each file, row group and column, see ``FOOTER_SCHEMA``; no data is read.

    ``columns`` narrows it to columns of these names, in any case. ``least`` and ``most`` are the
    statistics as text, NULL where a file has none. A file without row groups, and one with a
    problem, has one row whose ``column`` is NULL.
    """
    store = store_options(spark)
    wanted = None if columns is None else {name.lower() for name in columns}
    names = FOOTER_SCHEMA.names
    kinds = [pa.string()] * 3 + [pa.int32(), pa.int64()] + [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def rows_of(path: str, place: str) -> Iterator[tuple]:
        footer, problem = _tried(place, store)
        if footer is None or not footer.num_row_groups:
            writer = footer.created_by if footer else None
            yield (path, problem, writer, None, 0 if footer else None, *[None] * 6)
            return
        for number in range(footer.num_row_groups):
            group = footer.row_group(number)
            for i in range(group.num_columns):
                chunk, column = group.column(i), footer.schema.column(i)
                if wanted is not None and column.path.lower() not in wanted:
                    continue
                facts = chunk.statistics if chunk.is_stats_set else None
                nulls = facts.null_count if facts and facts.has_null_count else None
                yield (
                    path, None, footer.created_by, number, group.num_rows, column.path,
                    column.physical_type, str(column.logical_type), nulls,
                    *_ends(facts),
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, place in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = [dict(zip(names, row, strict=True)) for row in rows_of(path, place)]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

    return _paths(spark, paths).mapInArrow(read, FOOTER_SCHEMA)
