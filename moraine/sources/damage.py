"""Damage behind a sound footer: it fails the job, and here all files that have it are named.

Spark stops at the first file it cannot decode. Once that has happened, the files are read again in a
mode that passes over damage, the rows that come of each file are compared with what its footer
states, and each file that lacks some is tried by itself, for the reason. Nothing is left out of any
result: the job has failed, and the error says what is to be delivered anew.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.sources.conformed import ConformedFiles, literal_path
from moraine.sources.footers import read_footers, readable_by_tasks, resolved

_FAILED_READ = "FAILED_READ_FILE"
_CAUSE = re.compile(r"Caused by: ([^\n]+)")


@dataclass(frozen=True)
class Damage:
    path: str
    row_group: int
    reason: str


class DamagedFiles(ValueError):
    """Files whose footers are sound cannot be read."""

    def __init__(self, damages: Sequence[Damage]):
        self.damages = list(damages)
        named = "; ".join(f"{d.path} from row group {d.row_group}: {d.reason}" for d in self.damages)
        super().__init__(f"{len(self.damages)} files cannot be read: {named}")


def _decoded(df: DataFrame, *keys) -> DataFrame:
    """The rows of each file; every column of every row is decoded for it."""
    values = [F.col(f"`{name}`") for name in df.columns]
    plain = [v for v, f in zip(values, df.schema, strict=True) if not isinstance(f.dataType, T.MapType)]
    return df.groupBy(F.col("_metadata.file_path").alias("file"), *keys).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*plain or [F.lit(1)])).alias("decoded")
    )


def _same_spelling(path: str) -> str:
    """A path as metadata or a listing spells it, comparable."""
    return re.sub(r"^(\w+):/+", r"\1:/", path if ":/" in path else f"file:{path}")


def damaged_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> list[Damage]:
    """The files of which not all rows can be read, with the first row group that lacks some."""
    stated: dict[str, list[tuple[int, int]]] = {}
    footers = read_footers(spark, paths).select("path", "row_group", "rows").distinct()
    for row in footers.where("row_group IS NOT NULL").orderBy("path", "row_group").collect():
        stated.setdefault(row.path, []).append((row.row_group, row.rows))
    literal = [literal_path(path) for path in paths]
    passing = spark.read.schema(schema).option("ignoreCorruptFiles", "true")
    found = {
        _same_spelling(unquote(row.file)): row.rows for row in _decoded(passing.parquet(*literal)).collect()
    }
    suspects = [
        path
        for path, groups in stated.items()
        if found.get(_same_spelling(path), 0) != sum(rows for _, rows in groups)
    ]
    out = []
    for path in sorted(suspects):
        # A task may have passed over the file for another reason than damage: what Spark says of
        # this file alone decides.
        try:
            own = spark.read.schema(schema).option("ignoreCorruptFiles", "false")
            _decoded(own.parquet(literal_path(path))).collect()
        except (PySparkException, Py4JJavaError) as error:
            reason = (_CAUSE.findall(str(error)) or str(error).splitlines())[-1]
            out.append(Damage(path, _first_short(passing.parquet(literal_path(path)), stated[path]), reason))
    return out


def _first_short(df: DataFrame, groups: Sequence[tuple[int, int]]) -> int:
    """The first row group that lacks rows, by the places of the rows that were read."""
    ends, total = [], 0
    for _, rows in groups:
        total += rows
        ends.append(total)
    place = F.col("_metadata.row_index")
    group = F.size(F.filter(F.array(*map(F.lit, ends)), lambda end: end <= place))
    read = {row.row_group: row.rows for row in _decoded(df, group.alias("row_group")).collect()}
    short = [number for i, (number, rows) in enumerate(groups) if read.get(i, 0) < rows]
    return short[0] if short else groups[0][0]


@contextmanager
def naming_damage(spark: SparkSession, files: ConformedFiles) -> Iterator[None]:
    """Where the block fails on a file that cannot be read, the error names all such files."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        if _FAILED_READ not in str(error):
            raise
        damages = []
        for group in files.groups:
            if readable_by_tasks(list(resolved(spark, group.paths).values())):
                damages += damaged_files(spark, group.paths, group.schema)
        if not damages:
            raise
        raise DamagedFiles(damages) from error
