"""The landing folder: which files are there, and which of them belong to a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.settings import packed_lookups


def list_landing_files(
    spark: SparkSession, folder: str, pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """The files of a folder as ``(path)``, one row each; their contents are not read.

    ``pattern`` is a regular expression looked for anywhere in the full path; end it with ``$`` to
    anchor it. ``recursive`` also lists subfolders, for feeds that deliver a month as a folder.

    Tasks over this source are cut by file size although nothing is read, so large files would cost
    a task each; they are packed into a few per core.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    with packed_lookups(spark):
        paths = reader.load(folder).select("path")
    if pattern is not None:
        paths = paths.where(F.col("path").rlike(pattern))
    return paths.coalesce(4 * spark.sparkContext.defaultParallelism)


def collect_paths(listing: DataFrame) -> list[str]:
    """The listed paths on the driver, in name order: bounded by the number of files."""
    return sorted(row.path for row in listing.select("path").collect())
