"""Where queries that write put their files and tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_databases: list[str] = []
_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a local one only where Spark itself is local."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="moraine-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name nobody has used; Spark creates it on the first write.

    It lies in a folder of the application, which is removed when the application ends.
    """
    return f"{_application_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def _application_folder(spark: SparkSession) -> str:
    key = spark.sparkContext.applicationId
    if key not in _folders:
        folder = f"{scratch_root(spark)}/moraine-{key}-{uuid.uuid4().hex[:12]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[key] = folder
    return _folders[key]


def new_database(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A fresh database whose managed tables live in a fresh folder: (name, folder)."""
    folder = new_folder(spark, purpose)
    name = f"moraine_{purpose}_{folder[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    if not _databases:
        atexit.register(drop_databases)
    _databases.append(name)
    return name, folder


def mount_folders(spark: SparkSession, mount: str, links: dict[str, str]) -> None:
    """Make folders reachable under a mount table of Hadoop's own, ``viewfs://name/link``."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for link, folder in links.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(hadoop)
        files.mkdirs(path)
        target = files.makeQualified(path).toString()
        hadoop.set(f"fs.viewfs.mounttable.{mount.removeprefix('viewfs://')}.link./{link}", target)


def drop_databases() -> None:
    """Drop the databases made here, with their tables, if the session that made them still lives."""
    spark = SparkSession.getActiveSession()
    while _databases and spark is not None and spark.sparkContext._jsc is not None:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
