"""What the operators share: column handling, a shared scratch folder, doc-id folds."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_outputs(df: DataFrame, outputs: Mapping[str, Column]) -> DataFrame:
    """``df`` and these columns. An input column of an output's name, in any case, is replaced."""
    taken = {name.lower() for name in outputs}
    kept = [quoted(name) for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in outputs.items()])


def with_struct(df: DataFrame, value: Column, fields: list[str], drop: tuple = ()) -> DataFrame:
    """``df`` and the fields of one struct-valued expression, which is evaluated once."""
    held = "__llm_struct"
    wide = df.withColumn(held, value)
    for name in drop:
        wide = wide.drop(quoted(name))
    out = with_outputs(wide, {name: F.col(f"{held}.{name}") for name in fields})
    return out.drop(held)


# Texts go to Python workers, and back, in batches of about this size.
BATCH_BYTES = 8 * 1024 * 1024
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Have the session send small batches to Python, so that long texts do not add up in a worker.

    The setting stays, since a plan is made when its rows are asked for; a smaller one is kept.
    """
    now = str(spark.conf.get(_BATCHES)).lower().removesuffix("b")
    scale = {"k": 2**10, "m": 2**20, "g": 2**30}.get(now[-1:], 1)
    if int(now.rstrip("kmg")) * scale > BATCH_BYTES:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))


_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors reach; it is removed when the application ends.

    It lies in ``spark.checkpoint.dir``. Only a local master may go without that setting.
    """
    key = spark.sparkContext.applicationId
    if key not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.match(r"local($|\[)", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            root = tempfile.mkdtemp(prefix="moraine-llm-")
        folder = f"{root.rstrip('/')}/llm-{key}-{uuid.uuid4().hex[:12]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[key] = folder
    return f"{_folders[key]}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str, file_rows: int = 0) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut.

    Later steps survive lost executors without computing it anew, and Spark knows its size. Files
    are cut at ``file_rows`` rows, if given.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % 4
