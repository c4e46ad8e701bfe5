"""Documents with gaps: NULLs in every column, empty and long texts, ties, repeated rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet 42 " * 20_000
PLAIN = "the quick brown fox jumps over the lazy dog and runs away"

ROWS = [
    (None, None, None, None, None),
    (1, "", "en", "s", 0),
    (1, "", "en", "s", 0),
    (2, PLAIN, None, "s", 57),
    (2, PLAIN, "en", "s", 57),
    (2, PLAIN, "en", "s", 57),
    (None, PLAIN, "en", None, 57),
    (3, " \t\n", "en", "s", 3),
    (4, None, "en", "s", None),
    (5, LONG, "la", "s", len(LONG)),
    (6, "x" * 300_000, "xx", "s", 300_000),
    (7, "é漢😀 ñandú 漢字", "es", "s", 14),
    (8, "mail a.b@c.example.org or +1 (372) 555-8850", "en", "s", 44),
    (9, "1234567890" * 3000, "en", "s", 30_000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *clashes):
    """The rows, with an extra column for each name, which an operator is to replace or keep."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("extra", *clashes):
        df = df.withColumn(name, F.lit("old"))
    return df


def none(df):
    return df.where("1 = 0")


def plain(value):
    """A value that can be compared and sorted."""
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(plain(v) for v in r) for r in chosen.collect()), key=repr)


def labels(spark):
    schema = T.StructType.fromDDL("doc_id long, quality int, toxic int")
    return spark.createDataFrame([(2, 1, 0), (8, 1, 1), (8, None, 1), (None, 1, 1), (7, 1, None)], schema)
