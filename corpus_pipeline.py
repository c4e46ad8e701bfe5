"""A corpus made ready for training, in stages: each reads what the one before it kept.

``STAGES`` lists the stages as (name, function). A function takes the session, the documents so far
and the folder of the given tables, and returns the documents that stay. All stages but the last
keep the columns of ``documents``; the last turns texts into tokens.

In every stage: columns keep their names, order and values, whatever they are called, but for what
the stage says it changes. NULL and empty texts, NULL ids and repeated rows are treated as the stage's
operator says; no documents in give none out.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm import bpe, decontaminate, pii, simhash, toxicity
from moraine.llm.frames import materialize, quoted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


INPUTS = ("doc_id", "text")  # what operators read, by name


def aside(docs: DataFrame) -> DataFrame:
    """The documents, all columns but the operators' inputs under names that no output has."""
    names = [name if name in INPUTS else f"__llm_own_{i}" for i, name in enumerate(docs.columns)]
    return docs.select(
        *[quoted(name).alias(own) for name, own in zip(docs.columns, names, strict=True)]
    )


def back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns that ``aside`` renamed, as they were; an operator's outputs are left out."""
    names = aside(docs).columns
    return kept.select(
        *[quoted(own).alias(name) for name, own in zip(docs.columns, names, strict=True)]
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, with all their columns as they were."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return back(toxicity.score_documents(aside(docs), labels).where("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of SimHash near-duplicates, as it was."""
    return back(simhash.keep_one_of_each(aside(docs)), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages do not make up a twentieth or more, as they were."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    searched = decontaminate.search_benchmark(aside(docs), benchmark)
    return back(searched.where(~decontaminate.is_contaminated()), docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data in ``text`` is masked by its kind, and the ``n_chars`` of such
    texts, where there is this column, becomes their new length. All other columns stay."""
    masked = pii.mask_personal_data(aside(docs))
    if "n_chars" in docs.columns:
        own = aside(docs).columns[docs.columns.index("n_chars")]
        length = F.when(F.col("masked"), F.length("text").cast("long")).otherwise(F.col(own))
        masked = masked.withColumn(own, length)
    return back(masked, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, as little-endian unsigned 32-bit integers, and their number."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(docs, path, pattern)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "token_ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode),
]

# SQL cannot express learned scores, fingerprint trees or token merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
