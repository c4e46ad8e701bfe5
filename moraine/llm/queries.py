"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm import (
    ann,
    bpe,
    decontaminate,
    exact_dedup,
    language,
    lexical,
    periodic,
    pii,
    secrets,
    sharding,
    simhash,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    printed = simhash.with_fingerprint(documents).drop("text")
    linked = simhash.with_components(printed)
    hexadecimal = simhash.as_hex(F.col("fingerprint")).alias("fingerprint")
    return linked.select("doc_id", hexadecimal, "component_id")


@query
def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return sharding.shard_by_bytes(sized, "size").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(documents)
    return found.select(
        "doc_id",
        *[pii.number_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("found")).alias("spans"),
    )


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(documents, path, pattern).drop("text")
    decoded = bpe.decode_documents(encoded, path, pattern)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.search_benchmark(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


ORACLE_SQL["op7_benchmark_decontamination"] = """
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS r
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
        FROM docs, lengths WHERE len(w) >= n)),
found AS (SELECT r, i, places.n AS n, item FROM places JOIN windows USING (n, s)),
hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found))
  GROUP BY r),
named AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


@query
def op9_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(embeddings, F.col("vec_id") % 100 == 0, k=10)


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(documents)
    return found.select(
        "doc_id",
        secrets.number_of(F.col("base"), "assign").alias("n_assign"),
        secrets.number_of(F.col("base"), "access").alias("n_access"),
        secrets.number_of(F.col("base"), "hex").alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("found")).alias("spans"),
    )


@query
def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(documents, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op5_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify_language(documents)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = exact_dedup.with_copies(exact_dedup.with_recipes(documents).drop("text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL["op11_chunk_recipe_dedup"] = """
WITH docs AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t,
    length(coalesce(text, '')) AS n
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(t) AS text_sha256
FROM docs WINDOW best AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST)
"""


@F.pandas_udf(T.StringType())
def with_planted_runs(ids: pd.Series, texts: pd.Series) -> pd.Series:
    """The contract's texts: of every tenth document the end repeats some of its words."""
    return pd.Series(map(planted, ids, texts), dtype=object)


def planted(doc_id: int | None, text: str | None) -> str | None:
    """The text itself, or its words joined by a space if it is one of those that are rewritten."""
    if pd.isna(doc_id) or text is None:
        return text
    g, rest = divmod(zlib.crc32(b"%d" % doc_id), 10)
    words = periodic.words_of(text)
    n = len(words)
    if rest or not n:
        return text
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    words[start:] = [words[start + (i - start) % period] for i in range(start, n)]
    return b" ".join(words).decode()


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", with_planted_runs("doc_id", "text").alias("text")
    )
    found = periodic.find_runs(documents).withColumn("best", periodic.longest_run())
    line = F.transform(
        "runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    )
    lines = F.array_join(F.transform(line, lambda text: F.concat(text, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


@query
def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank_documents(documents, table(spark, sf_dir, "benchmark"), k=10)


ORACLE_SQL["op13_ranked_lexical_search"] = """
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM terms WHERE len(w) > 0),
totals AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
  FROM benchmark),
held AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY t, nd),
scores AS (
  SELECT item_id, r, CAST(sum(
    weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN docs USING (r), totals
  GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
