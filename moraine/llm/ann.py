"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables cuts space into buckets by rounding projections on random Gaussian vectors,
``floor((a.x + b) / w)``. A query visits its own bucket of every table and then perturbed ones, in
the order of how likely they hold a near vector: the squared distances to the bucket walls that a
perturbation crosses are added up, and small sums come first. The candidates of all tables are
merged and ranked by their exact distance, in double precision.

Equal vectors are one point of the index. It keeps its ``k + 1`` smallest ids, the only ones that
can be among anyone's ``k`` nearest, so a vector that a third of all rows share is no hot bucket.

The points stay where they are: each batch of them gets its own part of every table, a sorted list
of bucket codes, so that a vector is stored and read once and not once for each table, and no bucket
is brought together anywhere, however many points it holds. Queries come in blocks of bounded size,
each with the codes that it visits, and a task keeps the nearest of every query over its batches. A
query whose buckets hold too few candidates is answered by all points, in blocks again.

Defined results: rows whose vector is NULL, zero or holds a NULL or non-finite component, and rows
without an id, take no part. Rows that repeat an id and vector count once; rows with the query's id
are the query's own. Vectors of different lengths never meet. Ties go to the smaller id. An empty
table gives an empty table; columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, materialize, quoted, shared_folder

TABLES = 10
HASHES = 10
PROBES = 160  # buckets visited in each table
WIDTH = 2.5  # of a bucket, in standard deviations of a projection
SAMPLE_ROWS = 4096  # the standard deviation is taken from so many rows
FILE_ROWS = 16_384  # points of one file, so that few points still keep several tasks busy
BLOCK_QUERIES = 1024  # queries of one pass over the points

FOUND = "qid long, gid long, score double"


@dataclass(frozen=True)
class Hashing:
    """The random projections of all tables, for vectors of any length."""

    scales: dict[int, float]
    tables: int
    hashes: int
    seed: int

    def projections(self, length: int):
        random = np.random.default_rng((self.seed, length))
        size = (self.tables, self.hashes)
        vectors = random.standard_normal((length, self.tables * self.hashes))
        shifts = random.random(size)
        factors = random.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        salts = random.integers(0, 2**63, self.tables, dtype=np.uint64)
        return vectors, shifts, factors, salts

    def cells(self, points: np.ndarray):
        """For each point and table: bucket codes, and the place inside the bucket's walls."""
        vectors, shifts, factors, salts = self.projections(points.shape[1])
        width = WIDTH * self.scales.get(points.shape[1], 1.0)
        at = (points @ vectors / width).reshape(len(points), self.tables, self.hashes) + shifts
        floor = np.floor(np.clip(at, -(2.0**52), 2.0**52))
        codes = (floor.astype(np.int64).view(np.uint64) * factors).sum(axis=2) + salts
        return codes, at - floor, factors


def probe_order(inside: np.ndarray, probes: int) -> list[tuple[tuple[int, int], ...]]:
    """Perturbations (function, step) of a bucket, likeliest first.

    The costs of crossing a wall are sorted; sets of them are grown from the cheapest by shifting
    or adding the last member, so that sets come out of the heap by their total cost.
    """
    walls = [(x * x, i, -1) for i, x in enumerate(inside.tolist())]
    walls += [((1 - x) * (1 - x), i, 1) for i, x in enumerate(inside.tolist())]
    walls.sort()
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(walls[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({walls[c][1] for c in chosen}) == len(chosen):
            out.append(tuple(walls[c][1:] for c in chosen))
        last = chosen[-1]
        if last + 1 < len(walls):
            added = walls[last + 1][0]
            heapq.heappush(heap, (cost + added, (*chosen, last + 1)))
            heapq.heappush(heap, (cost + added - walls[last][0], (*chosen[:-1], last + 1)))
    return out


def probed_codes(hashing: Hashing, point: np.ndarray, probes: int) -> np.ndarray:
    codes, inside, factors = hashing.cells(point[None, :])
    out = []
    for table in range(hashing.tables):
        own = factors[table]
        for steps in probe_order(inside[0, table], probes):
            code = int(codes[0, table])
            for function, step in steps:
                code += step * int(own[function])
            out.append(code % 2**64)
    return np.unique(np.array(out, dtype=np.uint64))


def vectors_of(values: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each vector length and their vectors."""
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    held = values.to_numpy()
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, np.stack(held[rows]).astype("<f8")


def best(scores: np.ndarray, gids: np.ndarray, k: int) -> np.ndarray:
    """The k nearest, ties to the smaller id."""
    if len(scores) > k:
        kept = np.flatnonzero(scores <= np.partition(scores, k - 1)[k - 1])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((gids[kept], scores[kept]))][:k]


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - query).sum(axis=1))


@dataclass(frozen=True)
class Asked:
    """A query of a block. Without codes it looks at every point."""

    qid: int
    vector: np.ndarray
    codes: np.ndarray | None


def search_batches(
    batches: Iterator[pd.DataFrame], block: list[Asked], hashing: Hashing, k: int
) -> pd.DataFrame:
    """The nearest of the candidates among a task's points, for each query of a block."""
    scores = {q.qid: np.zeros(0) for q in block}
    nearest_gids = {q.qid: np.zeros(0, dtype=np.int64) for q in block}
    for batch in batches:
        all_gids = batch["gid"].to_numpy(np.int64)
        for rows, points in vectors_of(batch["vector"]) if len(batch) else ():
            gids = all_gids[rows]
            codes = hashing.cells(points)[0].ravel()
            order = np.argsort(codes, kind="stable")
            codes, owners = codes[order], order // hashing.tables
            for asked in block:
                if len(asked.vector) != points.shape[1]:
                    continue
                at = np.arange(len(points))
                if asked.codes is not None:
                    at = held_in(codes, owners, asked.codes, len(points))
                if not len(at):
                    continue
                own = np.concatenate([scores[asked.qid], distances(points[at], asked.vector)])
                near_gids = np.concatenate([nearest_gids[asked.qid], gids[at]])
                near = best(own, near_gids, k)
                scores[asked.qid], nearest_gids[asked.qid] = own[near], near_gids[near]
    return pd.DataFrame(
        {
            "qid": np.repeat(list(scores), [len(x) for x in scores.values()]).astype(np.int64),
            "gid": np.concatenate([*nearest_gids.values(), np.zeros(0, dtype=np.int64)]),
            "score": np.concatenate([*scores.values(), np.zeros(0)]),
        }
    )


def held_in(codes: np.ndarray, owners: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """The points that are in any of the wanted buckets of any table, each once."""
    low, high = np.searchsorted(codes, wanted), np.searchsorted(codes, wanted, "right")
    held = high - low
    shift = np.repeat(low - np.cumsum(held) + held, held)
    candidate = np.zeros(n, dtype=bool)
    candidate[owners[shift + np.arange(held.sum())]] = True
    return np.flatnonzero(candidate)


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    df: DataFrame,
    query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    seed: int = 17,
) -> DataFrame:
    """The ``k`` nearest other rows of each row that ``query`` (an expression on ``df``) selects.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the Euclidean distance.
    """
    bounded_batches(df.sparkSession)
    rows = usable_rows(df, vec_id, vector, query)
    points = materialize(points_of(rows, k), "points", FILE_ROWS)
    asked = rows.where("q").groupBy("digest", "id").agg(F.first("vector").alias("vector"))
    asked = materialize(asked, "queries")
    distinct_queries = asked.groupBy("digest").agg(
        F.min("id").alias("qid"), F.first("vector").alias("vector")
    )
    queries = asked.select("id", "digest").join(distinct_queries.select("digest", "qid"), "digest")

    hashing = Hashing(fit_scales(points), tables, hashes, seed)
    found = search(points, distinct_queries.drop("digest"), hashing, probes, k + 1)
    # Who has found too few, although there are more?
    sizes = points.select(F.col("gid").alias("own"), F.size("ids").alias("n"), F.size("vector").alias("l"))
    held = found.join(sizes, F.col("gid") == F.col("own")).groupBy("qid").agg(F.sum("n").alias("n"))
    lengths = sizes.groupBy("l").agg(F.sum("n").alias("all"))
    short = (
        distinct_queries.withColumn("l", F.size("vector"))
        .join(lengths, "l")
        .join(held, "qid", "left")
        .where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), F.col("all")))
        .select("qid", "vector")
    )
    found = found.unionByName(search(points, short, hashing, 0, k + 1))
    return ranked(found, points, queries, k)


def usable_rows(df: DataFrame, vec_id: str, vector: str, query: Column) -> DataFrame:
    """Rows that take part: id, vector, whether it is a query, and a digest of the vector.

    Vectors of ``float`` stay as they are, half the size. A digest is that of all components'
    shortest spellings as doubles, so rows have equal ones where their vectors are equal; adding
    0.0 makes a negative zero a positive one.
    """
    values = quoted(vector)
    if df.select(values).schema[0].dataType != T.ArrayType(T.FloatType()):
        values = values.cast("array<double>")
    rows = df.select(quoted(vec_id).cast("long").alias("id"), values.alias("vector"), query.alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    spelled = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).cast("string")
    return rows.withColumn("digest", F.unhex(F.sha2(spelled, 256)))


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """The different vectors, each with its smallest id and its ``k + 1`` smallest ids.

    Ids are brought together by digest, without vectors; a vector crosses the network once.
    """
    of_vector = Window.partitionBy("digest").orderBy("id")
    ids = (
        rows.select("digest", "id")
        .distinct()
        .withColumn("n", F.row_number().over(of_vector))
        .where(F.col("n") <= k + 1)
        .groupBy("digest")
        .agg(F.min("id").alias("gid"), F.collect_list("id").alias("ids"))
    )
    vectors = rows.groupBy("digest").agg(F.first("vector").alias("vector"))
    return ids.join(vectors, "digest").select("gid", "ids", "vector")


def fit_scales(points: DataFrame) -> dict[int, float]:
    """Standard deviation of a projection, by vector length, from a bounded sample."""
    sample = points.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE_ROWS).select("vector").toPandas()
    scales = {}
    for _, own in vectors_of(sample["vector"]):
        spread = float(np.sqrt(np.square(own - own.mean(axis=0)).sum(axis=1).mean()))
        scales[own.shape[1]] = spread or 1.0
    return scales


def search(
    points: DataFrame, queries: DataFrame, hashing: Hashing, probes: int, k: int
) -> DataFrame:
    """The nearest candidates (``qid``, ``gid``, ``score``), in passes over the points.

    A pass answers a block of queries, which it carries; what tasks find is written, so that the
    plan does not grow with the passes. Without probes all points are candidates.
    """

    def visit(batches):
        for batch in batches:
            codes = [
                probed_codes(hashing, np.asarray(v, "<f8"), probes).tobytes() if probes else b""
                for v in batch["vector"]
            ]
            yield batch.assign(codes=codes)

    spark = points.sparkSession
    name = queries.schema["vector"].dataType.simpleString()
    # Queries cost much for their bytes.
    spread = queries.repartition(spark.sparkContext.defaultParallelism, "qid")
    visiting = spread.mapInPandas(visit, f"qid long, vector {name}, codes binary")
    visiting = materialize(visiting, "visiting")
    blocks = -(-visiting.count() // BLOCK_QUERIES)
    path = shared_folder(spark, "found")
    nothing = spark.createDataFrame([], FOUND)
    nothing.write.parquet(path)
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block
        held = [
            Asked(q, np.asarray(v, "<f8"), np.frombuffer(c, "<u8") if probes else None)
            for q, v, c in visiting.where(of_block).toPandas().itertuples(index=False)
        ]

        def near(batches, held=held):
            yield search_batches(batches, held, hashing, k)

        points.select("gid", "vector").mapInPandas(near, FOUND).write.mode("append").parquet(path)
    return spark.read.schema(nothing.schema).parquet(path)


def ranked(found: DataFrame, points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ids of the nearest points for every row that asked."""
    near = found.groupBy("qid", "gid").agg(F.first("score").alias("score"))
    of_query = Window.partitionBy("qid").orderBy("score", "gid")
    near = near.withColumn("n", F.row_number().over(of_query)).where(F.col("n") <= k + 1)
    ids = near.join(points.select("gid", "ids"), "gid").select(
        "qid", "score", F.explode("ids").alias("vec_id")
    )
    of_query = Window.partitionBy("qid").orderBy("score", "vec_id")
    ids = ids.withColumn("n", F.row_number().over(of_query)).where(F.col("n") <= k + 1)
    rows = queries.select(F.col("id").alias("query_id"), "qid").join(ids, "qid")
    rows = rows.where(F.col("vec_id") != F.col("query_id"))
    of_row = Window.partitionBy("query_id").orderBy("score", "vec_id")
    rows = rows.withColumn("rank", F.row_number().over(of_row)).where(F.col("rank") <= k)
    return rows.select("query_id", "rank", "vec_id", "score")
