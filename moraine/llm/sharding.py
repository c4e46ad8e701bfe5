"""Histogram sort: rows into shards of near-equal bytes, each in key order, by one exchange.

Candidate key boundaries are probed in rounds: each round counts, across all partitions, the exact
bytes and rows below every probe, and keeps for each wanted boundary the two probes around it. It
ends for a boundary when its bytes are within the tolerance, or when no key lies between the two.
Then the rows move once, to their shard and part of a shard.

Defined results: a key that is NULL sorts before all others. Rows with equal keys, also a hot key
or rows repeated whole, are told apart by their place in the input, so they can be split between
shards like any others. An empty table gives an empty table. Input columns of an output's name are
replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import materialize, quoted, with_outputs

KEY, TIE, SIZE, PLACE = "__llm_key", "__llm_tie", "__llm_size", "__llm_place"
LOWEST, TIES = -(2**63), 2**63
PROBES = 16  # new probes for each open boundary and round
PART_ROWS = 2_000_000  # rows that one task numbers, as far as MOST_PARTS allows
MOST_PARTS = 64  # parts of a shard


@dataclass(frozen=True)
class Point:
    """A candidate boundary and what lies below it. ``at`` orders (key, tie) as one integer."""

    at: int
    size: int
    rows: int


def as_point(key: int, tie: int) -> int:
    return (key - LOWEST) * TIES + tie


def split_points(points: list[int]) -> tuple[np.ndarray, np.ndarray]:
    pairs = [divmod(p, TIES) for p in points]
    keys = np.array([k + LOWEST for k, _ in pairs], dtype=np.int64)
    return keys, np.array([t for _, t in pairs], dtype=np.int64)


def points_reached(points: tuple, keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """For each row, how many of the sorted points are not above it."""
    at_keys, at_ties = points
    low = np.searchsorted(at_keys, keys, "left")
    high = np.searchsorted(at_keys, keys, "right")
    # Only rows whose key is itself a probe's depend on their tie.
    same = np.flatnonzero(high > low)
    firsts = low[same]
    for first in np.unique(firsts):
        rows = same[firsts == first]
        own = at_ties[first : high[rows[0]]]
        low[rows] = first + np.searchsorted(own, ties[rows], "right")
    return low


def counts_below(df: DataFrame, points: list[int]) -> list[Point]:
    """The exact bytes and rows below each of the sorted points: one number for each and task."""
    split = split_points(points)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, rows = np.zeros(len(points) + 1, np.int64), np.zeros(len(points) + 1, np.int64)
        for batch in batches:
            keys, ties, own = (batch.column(i).to_numpy() for i in range(3))
            reached = points_reached(split, keys, ties)
            np.add.at(sizes, reached, own)
            rows += np.bincount(reached, minlength=len(rows))
        bins = np.flatnonzero(rows)
        columns = [bins.astype(np.int64), sizes[bins], rows[bins]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bin", "size", "rows"])

    by_task = df.select(KEY, TIE, SIZE).mapInArrow(histogram, "bin long, size long, rows long")
    summed = by_task.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("n"))
    found = {r["bin"]: (r["size"], r["n"]) for r in summed.collect()}  # at most one for each probe
    out, size, rows = [], 0, 0
    for i, at in enumerate(points):
        size, rows = size + found.get(i, (0, 0))[0], rows + found.get(i, (0, 0))[1]
        out.append(Point(at, size, rows))
    return out


def splitters(df: DataFrame, cuts: int, slack: float) -> list[Point]:
    """``cuts - 1`` boundaries that part the rows of ``df`` into near-equal bytes."""
    ends = df.agg(
        F.min(KEY).alias("a"), F.max(KEY).alias("b"), F.sum(SIZE).alias("s"), F.count(KEY).alias("n")
    ).first()
    if not ends["n"]:
        return [Point(0, 0, 0)] * (cuts - 1)
    beyond = min(as_point(ends["b"] + 1, 0), as_point(2**63 - 1, TIES - 1))
    known = [Point(as_point(ends["a"], 0), 0, 0), Point(beyond, ends["s"], ends["n"])]
    wanted = [ends["s"] * (j + 1) / cuts for j in range(cuts - 1)]
    while True:
        sizes, probes = [p.size for p in known], set()
        for target in wanted:
            low, high = around(known, sizes, target)
            near = min(abs(low.size - target), abs(high.size - target))
            if near > slack and high.rows - low.rows > 1 and high.at - low.at > 1:
                step = (high.at - low.at) / (PROBES + 1)
                between = (low.at + int(step * (i + 1)) for i in range(PROBES))
                probes.update(p for p in between if low.at < p < high.at)
                probes.add((low.at + high.at) // 2)
        if not probes:
            break
        known = sorted({*known, *counts_below(df, sorted(probes))}, key=lambda p: p.at)
    chosen = [min(around(known, sizes, t), key=lambda p: abs(p.size - t)) for t in wanted]
    return sorted(chosen, key=lambda p: p.at)


def around(known: list[Point], sizes: list[int], target: float) -> tuple[Point, Point]:
    after = min(max(bisect_right(sizes, target), 1), len(known) - 1)
    return known[after - 1], known[after]


def shard_by_bytes(
    df: DataFrame, size: str, shards: int = 16, key: str = "doc_id", tolerance: float = 1e-4
) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard, in key order).

    ``size`` is a column of row sizes and ``key`` an integer column. Shards differ from an equal
    share by at most ``tolerance`` of it, or by a single row where one row is larger than that.
    What ``df`` holds is written to the shared folder once, so that all rounds see the same rows.
    """
    placed = materialize(
        df.select(
            "*",
            F.coalesce(quoted(key).cast("long"), F.lit(LOWEST)).alias(KEY),
            F.monotonically_increasing_id().alias(TIE),
            F.coalesce(quoted(size).cast("long"), F.lit(0)).alias(SIZE),
        ),
        "shards",
    )
    total = placed.agg(F.sum(SIZE).alias("s"), F.count(SIZE).alias("n")).first()
    parts = min(MOST_PARTS, -(-total["n"] // (shards * PART_ROWS)) or 1)
    cuts = splitters(placed, shards * parts, tolerance * (total["s"] or 0) / shards)
    split = split_points([p.at for p in cuts])
    # Rows before each part, within its shard.
    before = np.array([0, *(p.rows for p in cuts)], dtype=np.int64)
    before -= np.repeat(before[::parts], parts)

    place = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("before", T.LongType()),
        ]
    )

    @F.pandas_udf(place)
    def placing(keys: pd.Series, ties: pd.Series) -> pd.DataFrame:
        part = points_reached(split, keys.to_numpy(), ties.to_numpy())
        return pd.DataFrame({"part": part, "shard": part // parts, "before": before[part]})

    routed = placed.withColumn(PLACE, placing(KEY, TIE))
    in_part = Window.partitionBy(f"{PLACE}.part").orderBy(KEY, TIE)
    slot = F.col(f"{PLACE}.before") + F.row_number().over(in_part) - 1
    sharded = with_outputs(
        routed, {"shard": F.col(f"{PLACE}.shard"), "slot": slot.cast("long")}
    )
    return sharded.drop(KEY, TIE, SIZE, PLACE)
