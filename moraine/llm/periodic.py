"""Periodic runs of words, found by block convolution with an exact number-theoretic transform.

A run is a stretch of words with smallest period q that is at least 6 words and 4 periods long and
that no neighbouring word extends. At each dyadic scale B the words are cut into blocks of B, and the
sum of squared differences between a block and the words at every distance from B to 2 B - 1 behind
it is computed for all these distances at once, by number-theoretic transforms modulo one or more
primes whose product the sums cannot reach. So a sum is zero exactly where the block occurs. A run
of such a period always holds a whole block and its repetition; distances of zero sums are
extended word by word, and what is long enough is a run.

Blocks are not transformed where they cannot matter, which tests hold against the plain definition:
a block that starts a repetition has no word without another occurrence close behind, and what lies
in a known run only repeats its period. Blocks are at most ``MOST_BLOCK`` words and larger distances
are searched piece by piece, so memory is bounded by the text's own length. Texts of a batch are
searched as one sequence; separators between them, all different, keep runs inside a text.

Defined results: a NULL or wordless text has no run and collapses to an empty text. Rows that
repeat are searched each, an empty table gives an empty table, and input columns of an output's name
are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, quoted, with_struct

LEAST_WORDS, LEAST_PERIODS = 6, 4
MOST_BLOCK = 1 << 14
BATCH_VALUES = 1 << 19  # values transformed at once

# Primes that leave 1 when divided by 2^26, each with a root of unity's generator.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))

RUN = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("start", "length", "period")]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)
Run = tuple[int, int, int]  # start, length, period


def words_of(text: str | None) -> list[bytes]:
    """Maximal stretches of characters that are no white space of ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").split()


# --- exact convolution --------------------------------------------------------------------------


@lru_cache(maxsize=64)
def _roots(prime: int, generator: int, length: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a primitive root of unity of order ``length``."""
    root = pow(generator, (prime - 1) // length, prime)
    if inverse:
        root = pow(root, prime - 2, prime)
    powers = np.ones(max(length // 2, 1), dtype=np.uint64)
    known = 1
    while known < len(powers):
        step = np.uint64(pow(root, known, prime))
        powers[known : 2 * known] = powers[:known] * step % np.uint64(prime)
        known *= 2
    return powers


def transform(values: np.ndarray, prime: int, generator: int, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row; rows are a power of two long.

    Halves are combined until one value is left of each, the results in order at every step.
    """
    rows, length = values.shape
    modulus = np.uint64(prime)
    # Shape (rows, part of the spectrum, place): Stockham's arrangement needs no reordering.
    now = values.reshape(rows, 1, length)
    while now.shape[2] > 1:
        half = now.shape[2] // 2
        spread = now.shape[1]
        even, odd = now[:, :, :half], now[:, :, half:]
        turned = odd * _roots(prime, generator, 2 * spread, inverse)[:spread, None] % modulus
        both = (even + turned) % modulus, (even + modulus - turned) % modulus
        now = np.concatenate(both, axis=1)
    out = now.reshape(rows, length)
    if inverse:
        out = out * np.uint64(pow(length, prime - 2, prime)) % modulus
    return out


def squared_differences(
    blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int
) -> np.ndarray:
    """Modulo a prime: the sum of squared differences of each block and its window, by offset.

    Windows are twice as long as blocks; offsets go from 0 to the length of a block, exclusive.
    """
    size, modulus = blocks.shape[1], np.uint64(prime)
    block, window = blocks.astype(np.uint64) % modulus, windows.astype(np.uint64) % modulus
    turned = np.zeros_like(window)
    turned[:, 0], turned[:, size + 1 :] = block[:, 0], block[:, :0:-1]
    spectrum = transform(window, prime, generator) * transform(turned, prime, generator) % modulus
    product = transform(spectrum, prime, generator, inverse=True)[:, :size]
    squares = np.cumsum(window * window % modulus, axis=1)  # sums stay below 2^64: 2^15 terms of 2^31
    before = np.concatenate((np.zeros((len(blocks), 1), np.uint64), squares[:, : size - 1]), axis=1)
    own = (block * block % modulus).sum(axis=1, keepdims=True)
    total = (squares[:, size - 1 : 2 * size - 1] - before + own) % modulus
    return (total + 2 * (modulus - product)) % modulus


def primes_for(block: int, largest: int) -> list[tuple[int, int]]:
    """As many primes as make sums of ``block`` squared differences exact."""
    chosen, product = [], 1
    for prime in PRIMES:
        chosen.append(prime)
        product *= prime[0]
        if block * largest * largest < product:
            return chosen
    raise ValueError("too many different words in one batch")


# --- runs -----------------------------------------------------------------------------------------


def next_distance(ids: np.ndarray) -> np.ndarray:
    """How far behind each word its next occurrence is; the sequence's length where there is none."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), len(ids) + 1, dtype=np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def occurrences(ids: np.ndarray, starts: np.ndarray, size: int, first: int, largest: int):
    """Which of the blocks at ``starts`` occur at distances from ``first`` on, ``size`` of them."""
    step = max(BATCH_VALUES // (2 * size), 1)
    primes = primes_for(size, largest)
    for begin in range(0, len(starts), step):
        own = starts[begin : begin + step]
        blocks = ids[own[:, None] + np.arange(size)]
        at = own[:, None] + (first + np.arange(2 * size))
        windows = np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], 0)
        zero = np.ones((len(own), size), dtype=bool)
        for prime in primes:
            alive = np.flatnonzero(zero.any(axis=1))
            if not len(alive):
                break
            zero[alive] &= squared_differences(blocks[alive], windows[alive], *prime) == 0
        which, offset = np.nonzero(zero)
        yield own[which], offset + first


class Runs:
    """Runs found so far, and for each word the run that reaches farthest."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.found: dict[tuple[int, int], int] = {}  # (start, period) -> end
        self.reach = np.zeros(len(ids), dtype=np.int64)
        self.period = np.ones(len(ids), dtype=np.int64)

    def inside(self, starts: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return self.reach[starts] >= starts + length

    def repeats(self, starts: np.ndarray, distances: np.ndarray, size: int) -> np.ndarray:
        """Seeds that only say again what a known run says."""
        known = self.inside(starts, distances + size)
        return known & (distances % self.period[starts] == 0)

    def extend(self, start: int, distance: int, size: int) -> None:
        """Take in the run of this period around a block and its repetition, if it is long enough."""
        end = start + size + _agreement(self.ids, start + size, distance, 1)
        begin = start - _agreement(self.ids, start - 1, distance, -1)
        end += distance
        if end - begin < max(LEAST_WORDS, LEAST_PERIODS * distance):
            return
        self.found[begin, distance] = end
        farther = self.reach[begin:end] < end
        self.reach[begin:end][farther] = end
        self.period[begin:end][farther] = distance


def _agreement(ids: np.ndarray, at: int, distance: int, way: int) -> int:
    """How many words from ``at`` on, or backward, equal the word ``distance`` behind them."""
    room = len(ids) - distance - at if way > 0 else at + 1
    done, step = 0, 16
    while done < room:
        step = min(step, room - done)
        low = at + done if way > 0 else at - done - step + 1
        equal = ids[low : low + step] == ids[low + distance : low + distance + step]
        if not equal.all():
            return done + int((~(equal if way > 0 else equal[::-1])).argmax())
        done, step = done + step, step * 2
    return done


def periodic_runs(ids: np.ndarray, longest: int, most_block: int = MOST_BLOCK) -> list[Run]:
    """All runs of a sequence of positive integers no part of which is longer than ``longest``.

    What is to be kept apart is parted by integers that occur once.
    """
    runs = Runs(ids)
    if not len(ids):
        return []
    largest = int(ids.max())
    # The largest next distance of the words of each block.
    farthest, block = next_distance(ids), 1
    while LEAST_PERIODS * block <= longest:
        size = min(block, most_block)
        whole = len(farthest) if size == block else len(ids) // block
        starts = np.arange(whole, dtype=np.int64) * block
        if block > size:
            limit = farthest[starts // size]
        else:
            limit = farthest
        starts = starts[limit <= 2 * block - 1]
        # Of a block that lies in a run with all distances in question, nothing new can be said.
        starts = starts[~(runs.inside(starts, 2 * block + size) & (runs.period[starts] <= size))]
        for first in range(block, 2 * block, size):
            for at, distance in occurrences(ids, starts, size, first, largest):
                new = ~runs.repeats(at, distance, size)
                for start, d in zip(at[new].tolist(), distance[new].tolist(), strict=True):
                    one = np.array([start])
                    if not runs.repeats(one, np.array([d]), size)[0]:
                        runs.extend(start, d, size)
        if 2 * block <= most_block:
            even = len(farthest) // 2 * 2
            farthest = np.maximum(farthest[0:even:2], farthest[1:even:2])
        block *= 2
    return sorted((start, end - start, period) for (start, period), end in runs.found.items())


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, given as words; starts count from the text's first word."""
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    parts, offsets = [], [0]
    for words in texts:
        parts.extend(number(word, len(vocabulary) + 1) for word in words)
        parts.append(0)
        offsets.append(len(parts))
    ids = np.array(parts, dtype=np.int64)
    gaps = np.flatnonzero(ids == 0)
    ids[gaps] = len(vocabulary) + 1 + np.arange(len(gaps))
    out: list[list[Run]] = [[] for _ in texts]
    longest = max(map(len, texts), default=0)
    for start, length, period in periodic_runs(ids, longest):
        text = int(np.searchsorted(offsets, start, "right")) - 1
        out[text].append((start - offsets[text], length, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    dropped = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    return [word for word, gone in zip(words, dropped.tolist(), strict=True) if not gone]


def searched(texts: list[str | None]) -> Iterator[tuple[int, list[dict], str]]:
    words = [words_of(text) for text in texts]
    for own, runs in zip(words, runs_of(words), strict=True):
        digest = hashlib.sha256(b" ".join(collapsed(own, runs))).hexdigest()
        yield len(own), [dict(zip(RUN.names, run, strict=True)) for run in runs], digest


def find_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``runs`` and ``collapsed_sha256``.

    ``runs`` are structs of start (a word's number, from 0), length and period, by start and period.
    ``collapsed_sha256`` is of the words that stay if each run is cut to its first period, joined by
    one space.
    """
    bounded_batches(df.sparkSession)

    @F.pandas_udf(FOUND)
    def search(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(searched(texts.tolist())), columns=FOUND.names)

    return with_struct(df, search(quoted(text).cast("string")), FOUND.names)


def longest_run() -> Column:
    """The run of ``runs`` with the greatest length, then the smallest start and period; or NULL."""
    def key(run: Column) -> Column:
        return F.struct((-run["length"]).alias("length"), run["start"], run["period"])

    ordered = F.transform("runs", key)
    best = F.array_min(ordered)
    return F.struct(
        best["start"].alias("start"),
        (-best["length"]).alias("length"),
        best["period"].alias("period"),
    )
