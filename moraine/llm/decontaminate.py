"""Benchmark decontamination: an FM-index over each shard of the training texts.

A shard is a bounded run of documents. Its words become symbols, a suffix array and from it a
Burrows-Wheeler transform whose ranks a wavelet matrix answers. All windows of the benchmark are
searched backward at once; occurrences are located by walking to sampled suffix positions, and the
words that they cover are merged into removal spans.

Words that no benchmark item has, and runs of known words shorter than the shortest window, cannot
be part of an occurrence: they become separators. All other words of all documents are indexed.

Benchmark windows are sent to the tasks in blocks of bounded size, one pass for each block.

Defined results: a NULL or wordless text has no words and no hits; wordless items have no window;
items that share an id count as one; the windows of an item without an id are searched and hit like any
others, and only ``items`` has no name for it; rows that repeat are judged each; an empty table, of documents
or of items, is fine. Input columns of an output's name are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, materialize, quoted, with_struct

WINDOW = 13
SHARD_CHARS = 8_000_000
BLOCK_CHARS = 2_000_000  # about 175 MB while a driver builds a block, 30 MB where it is sent
SAMPLE_EVERY = 16

# Lower-cases A-Z; what is neither a digit, a letter of these nor outside ASCII parts words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

SPAN = T.StructType(
    [T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]
)
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class BitRanks:
    """A bit vector that counts the ones before any position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1]))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, BitRanks, int]] = []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit) & 1 != 0
            self.levels.append((bit, BitRanks(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` falls among the sorted symbols, seen from ``symbol``."""
        for bit, ranks, zeros in self.levels:
            ones = ranks.ones(at)
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions, and where they fall among the sorted symbols."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for bit, ranks, zeros in self.levels:
            one, ones = ranks.get(at), ranks.ones(at)
            symbol |= one.astype(np.int64) << bit
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Each 0 is a separator and unlike all others, in order of position.

    Prefix doubling: a round sorts only those suffixes that the rounds before left tied.
    """
    n = len(symbols)
    separators = symbols == 0
    first = np.where(separators, np.cumsum(separators), symbols.astype(np.int64) + n)
    order = np.argsort(first, kind="stable")
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    tied = _rank_groups(rank, order, first[order], np.arange(n))
    width = 1
    while len(tied):
        at = order[tied]
        key = rank[at] * (n + 1) + rank[np.minimum(at + width, n)] + 1
        moved = np.argsort(key, kind="stable")
        order[tied] = at[moved]
        tied = _rank_groups(rank, order, key[moved], tied)
        width *= 2
    return order


def _rank_groups(rank: np.ndarray, order: np.ndarray, keys: np.ndarray, slots: np.ndarray):
    """Rank suffixes by the first slot of their group of equal keys; the slots still tied."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    rank[order[slots]] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
    alone = new & np.append(new[1:], True)
    return slots[~alone]


class FmIndex:
    """Backward search over symbols that end in a separator; separators cannot be searched."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_array(symbols)
        self.length = n = len(symbols)
        self.ranks = WaveletMatrix(symbols[order - 1].astype(np.int64), n_symbols.bit_length())
        counts = np.bincount(symbols, minlength=n_symbols + 1)
        self.smaller = np.concatenate(([0], np.cumsum(counts)[:-1]))
        alphabet = np.arange(n_symbols + 1)
        self.origin = self.ranks.place(alphabet, np.zeros(n_symbols + 1, dtype=np.int64))
        # Positions that the walk of locate() stops at: every few, and all after a separator.
        sampled = np.arange(n) % SAMPLE_EVERY == 0
        sampled[1:] |= symbols[:-1] == 0
        marks = sampled[order]
        self.marks, self.samples = BitRanks(marks), order[marks]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, and their ranges of suffixes. All windows are equally long."""
        alive = np.arange(len(windows))
        start = np.zeros(len(windows), dtype=np.int64)
        end = np.full(len(windows), self.length, dtype=np.int64)
        for column in reversed(range(windows.shape[1])):
            symbol = windows[alive, column]
            base = self.smaller[symbol] - self.origin[symbol]
            start = base + self.ranks.place(symbol, start)
            end = base + self.ranks.place(symbol, end)
            found = end > start
            alive, start, end = alive[found], start[found], end[found]
            if not len(alive):
                break
        return alive, start, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back to a sampled one, counted."""
        out = np.empty(len(rows), dtype=np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            hit = self.marks.get(rows)
            out[left[hit]] = self.samples[self.marks.ones(rows[hit])] + steps
            left, rows, steps = left[~hit], rows[~hit], steps + 1
            symbol, place = self.ranks.access(rows)
            rows = self.smaller[symbol] + place - self.origin[symbol]
        return out


@dataclass
class Phrases:
    """A block of the benchmark: its vocabulary, its distinct windows by length, their items."""

    vocabulary: dict[bytes, int]
    windows: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                of_window = found[length][tuple(ids[i : i + length])]
                if item is not None:
                    of_window.add(item)
        windows = {k: np.array(list(v), dtype=np.int64) for k, v in found.items()}
        items = {k: [sorted(x) for x in v.values()] for k, v in found.items()}
        return cls(vocabulary, windows, items)


def search_shard(texts: list[str | None], phrases: Phrases):
    """For each text: its number of words, merged spans of words that windows cover, items."""
    get, zero = phrases.vocabulary.get, repeat(0)
    parts, sizes = [], []
    for text in texts:
        words = words_of(text)
        ids = np.zeros(len(words) + 1, dtype=np.int64)
        ids[:-1] = np.fromiter(map(get, words, zero), np.int64, len(words))
        parts.append(ids)
        sizes.append(len(words))
    nothing = [(n, [], []) for n in sizes]
    if not phrases.windows or not parts:
        return nothing
    ids = np.concatenate(parts)
    known = ids != 0
    edges = np.flatnonzero(np.diff(known, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    kept = ends - begins >= min(phrases.windows)
    begins, ends = begins[kept], ends[kept]
    if not len(begins):
        return nothing
    # Each kept run and the separator behind it.
    keep = np.zeros(len(ids) + 1, dtype=np.int8)
    np.add.at(keep, begins, 1)
    np.add.at(keep, np.minimum(ends + 1, len(ids)), -1)
    place = np.flatnonzero(np.cumsum(keep[:-1]) > 0)
    index = FmIndex(ids[place], len(phrases.vocabulary))

    offsets = np.cumsum([0, *(len(p) for p in parts)])
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for length, windows in phrases.windows.items():
        which, start, end = index.search(windows)
        for_each = end - start
        if not len(which):
            continue
        shift = np.repeat(start - np.cumsum(for_each) + for_each, for_each)
        rows = shift + np.arange(for_each.sum())
        at = place[index.locate(rows)]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length, -1)
        document = np.searchsorted(offsets, at, "right") - 1
        pairs = np.unique(np.stack((document, np.repeat(which, for_each))), axis=1)
        for d, w in pairs.T.tolist():
            items[d].update(phrases.items[length][w])
    hit = np.cumsum(covered) > 0
    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    spans: dict[int, list] = defaultdict(list)
    documents = np.searchsorted(offsets, edges[::2], "right") - 1
    for d, b, e in zip(documents.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        spans[d].append((b - int(offsets[d]), e - int(offsets[d])))
    return [(n, spans[d], sorted(items[d])) for d, n in enumerate(sizes)]


def shards_of(texts: list[str | None], limit: int = SHARD_CHARS):
    """Runs of texts of about ``limit`` characters; a longer text is one of its own."""
    shard, size = [], 0
    for text in texts:
        if shard and size + len(text or "") > limit:
            yield shard
            shard, size = [], 0
        shard.append(text)
        size += len(text or "")
    if shard:
        yield shard


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def phrase_blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int):
    """The benchmark's windows in blocks of bounded size, one after the other."""
    rows = benchmark.select(
        quoted(item).cast("string").alias("item"), quoted(text).cast("string").alias("text")
    ).where("text IS NOT NULL")
    # Rows that repeat add nothing, and may not fill a block.
    rows = materialize(rows.distinct(), "benchmark")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // limit) or 1
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block
        yield Phrases.of([(r["item"], r["text"]) for r in rows.where(own).collect()], window)


def search_benchmark(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit``, ``items`` and ``spans``.

    ``items`` are the ids of the benchmark items that have a window of ``window`` words in the
    text (a shorter item is one window), sorted as strings. ``spans`` are the words that such
    windows cover, as merged ranges of word numbers, the end exclusive; ``n_hit`` is their number.
    """
    bounded_batches(df.sparkSession)
    out, earlier = df, None
    for number, block in enumerate(phrase_blocks(benchmark, item, item_text, window, block_chars)):
        if number:
            out = materialize(out, "decontaminate")
            earlier = ("spans", "items")
        out = _search_block(out, block, text, earlier)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.withColumn("n_hit", hits)


def _search_block(df: DataFrame, phrases: Phrases, text: str, earlier) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(phrases)  # bounded by block_chars

    def found(texts: pd.Series):
        for shard in shards_of(texts.tolist()):
            yield from search_shard(shard, sent.value)

    def frame(rows) -> pd.DataFrame:
        names = ["begin", "end"]
        made = [
            (n, [dict(zip(names, s, strict=True)) for s in merged(spans)], sorted(set(items)))
            for n, spans, items in rows
        ]
        return pd.DataFrame(made, columns=FOUND.names)

    if earlier is None:

        @F.pandas_udf(FOUND)
        def search(texts: pd.Series) -> pd.DataFrame:
            return frame(found(texts))

        value = search(quoted(text).cast("string"))
    else:

        @F.pandas_udf(FOUND)
        def search(texts: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
            before = zip(spans, items, strict=True)
            return frame(
                (n, [*new, *((s["begin"], s["end"]) for s in old)], [*ids, *known])
                for (n, new, ids), (old, known) in zip(found(texts), before, strict=True)
            )

        value = search(quoted(text).cast("string"), *map(quoted, earlier))
    return with_struct(df, value, FOUND.names)


def is_contaminated(percent: int = 5):
    """The rule: hit words are at least this share of all words, and there are some."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
