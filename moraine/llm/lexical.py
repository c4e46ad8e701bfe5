"""Ranked lexical search: the best documents for each item, by branch and bound over an FP-tree.

Documents become vectors of the terms that any item asks for, with how often they hold them. Each
task takes bounded runs of these vectors. In a run the terms of a vector are put in order of their
document frequency, most frequent first, and sorted vectors share the paths of a trie. A chain of
nodes with one child each is one node, and a subtree of few documents is one leaf. Every node knows
the largest number of occurrences of each term, the smallest length measure and the smallest id below
it, which bound the score of every document there from above. For each item the tree is searched
depth first, the most promising branch first; a branch goes whose bound is below the item's k-th best
score so far, or equal to it with larger ids only. So the result is that of scoring every document.

Scores are whole numbers: a term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` for N documents
with a term and df with this one; a document's measure m is ``10 + 90 n N div L`` for its n of all L
terms; the score adds up ``weight * (1000000000 tf div (1000 tf + 8 m))`` over the item's terms.

Items go to the tasks in blocks of bounded size, one pass over the documents for each.

Defined results: a NULL text has no terms, and counts neither as a document nor for a length. An item
without terms has no result. Rows with one item id, NULL included, are one item with the terms of all
of them. Document rows that repeat are documents each; a NULL id ranks behind others at equal scores.
Empty tables of either kind give an empty table. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappush, heapreplace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, materialize, quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The same terms in bytes of UTF-8: lower-cases A-Z; ASCII that is no letter or digit parts terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

BLOCK_PAIRS = 100_000  # items' terms searched in one pass
RUN_DOCUMENTS, RUN_POSTINGS = 16_384, 2_000_000  # of one tree
LEAF = 64  # documents that are scored together
NO_ID = 2**63 - 1  # stands for a NULL id, behind all others

VECTOR = "id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0)))


# --- vectors --------------------------------------------------------------------------------------


def vectors(texts: list[str | None], vocabulary: dict[bytes, int]):
    """Each text's number of terms; offsets, terms and occurrences of those in the vocabulary."""
    get, none = vocabulary.get, repeat(-1)
    sizes, parts = np.zeros(len(texts), dtype=np.int64), []
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "replace").translate(TERM_BYTES).split()
        own = np.fromiter(map(get, words, none), np.int64, len(words))
        sizes[i] = len(words)
        parts.append(own[own >= 0] + i * len(vocabulary))
    keys, tfs = np.unique(np.concatenate(parts or [sizes]), return_counts=True)
    document, term = np.divmod(keys, max(len(vocabulary), 1))
    offsets = np.searchsorted(document, np.arange(len(texts) + 1))
    return sizes, offsets, term, tfs


def with_vectors(df: DataFrame, text: str, key: str, vocabulary: dict[bytes, int]) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by BLOCK_PAIRS

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, offsets, term, tfs = vectors(batch.column(1).to_pylist(), sent.value)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                for values in (term, tfs)
            ]
            columns = [batch.column(0), pa.array(sizes), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    own = df.select(quoted(key).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    return own.mapInArrow(made, VECTOR)


# --- the tree ---------------------------------------------------------------------------------------


def gain(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


def measures(sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    if 90 * int(sizes.max(initial=0)) * documents >= 2**63:
        return np.array([10 + 90 * int(n) * documents // total for n in sizes], dtype=np.int64)
    return 10 + 90 * sizes * documents // max(total, 1)


@dataclass
class Node:
    begin: int
    end: int
    children: list[Node] = field(default_factory=list)
    row: int = 0
    # Of the children: rows of maxima, smallest measures and ids.
    rows: np.ndarray | None = None
    least_m: np.ndarray | None = None
    least_id: np.ndarray | None = None


class FpTree:
    """Documents sorted by their vectors; terms are numbers in order of falling frequency."""

    def __init__(self, ids, m, offsets, terms, tfs, n_terms: int, leaf: int = LEAF):
        self.leaf, self.n_terms = leaf, n_terms
        # Terms of each vector in their order, then vectors in theirs.
        owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
        inside = np.lexsort((terms, owner))
        terms, tfs = terms[inside], tfs[inside]
        spelled = terms.astype(">u4").tobytes()
        at = (4 * offsets).tolist()
        keys = [spelled[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        sizes = np.diff(offsets)[order]
        self.offsets = np.concatenate(([0], np.cumsum(sizes)))
        take = np.repeat(offsets[:-1][order] - self.offsets[:-1], sizes) + np.arange(len(terms))
        self.ids, self.m = ids[order], m[order]
        self.terms, self.tfs = terms[take], tfs[take].astype(np.int64)
        self.gains = gain(self.tfs, np.repeat(self.m, sizes))
        self.maxima: list[np.ndarray] = []
        self.root = self._node(0, len(ids), 0)
        self.maxima = np.stack(self.maxima)

    def _vector(self, document: int) -> np.ndarray:
        return self.terms[self.offsets[document] : self.offsets[document + 1]]

    def _node(self, begin: int, end: int, depth: int) -> Node:
        """The subtree of a range of documents that share their first ``depth`` terms.

        Built from the bottom in a loop of its own, since paths can be deeper than calls may nest.
        """
        root = Node(begin, end)
        pending, opened = [(root, depth)], []
        while pending:
            node, depth = pending.pop()
            opened.append(node)
            if node.end - node.begin > self.leaf:
                for child, below in self._branches(node, depth):
                    node.children.append(child)
                    pending.append((child, below))
        for node in reversed(opened):
            self._sum_up(node)
        return root

    def _branches(self, node: Node, depth: int) -> Iterator[tuple[Node, int]]:
        # Sorted vectors share what the first and the last of them share.
        first, last = self._vector(node.begin), self._vector(node.end - 1)
        room = min(len(first), len(last))
        differ = first[depth:room] != last[depth:room]
        depth = depth + int(differ.argmax()) if differ.any() else room
        starts, ends = self.offsets[node.begin : node.end], self.offsets[node.begin + 1 : node.end + 1]
        here = starts + depth
        following = np.full(len(here), -1, dtype=np.int64)
        longer = here < ends
        following[longer] = self.terms[here[longer]]
        cuts = node.begin + np.concatenate(
            ([0], np.flatnonzero(np.diff(following)) + 1, [len(following)])
        )
        if len(cuts) == 2:  # equal vectors
            cuts = np.append(np.arange(node.begin, node.end, self.leaf), node.end)
        begin = node.begin
        for cut, after in zip(cuts[1:].tolist(), [*cuts[2:].tolist(), node.end], strict=True):
            # Small neighbours share a leaf.
            if cut == node.end or cut - begin >= self.leaf or after - begin > self.leaf:
                yield Node(begin, cut), depth
                begin = cut

    def _sum_up(self, node: Node) -> None:
        node.row = len(self.maxima)
        if node.children:
            node.rows = np.array([child.row for child in node.children])
            node.least_m = np.array([self.m[c.begin : c.end].min() for c in node.children])
            node.least_id = np.array([self.ids[c.begin : c.end].min() for c in node.children])
            most = self.maxima[node.rows[0]].copy()
            for row in node.rows[1:]:
                np.maximum(most, self.maxima[row], out=most)
        else:
            most = np.zeros(self.n_terms, dtype=np.int32)
            held = slice(self.offsets[node.begin], self.offsets[node.end])
            np.maximum.at(most, self.terms[held], self.tfs[held])
        self.maxima.append(most)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Offer ``best`` all documents that can be among the best; the number of those scored."""
        weight = np.zeros(self.n_terms, dtype=np.int64)
        weight[terms] = weights
        # Terms that none of these documents holds bound nothing.
        held = self.maxima[self.root.row][terms] > 0
        terms, weights = terms[held], weights[held]
        scored, stack = 0, [(NO_ID, -1, self.root)]
        while stack:
            bound, least_id, node = stack.pop()
            if best.beats(bound, least_id):
                continue
            if not node.children:
                scored += node.end - node.begin
                self._score(node, weight, best)
                continue
            tfs = self.maxima[node.rows[:, None], terms].astype(np.int64)
            bounds = (gain(tfs, node.least_m[:, None]) * weights).sum(axis=1)
            order = np.lexsort((-node.least_id, bounds))  # the last is opened first
            for i in order[bounds[order] >= best.least].tolist():
                stack.append((int(bounds[i]), int(node.least_id[i]), node.children[i]))
        return scored

    def _score(self, node: Node, weight: np.ndarray, best: Best) -> None:
        held = slice(self.offsets[node.begin], self.offsets[node.end])
        sums = np.concatenate(([0], np.cumsum(self.gains[held] * weight[self.terms[held]])))
        edges = self.offsets[node.begin : node.end + 1] - self.offsets[node.begin]
        scores = sums[edges[1:]] - sums[edges[:-1]]
        for i in np.flatnonzero(scores >= best.least).tolist():
            best.offer(int(scores[i]), int(self.ids[node.begin + i]))


class Best:
    """The k documents with the highest scores above 0, of equal ones those with smaller ids."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.heap: list[tuple[int, int]] = []  # (score, -id)

    def beats(self, bound: int, least_id: int) -> bool:
        """Whether nothing with such a bound and such ids can be among the best."""
        full = len(self.heap) == self.k
        return bound < self.least or full and (bound, -least_id) <= self.heap[0]

    def offer(self, score: int, document: int) -> None:
        if score < 1:
            return
        if len(self.heap) < self.k:
            heappush(self.heap, (score, -document))
        elif (score, -document) > self.heap[0]:
            heapreplace(self.heap, (score, -document))
        if len(self.heap) == self.k:
            self.least = self.heap[0][0]


# --- the search -------------------------------------------------------------------------------------


@dataclass
class Question:
    """A block of items: their terms, numbered by falling frequency, and what weighs a score."""

    rank: np.ndarray  # of a term of the vocabulary
    weights: np.ndarray  # by rank
    items: list[np.ndarray]  # ranks of each item's terms
    documents: int
    total: int
    k: int


def answers(batches: Iterator[pa.RecordBatch], asked: Question) -> list[Best]:
    """The best documents of a task for each item, tree by tree."""
    best = [Best(asked.k) for _ in asked.items]
    run: list[tuple] = []

    def search() -> None:
        ids, sizes, lengths, terms, tfs = (np.concatenate(parts) for parts in zip(*run, strict=True))
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        m = measures(sizes, asked.documents, asked.total)
        tree = FpTree(ids, m, offsets, asked.rank[terms], tfs, len(asked.rank))
        for item, own in zip(asked.items, best, strict=True):
            tree.search(item, asked.weights[item], own)
        run.clear()

    documents = postings = 0
    for batch in batches:
        for begin in range(0, batch.num_rows, RUN_DOCUMENTS):
            part = batch.slice(begin, RUN_DOCUMENTS)
            terms, tfs = part.column(2), part.column(3)
            lengths = np.diff(terms.offsets.to_numpy())
            ids = part.column(0).fill_null(NO_ID).to_numpy()
            flat = (column.flatten().to_numpy() for column in (terms, tfs))
            run.append((ids, part.column(1).to_numpy(), lengths, *flat))
            documents, postings = documents + len(ids), postings + int(lengths.sum())
            if documents >= RUN_DOCUMENTS or postings >= RUN_POSTINGS:
                search()
                documents = postings = 0
    if run:
        search()
    return best


def weights_of(frequencies: np.ndarray, documents: int) -> np.ndarray:
    ratio = ((2 * documents + 2) / (2 * int(df) + 1) for df in frequencies)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def _block(df: DataFrame, pairs: list[tuple], text: str, key: str, k: int):
    """For each item of a block, by its number: the best documents of each task, and item ids."""
    spark = df.sparkSession
    vocabulary: dict[bytes, int] = {}
    items: dict = {}
    for item, term in pairs:
        number = vocabulary.setdefault(term.encode(), len(vocabulary))
        items.setdefault(item, []).append(number)
    held = materialize(with_vectors(df, text, key, vocabulary).where("n > 0"), "vectors")
    totals = held.agg(F.count("n").alias("documents"), F.sum("n").alias("total")).first()
    counted = held.select(F.explode("terms").alias("term")).groupBy("term").count()
    frequencies = np.zeros(len(vocabulary), dtype=np.int64)
    for row in counted.collect():  # one for each term of the block
        frequencies[row["term"]] = row["count"]
    order = np.argsort(-frequencies, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    asked = Question(
        rank,
        weights_of(frequencies[order], totals["documents"]),
        [np.sort(rank[terms]) for terms in items.values()],
        totals["documents"],
        totals["total"] or 0,
        k,
    )
    sent = spark.sparkContext.broadcast(asked)  # bounded by BLOCK_PAIRS

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (i, None if document == -NO_ID else -document, score)
            for i, best in enumerate(answers(batches, sent.value))
            for score, document in best.heap
        ]
        columns = [list(c) for c in zip(*found, strict=True)] or [[], [], []]
        types = [pa.int32(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return held.mapInArrow(search, FOUND), list(items)


def rank_documents(
    df: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents, ranks from 1.

    ``key`` is an integer column. Items keep the type of their id.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    kind = items.schema[item].dataType
    pairs = materialize(
        items.select(
            quoted(item).alias("item"), F.explode(terms_of(quoted(item_text))).alias("term")
        ).distinct(),
        "item-terms",
    )
    blocks = -(-pairs.count() // block_pairs) or 1
    out = None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).orderBy("item", "term")
        rows = [(row["item"], row["term"]) for row in own.collect()]
        found, ids = _block(df, rows, text, key, k)
        by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
        names = spark.createDataFrame(list(enumerate(ids)), schema)
        named = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = named if out is None else out.unionAll(named)
    return out
