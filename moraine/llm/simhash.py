"""SimHash near-duplicates: fingerprints linked by Hamming distance through vantage-point trees.

Two 64-bit fingerprints within ``d`` bits have a half in which they differ by at most ``d // 2``
bits. So there is one tree for each half. A node of a tree holds a vantage point and a radius, and
parts the fingerprints into those within the radius and those beyond. The triangle bound says that
a fingerprint whose distance to the vantage point is farther than ``d // 2`` from the radius has
no partner on the other side; only the others also query the shard beyond the boundary. Leaves are
shards; inside a shard the same splitting goes on, down to blocks in which all pairs are compared
on all 64 bits. A shard answers with a spanning forest of its links, never with all pairs.

Links are joined to components by rounds of star contraction; each round is written to the shared
folder. Equal fingerprints are one point from the start, so groups of copies cost nothing.

Defined results: a NULL, empty or wordless text has fingerprint zero, linked like any other. A row
without an id belongs to its component but does not name it; a component of such rows only has a
NULL id. Repeated rows get the same answer each; an empty table gives an empty table. Input columns
of an output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, materialize, quoted, with_outputs

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

SAMPLE_POINTS = 20_000  # fingerprints that the trees' upper levels are fitted on
SHARD_POINTS = 30_000  # about so many fingerprints are wanted in a shard
MOST_LEVELS = 14
BLOCK_POINTS = 512  # compared all with all
HOT_POINTS = 100_000  # a shard of more is compared in parts, pair by pair

HOT_SHARE, MOST_PARTS = 1000, 64  # copies of more than this part of all rows are spread over parts

FP, ID, ROOT, COMPONENT = "__llm_fp", "__llm_id", "__llm_root", "__llm_component"
PLACE, PART, PARTS = "__llm_place", "__llm_part", "__llm_parts"


# --- fingerprints -------------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        joined, ends, at = b" ".join(words), [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        begins = [0, *(end + 1 for end in ends[:-shingle])]
        grams = [joined[i:j] for i, j in zip(begins, ends[shingle - 1 :], strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(gram, SEED) for gram in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little"), "little")


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with ``fingerprint``: the 64 bits as a signed long."""
    bounded_batches(df.sparkSession)

    @F.pandas_udf(T.LongType())
    def bits(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(prints.view(np.int64))

    return with_outputs(df, {"fingerprint": bits(quoted(text).cast("string"))})


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


# --- vantage-point trees ------------------------------------------------------------------------


def half(points: np.ndarray, tree: int) -> np.ndarray:
    return points >> np.uint64(32) if tree else points & np.uint64(0xFFFFFFFF)


def choose_vantage(values: np.ndarray) -> tuple[int, int] | None:
    """The vantage point of some tried that splits best, and its radius: values at most that far
    from it are inside. None where no point parts the values."""
    best = None
    for point in values[:: max(1, len(values) // 8)][:8]:
        distance = np.bitwise_count(values ^ point)
        radius = int(np.partition(distance, (len(distance) - 1) // 2)[(len(distance) - 1) // 2])
        for r in (radius - 1, radius):
            inside = int((distance <= r).sum())
            uneven = abs(2 * inside - len(values))
            if 0 < inside < len(values) and (best is None or uneven < best[0]):
                best = (uneven, int(point), r)
    return best and best[1:]


def fit_tree(values: np.ndarray, levels: int) -> dict[int, tuple[int, int]]:
    """Vantage point and radius of the inner nodes, numbered as in a heap."""
    nodes, waiting = {}, [(1, values)]
    while waiting:
        node, own = waiting.pop()
        chosen = choose_vantage(own) if node < 1 << levels and len(own) > 8 else None
        if chosen:
            nodes[node] = chosen
            inside = np.bitwise_count(own ^ np.uint64(chosen[0])) <= chosen[1]
            waiting += [(2 * node, own[inside]), (2 * node + 1, own[~inside])]
    return nodes


def shards_for(points: np.ndarray, nodes: dict, slack: int, tree: int):
    """For each point its home shard, and with it each shard beyond a boundary that is to be asked.

    Every pair within the slack meets in the home shard of at least one of its two points: the
    points inside a radius also go to the other side, those outside need not come back.
    """
    found, waiting = [], [(1, np.arange(len(points)))]
    values = half(points, tree)
    while waiting:
        node, rows = waiting.pop()
        if node not in nodes:
            found.append((node, rows))
            continue
        vantage, radius = nodes[node]
        distance = np.bitwise_count(values[rows] ^ np.uint64(vantage)).astype(np.int64)
        inside = distance <= radius
        beyond = ~inside | (distance + slack > radius)
        if inside.any():
            waiting.append((2 * node, rows[inside]))
        if beyond.any():
            waiting.append((2 * node + 1, rows[beyond]))
    return found


class Forest:
    """Sets of linked points, by the smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def link_blocks(points: np.ndarray, rows: np.ndarray, others: np.ndarray, bits: int, sets: Forest):
    """Compare all of ``rows`` with all of ``others`` on all 64 bits and link those that are near."""
    for start in range(0, len(rows), BLOCK_POINTS):
        own = rows[start : start + BLOCK_POINTS]
        for low in range(0, len(others), 8 * BLOCK_POINTS):
            theirs = others[low : low + 8 * BLOCK_POINTS]
            near = np.bitwise_count(points[own][:, None] ^ points[theirs][None, :]) <= bits
            for i in np.flatnonzero(near.any(axis=1)):
                partners = theirs[near[i]]
                partners = partners[partners != own[i]]
                # Partners already in one set with the point need no link.
                for j in np.unique(sets.parent[partners]):
                    sets.link(int(own[i]), int(j))


def link_near(points: np.ndarray, bits: int, tree: int, sets: Forest) -> None:
    """Link all pairs of a shard: split by vantage points while that helps, then compare blocks."""
    slack, values = bits // 2, half(points, tree)
    waiting = [np.arange(len(points))]
    while waiting:
        rows = waiting.pop()
        chosen = choose_vantage(values[rows]) if len(rows) > BLOCK_POINTS else None
        if chosen:
            distance = np.bitwise_count(values[rows] ^ np.uint64(chosen[0])).astype(np.int64)
            inside = distance <= chosen[1]
            beyond = ~inside | (distance + slack > chosen[1])
            if inside.sum() <= 0.9 * len(rows) and beyond.sum() <= 0.9 * len(rows):
                waiting += [rows[inside], rows[beyond]]
                continue
        link_blocks(points, rows, rows, bits, sets)


# --- links on Spark -----------------------------------------------------------------------------

LINK = "a long, b long"


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (a column ``fp``, read several times) to links (a, b) between them.

    The links join exactly the fingerprints that chains of pairs within ``bits`` bits join.
    """
    total = prints.count()
    levels = min(MOST_LEVELS, max(0, int(total // SHARD_POINTS).bit_length()))
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE_POINTS).collect()
    fitted = np.array([r["fp"] for r in sample], dtype=np.int64).view(np.uint64)
    trees = [fit_tree(half(fitted, tree), levels) for tree in (0, 1)]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for tree in (0, 1):
                found = shards_for(points, trees[tree], bits // 2, tree)
                shard = np.repeat([2 * node + tree for node, _ in found], [len(r) for _, r in found])
                own = points[np.concatenate([rows for _, rows in found])].view(np.int64)
                yield pd.DataFrame({"shard": shard.astype(np.int64), "fp": own})

    routed = prints.select("fp").mapInPandas(route, "shard long, fp long")
    # A hot shard is cut into parts by a hash; each pair of its parts is a task's work.
    routed = materialize(routed, "shards")
    sizes = routed.groupBy("shard").agg(F.count("fp").alias("n")).where(F.col("n") > HOT_POINTS)
    parts = F.coalesce(F.ceil(F.col("n") / HOT_POINTS) * 2, F.lit(1)).cast("int")
    cut = routed.join(sizes, "shard", "left").withColumn("parts", parts)
    cut = cut.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    pair = cut.withColumn("other", F.explode(others)).select(
        "shard",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "fp",
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(rows["fp"].to_numpy(np.int64)).view(np.uint64)
        sets = Forest(len(points))
        link_near(points, bits, int(key[0]) & 1, sets)
        roots = np.array([sets.root(i) for i in range(len(points))], dtype=np.int64)
        linked = roots != np.arange(len(points))
        signed = points.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[roots[linked]]})

    return pair.groupBy("shard", "low", "high").applyInPandas(compare, LINK)


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) to (node, component): the smallest node that can be reached.

    Large-star and small-star rounds: each links the neighbours of a node to the smallest of them,
    so the links of a hot node are spread over its neighbours, and the count of links never grows.
    """
    edges = materialize(edges.where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Large star: every larger neighbour is linked to the smallest one.
        star = both.join(least.withColumn("m", F.least("a", "m")), "a")
        large = star.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the node and its smaller neighbours are linked to the smallest one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least, "a")
        small = star.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            star.select("a", F.col("m").alias("b"))
        )
        edges = materialize(small.where("a <> b").distinct(), "links")
        state = edges.agg(
            F.count("a").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if state == before:
            break
        before = state
    return edges.toDF("node", "component")


def _rooted(df: DataFrame, fingerprint: str, doc_id: str, bits: int) -> DataFrame:
    """``df``, written once, with its id, ROOT (one of the component's points) and COMPONENT."""
    printed = df.withColumns({ID: quoted(doc_id), FP: quoted(fingerprint)})
    printed = materialize(printed.withColumn(PLACE, F.monotonically_increasing_id()), "prints")
    named = printed.groupBy(F.col(FP).alias("fp")).agg(
        F.min(ID).alias("least"), F.count(F.lit(1)).alias("rows")
    )
    named = materialize(named, "points")
    joined = components(links(named.select("fp"), bits))
    # A component's points: those linked to its smallest one, and that one itself.
    roots = joined.select(F.col("component").alias("node"), "component").distinct()
    member = joined.union(roots)
    named_member = named.join(member, F.col("fp") == F.col("node"))
    smallest = named_member.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = named_member.join(smallest, "component")
    linked = linked.select(F.col("fp").alias("own"), "component", "smallest")
    alone = F.col("own").isNull()
    answer = named.join(linked, F.col("fp") == F.col("own"), "left").select(
        F.col("fp").alias(FP),
        F.when(alone, F.col("fp")).otherwise(F.col("component")).alias(ROOT),
        F.when(alone, F.col("least")).otherwise(F.col("smallest")).alias(COMPONENT),
    )
    # The copies of a common fingerprint are spread over parts, and its answer is given to each. Fewer
    # than HOT_SHARE fingerprints can be that common; they and their parts are sent to the tasks.
    least = max(printed.count() / HOT_SHARE, 1)
    parts = F.least(F.lit(MOST_PARTS), F.ceil(F.col("rows") / least)).cast("int")
    common = F.broadcast(
        named.where(F.col("rows") > least).select(F.col("fp").alias(FP), parts.alias(PARTS))
    )
    part = F.coalesce(F.pmod(F.xxhash64(PLACE), F.col(PARTS)), F.lit(0)).cast("int")
    routed = printed.join(common, FP, "left").withColumn(PART, part).drop(PARTS, PLACE)
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PARTS), F.lit(1)) - 1))
    answers = answer.join(common, FP, "left").select(FP, ROOT, COMPONENT, each.alias(PART))
    return routed.join(answers, [FP, PART]).drop(PART)


def with_components(
    df: DataFrame,
    fingerprint: str = "fingerprint",
    doc_id: str = "doc_id",
    bits: int = MAX_BITS,
) -> DataFrame:
    """``df`` with ``component_id``: the smallest id of the documents linked to a row's fingerprint.

    Fingerprints (signed longs) are linked if they differ in at most ``bits`` bits. What ``df``
    holds is written to the shared folder once, and read from there.
    """
    rooted = _rooted(df, fingerprint, doc_id, bits)
    return with_outputs(rooted, {"component_id": F.col(COMPONENT)}).drop(FP, ID, ROOT, COMPONENT)


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
) -> DataFrame:
    """``df`` with ``fingerprint`` (a signed long) and ``component_id``."""
    return with_components(with_fingerprint(df, text, shingle), "fingerprint", doc_id, bits)


def keep_one_of_each(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
) -> DataFrame:
    """One row of each component: that with the smallest id, rows without an id last.

    Rows of equal id and text are told apart by nothing; of these one stays. Decisions are made on
    ids and hashes alone; the texts are shuffled once, to meet them.
    """
    value = quoted(text).cast("string")
    slim = df.select(quoted(doc_id).alias("i"), F.xxhash64(value).alias("t"), value.alias("text"))
    slim = with_fingerprint(slim, "text", shingle).drop("text")
    rooted = _rooted(slim, "fingerprint", "i", bits)
    rows = rooted.groupBy(ROOT, "i", "t").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("i").isNull().alias("last"), F.col("i"), F.col("t"), F.col("n"))
    kept = rows.groupBy(ROOT).agg(F.min(order).alias("k"))
    kept = kept.select(F.col("k.i").alias("__llm_i"), F.col("k.t").alias("__llm_t"), F.col("k.n"))
    kept = materialize(kept, "kept")
    repeated = kept.where(F.col("n") > 1).limit(1).count()
    chosen = kept.drop("n").hint("merge")
    keyed = df.withColumns({ID: quoted(doc_id), FP: F.xxhash64(value)})
    same = F.col(ID).eqNullSafe(F.col("__llm_i")) & F.col(FP).eqNullSafe(F.col("__llm_t"))
    out = keyed.join(chosen, same).drop("__llm_i", "__llm_t")
    if repeated:
        out = out.dropDuplicates([ID, FP])
    return out.drop(ID, FP)
