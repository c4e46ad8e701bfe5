"""Neighbours against brute force: recall on random vectors, everything on awkward ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moraine.llm import ann
from tests.llm import messy

SCHEMA = "vec_id long, embedding array<double>"


def hundreds():
    return F.col("vec_id") % 100 == 0


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)


def brute(rows, k):
    own = {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}
    out = set()
    for q, v in own:
        if q % 100 == 0:
            near = sorted(
                (float(np.sqrt(np.square(np.subtract(w, v)).sum())), i)
                for i, w in own
                if i != q and len(w) == len(v)
            )
            out |= {(q, rank + 1, i) for rank, (_, i) in enumerate(near[:k])}
    return out


def found(df, **parameters):
    return {tuple(r) for r in ann.nearest(df, hundreds(), **parameters).select("query_id", "rank", "vec_id").collect()}


def test_recall_on_random_vectors(spark):
    vectors = np.random.default_rng(0).standard_normal((3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(enumerate(vectors.tolist()))
    own = {(q, i) for q, _, i in found(spark.createDataFrame(rows, SCHEMA))}
    wanted = {(q, i) for q, _, i in brute(rows, 10)}
    assert len(own) == len(wanted) == 300
    assert len(own & wanted) >= 0.9 * len(wanted)


def awkward():
    random = np.random.default_rng(1)
    vectors = random.standard_normal((300, 6))
    rows = [(i, vectors[i if i % 3 else 0].tolist()) for i in range(300)]  # a third are equal
    rows += [(1000, [1.0, 2.0]), (1001, [1.0, 2.5]), (5, vectors[5].tolist()), (0, vectors[7].tolist())]
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [float("nan")] * 6)]
    rows += [(2400, [1.0, None]), (2500, [float("inf"), 1.0]), (None, vectors[3].tolist()), (2600, [-0.0, 0.0])]
    return rows


@pytest.mark.parametrize("block, file_rows, kind", [(1024, 16_384, "double"), (2, 20, "double"), (2, 20, "float")])
def test_copies_gaps_and_other_lengths(spark, monkeypatch, block, file_rows, kind):
    monkeypatch.setattr(ann, "BLOCK_QUERIES", block)
    monkeypatch.setattr(ann, "FILE_ROWS", file_rows)
    rows = awkward()
    if kind == "float":
        single = lambda x: None if x is None else float(np.float32(x))
        rows = [(i, v and [single(x) for x in v]) for i, v in rows]
    schema = SCHEMA.replace("double", kind) + ", rank string, qid int"
    df = spark.createDataFrame([(i, v, "old", 0) for i, v in rows], schema)
    own, wanted = found(df), brute(rows, 10)
    # Id 0 has two vectors: its rows are one query.
    once = {r for r in own if r[0]}
    assert once == {r for r in wanted if r[0]}
    assert sorted(r[1] for r in own if not r[0]) == list(range(1, 11))


def test_queries_that_find_too_few_are_answered_by_a_scan(spark):
    vectors = np.random.default_rng(3).standard_normal((400, 16)) * 5
    rows = list(enumerate(vectors.tolist()))
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, tables=1, hashes=16, probes=1) == brute(rows, 10)


def test_scores_are_the_distances_and_small_tables_are_exhausted(spark):
    rows = [(0, [3.0, 4.0]), (1, [0.0, 1.0]), (2, [3.0, 5.0])]
    out = ann.nearest(spark.createDataFrame(rows, SCHEMA), hundreds())
    assert messy.rows(out) == [(0, 1, 2, 1.0), (0, 2, 1, np.sqrt(18.0))]
    assert messy.rows(ann.nearest(spark.createDataFrame([], SCHEMA), hundreds())) == []
    assert messy.rows(ann.nearest(spark.createDataFrame(rows[:1], SCHEMA), hundreds())) == []


def test_probes_come_in_order_of_cost():
    inside = np.array([0.1, 0.5, 0.8, 0.35])

    def cost(steps):
        return sum((inside[i] if s < 0 else 1 - inside[i]) ** 2 for i, s in steps)

    order = ann.probe_order(inside, 81)
    assert order[0] == () and len(set(map(frozenset, order))) == 81 == 3**4
    assert [cost(s) for s in order] == sorted(cost(s) for s in order)


def test_candidates_are_those_of_the_visited_buckets():
    points = np.random.default_rng(4).standard_normal((500, 8))
    hashing = ann.Hashing({8: np.sqrt(8.0)}, 3, 4, 9)
    own = hashing.cells(points)[0]
    codes, order = np.sort(own.ravel()), np.argsort(own.ravel(), kind="stable")
    for query in points[:20]:
        wanted = ann.probed_codes(hashing, query, 5)
        plain = [i for i in range(500) if set(own[i].tolist()) & set(wanted.tolist())]
        assert ann.held_in(codes, order // 3, wanted, 500).tolist() == plain


def test_a_vector_is_shuffled_once_and_not_for_each_table(spark):
    rows = [(i, [float(i), 1.0]) for i in range(50)]
    rows = ann.usable_rows(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", hundreds())
    plan = ann.points_of(rows, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("first(vector") and "Python" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 3  # ids by (digest, id), ids by digest, vectors by digest
