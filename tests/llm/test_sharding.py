"""Shards against their definition: near-equal bytes, key order, gapless slots, no row lost."""

import random

import pytest

from moraine.llm import sharding
from tests.llm import messy

PICK = random.Random(1)
CASES = {
    "empty": [],
    "one row": [(1, 5)],
    "unique": [(i, PICK.randint(1, 50)) for i in range(2000)],
    "hot key": [(7, PICK.randint(1, 50)) for _ in range(900)] + [(i * 10**14, 9) for i in range(700)],
    "no key": [(None, 3)] * 900 + [(i, 3) for i in range(300)],
    "all alike": [(7, 10)] * 800,
    "far ends": [(-(2**63), 10)] * 20 + [(2**63 - 1, 10)] * 20,
    "one huge": [(i, 1) for i in range(100)] + [(50, 10_000)],
    "no sizes": [(i, None) for i in range(50)],
}


@pytest.mark.parametrize("rows_of_a_part", [2_000_000, 30])
@pytest.mark.parametrize("name", CASES)
def test_law(spark, monkeypatch, name, rows_of_a_part):
    monkeypatch.setattr(sharding, "PART_ROWS", rows_of_a_part)
    rows, shards = CASES[name], 5
    df = spark.createDataFrame(rows, "doc_id long, size long")
    out = sharding.shard_by_bytes(df, "size", shards).select("shard", "slot", "doc_id", "size")
    found = sorted(map(tuple, out.collect()), key=lambda r: r[:2])
    assert sorted((r[2:] for r in found), key=repr) == sorted(rows, key=repr)
    keys = [-(2**63) if r[2] is None else r[2] for r in found]
    assert keys == sorted(keys)
    sizes, largest = [0] * shards, max([s or 0 for _, s in rows], default=0)
    for shard in range(shards):
        own = [r for r in found if r[0] == shard]
        assert [r[1] for r in own] == list(range(len(own)))
        sizes[shard] = sum(r[3] or 0 for r in own)
    share = sum(sizes) / shards
    assert all(abs(s - share) <= largest + 1e-4 * share for s in sizes)


def test_the_answer_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(CASES["unique"], "doc_id long, size long")
    one = messy.rows(sharding.shard_by_bytes(df.repartition(1), "size"), "doc_id", "shard", "slot")
    many = messy.rows(sharding.shard_by_bytes(df.repartition(13), "size"), "doc_id", "shard", "slot")
    assert one == many


def test_names_that_clash(spark):
    docs = messy.documents(spark, "Slot", "key", "part", "tie", "before")
    out = sharding.shard_by_bytes(docs, "n_chars", 2)
    assert {"extra", "key", "part", "tie", "before", "shard", "slot"} <= set(out.columns)
    assert out.count() == len(messy.ROWS) and "Slot" not in out.columns


def test_one_exchange_moves_the_rows(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "id % 7 AS size")
    plan = sharding.shard_by_bytes(df, "size")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Broadcast" not in plan
