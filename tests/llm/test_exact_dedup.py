"""Copies by recipes of chunks, against plain comparison of texts."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from moraine.llm import exact_dedup
from tests.llm import messy


def expected(rows):
    """(id, keep id, size, kept) of (id, text) rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[ \t-\r]", "", text or "")].append((doc_id, text or ""))
    out = []
    for group in groups.values():
        group.sort(key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        out.extend((r[0], group[0][0], len(group), i == 0) for i, r in enumerate(group))
    return sorted(out, key=repr)


def found(df, **options):
    kept = exact_dedup.with_copies(exact_dedup.with_recipes(df, **options).drop("text"))
    return messy.rows(kept, "doc_id", "keep_id", "group_size", "kept")


@pytest.mark.parametrize("id_bytes", [1, 16])
def test_messy(spark, id_bytes):
    clashes = ("kept", "keep_id", "group_size", "text_sha256", "rows", "place")
    df = messy.documents(spark, *clashes)
    own = [(r[0], r[1]) for r in messy.ROWS]
    assert found(df, id_bytes=id_bytes) == expected(own)
    out = exact_dedup.with_copies(exact_dedup.with_recipes(df))
    assert {"extra", "rows", "place", "text"} < set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert found(messy.none(df)) == []


def test_near_misses_and_shared_passages(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefghij éß漢\n\t\x0b\x1f\xa0") for _ in range(30_000))
    texts = [passage, passage + " ", passage[:-1], passage.replace("a", " a"), "x" + passage, passage + passage]
    texts += ["a" * 9000, "a" * 8999, "\t" + "a" * 9000, "漢" * 5000, "漢 " * 5000, "", " ", None, "\x1f", "\xa0"]
    rows = [(i, t) for i, t in enumerate(texts)] * 2
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_chunks_are_cut_by_content(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("etaoin shrdlu,.") for _ in range(200_000)).replace(" ", "")
    df = spark.createDataFrame([(text,), ("z" + text,), (text[5000:],)], "text string")
    first, shifted, later = (
        r[0] for r in df.select(exact_dedup.chunks(F.col("text"))).collect()
    )
    assert "".join(first) == text
    assert all(len(c) <= exact_dedup.MOST_BYTES for c in first) and len(first) > 100
    # An inserted or missing beginning changes the chunks around it and no others.
    assert len(set(first) - set(shifted)) < 10 and len(set(later) - set(first)) < 10


def test_identifiers_are_verified(spark):
    texts = spark.createDataFrame([(f"{i}" * 300,) for i in range(2000)], "text string")
    assert exact_dedup.clashing(texts, 1) and not exact_dedup.clashing(texts, 16)
    assert exact_dedup.verified_length(texts, 1) > 1


def test_chunks_themselves_are_the_last_resort(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "clashing", lambda texts, length: True)
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert exact_dedup.verified_length(df, 16) is None
    assert found(df) == expected(rows)


def test_hot_group_is_spread(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 10)
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == expected(rows)


def test_drop_copies_keeps_columns(spark):
    df = messy.documents(spark, "kept", "text_sha256", "row", "key")
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    kept = {k for k in expected([(r[0], r[1]) for r in messy.ROWS]) if k[3]}
    assert out.count() == len(kept)
    assert out.where("kept = 'old' AND text_sha256 = 'old'").count() == len(kept)


def test_native(spark):
    df = messy.documents(spark)
    out = exact_dedup.with_copies(exact_dedup.with_recipes(df).drop("text"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
