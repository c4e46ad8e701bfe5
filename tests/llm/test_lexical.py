"""Ranked search through the tree, against scoring every document."""

import math
import random
import re

import numpy as np
import pytest

from moraine.llm import lexical
from tests.llm import messy

ASCII_LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)


def words(text):
    return re.findall(lexical.TERM, (text or "").translate(ASCII_LOWER))


def plain(documents, items, k=10):
    """(item, rank, id, score) by scoring all (id, text) for all (item, text)."""
    docs = [(d, words(t)) for d, t in documents]
    docs = [(d, w) for d, w in docs if w]
    total, asked = sum(len(w) for _, w in docs), {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        df = {t: sum(t in w for _, w in docs) for t in terms}
        weight = {t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * n + 1))) for t, n in df.items()}
        scores = []
        for doc_id, w in docs:
            m = 10 + 90 * len(w) * len(docs) // total
            score = sum(
                weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in terms if t in w
            )
            scores.append((-score, doc_id is None, doc_id))
        best = sorted((s for s in scores if s[0] < 0), key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out.extend((item, i + 1, s[2], -s[0]) for i, s in enumerate(best))
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "漢字", "x9", "A"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 40))) for _ in range(n)]
    texts += texts[: n // 3] + [texts[0]] * (n // 3)
    documents = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    items = [(i, "-".join(rng.choices(vocabulary, k=rng.randrange(0, 12)))) for i in range(12)]
    return documents, items


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_tree_against_all_scores(leaf):
    for seed in range(6):
        documents, items = corpus(seed, 120)
        numbers = {}
        asked = [[numbers.setdefault(t.encode(), len(numbers)) for t in sorted(set(words(x)))] for _, x in items]
        sizes, offsets, terms, tfs = lexical.vectors([t for _, t in documents], numbers)
        held = sizes > 0
        frequencies = np.bincount(terms, minlength=len(numbers))
        order = np.argsort(-frequencies, kind="stable")
        rank = np.argsort(order)
        weights = lexical.weights_of(frequencies[order], int(held.sum()))
        m = lexical.measures(sizes, int(held.sum()), int(sizes.sum()))
        ids = np.array([d for d, _ in documents])
        tree = lexical.FpTree(ids, m, offsets, rank[terms], tfs, len(numbers), leaf)
        found, scored = [], 0
        for (item, _), own in zip(items, asked, strict=True):
            best = lexical.Best(10)
            own = np.sort(rank[own]) if own else np.zeros(0, dtype=np.int64)
            scored += tree.search(own, weights[own], best)
            ranked = sorted(best.heap, reverse=True)
            found.extend((item, i + 1, -d, s) for i, (s, d) in enumerate(ranked))
        assert sorted(found, key=repr) == plain(documents, items)
        # Branches that cannot hold a result are not scored.
        assert leaf == 64 or scored < 0.8 * len(items) * len(documents)


def test_trie_paths_are_shared():
    texts = ["a b c"] * 5 + ["a b d"] * 5 + ["a"] * 5 + ["e"] * 5
    numbers = {t.encode(): i for i, t in enumerate("abcde")}
    sizes, offsets, terms, tfs = lexical.vectors(texts, numbers)
    ids = np.arange(len(texts))
    tree = lexical.FpTree(ids, lexical.measures(sizes, 20, 45), offsets, terms, tfs, 5, leaf=1)
    ranges = [(c.end - c.begin) for c in tree.root.children]
    assert ranges == [15, 5]
    below = tree.root.children[0].children
    assert [(c.end - c.begin) for c in below] == [5, 10]
    assert (tree.maxima[tree.root.row] == [1, 1, 1, 1, 1]).all()


def test_deep_paths():
    numbers = {b"%d" % i: i for i in range(1500)}
    texts = [" ".join(str(j) for j in range(i)) for i in range(1, 1500)]
    sizes, offsets, terms, tfs = lexical.vectors(texts, numbers)
    tree = lexical.FpTree(np.arange(len(texts)), sizes, offsets, terms, tfs, 1500, leaf=1)
    best = lexical.Best(1)
    tree.search(np.array([1400]), np.array([1]), best)
    assert best.heap[0][1] == -1400


def test_bytes_and_regex_agree_on_terms(spark):
    text = "".join(map(chr, range(1, 0x250))) + " Straße İstanbul É漢\x80 x ÀB"
    df = spark.createDataFrame([(text,)], "text string")
    own = df.select(lexical.terms_of(df.text)).first()[0]
    as_bytes = set(text.encode().translate(lexical.TERM_BYTES).split())
    assert {t.encode() for t in own} == as_bytes == {t.encode() for t in words(text)}


@pytest.mark.parametrize("block_pairs", [20, 100_000])
def test_on_spark(spark, block_pairs):
    documents, items = corpus(9, 60)
    documents += [(None, items[0][1]), (None, None), (2000, " .,!"), (2001, messy.LONG)]
    items += [(items[1][0], "w3 w4"), (None, "lorem w1"), (50, None), (51, "...")]
    df = spark.createDataFrame([(*d, "old") for d in documents], "doc_id long, text string, score string")
    asked = spark.createDataFrame([(*i, "old") for i in items], "item_id long, text string, rank string")
    out = lexical.rank_documents(df, asked, block_pairs=block_pairs)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert messy.rows(out) == plain(documents, items)
    assert messy.rows(lexical.rank_documents(messy.none(df), asked)) == []
    assert messy.rows(lexical.rank_documents(df, messy.none(asked))) == []


def test_measures_beyond_64_bits():
    sizes = np.array([1, 10**9], dtype=np.int64)
    found = lexical.measures(sizes, 10**10, 10**12).tolist()
    assert found == [10 + 90 * n * 10**10 // 10**12 for n in (1, 10**9)]
