"""Periodic runs, against the plain definition."""

import hashlib
import random

import numpy as np
import pytest

from moraine.llm import periodic
from tests.llm import messy


def plain_runs(words):
    """(start, length, period) of every run, by trying all periods."""
    numbers, out = {}, []
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    for q in range(1, len(words) // 4 + 1):
        equal = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist(), strict=True):
            if end - start >= max(6, 4 * q):
                stretch = ids[start:end]
                if not any((stretch[p:] == stretch[:-p]).all() for p in range(1, q)):
                    out.append((start, end - start, q))
    return sorted(out)


def plain_collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def random_words(rng):
    letters = rng.choice([1, 2, 3, 6])
    words = [b"%d" % rng.randrange(letters) for _ in range(rng.randrange(30))]
    for _ in range(rng.randrange(4)):
        unit = [b"%d" % rng.randrange(letters + 1) for _ in range(rng.randrange(1, 14))]
        words += (unit * 9)[: rng.randrange(1, 90)]
    return words


@pytest.mark.parametrize("seed", range(20))
def test_against_the_definition(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 5))]
        found = periodic.runs_of(texts)
        assert found == [plain_runs(words) for words in texts]
        for words, runs in zip(texts, found, strict=True):
            assert periodic.collapsed(words, runs) == plain_collapsed(words, runs)


@pytest.mark.parametrize("most", [1, 2, 8])
def test_distances_beyond_the_largest_block(most):
    rng = random.Random(most)
    for _ in range(150):
        words = random_words(rng)
        numbers = {}
        ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.int64)
        assert periodic.periodic_runs(ids, len(ids), most) == plain_runs(words)


@pytest.mark.parametrize("prime", periodic.PRIMES)
@pytest.mark.parametrize("size", [1, 2, 16, 256])
def test_convolution_is_exact(prime, size):
    rng = np.random.default_rng(size)
    blocks, windows = rng.integers(0, 2**20, (3, size)), rng.integers(0, 2**20, (3, 2 * size))
    found = periodic.squared_differences(blocks, windows, *prime)
    for row in range(3):
        for offset in range(size):
            pairs = zip(blocks[row].tolist(), windows[row, offset : offset + size].tolist(), strict=True)
            assert found[row, offset] == sum((a - b) ** 2 for a, b in pairs) % prime[0]


def test_enough_primes():
    assert len(periodic.primes_for(1, 100)) == 1
    for block, largest in [(1, 2**17), (2**14, 2**20), (2**14, 2**26)]:
        product = np.prod([float(p) for p, _ in periodic.primes_for(block, largest)])
        assert block * largest**2 < product


def test_long_periods_and_long_texts():
    unit = [b"%d" % i for i in range(20_000)]
    text = [b"x"] + unit * 5 + [b"y"] * 300_000
    assert periodic.runs_of([text]) == [[(1, 100_000, 20_000), (100_001, 300_000, 1)]]


def test_on_spark(spark):
    df = messy.documents(spark, "runs", "n_words", "collapsed_sha256")
    out = periodic.find_runs(df)
    assert sorted(out.columns) == sorted([*df.columns])
    found = messy.rows(out.select("doc_id", "text", "n_words", "runs", "collapsed_sha256", "extra"))
    assert len(found) == len(messy.ROWS)
    for _, text, n, runs, digest, extra in found:
        words = (text or "").encode().split()
        own = [(0, 120_000, 6)] if text == messy.LONG else plain_runs(words)
        assert n == len(words) and list(runs) == own and extra == "old"
        kept = b" ".join(plain_collapsed(words, own))
        assert digest == hashlib.sha256(kept).hexdigest()
    assert messy.rows(periodic.find_runs(messy.none(df))) == []


def test_longest_run(spark):
    text = "a a a a a a " + "b c " * 4 + "d " * 8
    df = spark.createDataFrame([(text,), ("a b",)], "text string")
    best = [r[0] for r in periodic.find_runs(df).select(periodic.longest_run()).collect()]
    assert tuple(best[0]) == (6, 8, 2) and best[1] is None or tuple(best[1]) == (None,) * 3
