"""Base spans against the patterns in Python, and the tests on keys and on ordinary tokens."""

import itertools
import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from moraine.llm import secrets
from tests.llm import messy

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
HEX, BASE64 = "0123456789abcdef", string.ascii_letters + string.digits + "+/"


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[k]}:{b}:{e}" for b, k, e in sorted(out))


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = secrets.find_secrets(df).select(
        "doc_id", secrets.spelled(F.col("base")), secrets.spelled(F.col("found"))
    )
    return {r[0]: (r[1], r[2]) for r in out.collect()}


def key(pick, alphabet, n):
    return "".join(pick.choice(alphabet) for _ in range(n))


def test_base_spans(spark):
    pick = random.Random(1)
    parts = [
        "password=", "API_KEY: ", "é😀 ", "AKIA" + "AB1" * 6, "AKIAX", HEX * 2, 'secret="', "abc.def/g",
        "token:", "Passwd'= '", "ab=", "the quick", "==", "api-key=123456",
    ]
    texts = [None, "", "token=token=secret1", "token=token:abcdefgh", "a" * 100_000, "ab " * 20_000]
    for n in (1, 5, 40, 400):
        texts += [pick.choice(["", " ", "\n"]).join(pick.choices(parts, k=n)) for _ in range(40)]
    found = scan(spark, texts)
    assert {i: b for i, (b, _) in found.items()} == {i: base(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("name, alphabet, n", [("hex", "0123456789ABCDEF", 40), ("base64", BASE64, 40)])
def test_random_keys_are_found(spark, name, alphabet, n):
    pick = random.Random(2)
    texts = [f"see {key(pick, alphabet, n)} there" for _ in range(200)]
    hits = sum("random:4:" in found for _, found in scan(spark, texts).values())
    assert hits >= 185


@pytest.mark.parametrize("prefix, sizes", [("sk_live_", [24]), ("rk-test-", [32]), ("", [16, 16]), ("x/", [40])])
def test_keys_in_one_case_with_separators_are_found(spark, prefix, sizes):
    pick = random.Random(6)
    letters = string.ascii_lowercase + string.digits
    keys = [prefix + "-".join(key(pick, letters, n) for n in sizes) for _ in range(100)]
    found = scan(spark, [f"use {k} here" for k in keys])
    hits = sum(f"random:4:{4 + len(keys[i])}" == spans for i, (_, spans) in found.items())
    assert hits >= 95


def test_orderly_tokens_are_not(spark):
    pick = random.Random(3)
    words = ["user", "Name", "file", "Path", "index", "Value", "of", "The", "row", "2024", "v1"]
    texts = ["_".join(pick.choices(words, k=8)) + "_7a" for _ in range(200)]
    texts += ["Ab1" * 12, "aaaa1" * 8, "A1b2" * 10, "menteuxlereontionmenteuxlereontion", "1" * 40]
    assert sum("random" in found for _, found in scan(spark, texts).values()) <= 2


def test_tokens_of_any_length_are_tested_whole(spark):
    pick = random.Random(4)
    sizes = [secrets.PIECE + 1, 5000, 8192, 30_000, 200_000]
    keys = [f"see {key(pick, BASE64, n)} there" for n in sizes * 6]
    orderly = ["x " + ("Ab1" * n)[:n] for n in sizes]
    # Each piece looks random by itself; only the whole token tells that they are the same.
    half = key(pick, BASE64, secrets.PIECE)
    found = scan(spark, [*keys, *orderly, half * 6])
    hits = [found[i][1] for i in range(len(keys))]
    assert sum(f"random:4:{4 + n}" == h for h, n in zip(hits, sizes * 6, strict=True)) >= 26
    assert not any("random" in found[i][1] for i in range(len(keys), len(found)))


def test_pieces_add_up_to_the_whole(spark, monkeypatch):
    pick = random.Random(5)
    texts = [key(pick, alphabet, n) for alphabet in (BASE64, HEX) for n in (20, 40, 41, 333, 4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = [r[secrets.TESTED] for r in secrets.scan(df).orderBy("doc_id").collect()]
    monkeypatch.setattr(secrets, "PIECE", 20)
    pieces = [r[secrets.TESTED] for r in secrets.scan(df).orderBy("doc_id").collect()]
    assert all(len(w) == 1 for w in whole)
    for (w,), (p,) in zip(whole, pieces, strict=True):
        assert (w["encoding"], w["length_class"]) == (p["encoding"], p["length_class"])
        assert abs(w["bin"] - p["bin"]) <= 1  # rounding


WORDS = (
    "get set user by id name file path index value of the row list map string parse read write load "
    "save find all items count total order customer line create update delete is has with from to "
    "table column type date time handle event request response client server option default buffer"
).split()


def identifiers(pick, camel, n):
    out = []
    while len(out) < n:
        words = pick.choices(WORDS, k=pick.randint(3, 7))
        words = [words[0], *(w.title() for w in words[1:])] if camel else words
        word = "".join(words) + str(pick.randint(1, 99))
        out += [word] if len(word) >= 20 else []
    return out


@pytest.mark.parametrize("camel", [True, False])
def test_few_identifiers_are_reported(spark, camel):
    found = scan(spark, [f"call {w} here" for w in identifiers(random.Random(8), camel, 1000)])
    assert sum("random" in spans for _, spans in found.values()) <= 1000 * secrets.FALSE_DISCOVERY


def test_few_of_what_is_reported_among_keys_are_identifiers(spark):
    pick = random.Random(9)
    ordinary = identifiers(pick, True, 1000)
    keys = [key(pick, BASE64[:62], 24) for _ in range(300)]
    found = scan(spark, [f"a {w} b" for w in ordinary + keys])
    reported = [i for i, (_, spans) in found.items() if "random" in spans]
    assert sum(i < 1000 for i in reported) <= secrets.FALSE_DISCOVERY * len(reported)
    assert sum(i >= 1000 for i in reported) >= 270


def plain_p(encoding, token):
    """The combined p-value, in plain Python, with the normal tail from the error function."""
    alphabet = secrets.ALPHABETS[encoding]
    if encoding != "base64":
        token = token.lower()
    values, n, k = [alphabet.index(c) for c in token], len(token), len(alphabet)

    def tail(z):
        return math.erfc(z / math.sqrt(2)) / 2

    def chi(parts):
        free = len(parts) - 1
        x = sum((sum(c in p for c in token) - n * len(p) / k) ** 2 / (n * len(p) / k) for p in parts)
        return tail(((x / free) ** (1 / 3) - 1 + 2 / (9 * free)) / math.sqrt(2 / (9 * free)))

    high = [v >= k / 2 for v in values]
    one, other = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in itertools.pairwise(high))
    mean = 1 + 2 * one * other / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    around = [v - sum(values) / n for v in values]
    serial = sum(a * b for a, b in itertools.pairwise(around)) / sum(a * a for a in around)
    ps = [chi(alphabet), chi(secrets.CLASSES[encoding]), 2 * tail(abs(runs - mean) / math.sqrt(variance))]
    ps += [2 * tail(abs(serial + 1 / n) * math.sqrt(n))]
    h = -sum(math.log(min(p, 1)) for p in ps)
    return math.exp(-h) * sum(h**i / math.factorial(i) for i in range(4))


def test_p_values_against_a_plain_computation(spark):
    pick = random.Random(10)
    made = [("hex", key(pick, HEX, n)) for n in (20, 33, 64, 300)]
    made += [("base32", "a" + key(pick, "abcdefghijklmnopqrstuvwxyz234567", n) + "w7") for n in (20, 50)]
    made += [("base36", key(pick, string.ascii_lowercase + string.digits, n) + "z1") for n in (20, 90)]
    made += [("base64", key(pick, BASE64, n) + "aB1") for n in (20, 40, 500)]
    made += [("base64", w) for w in identifiers(pick, True, 20)]
    made += [("base36", w + "18") for w in identifiers(pick, False, 20)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(made)], "doc_id long, text string")
    for row in secrets.scan(df).collect():
        encoding, token = made[row.doc_id]
        (tested,) = row[secrets.TESTED]
        assert tested["encoding"] == encoding
        number = min(secrets.MOST_BINS, -math.log(plain_p(encoding, token)) * secrets.BINS_PER_E)
        assert abs(tested["bin"] - math.floor(number)) <= 1 + number / 1000


def test_the_bar_is_raised_where_ordinary_tokens_pass_it():
    # 1,000 random keys: 20 in each bin of equal probability; then 200 ordinary tokens at p = 0.2.
    edges = [math.floor(-math.log((i + 0.5) / 50) * secrets.BINS_PER_E) for i in range(50)]
    keys = {b: 20 * edges.count(b) for b in edges}
    assert secrets.doubtful_from(keys, 0.05) > secrets.MOST_BINS
    at = math.floor(-math.log(0.2) * secrets.BINS_PER_E)
    mixed = {**keys, at: keys.get(at, 0) + 200}
    assert secrets.doubtful_from(mixed, 0.05) <= at
    assert secrets.doubtful_from({0: 1}, 0.05) > secrets.MOST_BINS  # one key


def test_the_level_is_set_for_each_length_class():
    assert secrets.orderly_from({0: 1000}, 0.05) > secrets.MOST_BINS
    first = secrets.orderly_from({0: 10, 500: 10}, 0.05)
    assert 0 < first <= 500


def test_no_python_on_the_way(spark):
    df = messy.documents(spark)
    plan = secrets.find_secrets(df)._jdf.queryExecution().executedPlan().toString()
    inner = secrets.scan(df)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow"):
        assert word not in plan + inner


def test_messy_documents(spark):
    df = messy.documents(spark, "BASE", "found", "begin", "kind", "match")
    out = secrets.find_secrets(df)
    assert {"extra", "begin", "kind", "match", "base", "found"} <= set(out.columns)
    assert "BASE" not in out.columns and "text" not in out.columns
    assert out.count() == len(messy.ROWS)
    assert messy.rows(secrets.find_secrets(messy.none(df))) == []
