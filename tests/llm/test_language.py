"""Bundles against a plain sum of bound vectors, and held-out accuracy."""

import random
import subprocess
import sys
import zlib

import numpy as np
import pytest

from moraine.llm import language
from tests.llm import messy


def plain_bundle(text):
    letters, last = [], None
    for char in " " + (text or "").lower() + " ":
        letter = ord(char) if char.isalpha() else 0
        if letter or last != 0:
            letters.append(letter)
        last = letter
    vectors = [language.known_vector(c) for c in letters]
    out = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(vectors, vectors[1:], vectors[2:], strict=False):
        out += np.roll(a, 2) * np.roll(b, 1) * c
    return out / np.linalg.norm(out)


@pytest.mark.parametrize("text", ["Hello, world", "é漢字 a", "x", "The the THE", "a1b2c3"])
def test_bundle(text):
    assert np.allclose(language.bundles([text])[0], plain_bundle(text), atol=1e-5)


def test_texts_without_letters_and_batches():
    texts = ["12 34", None, "", "abc", "漢字 and more", "  "] * 50
    whole = language.bundles(texts)
    assert not whole[[0, 1, 2, 5]].any()
    language_batch, language.BATCH_CHARS = language.BATCH_CHARS, 10
    try:
        assert np.allclose(language.bundles(texts), whole, atol=1e-6)
    finally:
        language.BATCH_CHARS = language_batch


def corpus(n=600):
    pick = random.Random(4)
    syllables = {"aa": ["ka", "to", "mi", "ne"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["tion", "eux", "lle", "que"]}
    rows = []
    for i in range(n):
        lang = pick.choice(list(syllables))
        words = ["".join(pick.choices(syllables[lang], k=2)) for _ in range(pick.choice([5, 50, 300]))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy_and_no_leaks(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify_language(df)
    truth = {i: lang for i, _, lang in rows}
    held = [r for r in out.collect() if r.held_out]
    assert len(held) > 100 and all(r.lang_pred == truth[r.doc_id] for r in held)
    hidden = {r.doc_id for r in held}
    other = [(i, t, "zz" if i in hidden else lang) for i, t, lang in rows]
    again = language.identify_language(spark.createDataFrame(other, df.schema))
    assert messy.rows(again.drop("lang")) == messy.rows(out.drop("lang"))


def test_predictions_against_plain_prototypes(spark):
    rows = [(i, " ".join(t.split()[:12]), lang) for i, t, lang in corpus(160)]
    rows += [(500, rows[0][1] + " " + rows[1][1], None), (501, "12 3", "aa"), (502, None, "bb"), (503, "漢 x", "dd")]
    out = language.identify_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    learned = {}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2 and lang and any(c.isalpha() for c in text or ""):
            learned[lang] = learned.get(lang, 0) + plain_bundle(text)
    prototypes = {lang: v / np.linalg.norm(v) for lang, v in learned.items()}
    for row in out.collect():
        if not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        cosines = {lang: float(plain_bundle(row.text) @ v) for lang, v in prototypes.items()}
        best = max(sorted(cosines), key=cosines.get)
        assert row.lang_pred == best
        assert row.score == pytest.approx(min(max(cosines[best], 0.0), 1.0), abs=1e-4)


def test_the_sample_is_bounded(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.learn_prototypes(df, "text", "doc_id", "lang", rows=20)
    assert list(found) == ["aa", "bb", "cc"]
    assert all(abs(np.linalg.norm(p) - 1) < 1e-5 for p in found.values())


def test_messy_documents(spark):
    docs = messy.documents(spark, "Lang_Pred", "h", "n", "score")
    out = language.identify_language(docs)
    assert {"extra", "h", "n", "lang_pred"} <= set(out.columns) and "Lang_Pred" not in out.columns
    found = out.collect()
    assert len(found) == len(messy.ROWS)
    for row in found:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters) and 0 <= row.score <= 1
    assert messy.rows(language.identify_language(messy.none(docs))) == []
    unlearned = language.identify_language(docs, learn_from=messy.none(docs))
    assert {(r.lang_pred, r.score) for r in unlearned.collect()} == {("und", 0.0)}


def test_many_short_texts_of_a_large_script_take_little_memory():
    code = """
import resource, sys
import numpy as np
from moraine.llm import language
random = np.random.default_rng(1)
texts = ["".join(map(chr, random.integers(0x4E00, 0x9FA0, 20))) for _ in range(10_000)]
language.bundles(texts[:10])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = language.bundles(texts)
after = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert np.allclose(found[:10], language.bundles(texts[:10]), atol=1e-5)
print((after - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 500
