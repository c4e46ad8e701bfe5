"""Counts against the library's own, on whole texts and through spliced chunks."""

import copy
import json
import random
import uuid

import pytest
import public_tokenizers

from moraine.llm import token_counts
from tests.llm import messy

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return len(token_counts.tokenizer(PATH).encode(text, add_special_tokens=False))


def texts():
    pick, alphabet = random.Random(0), "ab '.s1é \n\tΣ漢字<|endoftext|> 's 😀　́"
    return ["".join(pick.choice(alphabet) for _ in range(n)) for n in (0, 1, 5, 50, 400, 3000, 9000)]


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (300, 20), (1000, 5), (16384, 512)])
@pytest.mark.parametrize("text", [*texts(), "漢" * 5000 + " b" * 3, "ab " * 3000, " " * 3000, "a" * 3000])
def test_spliced_chunks(text, chunk, overlap):
    assert token_counts.count_huge(PATH, text, chunk, overlap) == whole(text)


@pytest.mark.parametrize("huge", [10, 100, 10**9])
def test_batches(huge):
    own = texts()
    assert token_counts.count_batch(PATH, own, huge) == [whole(t) for t in own]


def test_an_overlap_without_a_stable_place_is_widened(monkeypatch):
    seen = []
    real = token_counts.starts
    monkeypatch.setattr(token_counts, "starts", lambda *a: seen.append(a[2:]) or real(*a))
    text = "one two " + "x" * 200 + " three four " * 20
    assert token_counts.count_huge(PATH, text, 100, 8) == whole(text)
    assert len({end - begin for begin, end in seen}) > 2


def test_messy_documents(spark):
    docs = messy.documents(spark, "OVER_LIMIT", "n_bytes", "words")
    found = token_counts.count_tokens(docs, PATH, limit=13)
    assert {"extra", "words", "over_limit"} <= set(found.columns)
    rows = found.select("text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(rows) == len(messy.ROWS)
    for row in rows:
        text = row.text or ""
        assert row.n_bytes == len(text.encode()) and row.n_tokens == whole(text)
        assert row.over_limit == (row.n_tokens > 13)
    assert messy.rows(token_counts.count_tokens(messy.none(docs), PATH)) == []


OTHER = public_tokenizers.path("byte_bpe_50k.json")


def test_white_space_must_be_proved_to_be_dropped(tmp_path):
    assert token_counts.drops_space(PATH) and not token_counts.drops_space(OTHER)
    with open(PATH, encoding="utf-8") as file:
        facts = json.load(file)
    for change in (
        lambda f: f["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex="[\\p{L}]+|\\s+"),
        lambda f: f["pre_tokenizer"]["pretokenizers"][0].update(invert=False),
        lambda f: f["pre_tokenizer"]["pretokenizers"].pop(0),
        lambda f: f["normalizer"]["normalizers"].append({"type": "Strip"}),
        lambda f: f["added_tokens"][0].update(lstrip=True),
        lambda f: f["added_tokens"][0].update(content="a b"),
        lambda f: f.update(pre_tokenizer=None),
    ):
        other = copy.deepcopy(facts)
        change(other)
        path = tmp_path / f"{uuid.uuid4().hex}.json"
        path.write_text(json.dumps(other))
        assert not token_counts.drops_space(str(path))


@pytest.mark.parametrize("huge", [10, 10**9])
def test_a_tokenizer_that_keeps_white_space(spark, huge):
    own = [*texts(), "The quick brown fox jumps\n\nover 12 dogs", "  two  spaces " * 300]
    loaded = token_counts.tokenizer(OTHER)
    expected = [len(loaded.encode(t, add_special_tokens=False)) for t in own]
    assert token_counts.count_batch(OTHER, own, huge) == expected
    found = token_counts.count_tokens(spark.createDataFrame([(t,) for t in own], "text string"), OTHER)
    assert sorted(r.n_tokens for r in found.collect()) == sorted(expected)
