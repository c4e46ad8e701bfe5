"""Ids against the library's own, whatever the cut; bytes come back unchanged."""

import random

import numpy as np
import pytest
import public_tokenizers

from moraine.llm import bpe
from tests.llm import messy

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    pick, alphabet = random.Random(0), "ab '.s1é \n\tΣ漢字´<|endoftext|> 's 😀　 "
    return ["".join(pick.choice(alphabet) for _ in range(n)) for n in (0, 1, 5, 50, 50, 400, 3000)]


@pytest.mark.parametrize("limit", [1, 7, 100, 1 << 18])
@pytest.mark.parametrize("text", texts())
def test_any_cut_gives_the_same_ids(text, limit):
    whole = bpe.encoding(PATH, PATTERN).encode_ordinary(text)
    assert bpe.encode_text(text, PATH, PATTERN, limit).tolist() == whole
    assert "".join(bpe.safe_pieces(text, limit)) == text


@pytest.mark.parametrize("text", [" " * 50_000 + "x", "a" * 50_000, "ab " * 20_000, "\n" * 9])
def test_long_runs(text):
    whole = bpe.encoding(PATH, PATTERN).encode_ordinary(text)
    assert bpe.encode_text(text, PATH, PATTERN, 1000).tolist() == whole


def test_round_trip_of_messy_documents(spark):
    docs = messy.documents(spark, "N_Tokens", "decoded")
    encoded = bpe.encode_documents(docs, PATH, PATTERN, limit=500)
    found = bpe.decode_documents(encoded, PATH, PATTERN)
    assert "extra" in found.columns and "N_Tokens" not in found.columns
    rows = found.select("text", "n_tokens", "token_ids", "decoded").collect()
    assert len(rows) == len(messy.ROWS)
    for row in rows:
        assert bytes(row.decoded) == (row.text or "").encode()
        ids = np.frombuffer(row.token_ids, "<u4").tolist()
        assert len(ids) == row.n_tokens
        assert ids == bpe.encoding(PATH, PATTERN).encode_ordinary(row.text or "")
    assert messy.rows(bpe.encode_documents(messy.none(docs), PATH, PATTERN)) == []


def test_ids_that_are_no_text(spark):
    df = spark.createDataFrame([(np.array([255, 0], "<u4").tobytes(),), (None,)], "token_ids binary")
    first, second = (bytes(r[0]) for r in bpe.decode_documents(df, PATH, PATTERN).select("decoded").collect())
    assert first == bpe.encoding(PATH, PATTERN).decode_bytes([255, 0]) and second == b""
