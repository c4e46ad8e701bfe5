"""Byte-level BPE: texts to token ids by a local rank file, and ids back to raw bytes.

Texts are encoded by tiktoken. A long text is first cut at safe boundaries, so that the time and
the memory of one call stay bounded by the cut and not by the document.

Defined results: a NULL text encodes like an empty one (no ids); NULL ids decode to empty bytes.
Repeated rows are encoded each; an empty table gives an empty table. Input columns that carry an
output's name are replaced, all others are kept.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, quoted, with_outputs, with_struct

CUT_CHARS = 1 << 18

# A character that is no white space and one that is: no match of the splitting pattern holds both
# in this order, so a match always starts between them, and what follows is split the same alone.
SAFE_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")

ENCODED = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
)


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The tokenizer of a rank file; loaded once by each worker process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


def safe_pieces(text: str, limit: int = CUT_CHARS) -> Iterator[str]:
    """The text in pieces of about ``limit`` characters that can be encoded one by one."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE_BOUNDARY.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(text: str, path: str, pattern: str, limit: int = CUT_CHARS) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit integers."""
    encoder = encoding(path, pattern)
    ids = [np.asarray(encoder.encode_ordinary(p), "<u4") for p in safe_pieces(text, limit)]
    return ids[0] if len(ids) == 1 else np.concatenate(ids)


def encode_documents(
    df: DataFrame, path: str, pattern: str, text: str = "text", limit: int = CUT_CHARS
) -> DataFrame:
    """``df`` with ``n_tokens`` and ``token_ids`` (little-endian unsigned 32-bit integers).

    ``path`` is the rank file's place on every machine, ``pattern`` the one that splits a text
    before the merges. Strings that look like special tokens are ordinary text.
    """
    bounded_batches(df.sparkSession)

    @F.pandas_udf(ENCODED)
    def encode(texts: pd.Series) -> pd.DataFrame:
        ids = [encode_text(t or "", path, pattern, limit) for t in texts]
        return pd.DataFrame(
            {"n_tokens": [len(i) for i in ids], "token_ids": [i.tobytes() for i in ids]}
        )

    return with_struct(df, encode(quoted(text).cast("string")), ENCODED.names)


def decode_documents(
    df: DataFrame, path: str, pattern: str, ids: str = "token_ids", output: str = "decoded"
) -> DataFrame:
    """``df`` with the raw bytes that the ids stand for. They need not be valid UTF-8."""
    bounded_batches(df.sparkSession)

    @F.pandas_udf(T.BinaryType())
    def decode(values: pd.Series) -> pd.Series:
        decoder = encoding(path, pattern)
        return pd.Series(
            [decoder.decode_bytes(np.frombuffer(v or b"", "<u4").tolist()) for v in values],
            dtype=object,
        )

    return with_outputs(df, {output: decode(quoted(ids))})
