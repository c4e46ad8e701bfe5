"""Token counts as a tokenizer file's library gives them, for texts of any length.

A huge document is encoded in overlapping chunks with offsets. Two neighbours are spliced at a
boundary that both encodings have and that is proven stable: a token that starts at the same
character in both, right after white space. The tokenizer drops white space and no pre-token, no
special string and no normalisation reaches across it, so from there on both encodings are the
whole document's. Where an overlap has no such place, it is widened, up to the rest of the text.

Shorter documents are one chunk each. As white space is such a boundary everywhere, their words
are counted by the library once for each distinct word of a batch and added up.

Both rest on white space being dropped, which ``drops_space`` proves from the tokenizer's file. With a
file of which it cannot be proved, every document, of any length, is encoded whole by the library.

Defined results: a NULL text counts like an empty one, 0. Repeated rows count each; an empty table
gives an empty table; input columns of an output's name are replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, quoted, with_outputs

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
HUGE_CHARS = 2 * CHUNK_CHARS
WORD_CHARS = 256  # longer runs without white space are not worth remembering

# White space to every part of the tokenizer, whatever its Unicode version.
SURE_SPACE = " \t\n\r"
UNITS = re.compile(r"[^ \t\n\r]+")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer; loaded once by each worker process, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


# Parts of a tokenizer that treat each stretch without white space by itself.
APART_NORMALIZERS = {"NFC", "NFD", "Lowercase"}
APART_SPLITTERS = {"WhitespaceSplit", "Whitespace", "BertPreTokenizer"}
# An alternative of a splitting pattern that no white space matches: plain letters and marks, or one
# class of letters, of digits, or of what is no white space.
APART_PATTERN = re.compile(r"[\w'<>|.,-]+|\[(?:\^\\s(?:\\p\{\w+\})*|(?:\\p\{[LN]\w?\})+)\]\+?")


def _parts(part: dict | None, inner: str) -> list[dict]:
    if part is None:
        return []
    return [p for own in part[inner] for p in _parts(own, inner)] if part["type"] == "Sequence" else [part]


def _keeps_apart(normalizer: dict) -> bool:
    if normalizer["type"] == "Replace":
        return normalizer["pattern"] == {"Regex": "\\s+"} and normalizer["content"] == " "
    return normalizer["type"] in APART_NORMALIZERS


@lru_cache(maxsize=4)
def drops_space(path: str) -> bool:
    """Whether a tokenizer's file shows that it drops white space and nothing reaches across it."""
    with open(path, encoding="utf-8") as file:
        facts = json.load(file)
    if not all(map(_keeps_apart, _parts(facts["normalizer"], "normalizers"))):
        return False
    for token in facts["added_tokens"]:
        stripping = token["lstrip"] or token["rstrip"] or token["single_word"]
        if stripping or re.search(r"\s", token["content"]):
            return False
    splitters = _parts(facts["pre_tokenizer"], "pretokenizers")
    if not splitters:
        return False
    first = splitters[0]
    if first["type"] == "Split":
        matches_kept = (first["behavior"], first["invert"]) == ("Removed", True)
        pattern = first["pattern"].get("Regex", "")
        return matches_kept and all(map(APART_PATTERN.fullmatch, pattern.split("|")))
    return first["type"] in APART_SPLITTERS


@lru_cache(maxsize=4)
def known_words(path: str) -> dict[str, int]:
    return {}


def starts(path: str, text: str, begin: int, end: int) -> list[int]:
    """Where the tokens of a chunk start in the whole text, one entry for each token."""
    encoded = tokenizer(path).encode(text[begin:end], add_special_tokens=False)
    return [begin + offset[0] for offset in encoded.offsets]


def stable(text: str, left: list[int], right: list[int], begin: int, end: int) -> int | None:
    """A character in the overlap from which both encodings are the whole document's."""
    shared = set(left).intersection(right)
    inside = [p for p in shared if begin < p < end and text[p - 1] in SURE_SPACE]
    return min(inside, key=lambda p: abs(2 * p - begin - end), default=None)


def count_huge(
    path: str, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """Tokens of one document by overlapping chunks, spliced where they provably agree."""
    total, begin, end = 0, 0, min(chunk, len(text))
    left, done = starts(path, text, 0, end), 0
    while end < len(text):
        wide, cut = overlap, None
        while cut is None:
            again = max(done, end - wide)
            reach = min(len(text), max(end, again) + chunk)
            right = starts(path, text, again, reach)
            cut = stable(text, left, right, again, end)
            if cut is None and again == done:
                # Nothing in this chunk to splice at: it grows by another one, from its start.
                end = min(len(text), end + max(chunk, end - done))
                left, wide = starts(path, text, done, end), overlap
                if end == len(text):
                    break
            elif cut is None:
                wide *= 2
        if cut is None:
            break
        total += sum(done <= s < cut for s in left)
        left, done, end = [s for s in right if s >= cut], cut, reach
    return total + sum(s >= done for s in left)


def count_batch(path: str, texts: list[str], huge: int = HUGE_CHARS) -> list[int]:
    """Tokens of each text; the library sees each distinct word of the shorter ones once."""
    if not drops_space(path):
        return [len(found) for found in _encode_all(path, texts, 16)]
    counts = [0] * len(texts)
    known = known_words(path)
    words = {}
    for i, text in enumerate(texts):
        if len(text) > huge:
            counts[i] = count_huge(path, text)
        else:
            words[i] = Counter(UNITS.findall(text))
    new = list({w for found in words.values() for w in found if w not in known})
    fresh = dict(zip(new, map(len, _encode_all(path, new)), strict=True))
    for i, found in words.items():
        counts[i] = sum(n * (known[w] if w in known else fresh[w]) for w, n in found.items())
    if len(known) > 500_000:
        known.clear()
    known.update((w, n) for w, n in fresh.items() if len(w) <= WORD_CHARS)
    return counts


def _encode_all(path: str, texts: list[str], at_once: int = 4096):
    for i in range(0, len(texts), at_once):
        yield from tokenizer(path).encode_batch_fast(texts[i : i + at_once], add_special_tokens=False)


def count_tokens(df: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path`` is the tokenizer file's place on every machine. No special tokens are added; special
    strings inside a text are handled as by the library's default.
    """
    bounded_batches(df.sparkSession)

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(count_batch(path, [t or "" for t in texts]), dtype="int64")

    value = quoted(text).cast("string")
    counted = with_outputs(df, {"n_tokens": count(value)})
    size = F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    return with_outputs(
        counted,
        {
            "n_bytes": size,
            "n_tokens": F.col("n_tokens"),
            "over_limit": F.col("n_tokens") > limit,
        },
    )
