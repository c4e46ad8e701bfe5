"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. Three letters in a row are bound into one vector by
rotating the first one's twice and the second one's once and multiplying all three; a document is
the bundle (sum) of its bound vectors, and a language the bundle of its documents. A document's
language is the one whose prototype has the largest cosine with it.

Case is folded, and anything but letters parts words: it counts as a blank, once for a run.

The prototypes are learned from a bounded sample: of each language the ``SAMPLE_ROWS`` rows with the
smallest hashed ids, whole texts, outside the held-out fold. All rows are predicted.

Defined results: a text that is NULL or without letters is ``und`` with score 0, as is every text
where nothing could be learned. Equal cosines go to the language that sorts first. Rows without an
id or a language are predicted and not learned from. Repeated rows are predicted alike; an empty
table gives an empty table; input columns of an output's name are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, fold, quoted, with_outputs, with_struct

DIMENSIONS = 1024
SEED = 11
SAMPLE_ROWS = 1000  # of each language
WIDE_SAMPLE = 3  # times as many are ranked to find them
HELD_OUT_FOLD = 2
BATCH_CHARS = 250_000  # bundled in one product
COUNTS, TRIPLES = 4_000_000, 4096  # that one step of a product holds
UNKNOWN = "und"
LETTER_BITS = 21

PREDICTED = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point the letter it counts as, or 0."""
    codes = range(0x110000)
    letters = np.fromiter(
        (0 if not chr(c).isalpha() else ord(low) if len(low := chr(c).lower()) == 1 else c for c in codes),
        dtype=np.int64,
        count=0x110000,
    )
    return letters


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """The random vector of each letter; the same on every machine."""
    out = np.empty((len(letters), DIMENSIONS), dtype=np.float32)
    for i, letter in enumerate(letters.tolist()):
        out[i] = known_vector(letter)
    return out


@lru_cache(maxsize=4096)
def known_vector(letter: int) -> np.ndarray:
    random = np.random.default_rng((SEED, letter))
    return (2 * random.integers(0, 2, DIMENSIONS) - 1).astype(np.float32)


def triples_of(text: str | None) -> np.ndarray:
    """Three letters in a row, as one number each; none for a text without letters."""
    raw = letter_table()[np.frombuffer((text or "").encode("utf-32-le", "replace"), "<u4")]
    if not raw.any():
        return np.zeros(0, dtype=np.int64)
    padded = np.zeros(len(raw) + 2, dtype=np.int64)
    padded[1:-1] = raw
    kept = np.ones(len(padded), dtype=bool)
    kept[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    own = padded[kept]
    return (own[:-2] << 2 * LETTER_BITS) | (own[1:-1] << LETTER_BITS) | own[2:]


def bound(triples: np.ndarray) -> np.ndarray:
    """The bound vector of each triple."""
    mask = (1 << LETTER_BITS) - 1
    parts = [(triples >> s) & mask for s in (2 * LETTER_BITS, LETTER_BITS, 0)]
    letters = np.unique(np.concatenate(parts))
    vectors = letter_vectors(letters)
    first, second, third = (np.searchsorted(letters, p) for p in parts)
    out = np.roll(vectors, 2, axis=1)[first]
    out *= np.roll(vectors, 1, axis=1)[second]
    out *= vectors[third]
    return out


def bundles(texts: list[str | None]) -> np.ndarray:
    """Unit bundles of the documents; zero for those without letters."""
    triples = [triples_of(t) for t in texts]
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(triples[stop]) <= BATCH_CHARS):
            size += len(triples[stop])
            stop += 1
        if size:
            out[start:stop] = _product(triples[start:stop])
        start = stop
    return out


def _product(triples: list[np.ndarray]) -> np.ndarray:
    known, which = np.unique(np.concatenate(triples), return_inverse=True)
    rows = np.repeat(np.arange(len(triples)), [len(t) for t in triples])
    # What texts have of each triple, a bounded number of texts and of triples at a time.
    summed = np.zeros((len(triples), DIMENSIONS), dtype=np.float32)
    order = np.argsort(which, kind="stable")
    rows, which = rows[order], which[order]
    wide = min(max(COUNTS // len(triples), 1), TRIPLES)
    for low in range(0, len(known), wide):
        high = min(low + wide, len(known))
        own = slice(*np.searchsorted(which, (low, high)))
        at = rows[own] * (high - low) + which[own] - low
        counts = np.bincount(at, minlength=len(triples) * (high - low))
        counts = counts.reshape(len(triples), high - low).astype(np.float32)
        summed += counts @ bound(known[low:high])
    length = np.linalg.norm(summed, axis=1, keepdims=True)
    return np.divide(summed, length, out=summed, where=length > 0)


def learn_prototypes(
    df: DataFrame, text: str, doc_id: str, lang: str, rows: int = SAMPLE_ROWS
) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages, from a bounded sample of each."""
    own, ranked = quoted(lang).cast("string"), F.xxhash64(quoted(doc_id))
    learnable = (fold(quoted(doc_id)) != HELD_OUT_FOLD) & quoted(lang).isNotNull()
    # A row for each language comes to the driver. The smallest hashes are looked for among so many
    # as surely hold them, so a common language is not ranked whole.
    counted = df.where(learnable).groupBy(own.alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    wide = F.lit(False)
    for row in counted.collect():
        share = min(2**64 - 1, 2**64 * WIDE_SAMPLE * rows // row["n"])
        wide = wide | ((own == row["lang"]) & (ranked <= share - 2**63))
    ids = df.where(learnable & wide).select(own.alias("lang"), ranked.alias("h"))
    in_lang = Window.partitionBy("lang").orderBy("h")
    first = ids.withColumn("n", F.row_number().over(in_lang)).where(F.col("n") <= rows)
    last = {r["lang"]: r["h"] for r in first.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    if not last:
        return {}
    chosen = F.lit(False)
    for name, h in last.items():
        chosen = chosen | ((own == name) & (ranked <= h))
    sample = df.where(learnable & chosen).select(
        own.alias("lang"), quoted(text).cast("string").alias("text")
    )

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors = bundles(batch["text"].tolist()).astype(np.float64)
            for name, at in batch.groupby("lang").indices.items():
                sums[name] = sums.get(name, 0) + vectors[at].sum(axis=0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sum": [s.tobytes() for s in sums.values()]})

    prototypes: dict[str, np.ndarray] = {}
    # A task sends at most one bundle for each sampled row.
    for row in sample.mapInPandas(bundle, "lang string, sum binary").toLocalIterator():
        prototypes[row["lang"]] = prototypes.get(row["lang"], 0) + np.frombuffer(row["sum"])
    lengths = {name: np.linalg.norm(p) for name, p in prototypes.items()}
    return {n: (prototypes[n] / lengths[n]).astype(np.float32) for n in sorted(lengths) if lengths[n]}


def identify_language(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
    learn_from: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``held_out``, ``lang_pred`` and ``score``, the cosine (from 0 on).

    Languages are learned from ``learn_from`` (by default ``df``), outside the held-out fold. Only
    the text is an input of a prediction.
    """
    bounded_batches(df.sparkSession)
    prototypes = learn_prototypes(df if learn_from is None else learn_from, text, doc_id, lang)
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else np.zeros((0, DIMENSIONS), np.float32)

    @F.pandas_udf(PREDICTED)
    def predict(texts: pd.Series) -> pd.DataFrame:
        vectors = bundles(texts.tolist())
        if not names:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
        cosines = vectors @ matrix.T
        known, best = vectors.any(axis=1), cosines.argmax(axis=1)
        score = np.clip(cosines.max(axis=1).astype(np.float64), 0.0, 1.0)
        chosen = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
        return pd.DataFrame({"lang_pred": chosen, "score": np.where(known, score, 0.0)})

    out = with_struct(df, predict(quoted(text).cast("string")), PREDICTED.names)
    held_out = F.coalesce(fold(quoted(doc_id)) == HELD_OUT_FOLD, F.lit(False))
    return with_outputs(out, {"held_out": held_out})
