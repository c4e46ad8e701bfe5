"""Toxicity by class-conditional Kneser-Ney models of character sequences.

Two interpolated Kneser-Ney models, of toxic and of ordinary texts, have counts of their own for
sequences of ``LENGTH`` characters and share all shorter ones: where a class has not seen a
sequence, both fall back to the same continuation counts, so rare expressions count neither way. The difference of the two log-likelihoods is compared per length. As a few words are enough to
make a long text toxic, this is the mean over the words of their likelihood ratios, in which a
single expression weighs much, and the log-ratio per character of the most toxic stretch of a fixed
length. A logistic curve makes the two a score.

Texts are sequences of their characters in lower case: letters, marks, digits and pictographs of all
scripts, each as it is, and one break for a run of anything else. A character's sequence goes back
to the break before its word, and further over words of one character, so that spaced-out words are
seen; before that are breaks.

The counts are a table that grows with the labelled rows. Texts are dealt out in blocks, packed;
labels are joined by id to the text's hash and meet the texts there. Each block's own sequences are
joined to the table, and the block is scored with what comes back; nothing is broadcast, and none of
it comes to the driver.

The curve is fitted on a bounded sample, ``CURVE_ROWS``, of an eighth of these rows, scored by models
of the other rows, so that no row's own counts speak for it; then the models take in the eighth too.
The curve starts from fixed weights, to which few rows add little; where all labelled rows of a class
are in the eighth, these weights stay.

Defined results: a NULL text scores like an empty one, and an empty one has no evidence at all.
Several labels of an id count as toxic if one does; rows without an id are scored and not learned
from. Where one of the classes has no labelled row, nothing can be told and every score is 0.
Repeated rows score alike; an empty table gives an empty table; input columns of an output's name
are replaced.
"""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, fold, materialize, quoted, with_outputs

LENGTH = 5  # characters of a sequence that each class counts for itself
DISCOUNT = 0.75
MOST_RATIO = 12.0  # a single word's log-ratio counts as this at most
STRETCH = 8  # symbols
EXTRA_WORDS, EXTRA_RATIO = 50, 2.0  # added to every text, so that short ones need more than chance
HELD_OUT_FOLD = 2
CURVE_ROWS = 20_000
THRESHOLD = 0.3
BLOCK_BYTES, LEAST_BLOCK_BYTES = 32 * 1024 * 1024, 1024 * 1024  # of texts that are scored together
CHUNK_CHARS = 1_000_000  # of these, looked up at once

# The curve before any rows are seen: weights of the words' mean and of the best stretch, and the
# offset; and how strongly each is held there.
START = np.array([1.0, 3.0, -6.0])
HOLD = np.array([0.1, 0.1, 0.05])

# Counts of ordinary and of toxic rows, apart from the curve's rows and of all.
MODELS = ("apart", "own")
COUNTS = ("apart_0", "apart_1", "own_0", "own_1")
EVIDENCE = ("words", "stretch")
KEY = "__llm_key"


# --- texts and their sequences ------------------------------------------------------------------


@lru_cache(maxsize=1)
def kept_characters() -> np.ndarray:
    """For every code point, whether it is a character of a word and not a break."""
    kinds = (unicodedata.category(chr(code)) for code in range(0x110000))
    return np.array([kind[0] in "LMN" or kind in ("So", "Co", "Cn") for kind in kinds])


def codes_of(text: str | None) -> np.ndarray:
    """The text's code points in lower case, 0 for a break, between two breaks; runs are one."""
    lower = (text or "").lower().encode("utf-32-le", "replace")
    raw = np.frombuffer(lower, "<u4")
    padded = np.zeros(len(raw) + 2, dtype=np.uint32)
    padded[1:-1] = np.where(kept_characters()[raw], raw, 0)
    kept = np.ones(len(padded), dtype=bool)
    kept[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    return padded[kept]


FACTORS = np.random.default_rng(8).integers(1, 2**63, LENGTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def joined_codes(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, the places at which a sequence ends, and how far each goes back."""
    codes = np.concatenate(texts)
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    first = np.zeros(len(codes), dtype=bool)
    first[starts] = True
    begins = codes == 0
    begins[2:] &= (codes[:-2] != 0) | (codes[1:-1] == 0)  # not behind a word of one character
    before = np.maximum.accumulate(np.where(begins | first, np.arange(len(codes)), 0))
    ends = np.flatnonzero(~first)
    return codes, ends, np.minimum(ends - before[ends - 1] + 1, LENGTH)


def hashes_of(codes: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits for each sequence; multilinear, so that different ones hardly ever meet."""
    values = codes.astype(np.uint64)
    out = np.zeros(len(ends), dtype=np.uint64)
    for i in range(LENGTH):
        out += np.where(lengths > i, values[np.maximum(ends - i, 0)], np.uint64(0)) * FACTORS[i]
    return out.view(np.int64)


def chunks_of(packed: list[bytes]):
    """The codes of some texts at a time, with the place of the first."""
    held, size, first = [], 0, 0
    for i, text in enumerate(packed):
        held.append(codes_of(zlib.decompress(text).decode()))
        size += len(held[-1])
        if size > CHUNK_CHARS:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def evidence(codes: np.ndarray, each: np.ndarray) -> tuple[float, float]:
    """Log of the words' mean likelihood ratio, and the best stretch's log-ratio per character."""
    if not len(each):
        return 0.0, 0.0
    # A word's sequences end at its characters and at the break behind it.
    words = np.minimum(np.add.reduceat(each, np.flatnonzero(codes[:-1] == 0)), MOST_RATIO)
    total = np.exp(words, dtype=np.float64).sum() + EXTRA_RATIO
    sums, width = each, 1
    while width < STRETCH and len(sums) > width:  # STRETCH is a power of two
        sums, width = sums[width:] + sums[:-width], 2 * width
    best = float(sums.max()) if width == STRETCH else float(each.sum())
    return float(np.log(total / (len(words) + EXTRA_WORDS))), best / STRETCH


# --- blocks of texts ----------------------------------------------------------------------------


def text_key(text: str) -> Column:
    return F.xxhash64(_plain(text))


def _plain(text: str) -> Column:
    return F.coalesce(quoted(text).cast("string"), F.lit(""))


def number_of_blocks(df: DataFrame, text: str) -> int:
    """Blocks of ``BLOCK_BYTES``; of a small input more and smaller ones, for all cores."""
    size = df.select(F.sum(F.octet_length(_plain(text)).cast("long"))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // BLOCK_BYTES), min(4 * cores, size // LEAST_BLOCK_BYTES))


def packed_texts(df: DataFrame, text: str, blocks: int) -> DataFrame:
    """Texts by block and key, compressed; a task leaves out copies it has sent already."""
    rows = df.select(text_key(text).alias("key"), _plain(text).alias("text"))

    def pack(batches):
        sent = set()
        for batch in batches:
            new = [i for i, key in enumerate(batch["key"]) if key not in sent and not sent.add(key)]
            own = batch.iloc[new]
            texts = [zlib.compress(t.encode(), 3) for t in own["text"]]
            yield pd.DataFrame({"block": own["key"] % blocks, "key": own["key"], "packed": texts})

    return rows.mapInPandas(pack, "block long, key long, packed binary")


def in_blocks(texts: DataFrame, others: DataFrame, function, schema: str) -> DataFrame:
    return texts.groupBy("block").cogroup(others.groupBy("block")).applyInPandas(function, schema)


def gram_counts(texts: DataFrame, marks: DataFrame, blocks: int) -> DataFrame:
    """Each block's sequences, and how often each class has them there."""

    def count(own: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        own = own.drop_duplicates("key")
        weights = marks.set_index("key")[list(COUNTS)].reindex(own["key"], fill_value=0).to_numpy()
        parts = []
        for first, held in chunks_of(own["packed"].tolist()):
            codes, ends, lengths = joined_codes(held)
            place, hashes = pd.factorize(hashes_of(codes, ends, lengths))
            if not len(hashes):
                continue
            at = np.zeros(len(hashes), dtype=np.int64)
            at[place[::-1]] = np.arange(len(place))[::-1]  # where each is met first
            whole = np.where(codes == 0, 32, codes).astype("<u4").tobytes().decode("utf-32-le")
            spots = zip(ends[at].tolist(), lengths[at].tolist(), strict=True)
            grams = [whole[e - n + 1 : e + 1].rjust(LENGTH) for e, n in spots]
            part = pd.DataFrame({"h": hashes, "gram": grams})
            of = np.repeat(weights[first : first + len(held)], [len(c) - 1 for c in held], axis=0)
            for i, name in enumerate(COUNTS):
                some = np.flatnonzero(of[:, i])
                sums = np.bincount(place[some], weights=of[some, i], minlength=len(hashes))
                part[name] = sums.astype(np.int64)
            parts.append(part)
            if len(parts) > 8:
                parts = [merged(parts)]
        out = merged(parts)
        out["block"] = int(own["key"].iloc[0] % blocks) if len(own) else 0
        return out

    def merged(parts: list[pd.DataFrame]) -> pd.DataFrame:
        if not parts:
            return pd.DataFrame(columns=["h", "gram", *COUNTS])
        whole = pd.concat(parts)
        how = {"gram": "first"} | dict.fromkeys(COUNTS, "sum")
        return whole.groupby("h", sort=False, as_index=False).agg(how)

    schema = "block long, h long, gram string, " + ", ".join(f"{name} long" for name in COUNTS)
    return in_blocks(texts, marks, count, schema)


def measured(texts: DataFrame, ratios: DataFrame) -> DataFrame:
    """The evidence of each text by the two pairs of models."""
    names = [f"{model}_{name}" for model in MODELS for name in EVIDENCE]

    def measure(own: pd.DataFrame, ratios: pd.DataFrame) -> pd.DataFrame:
        own = own.drop_duplicates("key")
        known = pd.Index(ratios["h"])
        sides = [ratios[model].to_numpy(np.float32) for model in MODELS]
        rows = []
        for _, held in chunks_of(own["packed"].tolist()):
            place = known.get_indexer(hashes_of(*joined_codes(held)))
            cuts = np.cumsum([len(c) - 1 for c in held])[:-1]
            split = [np.split(side[place], cuts) for side in sides]
            for i, text in enumerate(held):
                rows.append((*evidence(text, split[0][i]), *evidence(text, split[1][i])))
        out = pd.DataFrame(rows, columns=names, dtype=np.float64)
        out.insert(0, "key", own["key"].to_numpy())
        return out

    schema = "key long, " + ", ".join(f"{name} double" for name in names)
    return in_blocks(texts, ratios, measure, schema)


# --- the models ---------------------------------------------------------------------------------


def mixed(n: Column, total: Column, kinds: Column, below: Column) -> Column:
    """Discounted count of a context's character, the rest spread as the lower order says."""
    some = (F.greatest(n - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * below) / total
    return F.when(total > 0, some).otherwise(below)


def count_levels(counts: DataFrame, asked: DataFrame) -> dict[int, DataFrame]:
    """Sequences by length, counted or asked for: each class's counts, and of shorter ones
    continuation counts; 0 where none was seen."""
    none = [F.lit(0).cast("long").alias(name) for name in COUNTS]
    whole = counts.select("gram", *COUNTS).union(asked.select("gram", *none))
    sums = [F.sum(name).alias(name) for name in COUNTS]
    levels = {LENGTH: materialize(whole.groupBy("gram").agg(*sums), "grams-seen")}
    for k in range(LENGTH - 1, 0, -1):
        by_class = k == LENGTH - 1
        several = [
            F.count_if((F.col(f"{m}_0") + F.col(f"{m}_1") if by_class else F.col(m)) > 0).alias(m)
            for m in MODELS
        ]
        shorter = levels[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*several)
        levels[k] = materialize(shorter, "grams-shorter")
    return levels


def chances(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """For the sequences that are counted or asked for, each class's probability of the last character.

    Below one character is the same chance for all that were seen and one more. Each length is
    written before the next: a plan of all lengths at once, with the copies it has of the shorter ones,
    takes some 200 MB more of the driver while it is made and run, however few the texts.
    """
    levels = count_levels(counts, asked)
    found = None
    for k in range(1, LENGTH + 1):
        names = COUNTS if k == LENGTH else MODELS
        context = F.expr("substring(gram, 1, length(gram) - 1)").alias("context")
        facts = [F.sum(n).cast("double").alias(f"{n}_total") for n in names]
        facts += [F.count_if(F.col(n) > 0).cast("double").alias(f"{n}_kinds") for n in names]
        contexts = levels[k].groupBy(context).agg(*facts)
        # The tables grow with the corpus: they are shuffled at every size, and none is broadcast.
        rows = levels[k].select("gram", context, F.expr("substring(gram, 2)").alias("lower"), *names)
        rows = rows.join(contexts.hint("merge"), "context")
        if k == 1:
            below = {n: 1 / (F.col(f"{n}_kinds") + 1) for n in names}
        else:
            rows = rows.join(found.withColumnRenamed("gram", "lower").hint("merge"), "lower")
            below = {n: F.col("p_" + n.split("_")[0]) for n in names}
        chance = [
            mixed(F.col(n), F.col(f"{n}_total"), F.col(f"{n}_kinds"), below[n]).alias(f"p_{n}")
            for n in names
        ]
        found = materialize(rows.select("gram", *chance), "chances")
    return found


def log_ratios(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """For each block's sequences, the toxic less the ordinary log-probability of the last character,
    by the models apart from the curve's rows and by those of all rows."""
    ratios = [(F.log(f"p_{m}_1") - F.log(f"p_{m}_0")).cast("float").alias(m) for m in MODELS]
    return asked.join(chances(counts, asked).hint("merge"), "gram").select("block", "h", *ratios)


# --- labels and the curve -----------------------------------------------------------------------


def labelled(df: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str) -> DataFrame:
    """Rows that may be learned from: id, the text's key, label, whether kept for the curve."""
    own = fold(quoted(doc_id))
    rows = df.where(own != HELD_OUT_FOLD).select(
        quoted(doc_id).alias("id"), text_key(text).alias("key")
    )
    marks = labels.where(fold(quoted(doc_id)) != HELD_OUT_FOLD).groupBy(quoted(doc_id).alias("id"))
    marks = marks.agg(F.max(quoted(label).cast("int")).alias("label"))
    # Both sides grow with the corpus: they are shuffled at every size, and neither is broadcast.
    marks = marks.where(F.col("label").isin(0, 1)).hint("merge")
    joined = rows.join(marks, "id")
    return joined.withColumn("curve", for_curve(F.col("id")))


def for_curve(doc_id: Column) -> Column:
    return F.floor(F.crc32(doc_id.cast("string")) / 4) % 8 == 0


def marks_of(rows: DataFrame, blocks: int) -> DataFrame:
    """How many rows of each class have a text, apart from the curve's and in all."""
    sums = []
    for name in COUNTS:
        own = F.col("label") == int(name[-1])
        own = own & ~F.col("curve") if name.startswith("apart") else own
        sums.append(F.count_if(own).alias(name))
    block = F.pmod(F.col("key"), F.lit(blocks)).alias("block")
    return rows.groupBy("key").agg(*sums).select(block, "key", *COUNTS)


def fit_curve(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method, held towards the start."""
    x = np.column_stack((rows, np.ones(len(rows))))
    weights = START.copy()
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (labels - chance) - HOLD * (weights - START)
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + np.diag(HOLD)
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def curve_weights(rows: DataFrame, found: DataFrame) -> np.ndarray:
    """The curve's weights, fitted on a bounded sample of its rows."""
    sample = rows.where("curve").join(found.hint("merge"), "key").withColumn("order", F.xxhash64("id"))
    names = [f"apart_{name}" for name in EVIDENCE]
    sample = sample.select("order", "label", *names).orderBy("order", "label").limit(CURVE_ROWS).toPandas()
    return fit_curve(sample[names].to_numpy(float), sample["label"].to_numpy(float))


def score_documents(
    df: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    threshold: float = THRESHOLD,
    learn_from: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Labels are learned from the rows of ``learn_from`` (by default ``df``) outside the held-out
    fold; a row's own label, id and other columns are no inputs of its score.
    """
    bounded_batches(df.sparkSession)
    source = df if learn_from is None else learn_from
    rows = materialize(labelled(source, labels, text, doc_id, label), "labelled")
    held_out = F.coalesce(fold(quoted(doc_id)) == HELD_OUT_FOLD, F.lit(False))
    classes = rows.select("label", "curve").distinct().collect()
    if len({r["label"] for r in classes}) < 2:
        score = F.lit(0.0)
        return _judged(df, {"held_out": held_out, "score": score}, threshold)
    blocks = number_of_blocks(df, text)
    texts = packed_texts(df, text, blocks)
    if learn_from is not None:
        texts = texts.union(packed_texts(learn_from, text, blocks))
    grams = materialize(gram_counts(texts, marks_of(rows, blocks), blocks), "grams")
    ratios = log_ratios(grams, grams.select("block", "h", "gram"))
    found = materialize(measured(texts, ratios).dropDuplicates(["key"]), "evidence")
    # Without rows of both classes besides the curve's, no models could score these.
    weights = START
    if len({r["label"] for r in classes if not r["curve"]}) == 2:
        weights = curve_weights(rows, found)
    total = F.lit(float(weights[-1]))
    for name, weight in zip(EVIDENCE, weights, strict=False):
        total = total + F.col(f"own_{name}") * float(weight)
    scores = found.select(F.col("key").alias(KEY), (1 / (1 + F.exp(-total))).alias(f"{KEY}_score"))
    out = df.withColumn(KEY, text_key(text)).join(scores.hint("merge"), KEY, "left")
    out = _judged(out, {"held_out": held_out, "score": F.col(f"{KEY}_score")}, threshold)
    return out.drop(KEY, f"{KEY}_score")


def _judged(df: DataFrame, outputs: dict[str, Column], threshold: float) -> DataFrame:
    out = with_outputs(df, outputs)
    return with_outputs(out, {"predicted": (F.col("score") >= threshold).cast("int")})
