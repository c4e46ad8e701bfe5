"""Exact dedup by recipes of content-defined chunks, in DataFrame functions only.

A normalised text is cut where its own bytes say so, so equal texts are cut alike and texts that
share a passage share its chunks. Each chunk has a short identifier, a digest. The identifiers are
verified: every distinct (identifier, chunk) moves once, after each task has dropped its repeats, and
no identifier may stand for two chunks. If one does, longer digests are tried and at last the chunks
themselves are the identifiers. Then a document is its list of identifiers, its recipe, and documents
are equal exactly if their recipes are; what is grouped and joined is recipes, not texts.

Defined results: a NULL text counts as empty, and all texts without a character beside white space
are equal. Rows that repeat, with their ids, are one group each of whose rows counts; one of them
stays. A NULL id sorts behind all others, and ``keep_id`` is NULL if the row that stays has none. An
empty table gives an empty table. Input columns of an output's name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.frames import materialize, quoted, with_outputs

# Characters that do not count.
SPACE = " \t\n\v\f\r"

# A chunk ends behind five bytes of this set, some 700 bytes apart in prose, or when it is as long as
# it may be. The least length is short against that, so chunks fall into step again behind a change.
LEAST_BYTES, MOST_BYTES, CUT_LENGTH = 128, 8192, 5
CUT_BYTES = "".join(f"\\x{b:02X}" for b in range(256) if (b * 151 + 43) % 256 < 56)
CHUNK = (
    f"(?s).{{{LEAST_BYTES},{MOST_BYTES - CUT_LENGTH}}}?[{CUT_BYTES}]{{{CUT_LENGTH}}}"
    f"|.{{1,{MOST_BYTES}}}"
)

ID_BYTES = 16
LONGEST_ID = 32  # of SHA-256

# Rows of one group that go to one task when groups are joined to rows.
HOT_SHARE = 1000  # groups of more than this part of all rows are spread
MOST_PARTS = 64

RECIPE, CHARS, PLACE = "__llm_recipe", "__llm_chars", "__llm_place"
GROUP, ANSWER, SHA = "__llm_group", "__llm_answer", "__llm_sha"
PARTS, PART, GROUP_PART = "__llm_parts", "__llm_part", "__llm_group_part"


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for character in SPACE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def chunks(text: Column) -> Column:
    """The UTF-8 bytes of a text in content-defined chunks, each byte as one character."""
    as_bytes = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.regexp_extract_all(as_bytes, F.lit(CHUNK), F.lit(0))


def identifier(chunk: Column, length: int | None) -> Column:
    """The first ``length`` bytes of a digest; without a length the chunk itself."""
    if length is None:
        return F.encode(chunk, "UTF-8")
    return F.unhex(F.substring(F.sha2(chunk, 256), 1, 2 * length))


def clashing(texts: DataFrame, length: int) -> bool:
    """Whether an identifier of this length stands for two different chunks of ``text``."""
    pieces = texts.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    distinct = pieces.groupBy(identifier(F.col("chunk"), length).alias("id"), "chunk").agg(
        F.lit(1).alias("one")
    )
    return not distinct.groupBy("id").agg(F.count("one").alias("n")).where("n > 1").isEmpty()


def verified_length(texts: DataFrame, length: int) -> int | None:
    """The first length from ``length`` on, doubling, at which no identifier is ambiguous."""
    while length <= LONGEST_ID:
        if not clashing(texts, length):
            return length
        length *= 2
    return None


def with_recipes(df: DataFrame, text: str = "text", id_bytes: int = ID_BYTES) -> DataFrame:
    """``df`` with ``text_sha256`` of the normalised text, and the columns ``with_copies`` needs.

    ``df`` is read twice: once to verify identifiers, once for the result.
    """
    own = normalised(quoted(text))
    length = verified_length(df.select(own.alias("text")), id_bytes)
    return with_outputs(
        df,
        {
            "text_sha256": F.sha2(own, 256),
            RECIPE: F.transform(chunks(own), lambda chunk: identifier(chunk, length)),
            CHARS: F.coalesce(F.length(quoted(text).cast("string")), F.lit(0)),
        },
    )


def with_copies(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``with_recipes`` with ``keep_id``, ``group_size`` and ``kept``; recipes are dropped.

    Of the rows of equal texts one stays: that of the longest original text, then of the smallest id.
    What ``df`` holds is written to the shared folder, so drop texts before where they are not needed.
    """
    placed = materialize(df.withColumn(PLACE, F.monotonically_increasing_id()), "recipes")
    order = F.struct(
        (-F.col(CHARS)).alias("chars"), quoted(key).isNull().alias("none"), quoted(key).alias("id"), PLACE
    )
    grouped = placed.groupBy(RECIPE).agg(
        F.min(order).alias("first"),
        F.count(F.lit(1)).alias("rows"),
        F.first("text_sha256").alias(SHA),
    )
    answer = F.struct("rows", F.col("first.id").alias("id"), F.col(f"first.{PLACE}").alias("place"))
    groups = materialize(
        grouped.select(F.col(RECIPE).alias(GROUP), SHA, answer.alias(ANSWER)), "recipe-groups"
    )
    # A large group's rows are spread over parts, and its answer is given to each. Fewer than
    # HOT_SHARE groups can be that large, and a digest of each is all that is sent to the tasks.
    least = max(placed.count() / HOT_SHARE, 1)
    rows = F.col(f"{ANSWER}.rows")
    parts = F.least(F.lit(MOST_PARTS), F.ceil(F.max(rows) / least)).cast("int")
    hints = F.broadcast(groups.where(rows > least).groupBy(SHA).agg(parts.alias(PARTS)))
    hinted = hints.withColumnRenamed(SHA, "text_sha256")
    part = F.coalesce(F.pmod(F.xxhash64(PLACE), F.col(PARTS)), F.lit(0)).cast("int")
    routed = placed.join(hinted, "text_sha256", "left").withColumn(PART, part).drop(PARTS)
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PARTS), F.lit(1)) - 1))
    answers = groups.join(hints, SHA, "left").select(GROUP, ANSWER, each.alias(GROUP_PART))
    joined = routed.join(answers, (F.col(RECIPE) == F.col(GROUP)) & (F.col(PART) == F.col(GROUP_PART)))
    out = with_outputs(
        joined,
        {
            "keep_id": F.col(f"{ANSWER}.id"),
            "group_size": F.col(f"{ANSWER}.rows"),
            "kept": F.col(f"{ANSWER}.place") == F.col(PLACE),
        },
    )
    return out.drop(RECIPE, CHARS, PLACE, PART, GROUP, GROUP_PART, ANSWER)


def drop_copies(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``df``."""
    whole = F.struct(*[quoted(name) for name in df.columns])
    held = df.select(
        whole.alias("row"), quoted(text).alias("text"), quoted(key).alias("key")
    )
    kept = with_copies(with_recipes(held).drop("text"), "key").where("kept")
    return kept.select("row.*")
