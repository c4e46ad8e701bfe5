"""Secret scans: fixed patterns, and a battery of randomness tests on other tokens.

Long tokens of letters and digits get an inferred encoding (hex, base 32, base 36 or base 64, by
the characters they use). If a token is a random key, its characters are uniform over the alphabet
(chi-squared, over all characters and over their classes: capitals, vowels, consonants, digits),
its high and low characters alternate by chance (runs), and neighbours are unrelated (serial
correlation). The four p-values are combined by Fisher's method.

Within each encoding and length class, false discoveries are controlled on both sides. Benjamini
and Hochberg's procedure says which tokens are too orderly to be random, so that few random keys are
lost. Of what remains, the share that is not random must stay under the same level: p-values of random
keys are uniform, so those above a half tell how many there are, and where more tokens than that
allows have p-values above the bar, the bar is raised. The classes see to it that short tokens, for
which the tests are weak, do not set the bar for long ones.

Everything is DataFrame functions: one pass over the texts writes spans and p-values without the
texts, a histogram of p-values (of bounded size) gives the thresholds, and a second pass over what
was written applies them.

Defined results: a NULL text is like an empty one and has no spans; repeated rows are scanned each;
an empty table gives an empty table; carried columns of an output's name are replaced. Tokens of
every length from 20 on are tested; sums over long ones are added up in pieces. A token in a single
letter case is tested by its parts of 12 characters and more, together; it needs 20 in them. Tokens
without a digit, or without a letter, are words or numbers to it, and are not tested.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.llm.frames import materialize, quoted, with_outputs

# The kinds and their patterns.
KINDS = ("assign", "access", "hex", "random")
KEY_VALUE = r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)" + KEY_VALUE
ASSIGN_VALUE = r"^(?i:password|passwd|secret|token|api_?key)" + (
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": DIGITS + LOWER[:6],
    "base32": LOWER + "234567",
    "base36": DIGITS + LOWER,
    "base64": LOWER.upper() + LOWER + DIGITS + "+/",
}
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"
# Classes of an alphabet's characters, which words use in other shares than keys do.
CLASSES = {
    "hex": (DIGITS, LOWER[:6]),
    "base32": (VOWELS, CONSONANTS, "234567"),
    "base36": (VOWELS, CONSONANTS, DIGITS),
    "base64": (LOWER.upper(), VOWELS, CONSONANTS, DIGITS + "+/"),
}
LEAST_TESTED, LEAST_PART = 20, 12  # characters of a token's core, and of a part of it
FALSE_DISCOVERY = 0.05
BINS_PER_E, MOST_BINS = 50, 2500  # of the p-values' negative logarithms
UPPER_BINS = 34  # these hold the p-values above a half, nearly
PIECE = 4096  # characters of a token that are numbers in memory at once
TEXT, BASE, TESTED = "__llm_text", "__llm_base", "__llm_tested"


# --- matches and where they are -----------------------------------------------------------------


def located(df: DataFrame, pattern: str, output: str) -> DataFrame:
    """``df`` with the matches of a pattern in ``TEXT``: begin, end (code points) and the match.

    The lengths of the matches and of the gaps before them are added up, in blocks of about the
    root of their number, so that texts with very many matches stay affordable.
    """
    gaps, found, blocks, sums = (f"{output}_{x}" for x in ("gaps", "found", "blocks", "sums"))
    has = F.col(TEXT).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(has, F.regexp_extract_all(TEXT, F.lit(pattern), 0)).otherwise(none))
    some = F.size(found) > 0
    df = df.withColumn(gaps, F.when(some, F.split(TEXT, pattern, -1)).otherwise(none))
    width = F.ceil(F.sqrt(F.size(found))).cast("int")
    count = F.ceil(F.size(found) / width).cast("int")
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        F.col(found),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
    )
    cut = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.slice(F.col(gaps), i * width + 1, width)
    )
    step = "array<struct<gap:int,match:string>>"
    df = df.withColumn(gaps, F.when(some, steps).otherwise(F.array().cast(step)))
    df = df.withColumn(blocks, F.when(some, cut).otherwise(F.array().cast(f"array<{step}>")))
    span = F.transform(
        blocks,
        lambda block: F.aggregate(block, F.lit(0), lambda n, s: n + s["gap"] + F.length(s["match"])),
    )
    df = df.withColumn(sums, span)

    def add(state: Column, s: Column) -> Column:
        begin = state["at"] + s["gap"]
        end = begin + F.length(s["match"])
        one = F.struct(begin.alias("begin"), end.alias("end"), s["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    spans = "array<struct<begin:int,end:int,match:string>>"

    def place(block: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(F.col(sums), 1, i), F.lit(0), lambda n, s: n + s)
        empty = F.array().cast(spans)
        start = F.struct(before.alias("at"), empty.alias("spans"))
        return F.aggregate(block, start, add, lambda state: state["spans"])

    placed = F.flatten(F.transform(blocks, place))
    df = df.withColumn(output, F.when(some, placed).otherwise(F.array().cast(spans)))
    return df.drop(gaps, found, blocks, sums)


def kind_spans(matches: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        matches,
        lambda m: F.struct(m["begin"].alias("begin"), number.alias("kind"), m["end"].alias("end")),
    )


def spelled(spans: Column) -> Column:
    """Sorted spans as kind:begin:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", names[s["kind"]], s["begin"], s["end"]),
        ),
    )


# --- the tests ----------------------------------------------------------------------------------


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by Abramowitz and Stegun 26.2.17; never zero."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    weights = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    series = F.lit(0.0)
    for weight in reversed(weights):
        series = (series + weight) * t
    tail = F.greatest(F.exp(-x * x / 2) * 0.3989422804014327 * series, F.lit(1e-300))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def core_of(token: Column) -> Column:
    """What of a token is tested: all of it, or of one in a single letter case its long parts.

    Letters of both cases make a token base 64, which has the separators in its alphabet. In other
    tokens separators join parts, and prefixes like those of vendors' keys are no part of the key.
    """
    cases = token.rlike("[A-Z]") & token.rlike("[a-z]")
    parts = F.filter(F.split(token, "[-_/+]"), lambda part: F.length(part) >= LEAST_PART)
    return F.when(cases, token).otherwise(F.array_join(parts, ""))


def encoding_of(token: Column) -> Column:
    """The narrowest encoding whose characters a core uses; NULL if it does not look like a key."""
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (F.length(token) >= LEAST_TESTED)
    return (
        F.when(~mixed, F.lit(None).cast("string"))
        .when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(token.rlike("^([A-Z2-7]+|[a-z2-7]+)$"), "base32")
        .when(token.rlike("^([A-Z0-9]+|[a-z0-9]+)$"), "base36")
        .when(token.rlike("[A-Z]") & token.rlike("[a-z]"), "base64")
    )


def by_encoding(encoding: Column, value) -> Column:
    out = F.lit(None)
    for name, alphabet in ALPHABETS.items():
        out = F.when(encoding == name, value(name, alphabet)).otherwise(out)
    return out


def tests(match: Column) -> Column:
    """A token's encoding and the combined p-value of the tests; NULL without an encoding.

    Written as a chain of one-element transforms, so that each step is computed once. A token is
    cut into pieces that know the character behind them, and what these sum to is added up.
    """
    begin, end = match["begin"], match["end"]

    def normal(encoding: Column, token: Column) -> Column:
        plain = F.translate(token, "-_", "+/")
        return F.when(encoding == "base64", plain).otherwise(F.lower(token))

    def numbers(encoding: Column, text: Column) -> Column:
        alphabet = by_encoding(encoding, lambda _, a: F.lit(a))
        return F.transform(F.split(text, ""), lambda c: F.instr(alphabet, c) - 1)

    def cut(text: Column) -> Column:
        some = F.regexp_extract_all(text, F.lit(f".{{1,{PIECE}}}"), F.lit(0))
        pieces = F.when(F.length(text) <= PIECE, F.array(text)).otherwise(some)
        return once(
            pieces,
            lambda own: F.zip_with(
                own,
                F.slice(own, 2, F.size(own)),
                lambda piece, behind: F.struct(
                    piece.alias("own"),
                    F.concat(piece, F.coalesce(F.substring(behind, 1, 1), F.lit(""))).alias("linked"),
                ),
            ),
        )

    def measured(encoding: Column, text: Column, pieces: Column) -> Column:
        size = by_encoding(encoding, lambda _, a: F.lit(float(len(a))))
        alphabet = by_encoding(encoding, lambda _, a: F.array(*[F.lit(c) for c in a]))
        held = F.transform(
            alphabet, lambda c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
        )
        sums = F.transform(
            pieces,
            lambda p: total(
                F.transform(numbers(encoding, p["own"]), lambda v: v.cast("double"))
            ),
        )
        facts = F.struct(
            F.length(text).cast("double").alias("n"),
            size.alias("k"),
            total(F.transform(held, lambda c: c.cast("double") * c)).alias("squares"),
            (total(sums) / F.length(text)).alias("mean"),
            by_encoding(encoding, lambda name, a: class_squares(text, name, a)).alias("classes"),
            by_encoding(encoding, lambda name, _: F.lit(len(CLASSES[name]) - 1.0)).alias("free"),
        )
        return once(facts, lambda f: judged(f, encoding, pieces))

    def class_squares(text: Column, name: str, alphabet: str) -> Column:
        """Chi-squared over the classes."""
        out = F.lit(0.0)
        for letters in CLASSES[name]:
            expected = F.length(text) * F.lit(len(letters) / len(alphabet))
            found = F.length(text) - F.length(F.translate(text, letters, ""))
            out = out + (found - expected) * (found - expected) / expected
        return out

    def judged(f: Column, encoding: Column, pieces: Column) -> Column:
        names = ("ones", "changes", "power", "product")

        def summed(piece: Column) -> Column:
            size = F.length(piece["own"])
            return once(
                numbers(encoding, piece["linked"]),
                lambda values: once(
                    F.struct(
                        F.transform(
                            values, lambda v: F.when(v * 2 >= f["k"], 1.0).otherwise(0.0)
                        ).alias("high"),
                        F.transform(values, lambda v: v - f["mean"]).alias("around"),
                    ),
                    lambda x: F.struct(
                        total(F.slice(x["high"], 1, size)).alias("ones"),
                        total(neighbours(x["high"], lambda a, b: F.abs(a - b))).alias("changes"),
                        total(
                            F.transform(F.slice(x["around"], 1, size), lambda v: v * v)
                        ).alias("power"),
                        total(neighbours(x["around"], lambda a, b: a * b)).alias("product"),
                    ),
                ),
            )

        return once(
            F.transform(pieces, summed),
            lambda sums: once(
                F.struct(*[total(sums.getField(n)).alias(n) for n in names]),
                lambda g: once(chances(f, g), lambda p: combined(f, p)),
            ),
        )

    def chances(f: Column, g: Column) -> Column:
        n, free = f["n"], f["k"] - 1

        def uniform(chi: Column, free: Column) -> Column:
            # Chi-squared, made normal by Wilson and Hilferty's cube root.
            shrunk = 2 / (9 * free)
            return (F.pow(chi / free, F.lit(1 / 3)) - (1 - shrunk)) / F.sqrt(shrunk)

        # Runs of the upper and the lower half of the alphabet, against their expected number.
        two = 2 * g["ones"] * (n - g["ones"])
        spread = two * (two - n) / (n * n * (n - 1))
        least = F.greatest(F.pow(F.lit(2.0), 1 - n), F.lit(1e-300))
        alternate = F.abs(g["changes"] - two / n) / F.sqrt(spread)
        # Serial correlation of neighbours.
        serial = F.abs(g["product"] / g["power"] + 1 / n) * F.sqrt(n)
        return F.struct(
            upper_tail(uniform(f["squares"] * f["k"] / n - n, free)).alias("uniform"),
            upper_tail(uniform(f["classes"], f["free"])).alias("classes"),
            F.when(spread > 0, 2 * upper_tail(alternate)).otherwise(least).alias("alternate"),
            F.when(g["power"] > 0, 2 * upper_tail(serial)).otherwise(least).alias("serial"),
        )

    def combined(f: Column, p: Column) -> Column:
        # Fisher: -2 sum ln p has 8 degrees of freedom.
        at_most_one = lambda x: F.log(F.least(x, F.lit(1.0)))
        half = -(
            F.log(p["uniform"])
            + F.log(p["classes"])
            + at_most_one(p["alternate"])
            + at_most_one(p["serial"])
        )
        return once(
            half,
            lambda h: F.struct(
                F.floor(F.log2(f["n"])).cast("int").alias("length_class"),
                F.least(
                    F.floor((h - F.log(1 + h + h * h / 2 + h * h * h / 6)) * BINS_PER_E),
                    F.lit(MOST_BINS),
                ).cast("int").alias("bin"),
            ),
        )

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def neighbours(xs: Column, both) -> Column:
        rest = F.size(xs) - 1
        return F.zip_with(F.slice(xs, 1, rest), F.slice(xs, 2, rest), both)

    def once(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    def tested(encoding: Column, token: Column) -> Column:
        return once(
            normal(encoding, token),
            lambda text: once(cut(text), lambda pieces: measured(encoding, text, pieces)),
        )

    def named(encoding: Column, token: Column) -> Column:
        return once(
            tested(encoding, token),
            lambda t: F.struct(
                begin.alias("begin"),
                end.alias("end"),
                encoding.alias("encoding"),
                t["length_class"].alias("length_class"),
                t["bin"].alias("bin"),
            ),
        )

    def looked_at(token: Column) -> Column:
        return once(
            encoding_of(token),
            lambda encoding: F.when(encoding.isNotNull(), named(encoding, token)),
        )

    return once(core_of(match["match"]), looked_at)


def thresholds(scanned: DataFrame, level: float) -> dict[tuple[str, int], int]:
    """For each encoding and length class, from which bin on a token is not reported.

    The histogram has at most MOST_BINS bins for each of a few classes, whatever the input.
    """
    counted = (
        scanned.select(F.explode(TESTED).alias("t"))
        .groupBy("t.encoding", "t.length_class", "t.bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    classes: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for row in counted:
        classes[row["encoding"], row["length_class"]][row["bin"]] = row["n"]
    return {
        name: min(orderly_from(bins, level), doubtful_from(bins, level))
        for name, bins in classes.items()
    }


def orderly_from(bins: dict[int, int], level: float) -> int:
    """Benjamini and Hochberg on binned p-values: the first bin that is rejected."""
    total, so_far, first = sum(bins.values()), 0, MOST_BINS + 1
    for number in sorted(bins, reverse=True):
        so_far += bins[number]
        if math.exp(-number / BINS_PER_E) <= level * so_far / total:
            first = number
    return first


def doubtful_from(bins: dict[int, int], level: float) -> int:
    """The last bin below which the share of tokens that are not random is at most ``level``.

    Random tokens are as many as p-values above a half allow: their number's upper bound (of about
    95 %), since a class may have few, and nothing should be left out for that.
    """
    upper = sum(n for number, n in bins.items() if number < UPPER_BINS)
    random = (upper + 1.645 * math.sqrt(upper) + 3) / (1 - math.exp(-UPPER_BINS / BINS_PER_E))
    so_far, last = 0, UPPER_BINS
    for number in range(MOST_BINS + 1):
        so_far += bins.get(number, 0)
        expected = random * (1 - math.exp(-(number + 1) / BINS_PER_E))
        if number >= UPPER_BINS and so_far * (1 - level) <= expected:
            last = number + 1
    return last


# --- the operator -------------------------------------------------------------------------------


def scan(df: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with base spans and tested tokens; the texts are left behind."""
    carried = [c for c in df.columns if c != text] if carry is None else carry
    df = df.select(
        *[quoted(c) for c in carried], F.coalesce(quoted(text).cast("string"), F.lit("")).alias(TEXT)
    )
    for pattern, kind in ((ASSIGN, "assign"), (ACCESS, "access"), (HEX, "hex"), (TOKEN, "random")):
        df = located(df, pattern, f"__llm_{kind}")
    value = lambda m: F.length(F.regexp_extract(m["match"], ASSIGN_VALUE, 1)) >= 6
    df = df.withColumn("__llm_assign", F.filter("__llm_assign", value))
    base = F.array_sort(
        F.concat(*[kind_spans(F.col(f"__llm_{kind}"), kind) for kind in KINDS[:3]])
    )
    df = df.withColumn(BASE, base)
    tested = F.filter(F.transform("__llm_random", tests), lambda t: t.isNotNull())
    return df.withColumn(TESTED, tested).drop(TEXT, *[f"__llm_{k}" for k in KINDS])


def find_secrets(
    df: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    level: float = FALSE_DISCOVERY,
) -> DataFrame:
    """The carried columns (by default all but the text) with the secrets of each text.

    ``base`` and ``found`` are spans (begin, kind number, end) in order: those of the fixed
    patterns, and these with the random tokens that overlap none of them.
    """
    scanned = materialize(scan(df, text, carry), "secrets")
    limits = thresholds(scanned, level)

    def random(token: Column) -> Column:
        rejected = F.lit(False)
        for (encoding, length), first in sorted(limits.items()):
            own = (token["encoding"] == encoding) & (token["length_class"] == length)
            rejected = rejected | (own & (token["bin"] >= first))
        return ~rejected

    def apart(token: Column) -> Column:
        meets = lambda b: (b["begin"] < token["end"]) & (token["begin"] < b["end"])
        return ~F.exists(BASE, meets)

    added = kind_spans(F.filter(TESTED, lambda t: random(t) & apart(t)), "random")
    out = with_outputs(
        scanned, {"base": F.col(BASE), "found": F.array_sort(F.concat(F.col(BASE), added))}
    )
    return out.drop(BASE, TESTED)


def number_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
