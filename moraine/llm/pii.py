"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions.

The network is trained in numpy on windows of text whose spans the patterns label, and on variants
of them in other spellings. Long texts are cut into overlapping windows. Each window is decoded by
Viterbi. A span that a window's edge may have cut is left to a window that holds it whole; where there
is none, a wider window around it is decoded, and a wider one again until it lies inside, unless what
is seen of it can be no personal data however it goes on. Of spans that overlap the heaviest set is
kept, over the whole text. A span is added to those
of the patterns if it is apart from them and a kind's own check holds.

Every span holds a digit or an "@", so windows with neither need no decoding: nothing in them could
be added. All other windows of all texts are decoded.

Defined results: a NULL text is like an empty one and has no spans; repeated rows are searched each;
an empty table gives an empty table, and without anything to learn from only the patterns speak.
Input columns of an output's name are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.frames import bounded_batches, materialize, quoted, with_outputs, with_struct

# The kinds, in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WINDOW, STRIDE = 96, 48
BATCH = 1024  # windows decoded together
SAMPLE_ROWS = 20_000  # texts that training windows are drawn from, about
TRAIN_WINDOWS = 1600
HIDDEN, EPOCHS, STEP, SEED = 24, 8, 0.02, 5
MASK = "[{}]"

TAGS = 1 + 2 * len(KINDS)  # outside, and begin and inside of each kind
SPAN = T.StructType(
    [
        T.StructField("begin", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]
)
FOUND = T.StructType(
    [T.StructField("base", T.ArrayType(SPAN)), T.StructField("found", T.ArrayType(SPAN))]
)


# --- patterns -----------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return sum(own[::2] + [d * 2 - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_byte(digits: str) -> bool:
    """Whether digits, however many, are a number up to 255; none are 0."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def holds(kind: int, text: str) -> bool:
    """The check that a match of a kind must pass."""
    if kind == 0:
        return True
    if kind == 1:
        return all(is_byte(p) for p in text.split("."))
    digits = digits_of(text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def emails(text: str):
    """Leftmost matches, found from their "@": what is before it is a run of its own characters."""
    after, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > after and text[begin - 1] in LOCAL_CHARS:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        after = domain.end() if domain else at + 1
        if domain:
            yield begin, after
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of the patterns' matches that hold, in order."""
    out = [(b, 0, e) for b, e in emails(text)] if "@" in text else []
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        if kind == 3 and "+" not in text:
            continue
        found = pattern.finditer(text)
        out += [(m.start(), kind, m.end()) for m in found if holds(kind, m[0])]
    return sorted(out)


# --- the network --------------------------------------------------------------------------------

# Characters: padding, printable ASCII one by one, other white space, other letters, all others.
PAD, SPACE, LETTER, OTHER, CHARS = 0, 96, 97, 98, 99


@lru_cache(maxsize=1)
def char_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    table[32:127] = np.arange(1, 96)
    for code in range(0x3000):
        char = chr(code)
        if code > 126 and char.isalpha():
            table[code] = LETTER
        elif char.isspace() and char != " ":
            table[code] = SPACE
    return table


TRIGGERS = np.zeros(CHARS, dtype=bool)
TRIGGERS[[ord(c) - 31 for c in "0123456789@"]] = True


def chars_of(text: str) -> np.ndarray:
    return char_table()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]


def windows_of(chars: np.ndarray) -> np.ndarray:
    """Where the windows with a digit or an "@" start."""
    starts = np.arange(0, max(len(chars) - WINDOW + STRIDE, 1), STRIDE)
    seen = np.concatenate(([0], np.cumsum(TRIGGERS[chars])))
    ends = np.minimum(starts + WINDOW, len(chars))
    return starts[seen[ends] > seen[starts]]


def cut(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate((chars, np.zeros(WINDOW, np.uint8)))
    return padded[starts[:, None] + np.arange(WINDOW)[None, :]]


def new_network(random: np.random.Generator) -> dict[str, np.ndarray]:
    h = HIDDEN
    network = {}
    for side in ("f", "b"):
        network[f"x{side}"] = random.normal(0, 0.3, (CHARS, 4 * h))
        network[f"h{side}"] = random.normal(0, 0.3 / np.sqrt(h), (h, 4 * h))
        network[f"o{side}"] = random.normal(0, 0.3, (h, TAGS))
        network[f"x{side}"][:, h : 2 * h] += 1.0  # forget little at first
    network["tag"] = np.zeros(TAGS)
    network["next"] = np.zeros((TAGS, TAGS))
    return {k: v.astype(np.float32) for k, v in network.items()}


def allowed() -> np.ndarray:
    """0 for transitions that are possible, a large negative number for others."""
    out = np.zeros((TAGS, TAGS), dtype=np.float32)
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        out[:, inside] = -1e4
        out[[inside - 1, inside], inside] = 0
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def run_lstm(inputs: np.ndarray, weights: np.ndarray, recurrent: np.ndarray, keep: bool):
    """Hidden states along the second axis; with ``keep`` also what the way back needs."""
    batch, steps = inputs.shape
    h = recurrent.shape[0]
    state, cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
    out, kept = np.empty((batch, steps, h), np.float32), []
    for t in range(steps):
        gates = weights[inputs[:, t]] + state @ recurrent
        squashed = sigmoid(gates[:, : 3 * h])
        new = np.tanh(gates[:, 3 * h :])
        enter, forget, leave = squashed[:, :h], squashed[:, h : 2 * h], squashed[:, 2 * h :]
        before, old = cell, state
        cell = forget * before + enter * new
        bent = np.tanh(cell)
        state = leave * bent
        out[:, t] = state
        if keep:
            kept.append((old, before, enter, forget, leave, new, bent))
    return out, kept


def back_lstm(inputs, recurrent, kept, grad_out, grad_x, grad_h) -> None:
    """Adds the gradients of the input and recurrent weights."""
    batch, steps = inputs.shape
    h = recurrent.shape[0]
    d_state, d_cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
    for t in reversed(range(steps)):
        old, before, enter, forget, leave, new, bent = kept[t]
        d_state = d_state + grad_out[:, t]
        d_cell = d_cell + d_state * leave * (1 - bent * bent)
        d_gates = np.concatenate(
            (
                d_cell * new * enter * (1 - enter),
                d_cell * before * forget * (1 - forget),
                d_state * bent * leave * (1 - leave),
                d_cell * enter * (1 - new * new),
            ),
            axis=1,
        )
        np.add.at(grad_x, inputs[:, t], d_gates)
        grad_h += old.T @ d_gates
        d_state = d_gates @ recurrent.T
        d_cell = d_cell * forget


def emissions(network: dict, windows: np.ndarray, keep: bool = False):
    forward, kept_f = run_lstm(windows, network["xf"], network["hf"], keep)
    backward, kept_b = run_lstm(windows[:, ::-1], network["xb"], network["hb"], keep)
    backward = backward[:, ::-1]
    scores = forward @ network["of"] + backward @ network["ob"] + network["tag"]
    scores[windows == PAD, 1:] -= 1e4
    return scores, (forward, backward, kept_f, kept_b)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def crf_gradients(scores: np.ndarray, tags: np.ndarray, nexts: np.ndarray):
    """Gradients of the negative log-likelihood by scores and by transitions."""
    batch, steps, _ = scores.shape
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    first = allowed()[0]  # nothing starts inside a span
    ahead[:, 0] = scores[:, 0] + first
    for t in range(1, steps):
        ahead[:, t] = log_sum(ahead[:, t - 1][:, :, None] + nexts[None], 1) + scores[:, t]
    for t in reversed(range(steps - 1)):
        behind[:, t] = log_sum(nexts[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = log_sum(ahead[:, -1], 1)
    d_scores = np.exp(ahead + behind - total[:, None, None])
    d_nexts = np.zeros_like(nexts)
    for t in range(1, steps):
        pair = ahead[:, t - 1][:, :, None] + nexts[None] + (scores[:, t] + behind[:, t])[:, None, :]
        d_nexts += np.exp(pair - total[:, None, None]).sum(axis=0)
    rows = np.arange(batch)
    for t in range(steps):
        d_scores[rows, t, tags[:, t]] -= 1
        if t:
            np.add.at(d_nexts, (tags[:, t - 1], tags[:, t]), -1)
    return d_scores / batch, d_nexts / batch


def train(windows: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    """Adam on the CRF's likelihood, in small batches."""
    random = np.random.default_rng(SEED)
    network, banned = new_network(random), allowed()
    first = {k: np.zeros_like(v) for k, v in network.items()}
    second = {k: np.zeros_like(v) for k, v in network.items()}
    step, total = 0, EPOCHS * -(-len(windows) // 64)
    for _ in range(EPOCHS):
        order = random.permutation(len(windows))
        for start in range(0, len(order), 64):
            rows = order[start : start + 64]
            grads = gradients(network, windows[rows], tags[rows], banned)
            step += 1
            rate = STEP * (1 - step / (total + 1))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6
                network[k] -= (rate / (1 - 0.9**step) * first[k] / size).astype(np.float32)
    return network


def gradients(network: dict, windows: np.ndarray, tags: np.ndarray, banned: np.ndarray) -> dict:
    scores, (forward, backward, kept_f, kept_b) = emissions(network, windows, keep=True)
    d_scores, d_next = crf_gradients(scores, tags, network["next"] + banned)
    d_scores = d_scores.astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in network.items()}
    grads["next"], grads["tag"] = np.where(banned == 0, d_next, 0), d_scores.sum(axis=(0, 1))
    for side, states, kept, inputs in (
        ("f", forward, kept_f, windows),
        ("b", backward, kept_b, windows[:, ::-1]),
    ):
        grads[f"o{side}"] = np.einsum("bth,btk->hk", states, d_scores)
        d_states = d_scores @ network[f"o{side}"].T
        d_states = d_states if side == "f" else d_states[:, ::-1]
        back_lstm(
            inputs, network[f"h{side}"], kept, d_states, grads[f"x{side}"], grads[f"h{side}"]
        )
    return grads


def viterbi(scores: np.ndarray, nexts: np.ndarray) -> np.ndarray:
    """The best tags of each window."""
    batch, steps, _ = scores.shape
    best = scores[:, 0] + allowed()[0]
    came = np.empty(scores.shape, dtype=np.int8)
    for t in range(1, steps):
        ways = best[:, :, None] + nexts[None]
        came[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + scores[:, t]
    tags = np.empty((batch, steps), dtype=np.int8)
    tags[:, -1] = best.argmax(axis=1)
    rows = np.arange(batch)
    for t in reversed(range(1, steps)):
        tags[:, t - 1] = came[rows, t, tags[:, t]]
    return tags


# --- spans of the network -----------------------------------------------------------------------


def decode(network: dict, windows: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    """(begin, kind, end, weight) of each window's spans, within the window."""
    scores, _ = emissions(network, windows)
    tags = viterbi(scores, network["next"] + allowed())
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in windows]
    begins = (tags > 0) & (tags % 2 == 1)
    for row, begin in zip(*np.nonzero(begins), strict=True):
        inside, end = tags[row, begin] + 1, begin + 1
        while end < tags.shape[1] and tags[row, end] == inside:
            end += 1
        at = np.arange(begin, end)
        gain = scores[row, at, tags[row, at]] - scores[row, at, 0]
        kind = (int(tags[row, begin]) - 1) // 2
        out[row].append((int(begin), kind, int(end), float(gain.sum())))
    return out


def heaviest(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Spans that do not overlap, of the largest weight in all."""
    spans = sorted({s for s in spans if s[3] > 0}, key=lambda s: (s[2], s[0], s[1], s[3]))
    ends, best, chosen = [s[2] for s in spans], [0.0], []
    for i, (begin, _, _, weight) in enumerate(spans):
        before = int(np.searchsorted(ends[:i], begin, "right")) if i else 0
        chosen.append((best[before] + weight > best[i], before))
        best.append(max(best[i], best[before] + weight))
    out, i = [], len(spans)
    while i:
        taken, before = chosen[i - 1]
        if taken:
            out.append(spans[i - 1][:3])
        i = before if taken else i - 1
    return out[::-1]


def trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    while begin < end and text[begin] in " \t\r\n.,;:-":
        begin += 1
    while end > begin and text[end - 1] in " \t\r\n.,;:-":
        end -= 1
    return begin, end


def plausible(kind: int, text: str) -> bool:
    """What a span of the network must be, whatever its spelling."""
    if kind == 0:
        return "@" in text[1:-1] and "." in text.partition("@")[2] and not re.search(r"\s", text)
    if kind == 1:
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", text) is not None and holds(1, text)
    spelled = re.fullmatch(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+", text) is not None
    return spelled and holds(kind, text)


MOST_DIGITS = 19  # of a card


def hopeless(kind: int, text: str) -> bool:
    """Whether no longer text that begins, ends or goes on like this can be plausible."""
    text = text.strip(" \t\r\n.,;:-")
    if kind == 0:
        return re.search(r"\s", text) is not None
    if kind == 1:
        if not re.fullmatch(r"[0-9.]*", text):  # the network may mark anything
            return True
        parts = text.split(".")
        return len(parts) > 4 or not all(is_byte(p) for p in parts[1:-1])
    return not re.fullmatch(r"[+0-9\x20().-]*", text) or len(digits_of(text)) > MOST_DIGITS


def widened(network: dict, text: str, chars: np.ndarray, begin: int, end: int, kind: int) -> list[tuple]:
    """The spans of the network around one that a window's edge cut, from a window that holds them."""
    reach = WINDOW
    while not hopeless(kind, text[begin:end]):
        low, high = max(begin - reach, 0), min(end + reach, len(chars))
        found = [(low + b, k, low + e, w) for b, k, e, w in decode(network, chars[None, low:high])[0]]
        near = [s for s in found if s[0] < end and s[2] > begin]
        cut_off = [s for s in near if s[0] == low > 0 or s[2] == high < len(chars)]
        if not cut_off:
            return near
        begin, end = min(s[0] for s in cut_off), max(s[2] for s in cut_off)
        kind, reach = cut_off[0][1], 2 * reach
    return []


def search_texts(texts: list[str], network: dict | None) -> list[tuple[list, list]]:
    """For each text the patterns' spans, and these with the network's."""
    bases = [base_spans(t) for t in texts]
    if network is None:
        return [(b, b) for b in bases]
    spans: list[list] = [[] for _ in texts]
    cut_off: dict[int, list] = {}
    waiting: list[tuple[int, int, np.ndarray]] = []
    held = 0

    def empty() -> None:
        windows = np.concatenate([w for _, _, w in waiting])
        owners = [(i, s) for i, starts, _ in waiting for s in starts.tolist()]
        for low in range(0, len(windows), BATCH):
            for (i, start), found in zip(
                owners[low : low + BATCH], decode(network, windows[low : low + BATCH]), strict=True
            ):
                size = len(texts[i])
                for begin, kind, end, weight in found:
                    whole = (begin > 0 or start == 0) and (end < WINDOW or start + WINDOW >= size)
                    span = (start + begin, kind, min(start + end, size), weight)
                    (spans[i] if whole else cut_off.setdefault(i, [])).append(span)

    for i, text in enumerate(texts):
        chars = chars_of(text)
        starts = windows_of(chars)
        for low in range(0, len(starts), 4 * BATCH):
            own = starts[low : low + 4 * BATCH]
            waiting.append((i, own, cut(chars, own)))
            held += len(own)
            if held >= BATCH:
                empty()
                waiting, held = [], 0
    if held:
        empty()
    for i, parts in cut_off.items():
        chars, known = chars_of(texts[i]), [(b, e) for b, _, e, _ in spans[i]]
        for begin, kind, end, _ in sorted(parts):
            if not any(b <= begin and end <= e for b, e in known):
                own = widened(network, texts[i], chars, begin, end, kind)
                spans[i] += own
                known += [(b, e) for b, _, e, _ in own]
    return [(b, sorted([*b, *added(t, s, b)])) for t, s, b in zip(texts, spans, bases, strict=True)]


def added(text: str, spans: list, base: list) -> list[tuple[int, int, int]]:
    """The network's spans that are plausible and apart from the patterns'."""
    out = []
    begins = [b for b, _, _ in base]
    reach = np.maximum.accumulate([e for _, _, e in base]) if base else []
    for begin, kind, end in heaviest(spans):
        begin, end = trimmed(text, begin, end)
        before = int(np.searchsorted(begins, end)) if base else 0
        apart = not before or reach[before - 1] <= begin
        if apart and plausible(kind, text[begin:end]):
            out.append((begin, kind, end))
    return out


# --- training data ------------------------------------------------------------------------------


def respelled(random: np.random.Generator, kind: int, text: str) -> str:
    """The same data in another spelling."""
    if kind == 2 and random.random() < 0.5:
        digits, mark = digits_of(text), str(random.choice(["-", " ", "."]))
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        if random.random() < 0.4:
            text = text.lstrip("+")
        if random.random() < 0.4:
            mark = str(random.choice([".", "-", " "]))
            return re.sub(r"[\x20().-]+", mark, text).strip(mark)
    return text


def labelled_windows(text: str, random: np.random.Generator) -> list[tuple[bytes, bytes]]:
    """Windows around the spans of a text, plain and respelled, and some with none."""
    out, spans = [], base_spans(text)
    for vary in (False, True) if spans else (False,):
        pieces, tags, after = [], [], 0
        for begin, kind, end in spans:
            if begin < after:
                continue
            own = respelled(random, kind, text[begin:end]) if vary else text[begin:end]
            pieces += [text[after:begin], own]
            tags += [[0] * (begin - after), [2 * kind + 1] + [2 * kind + 2] * (len(own) - 1)]
            after = end
        pieces.append(text[after:])
        tags.append([0] * (len(text) - after))
        chars = chars_of("".join(pieces))
        marks = np.array([t for part in tags for t in part], dtype=np.uint8)
        starts = windows_of(chars)
        if not len(starts):
            continue
        starts = starts[random.permutation(len(starts))[:8]]
        shift = random.integers(0, STRIDE, len(starts))
        starts = np.clip(starts + shift - STRIDE // 2, 0, max(len(chars) - WINDOW, 0))
        for window, own in zip(cut(chars, starts), cut(marks, starts), strict=True):
            own = own.copy()
            # A span that the window's left edge cuts has no beginning here.
            head = 0
            while head < WINDOW and own[head] and own[head] % 2 == 0:
                own[head], head = 0, head + 1
            out.append((window.tobytes(), own.tobytes()))
    return out


def learn_network(df: DataFrame, text: str = "text") -> dict[str, np.ndarray] | None:
    """A network trained on windows of a bounded sample of different texts with a digit or an "@".

    Texts are read once; the sample's windows are written to the shared folder.
    """
    value = quoted(text).cast("string")
    texts = df.select(value.alias("text")).where(value.rlike("[0-9@]"))
    rows = df.select(F.count(F.lit(1)).alias("n")).first()["n"]
    share = max(1, rows // SAMPLE_ROWS)
    hashed = texts.withColumn("h", F.xxhash64("text"))
    # A text counts once however often it is there; its copies share a hash.
    hashed = hashed.where(F.pmod("h", F.lit(share)) == 0).dropDuplicates(["h"])

    def windows(batches):
        for batch in batches:
            made = []
            for own, h in zip(batch["text"], batch["h"], strict=True):
                random = np.random.default_rng(abs(int(h)))
                made += [(hash_of(h, i), *w) for i, w in enumerate(labelled_windows(own, random))]
            yield pd.DataFrame(made, columns=["h", "window", "tags"])

    held = hashed.mapInPandas(windows, "h long, window binary, tags binary")
    held = materialize(held.dropDuplicates(["window", "tags"]), "windows")
    # Most windows of ordinary text have no span; keep as many with one as without.
    any_span = F.hex("tags").rlike("[1-9A-F]")
    sample = []
    for wanted in (any_span, ~any_span):
        part = held.where(wanted).orderBy("h", "window").limit(TRAIN_WINDOWS // 2)
        sample += part.collect()
    if not any(any(row["tags"]) for row in sample):
        return None
    chars = np.array([np.frombuffer(row["window"], np.uint8) for row in sample])
    tags = np.array([np.frombuffer(row["tags"], np.uint8) for row in sample])
    return train(chars, tags)


def hash_of(h: int, number: int) -> int:
    return int(np.int64(np.uint64((int(h) * 0x9E3779B97F4A7C15 + number * 0xBF58476D1CE4E5B9) % 2**64)))


# --- operators ----------------------------------------------------------------------------------


def find_personal_data(
    df: DataFrame, text: str = "text", learn_from: DataFrame | None = None
) -> DataFrame:
    """``df`` with ``base`` and ``found``: spans (begin, kind number, end) in order.

    ``base`` are the patterns' spans, ``found`` these with the network's, which is trained on a
    bounded sample of ``learn_from`` (by default ``df``). Positions are code points.
    """
    bounded_batches(df.sparkSession)
    network = learn_network(df if learn_from is None else learn_from, text)
    sent = df.sparkSession.sparkContext.broadcast(network)  # of fixed size

    @F.pandas_udf(FOUND)
    def search(texts: pd.Series) -> pd.DataFrame:
        found = search_texts([t or "" for t in texts], sent.value)
        names = ("begin", "kind", "end")
        spell = lambda spans: [dict(zip(names, s, strict=True)) for s in spans]
        return pd.DataFrame([(spell(b), spell(a)) for b, a in found], columns=FOUND.names)

    return with_struct(df, search(quoted(text).cast("string")), FOUND.names)


def spelled(spans: Column) -> Column:
    """Spans as kind:begin:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", names[s["kind"]], s["begin"], s["end"])
    return F.concat_ws(",", F.transform(spans, one))


def number_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind's name."""
    out, after = [], 0
    for begin, kind, end in spans:
        if begin >= after:
            out += [text[after:begin], MASK.format(KINDS[kind].upper())]
        after = max(after, end)
    return "".join([*out, text[after:]])


def mask_personal_data(
    df: DataFrame, text: str = "text", learn_from: DataFrame | None = None
) -> DataFrame:
    """``df`` with the personal data in its texts masked, and ``masked``: whether a text had any.

    The spans are those of ``find_personal_data``; texts without any stay as they are.
    """
    bounded_batches(df.sparkSession)
    network = learn_network(df if learn_from is None else learn_from, text)
    sent = df.sparkSession.sparkContext.broadcast(network)  # of fixed size

    @F.pandas_udf(T.StringType())
    def changed(texts: pd.Series) -> pd.Series:
        own = [t or "" for t in texts]
        found = search_texts(own, sent.value)
        return pd.Series(
            [masked(t, spans) if spans else None for t, (_, spans) in zip(own, found, strict=True)],
            dtype=object,
        )

    held = df.withColumn("__llm_masked", changed(quoted(text).cast("string")))
    held = held.withColumn(text, F.coalesce("__llm_masked", quoted(text)))
    return with_outputs(held, {"masked": F.col("__llm_masked").isNotNull()}).drop("__llm_masked")
