"""Personal data found by patterns and by a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The random field reads the
regions of a text in which something may be personal: runs of neighbouring words
that hold a digit or an at sign. Whole candidate segments of up to ``MAX_WORDS``
words are scored by features of the segment as one (shape, digits, separators),
each only for the kinds whose own check it passes, and dynamic programming over segments of bounded length chooses
boundaries and kinds together. A segment that it takes for personal by ``MARGIN``
more than for other text, and that no base span overlaps, is added.

The field is trained by gradients of the conditional likelihood on at most
``REGIONS`` regions, those with the smallest hashes of all documents' regions;
base spans are their labels. Every document is searched by its whole text, in
time proportional to its length.

A null text counts as empty and has no spans. Offsets count code points, ends are
exclusive. Rows that repeat an id are searched each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, and the patterns of the base spans; fixed values.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

TRIGGER = re.compile(r"[0-9@]+")
BREAK = re.compile(r"[ \t-\r]")
NOT_DIGIT = re.compile(r"[^0-9]+")
MAX_WORDS = 5
MARGIN = 2.0
REGIONS = 1200
EPOCHS = 6
ROWS = 512

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by kind, then start. Each pattern is read once from left to right."""
    out: list[Span] = []
    done = 0  # what stands before it belongs to the last match, or lies before the last at sign
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        done = at + 1
        if domain:
            out.append(("email", at - local, domain.end()))
            done = domain.end()
        at = text.find("@", done)
    for m in DOTTED.finditer(text):
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            if all(map(_octet, parts[i : i + 4])):
                out.append(("ip", start, start + size))
            start += size + 1
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words with a trigger, one blank apart; each word without the punctuation around it."""
    out: list[list[tuple[int, int]]] = []
    end = -2
    for m in TRIGGER.finditer(text):
        if m.start() < end:
            continue
        low = max(end, 0)
        start = max((text.rfind(c, low, m.start()) for c in " \t\n\x0b\x0c\r"), default=-1)
        start = low if start < 0 else start + 1
        stop = BREAK.search(text, m.end())
        stop = stop.start() if stop else len(text)
        word = _core(text, start, stop)
        if out and start == end + 1 and text[end] == " ":
            out[-1].append(word)
        else:
            out.append([word])
        end = stop
    return out


def _core(text: str, start: int, stop: int) -> tuple[int, int]:
    a, b = start, stop
    while a < b and text[a] in "\"'<[{(" and not (text[a] == "(" and ")" in text[a:b]):
        a += 1
    while a < b and text[b - 1] in "\"'>]},.;:!?)" and not (text[b - 1] == ")" and "(" in text[a:b]):
        b -= 1
    return (a, b) if a < b else (start, stop)


def may_be(span: str) -> tuple[bool, ...]:
    """For each kind whether a segment passes the kind's own check; only then is it a candidate of it."""
    digits = NOT_DIGIT.sub("", span)
    parts = span.split(".")
    return (
        "@" in span and 0 < span.find("@") == len(span) - len(span.lstrip(LOCAL)) and DOMAIN.fullmatch(span, span.find("@") + 1) is not None,
        len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts),
        13 <= len(digits) <= 19 and not span.strip("0123456789 -") and luhn(digits),
        9 <= len(digits) <= 15 and not span.strip("+0123456789 ().-"),
    )


def features(span: str, words: int) -> list[str]:
    """What a whole candidate segment looks like."""
    digits = NOT_DIGIT.sub("", span)
    n, shape = len(digits), []
    for c in span[:200]:  # the shape alone; the rest of a longer segment shows in its length
        kind = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not shape or shape[-1] != kind or kind not in "9a":
            shape.append(kind)
    form = "".join(shape)
    letters = sum(map(str.isalpha, span[:200]))
    parts = span.split(".")
    out = [
        "bias", f"shape {form[:24]}", f"digits {min(n, 20)}", f"words {words}", f"length {min(len(span), 64) // 4}",
        f"letters {min(letters * 8 // min(len(span), 200), 7)}", f"first {form[0]}", f"last {form[-1]}", f"plus {'+' in span}",
        f"at {span.count('@')}", f"dots {min(len(parts) - 1, 5)}", f"dashes {min(span.count('-'), 5)}",
    ]
    if 13 <= n <= 19:
        out.append(f"luhn {luhn(digits)} {letters > 0}")
    if "=" in span or "_" in span:
        out.append("assignment")
    return out


LABELS = ("other", *KINDS)


class Field:
    """Weights of (feature, label) and of neighbouring labels."""

    def __init__(self):
        self.weights: dict[str, list[float]] = {}
        self.steps = [[0.0] * len(LABELS) for _ in LABELS]

    def score(self, found: list[str]) -> list[float]:
        out = [0.0] * len(LABELS)
        for f in found:
            row = self.weights.get(f)
            if row is not None:
                for k, w in enumerate(row):
                    out[k] += w
        return out

    def segments(self, text: str, words: list[tuple[int, int]]):
        """(first, end, features, scores) of all candidates, by their end; only one word can be other text."""
        out = [[] for _ in range(len(words) + 1)]
        for j in range(1, len(words) + 1):
            for i in range(max(0, j - MAX_WORDS), j):
                span = text[words[i][0] : words[j - 1][1]]
                fits = (j - i == 1, *may_be(span))
                if any(fits):
                    found = features(span, j - i)
                    score = [s if fit else -math.inf for s, fit in zip(self.score(found), fits, strict=True)]
                    out[j].append((i, found, score))
        return out

    def decode(self, text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int, float]]:
        """(first, end, label, lead over other text) of the best segmentation."""
        ends = self.segments(text, words)
        best = [[0.0] * len(LABELS)] + [[-math.inf] * len(LABELS) for _ in words]
        back: list[list] = [[None] * len(LABELS) for _ in range(len(words) + 1)]
        single = [0.0]
        for j in range(1, len(words) + 1):
            single.append(single[-1] + next(s[0] for i, _, s in ends[j] if i == j - 1))
            for i, _, score in ends[j]:
                for k in range(len(LABELS)):
                    if score[k] == -math.inf:
                        continue
                    if i == 0:
                        value, prev = score[k] + self.steps[0][k], 0
                    else:
                        prev = max(range(len(LABELS)), key=lambda p: best[i][p] + self.steps[p][k])
                        value = best[i][prev] + self.steps[prev][k] + score[k]
                    if value > best[j][k]:
                        best[j][k], back[j][k] = value, (i, prev, score[k])
        out, j = [], len(words)
        k = max(range(len(LABELS)), key=lambda p: best[j][p])
        while j > 0:
            i, prev, score = back[j][k]
            out.append((i, j, k, score - (single[j] - single[i])))
            j, k = i, prev
        return out[::-1]

    def train(self, samples: list[tuple[str, list[tuple[int, int]], dict[tuple[int, int], int]]], epochs: int = EPOCHS) -> None:
        """Ascend the likelihood of the labelled segmentations, one sample at a time."""
        rng = random.Random(3)
        size: dict[tuple[str, int], float] = {}
        for _ in range(epochs):
            rng.shuffle(samples)
            for text, words, gold in samples:
                slopes = self._slopes(text, words, gold)
                for (name, k), g in slopes.items():
                    seen = size[name, k] = size.get((name, k), 1e-2) + g * g
                    step = 0.5 * g / math.sqrt(seen)
                    if name.startswith("\0"):
                        self.steps[int(name[1:])][k] += step
                    else:
                        self.weights.setdefault(name, [0.0] * len(LABELS))[k] += step

    def _slopes(self, text: str, words: list[tuple[int, int]], gold: dict[tuple[int, int], int]) -> dict[tuple[str, int], float]:
        """Features of the labelled segmentation minus their expectation, by the forward and backward sums."""
        n, labels, ends = len(words), range(len(LABELS)), self.segments(text, words)
        ahead = [[0.0] + [-math.inf] * (len(LABELS) - 1)] + [[-math.inf] * len(LABELS) for _ in words]
        for j in range(1, n + 1):
            for k in labels:
                ahead[j][k] = _log_sum([ahead[i][p] + self.steps[p][k] + s[k] for i, _, s in ends[j] for p in labels])
        behind = [[-math.inf] * len(LABELS) for _ in range(n)] + [[0.0] * len(LABELS)]
        for j in range(n - 1, -1, -1):
            for p in labels:
                behind[j][p] = _log_sum([self.steps[p][k] + s[k] + behind[e][k] for e in range(j + 1, min(n, j + MAX_WORDS) + 1) for i, _, s in ends[e] if i == j for k in labels])
        total = _log_sum(ahead[n])
        slopes: dict[tuple[str, int], float] = {}

        def add(name: str, k: int, value: float) -> None:
            slopes[name, k] = slopes.get((name, k), 0.0) + value

        for j in range(1, n + 1):
            for i, found, s in ends[j]:
                for k in labels:
                    chance = 0.0
                    for p in labels:
                        one = ahead[i][p] + self.steps[p][k] + s[k] + behind[j][k] - total
                        if one > -30:
                            one = math.exp(one)
                            chance += one
                            add(f"\0{p}", k, -one)
                    if chance > 1e-9:
                        for f in found:
                            add(f, k, -chance)
        previous, j = 0, 0
        while j < n:
            end, k = next(((e, gold[j, e]) for e in range(n, j, -1) if (j, e) in gold), (j + 1, 0))
            for f in next(found for i, found, _ in ends[end] if i == j):
                add(f, k, 1.0)
            add(f"\0{previous}", k, 1.0)
            previous, j = k, end
        return slopes


def _log_sum(values: list[float]) -> float:
    top = max(values, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def all_spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that the field adds) of one text."""
    if not TRIGGER.search(text):
        return [], []
    base, added = base_spans(text), []
    if field is not None:
        taken = sorted((a, b) for _, a, b in base)
        for words in regions(text):
            while taken and taken[0][1] <= words[0][0]:
                taken.pop(0)
            for i, j, k, lead in field.decode(text, words):
                a, b = words[i][0], words[j - 1][1]
                if k and lead >= MARGIN and not any(x < b and a < y for x, y in _near(taken, b)):
                    added.append((LABELS[k], a, b))
    return base, added


def _near(taken: list[tuple[int, int]], end: int):
    for span in taken:
        if span[0] >= end:
            return
        yield span


def _sample(batches):
    for batch in batches:
        found = []
        for text in batch.column("text").to_pylist():
            if not text or not TRIGGER.search(text):
                continue
            base = base_spans(text)
            starts = {a: (kind, b) for kind, a, b in base}
            covered = sorted((a, b) for _, a, b in base)
            for words in regions(text):
                if len(words) > 12:
                    continue
                low, high = words[0][0], words[-1][1]
                marks = [(a - low, starts[a][1] - low, starts[a][0]) for a, b in covered if a < high and b > low]
                cut = text[low:high]
                key = hashlib.sha256(cut.encode()).hexdigest()
                found.append((key, cut, [a - low for a, _ in words], [b - low for _, b in words], [f"{k}:{a}:{b}" for a, b, k in marks]))
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [[]] * 5, SAMPLE.types, strict=True)], schema=SAMPLE
        )


SAMPLE = pa.schema([
    ("key", pa.string()), ("cut", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("marks", pa.list_(pa.string())),
])


def fit(documents: DataFrame, limit: int = REGIONS, epochs: int = EPOCHS) -> Field | None:
    """A field trained on regions of ``documents`` (text); None if they hold no base span."""
    found = documents.select("text").mapInArrow(_sample, "key string, cut string, starts array<long>, ends array<long>, marks array<string>")
    rows = found.dropDuplicates(["key"]).orderBy("key").limit(limit).collect()
    samples = []
    for row in rows:
        words = list(zip(row.starts, row.ends, strict=True))
        at, to = {a: i for i, (a, _) in enumerate(words)}, {b: i + 1 for i, (_, b) in enumerate(words)}
        gold = {}
        for mark in row.marks:
            kind, a, b = mark.split(":")
            gold[at.get(int(a), -1), to.get(int(b), -1)] = LABELS.index(kind)
        if all(i >= 0 and 0 < j - i <= MAX_WORDS for i, j in gold):
            samples.append((row.cut, words, gold))
    if not any(gold for _, _, gold in samples):
        return None
    field = Field()
    field.train(samples, epochs)
    return field


def written(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in order)


def _find(field: Field | None):
    schema = pa.schema([
        ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string()), ("spans", pa.string()), ("n_added", pa.int64()),
    ])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                out = []
                for text in part.column("text").to_pylist():
                    base, added = all_spans(text or "", field)
                    out.append((*(sum(s[0] == k for s in base) for k in KINDS), written(base), written(base + added), len(added)))
                yield pa.record_batch([part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True))], schema=schema)

    return run


def find(documents: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_added) of every row of ``documents`` (doc_id, text).

    The counts are those of the base spans; ``base`` and ``spans`` list kind:start:end.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_find(field), f"doc_id long, {counts}, base string, spans string, n_added long")


def redact(documents: DataFrame, field: Field | None) -> DataFrame:
    """``documents`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""

    def run(batches):
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                base, added = all_spans(text or "", field)
                at, cuts = 0, []
                for kind, a, b in sorted(base + added, key=lambda s: s[1:]):
                    if a >= at:
                        cuts += [text[at:a], f"[{kind}]"]
                    at = max(at, b)
                texts.append(text if text is None else "".join(cuts) + text[at:])
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, batch.schema.field("text").type))

    return documents.mapInArrow(run, documents.schema)
