"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit of the code one binary classifier
tells the languages that have it from the others, by log-odds of hashed byte
n-grams of the folded text. A text's margins are decoded to the codeword of least
weighted logistic loss; a small lead over the second marks the text as ambiguous.

The classifiers are fitted on the texts of at most ``PER_LANGUAGE`` labelled
documents of each language, those with the smallest hashes of their ids. What
reaches the driver are the n-gram counts of each language, of fixed size. Every
document is scored by its whole text.

A text that is null or has no letter is ``und`` with score 0. Ties go to the
language that comes first in order. Without labelled documents every text is
``und``. Rows that repeat an id are scored each; columns but doc_id, text and
lang are not read, and lang only of labelled rows.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.llm.text import pieces
from skylattice.llm.workspace import Workspace

PER_LANGUAGE = 3000
BROADCAST_ROWS = 100_000
SHARES = 64
GRAMS = (3, 4, 5)
BITS = 15
AMBIGUOUS = 0.2
CALIBRATION = 0.25
LETTER = re.compile(r"[^\W\d_]")

#: Letters in lower case, everything else of ASCII a space; bytes of other characters as they are.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x61:0x7B] = FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)
MULTIPLIER = 0x9E3779B97F4A7C15


def codewords(n: int) -> np.ndarray:
    """n codewords of -1 and 1, far apart: all distinct splits for a few languages, else seeded ones."""
    if n <= 5:
        splits = [
            [1 if i == 0 or i in ones else -1 for i in range(n)]
            for size in range(max(0, n - 1)) for ones in combinations(range(1, n), size)
        ]
        return np.array(splits or [[1] * n], np.float64).T.reshape(n, -1)
    rng, best, distance = np.random.default_rng(7), None, -1
    length = max(15, 4 * int(np.ceil(np.log2(n))))
    for _ in range(500):
        code = rng.integers(0, 2, (n, length)) * 2 - 1
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        apart = min(int((code[a] != code[b]).sum()) for a, b in combinations(range(n), 2))
        if apart > distance:
            best, distance = code, apart
    return best.astype(np.float64)


def grams(data: np.ndarray, offsets: np.ndarray):
    """For each n-gram length: (bucket of every position, positions of each row's first and last).

    Each row is read with a space before and behind it.
    """
    n_rows = len(offsets) - 1
    where = np.arange(len(data)) + 2 * np.repeat(np.arange(n_rows), np.diff(offsets)) + 1
    folded = np.full(len(data) + 2 * n_rows, 0x20, np.uint8)
    folded[where] = FOLD[data]
    capital = (folded[:-1] == 0xC3) & (folded[1:] >= 0x80) & (folded[1:] <= 0x9E)
    folded[1:][capital] += 0x20
    first = offsets[:-1] + 2 * np.arange(n_rows)
    last = offsets[1:] + 2 * np.arange(1, n_rows + 1)
    wide = folded.astype(np.uint64)
    packed = wide.copy()
    for size in range(2, max(GRAMS) + 1):
        packed = packed[:-1] | wide[size - 1 :] << np.uint64(8 * (size - 1)) if len(packed) > 1 else packed[:0]
        if size in GRAMS:
            bucket = (packed * np.uint64(MULTIPLIER) >> np.uint64(64 - BITS)).astype(np.int64)
            blank = int("20" * size, 16)
            bucket[packed == np.uint64(blank)] = 1 << BITS  # white space and signs alone say nothing
            yield size, bucket, first, np.maximum(last - size + 1, first)


def _row_sums(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of values[first:last] of consecutive rows."""
    if len(values) == 0:
        return np.zeros((len(first), *values.shape[1:]))
    out = np.add.reduceat(np.concatenate((values, np.zeros_like(values[:1]))), np.stack((first, last), 1).ravel(), axis=0)[::2]
    out[first >= last] = 0
    return out


class Model:
    """Log-odds tables of all bits, and how far to trust each of them."""

    def __init__(self, languages: list[str], counts: dict[str, np.ndarray]):
        self.languages = languages
        self.code = codewords(len(languages))
        share = np.stack([(counts[name] + 0.5) / (counts[name] + 0.5).sum(axis=1, keepdims=True) for name in languages])
        tables = []
        for bit in self.code.T:
            yes, no = share[bit > 0], share[bit <= 0]
            tables.append(np.log(yes.mean(axis=0) / no.mean(axis=0)) if len(no) else np.zeros(share.shape[1:]))
        odds = np.stack(tables, axis=-1)  # (gram length, bucket, bit)
        self.odds = np.concatenate((odds, np.zeros_like(odds[:, :1])), axis=1).astype(np.float32)
        apart = [  # how far the two sides of a bit lie apart
            abs(((share[bit > 0].mean(axis=0) - share[bit <= 0].mean(axis=0)) * odds[..., i]).sum()) if (bit <= 0).any() else 1.0
            for i, bit in enumerate(self.code.T)
        ]
        self.weight = np.array(apart) / max(float(np.mean(apart)), 1e-9)

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean log-odds of every bit for each row, and its number of n-grams."""
        total, n = np.zeros((len(offsets) - 1, self.code.shape[1])), np.zeros(len(offsets) - 1)
        for i, (_, bucket, first, last) in enumerate(grams(data, offsets)):
            total += _row_sums(self.odds[i][bucket], first, last)
            n += _row_sums((bucket < 1 << BITS).astype(np.float32), first, last)
        return total / np.maximum(n, 1)[:, None], n

    def decode(self, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, its score, lead over the second) of each row."""
        sure = margin * np.minimum(n, 200)[:, None] * CALIBRATION
        loss = np.stack([(np.logaddexp(0, -sure * word) * self.weight).sum(axis=1) for word in self.code], axis=1)
        loss /= max(1.0, self.weight.sum() / 2)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        top = np.sort(share, axis=1)
        second = top[:, -2] if share.shape[1] > 1 else np.zeros(len(best))
        return best, top[:, -1], top[:, -1] - second


def _counts():
    def run(batches):
        total = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            for first, end, data, offsets in pieces(batch.column("text")):
                rows = langs[first:end]
                for size, bucket, begin, stop in grams(data, offsets):
                    for name in set(rows.tolist()):
                        mine = np.concatenate([bucket[a:b] for a, b, r in zip(begin, stop, rows, strict=True) if r == name] or [bucket[:0]])
                        at = total.setdefault((name, size), np.zeros((1 << BITS) + 1, np.int64))
                        at += np.bincount(mine, minlength=len(at))
        for (name, size), count in total.items():
            seen = np.flatnonzero(count[:-1])
            yield pa.record_batch(
                [pa.array([name] * len(seen), pa.string()), pa.array(np.full(len(seen), size)), pa.array(seen), pa.array(count[seen])],
                names=["lang", "size", "bucket", "count"],
            )

    return run


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from rows (doc_id, text, lang); None without any."""
    known = labelled.where("lang is not null and text is not null").select("doc_id", "lang")
    # Ranked in shares of each language first, so that a language of most documents is not one task's.
    chosen = known.withColumn("share", F.expr(f"pmod(xxhash64(doc_id, 5), {SHARES})"))
    for by in (["lang", "share"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id"))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= per_language)
    chosen = chosen.select("doc_id", "lang")
    chosen = Workspace(labelled.sparkSession).stage(chosen)
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    sample = labelled.select("doc_id", "text").where("text is not null").join(chosen, "doc_id")
    found = sample.select("text", "lang").mapInArrow(_counts(), "lang string, size long, bucket long, count long")
    counts: dict[str, np.ndarray] = {}
    found = found.groupBy("lang", "size", "bucket").agg(F.sum("count").alias("count")).toArrow()
    size, bucket, count = (found.column(c).to_numpy() for c in ("size", "bucket", "count"))
    lang = found.column("lang").combine_chunks().dictionary_encode()
    for i, name in enumerate(lang.dictionary.to_pylist() if len(found) else []):
        mine = lang.indices.to_numpy() == i
        counts[name] = np.zeros((len(GRAMS), 1 << BITS))
        counts[name][size[mine] - min(GRAMS), bucket[mine]] = count[mine]
    return Model(sorted(counts), counts) if counts else None


def _predict(model: Model | None):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_()),
    ])

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in pieces(batch.column("text")):
                n = end - first
                texts = batch.column("text").slice(first, n)
                letter = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
                if model is None:
                    letter = np.zeros(n, bool)
                    best, score, lead, names = np.zeros(n, int), np.zeros(n), np.zeros(n), ["und"]
                else:
                    (best, score, lead), names = model.decode(*model.margins(data, offsets)), model.languages
                names = np.array(names, object)[best]
                names[~letter] = "und"
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, n), pa.array(names, pa.string()),
                    pa.array(np.where(letter, score, 0.0)), pa.array(np.where(letter, lead < AMBIGUOUS, True)),
                ], schema=schema)

    return run


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``documents`` (doc_id, text)."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predict(model), "doc_id long, lang_pred string, score double, ambiguous boolean"
    )


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fold that takes no part in fitting."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
