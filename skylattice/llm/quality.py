"""Document quality by co-training on two views: the text, and the page's metadata.

Each view has a logistic classifier. Both start from the labelled sample; over
``ROUNDS`` rounds each scores the unlabelled sample and hands the documents it is
surest of, at most ``GIVE`` of a class and only beyond ``SURE``, to the other as
pseudo-labels. A quarter of each class of the labelled sample takes no part in
this: on it each view is calibrated and the calibrated views are combined. Every
document is then scored, by its whole text.

The classifiers are fitted on at most ``LABELLED`` labelled documents of each class
and ``UNLABELLED`` other ones, those with the smallest hashes of their ids; nothing
else comes to the driver. Where that leaves out more of one class than of the other,
log-odds are moved back to the classes' shares of all labels. The only label of a
class serves for fitting and calibration. Labels that contradict each other are left
out. Without labels of both kinds the score is 0.5.

A text that is null or has no words is rejected with score 0. Nulls in metadata
are values of their own. Sources and languages are hashed whole; each value sets
``MARKS`` of ``META // 2 - 8`` features, so that two values are told apart unless
they share all of them by chance. Rows that repeat an id are scored each. Other columns
than doc_id, text, lang, source and n_chars are passed through by ``keep_good``.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.llm.text import NOT_SPACE, U64, mix, pieces, word_bounds, word_hashes
from skylattice.llm.workspace import Workspace

LABELLED = 4000
UNLABELLED = 3000
SHARES = 64
ROUNDS = 5
GIVE = 100
SURE = 0.95
KEEP = 0.5
ROWS = 1024
SHAPES = 512
META = 128
MARKS = 3

#: Upper case, lower case, digits, line ends, white space and non-ASCII as one sign each; punctuation as it is.
SHAPE = np.arange(256, dtype=np.uint64)
SHAPE[0x41:0x5B], SHAPE[0x61:0x7B], SHAPE[0x30:0x3A], SHAPE[0x80:] = 1, 2, 3, 4
SHAPE[[0x20, 0x09]], SHAPE[[0x0A, 0x0D]] = 5, 6


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of each text (shapes of neighbouring characters, repetition, word length), and its number of words."""
    blocks, words = [], []
    for first in range(0, len(column), ROWS):
        for _, _, data, offsets in pieces(column.slice(first, ROWS)):
            x, n = _text_block(data, offsets)
            blocks.append(x)
            words.append(n)
    if not blocks:
        return np.zeros((0, SHAPES + 8), np.float32), np.zeros(0, np.int64)
    return np.concatenate(blocks), np.concatenate(words)


def _text_block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    length = np.diff(offsets)
    row = np.repeat(np.arange(n), length)
    sign = SHAPE[data]
    bucket = np.zeros(0, np.int64)
    if len(sign) > 2:
        gram = sign[:-2] | sign[1:-1] << U64(8) | sign[2:] << U64(16)
        bucket = (gram * U64(0x9E3779B97F4A7C15) >> U64(55)).astype(np.int64)
    inside = row[:-2] == row[2:] if len(row) > 2 else np.zeros(0, bool)
    shape = np.bincount(row[: len(bucket)][inside] * SHAPES + bucket[inside], minlength=n * SHAPES).reshape(n, SHAPES)
    starts, ends, whose = word_bounds(data, offsets, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    count = np.bincount(whose, minlength=n)
    order = np.lexsort((words, whose))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (whose[order][1:] != whose[order][:-1])
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (whose[1:] == whose[:-1])
    some, chars = np.maximum(count, 1), np.maximum(length, 1)
    extra = np.stack([
        np.bincount(whose[order], weights=fresh, minlength=n) / some,
        np.bincount(whose, weights=again, minlength=n) / some,
        np.bincount(whose, weights=ends - starts, minlength=n) / some / 10,
        np.log1p(count) / 10,
        np.bincount(row, weights=sign == 1, minlength=n) / chars,
        np.bincount(row, weights=sign == 3, minlength=n) / chars,
        np.bincount(row, weights=sign == 6, minlength=n) / chars,
        np.ones(n),
    ], axis=1)
    return np.hstack((np.sqrt(shape / chars[:, None]), extra)).astype(np.float32), count


def meta_view(batch: pa.RecordBatch) -> np.ndarray:
    """Features of each row's source, language and stated length."""
    n = batch.num_rows
    out = np.zeros((n, META), np.float32)
    for seed, name in enumerate(("source", "lang")):
        column = pc.fill_null(batch.column(name).cast(pa.string()), "\0").dictionary_encode()
        names = column.dictionary.cast(pa.binary()).to_pylist()
        code = np.array([int.from_bytes(blake2b(name, digest_size=8).digest(), "little") for name in names], U64)
        for again in range(MARKS):
            bucket = (mix(code, seed + 20 + 2 * again) % U64(META // 2 - 8)).astype(np.int64) + seed * (META // 2 - 8)
            out[np.arange(n), bucket[column.indices.to_numpy()]] = 1
    chars = np.maximum(np.nan_to_num(pc.fill_null(batch.column("n_chars").cast(pa.float64()), 0).to_numpy()), 0)
    out[np.arange(n), META - 16 + np.minimum(np.log2(chars + 1).astype(int) // 2, 13)] = 1
    out[:, META - 1] = 1
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 15) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method."""
    x = x.astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Two views, their calibrations and their combination."""

    def __init__(self, views: list[np.ndarray], labels: np.ndarray, prior: float = 0.0):
        """``labels``: 0, 1, or -1 for unlabelled rows. ``prior``: what the log-odds of 1 among all labels are above those of the rows."""
        self.prior = prior
        kinds = [np.flatnonzero(labels == label) for label in (0, 1)]
        check = np.sort(np.concatenate([rows[::4] for rows in kinds]))
        train = np.sort(np.concatenate([np.delete(rows, np.s_[::4]) if len(rows) > 1 else rows for rows in kinds]))
        free = np.flatnonzero(labels < 0)
        given = [{i: labels[i] for i in train.tolist()} for _ in views]
        for _ in range(ROUNDS):
            self.views = [self._fit(x, mine) for x, mine in zip(views, given, strict=True)]
            for v, other in ((0, 1), (1, 0)):
                p = sigmoid(views[v][free] @ self.views[v] + prior)
                for label, sure in ((1, p), (0, 1 - p)):
                    best = [i for i in np.argsort(-sure, kind="stable") if sure[i] >= SURE and int(free[i]) not in given[other]]
                    given[other].update((int(free[i]), label) for i in best[:GIVE])
        self.views = [self._fit(x, mine) for x, mine in zip(views, given, strict=True)]
        self.platt = [
            logistic(np.stack((x[check] @ w, np.ones(len(check))), 1), labels[check], 0.01)
            for x, w in zip(views, self.views, strict=True)
        ]
        logit = self._logits([x[check] for x in views])
        self.mix = logistic(np.hstack((logit, np.ones((len(check), 1)))), labels[check], 0.1)

    @staticmethod
    def _fit(x: np.ndarray, given: dict) -> np.ndarray:
        rows = sorted(given)
        return logistic(x[rows], np.array([given[i] for i in rows], float))

    def _logits(self, views: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.clip(x @ w * a + b, -8, 8) for x, w, (a, b) in zip(views, self.views, self.platt, strict=True)], axis=1)

    def score(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(combined score, score of each view)."""
        logit = self._logits(views)
        return sigmoid(logit @ self.mix[:-1] + self.mix[-1] + self.prior), sigmoid(logit + self.prior)


def _views(batches):
    for batch in batches:
        text, _ = text_view(batch.column("text"))
        both = np.hstack((text, meta_view(batch)))
        yield pa.record_batch([
            batch.column("quality").cast(pa.int32()),
            pa.array([r.tobytes() for r in both], pa.binary()),
        ], names=["quality", "features"])


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> Model | None:
    """A model from ``labels`` (doc_id, quality), at most ``labelled`` of a class; None without labels of both kinds."""
    work = Workspace(documents.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    ids = documents.select("doc_id").where("doc_id is not null").join(known, "doc_id", "left").where("quality is null or quality = other")
    order = [F.xxhash64("doc_id", F.lit(6)), "doc_id"]
    known = work.stage(ids.where("quality is not null").select("doc_id", "quality").distinct())
    total = dict(known.groupBy("quality").count().collect())
    # Ranked in shares of each class first, so that a class of most labels is not one task's.
    ranked = known.withColumn("share", F.expr(f"pmod(xxhash64(doc_id, 5), {SHARES})"))
    for by in (["quality", "share"], ["quality"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= labelled)
    chosen = work.stage(
        ranked.select("doc_id", "quality")
        .union(ids.where("quality is null").select("doc_id", F.lit(-1)).orderBy(*order).limit(unlabelled)).distinct()
    )
    sample = documents.select("doc_id", "text", "lang", "source", "n_chars").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    rows = sample.orderBy(*order).mapInArrow(_views, "quality int, features binary").toArrow()
    work.drop(known, chosen)
    if rows.num_rows == 0:
        return None
    quality = rows.column("quality").to_numpy()
    if not {0, 1} <= set(quality.tolist()):
        return None
    both = np.stack([np.frombuffer(r.as_buffer(), np.float32) for r in rows.column("features")])
    del rows  # the driver holds the sample once
    pa.default_memory_pool().release_unused()
    reject, keep = (np.log(total[label] / (quality == label).sum()) for label in (0, 1))
    return Model([both[:, : SHAPES + 8], both[:, SHAPES + 8 :]], quality, float(keep - reject))


def _scores(batch: pa.RecordBatch, model: Model | None):
    text, words = text_view(batch.column("text"))
    if model is None:
        score, views = np.full(batch.num_rows, 0.5), np.full((batch.num_rows, 2), 0.5)
    else:
        score, views = model.score([text, meta_view(batch)])
    return np.where(words > 0, score, 0.0), views


def _judge(model: Model | None):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("score", pa.float64()), ("text_score", pa.float64()), ("meta_score", pa.float64()), ("keep", pa.bool_()),
    ])

    def run(batches):
        for batch in batches:
            score, views = _scores(batch, model)
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, (score, views[:, 0], views[:, 1], score >= KEEP))], schema=schema)

    return run


def judge(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, text_score, meta_score, keep) of every row of ``documents``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    return rows.mapInArrow(_judge(model), "doc_id long, score double, text_score double, meta_score double, keep boolean")


def keep_good(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``documents`` that the model keeps, with all their columns."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, model)[0] >= KEEP))

    return documents.mapInArrow(run, documents.schema)
