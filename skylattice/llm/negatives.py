"""Hard negatives of anchors by slots of scores.

A row's score for an anchor is the inner product of their whole-number vectors.
An anchor's positives are its best rows of the same label. Each positive opens a
window of scores, from ``low`` to ``high`` percent of its own, and takes the best
rows of other labels in it. The windows of an anchor overlap, so they are not
searched one by one: the upper limits of all its positives split the scores into
disjoint slots, from one limit down to the next. A row falls into one slot at
most. Tasks keep the best ``k`` of every slot of what they have scored, again
before and after the shuffle, and merging the slots from the lowest limit up
gives, at each limit, the best k of all slots up to it: the window's answer, as
far as it lies above the lower limit.

All rows are scored against all anchors, in blocks of vectors that meet blocks of
anchors by a join on ``part``, over which both are dealt; rows of the same label
only where the label ranges of two blocks meet. A label that holds a third of all
rows is many blocks. What a task holds is one block of each. Anchors are dealt to
every part, so there are no more parts than keep the cores busy or hold ``HELD``
blocks each; copies never travel by broadcast, as the optimizer sees one of each.
Rows that leave a block pair are bounded by anchors, slots and k.

Rows without an id, a label or a vector, with an empty vector, or with null or
non-finite components take no part. Only vectors of the same length are compared.
Rows that repeat an id are candidates each; an anchor's own id never is one, and
of several rows of one anchor id the least in (label, vector) asks. Ties go to the smaller
id. A positive with a score below zero has an empty window, one with a score of
zero takes scores of zero. Scores are exact whatever their size, and travel as
binary marks that sort as they do; only shown ones are held at 38 digits. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from skylattice.llm.vectors import best_first, dealt, finite, held, matrix, number, ordered, products, runs, whole
from skylattice.llm.workspace import Workspace

SCALE = 256
ROWS, ANCHORS = 2048, 1024
HELD, WAVES = 16, 4
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95

VECTORS = "dim int, least long, most long, ids binary, labels binary, vectors binary"
ASKING = "dim int, least long, most long, anchors binary, anchor_labels binary, asked binary, limits array<array<binary>>, lowest array<binary>"
FOUND = "anchor_id long, slot int, vec_id long, score binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score decimal(38,0), negative_score decimal(38,0)"


def _raw(column: pa.Array, kind) -> pa.Array:
    return pa.array([column.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary())


def _blocks(size: int, names: list[str], limits: bool, kind: str):
    """Rows sorted by length and label as blocks; the vectors stay the floats or doubles that they are."""
    def run(batches):
        for rows in runs(batches, size, "dim"):
            label = rows.column("label").to_numpy()
            found = [
                pa.array([rows.column("dim")[0].as_py()], pa.int32()), pa.array([label.min()]), pa.array([label.max()]),
                _raw(rows.column("vec_id"), np.int64), _raw(rows.column("label"), np.int64),
                pa.array([matrix(rows.column("v")).astype(kind).tobytes()], pa.binary()),
            ]
            if limits:
                found += [pa.array([rows.column(c).to_pylist()], t) for c, t in (
                    ("limits", pa.list_(pa.list_(pa.binary()))), ("lowest", pa.list_(pa.binary())),
                )]
            yield pa.record_batch(found, names=names)

    return run


def _vectors(raw: bytes, n: int, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(n, -1).astype(np.float64)


def _scored(row: dict, kind: str) -> tuple[np.ndarray, ...]:
    """Anchor ids, ids in their order, scores, and which pairs have one label and which another."""
    anchors, ids = np.frombuffer(row["anchors"], np.int64), np.frombuffer(row["ids"], np.int64)
    order = np.argsort(ids, kind="stable")
    asked, vectors = _vectors(row["asked"], len(anchors), kind), _vectors(row["vectors"], len(ids), kind)
    scores = products(whole(asked, SCALE), whole(vectors[order], SCALE))
    ids = ids[order]
    same = np.frombuffer(row["anchor_labels"], np.int64)[:, None] == np.frombuffer(row["labels"], np.int64)[order]
    return anchors, ids, scores, same & (anchors[:, None] != ids), ~same & (anchors[:, None] != ids)


def _pairs(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _found(anchors: np.ndarray, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(anchors), pa.array(slot, pa.int32()), pa.array(ids), ordered(scores)], names=["anchor_id", "slot", "vec_id", "score"],
    )


def _positives(k: int, kind: str):
    def run(batches):
        for row in _pairs(batches):
            anchors, ids, scores, good, _ = _scored(row, kind)
            best = best_first(scores, good)[:, :k]
            which, place = np.nonzero(np.take_along_axis(good, best, axis=1))
            at = best[which, place]
            yield _found(anchors[which], np.zeros(len(at)), ids[at], scores[which, at])

    return run


def _slots(k: int, kind: str):
    """The best k of every slot of a block; slot s lies below the s-th highest limit and above the next."""
    def run(batches):
        for row in _pairs(batches):
            anchors, ids, scores, _, good = _scored(row, kind)
            depth = max(map(len, row["limits"]), default=0)
            if scores.dtype == object:
                none, most, whole_kind = -(1 << 2200), 1 << 2200, object
            else:
                none, most, whole_kind = np.iinfo(np.int64).min, np.iinfo(np.int64).max, np.int64
            floor = np.array([min(number(x), most) for x in row["lowest"]], whole_kind)
            limit = np.full((len(anchors), depth), none, whole_kind)
            for i, own in enumerate(row["limits"]):
                limit[i, : len(own)] = [min(number(x), most) for x in own]
            slot = -np.ones(scores.shape, np.int32)
            for s in range(depth):
                slot += (scores <= limit[:, s : s + 1]).astype(np.int32)
            good &= (slot >= 0) & (scores >= floor[:, None])
            order = best_first(scores, good)
            ranked, fine = np.take_along_axis(slot, order, axis=1), np.take_along_axis(good, order, axis=1)
            for s in range(depth):
                mine = fine & (ranked == s)
                which, place = np.nonzero(mine & (np.cumsum(mine, axis=1) <= k))
                at = order[which, place]
                yield _found(anchors[which], np.full(len(at), s), ids[at], scores[which, at])

    return run


def _limits(high: int, low: int):
    """Upper limits of each anchor's windows, highest first, and its lowest lower limit."""
    def run(batches):
        for batch in batches:
            scores = [[s for s in map(number, own) if s >= 0] for own in batch.column("scores").to_pylist()]
            limits = [np.array(sorted({high * s // 100 for s in own}, reverse=True), object) for own in scores]
            lowest = [min((-(-low * s // 100) for s in own), default=0) for own in scores]
            yield pa.record_batch([
                batch.column("anchor_id"), pa.array([ordered(own).to_pylist() for own in limits], pa.list_(pa.binary())), ordered(np.array(lowest, object)),
            ], names=["anchor_id", "limits", "lowest"])

    return run


def _merged(k: int, high: int, low: int):
    """Answers of all windows of an anchor, by merging its slots from the lowest limit up."""
    schema = pa.schema([
        ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
        ("positive_score", pa.decimal128(38, 0)), ("negative_score", pa.decimal128(38, 0)),
    ])

    def run(batches):
        for batch in batches:
            out = []
            for anchor, positives, found in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "positives", "found")), strict=True):
                positives = [(number(p["score"]), p["vec_id"]) for p in positives]
                limits = sorted({high * score // 100 for score, _ in positives if score >= 0}, reverse=True)
                best: list[tuple[int, int]] = []
                for slot in range(len(limits) - 1, -1, -1):
                    best = sorted([*best, *((-number(f["score"]), f["vec_id"]) for f in found if f["slot"] == slot)])[:k]
                    for score, positive in positives:
                        if score >= 0 and high * score // 100 == limits[slot]:
                            fit = [(n, i) for n, i in best if -100 * n >= low * score]
                            out += [(anchor, positive, rank, i, held(score), held(-n)) for rank, (n, i) in enumerate(fit, 1)]
            if out:
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k of each slot of each anchor; Spark ranks within each task first."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def mine(
    embeddings: DataFrame, anchors: Column | str = "vec_id % 50 = 0", positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``embeddings`` (vec_id, embedding, label).

    Rows that fit ``anchors`` ask. Of each of an anchor's best ``positives`` the first ``negatives`` rows of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score are returned.
    """
    spark = embeddings.sparkSession
    work = Workspace(spark)
    single = isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType)
    kind, held = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = embeddings.where(finite() & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.size("embedding").alias("dim"), F.col("embedding").cast(held).alias("v"),
    )
    order = ["dim", "label", "vec_id"]

    def blocks(df: DataFrame, size: int, schema: str, limits: bool = False) -> DataFrame:
        names = [c.split()[0] for c in schema.split(", ")][: None if limits else 6]
        kept = schema if limits else schema.split(", limits")[0]
        return df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(size, names, limits, kind), kept)

    stored = work.stage(blocks(rows, ROWS, VECTORS))
    busy = min(int(spark.conf.get("spark.sql.shuffle.partitions")), WAVES * spark.sparkContext.defaultParallelism)
    parts = max(busy, -(-stored.count() // HELD))
    stored = stored.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
    asking = rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "dim", "v")).alias("row"))
    asking = work.stage(asking.select("vec_id", "row.*"))

    def met(asked: DataFrame, condition: str) -> DataFrame:
        # Guessed by the size of one copy, the copies for all parts would be broadcast, through the driver.
        copies = dealt(asked.withColumnsRenamed({"least": "from", "most": "to"}), parts).hint("merge")
        both = copies.join(stored, ["dim", "part"])
        return both.where(condition).drop("dim", "part", "least", "most", "from", "to")

    pairs = met(blocks(asking, ANCHORS, ASKING), "`from` <= most and to >= least")
    best = work.stage(_best(pairs.mapInArrow(_positives(positives, kind), FOUND), positives).drop("slot"))

    own = best.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))  # at most ``positives`` rows
    limits = own.select("anchor_id", F.col("positives.score").alias("scores")).mapInArrow(
        _limits(high, low), "anchor_id long, limits array<binary>, lowest binary")
    searching = asking.join(limits.where("size(limits) > 0").withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    pairs = met(blocks(searching, ANCHORS, ASKING, limits=True), "`from` <> most or to <> least")
    found = _best(pairs.mapInArrow(_slots(negatives, kind), FOUND), negatives)
    slots = found.groupBy("anchor_id").agg(F.collect_list(F.struct("slot", "vec_id", "score")).alias("found"))  # k a slot
    return own.join(slots, "anchor_id").mapInArrow(_merged(negatives, high, low), RESULT)
