"""Exact top-k by inner product with a pivot-distance index.

With M the largest norm, a vector x gets one more component, sqrt(M^2 - |x|^2),
and a query q a zero: then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so that the largest
inner products are the nearest neighbours. Each vector is keyed by its nearest
pivot and its distance from it, and the index is kept in that order, in blocks:
annuli of a pivot's cell. By the triangle inequality, a query at distance d from
a pivot and with search radius R needs only the annuli between d - R and d + R.

The radius is that of the k-th best score known. It starts from a sample, shrinks
as the annuli of the query's own cell are searched, and then decides which annuli
of all other cells are opened; the rest are never read against the query.

Pivots come from a sample of at most ``SAMPLE`` vectors, those with the smallest
hashes of their ids; every vector is indexed. A cell that holds a third of all
vectors is many blocks, dealt over ``PARTS`` keys.

Distances are doubles in units of the largest component, with a margin above what
rounding can do; they only decide what is opened. Scores are exact integers at any
size that a double allows: where 64 bits do not hold them, those that may be among
the k best are worked out as Python integers. They travel as binary marks that
sort as they do, and are shown at 38 digits. If a few vectors are far larger than
all others, the margin exceeds the distances of the others, and more is opened.

Only vectors of the same length are compared; lengths have cells of their own under
pivots that are shorter or longer by zeros. Vectors that are null or empty or hold
null or non-finite components take no part, nor do rows without an id. Rows that
repeat an id are candidates each; a query's own id is never its candidate, and of
several vectors of one query id the least in order asks. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.llm.vectors import best_first, finite, held, matrix, number, ordered, products, whole
from skylattice.llm.workspace import Workspace

SAMPLE = 2048
PIVOTS = 64
BLOCK = 1024
PACK = 256
PARTS = 8
SCALE = 256
CELLS = 1 << 16
RESULT = "query_id long, rank int, vec_id long, score decimal(38,0)"
FOUND = "query_id long, vec_id long, near double, score binary"
INDEX = "cell long, part int, lo double, hi double, ids binary, vectors binary"
PACKED = "cell long, least double, most double, queries binary, asked binary, near binary, far binary, kth binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, v) of the vectors that take part, as the doubles that they are."""
    return embeddings.where(finite() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"),
        F.col("embedding").cast("array<double>").alias("v"),
    )


def in_units(v: np.ndarray, top: float) -> np.ndarray:
    """floor(SCALE * v) / SCALE in units of ``top``; of huge ones rounding takes more than the floor does."""
    return np.floor(v * SCALE) / SCALE / top if top < 1e100 else v / top


class Space:
    """Pivots, the sample that they are from, and the geometry of the longer vectors."""

    def __init__(self, sample: list[list[float]], ids: np.ndarray, top: float, largest: float):
        self.ids, self.top, self.largest = ids, top, largest
        self.lengths = np.array([len(v) for v in sample])
        self.sample = np.zeros((len(sample), self.lengths.max()))
        for row, v in zip(self.sample, sample, strict=True):
            row[: len(v)] = in_units(np.array(v, np.float64), top)
        lifted = np.column_stack((self.sample, self.lift(self.sample)))
        chosen = [0]
        near = ((lifted - lifted[0]) ** 2).sum(axis=1)
        while len(chosen) < min(PIVOTS, len(sample)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
        self.pivots, self.lifts = self.sample[chosen], self.lift(self.sample[chosen])

    def lift(self, units: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.largest - (units * units).sum(axis=1), 0))

    def distances(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        """From every pivot; a query's added component is zero."""
        units = in_units(v, self.top)
        lift = np.zeros(len(units)) if query else self.lift(units)
        both = min(units.shape[1], self.pivots.shape[1])
        inner = units[:, :both] @ self.pivots[:, :both].T + lift[:, None] * self.lifts
        own, others = (units**2).sum(axis=1) + lift**2, (self.pivots**2).sum(axis=1) + self.lifts**2
        return np.sqrt(np.maximum(own[:, None] + others - 2 * inner, 0))

    def near(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Scores in units, up to the margin."""
        return in_units(queries, self.top) @ in_units(vectors, self.top).T

    def margin(self, queries: np.ndarray) -> np.ndarray:
        """More than rounding can change a query's score in units."""
        size = np.abs(in_units(queries, self.top)).max(axis=1) * np.sqrt(queries.shape[1])
        return 1e-9 * size * np.sqrt(self.largest) + 1e-290

    def radius(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Within it lies every vector with that score or a better one; a little more for rounding."""
        whole_ = (in_units(queries, self.top) ** 2).sum(axis=1) + self.largest
        square = np.maximum(whole_ - 2 * (kth - self.margin(queries)), 0)
        return np.sqrt(square) + 4 * np.sqrt(1e-15 * (queries.shape[1] + 1) * whole_) + 1e-140

    def scores(self, queries: np.ndarray, vectors: np.ndarray, good: np.ndarray, near: np.ndarray, k: int):
        """Exact scores, and which of them to look at: all that are ``good`` and may be among the k best of their query."""
        a, b = whole(queries, SCALE), whole(vectors, SCALE)
        if a.dtype != object and b.dtype != object:
            if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 1 << 62:
                return products(a, b), good
        if near.shape[1] > k:
            cut = np.sort(np.where(good, near, -np.inf), axis=1)[:, -k]
            good = good & (near >= (cut - 2 * self.margin(queries))[:, None])
        a, b = a.astype(object), b.astype(object)
        out = np.zeros(good.shape, object)
        for i in range(len(a)):
            at = np.flatnonzero(good[i])
            if len(at):
                out[i, at] = b[at] @ a[i]
        return out, good


def _by_length(batches):
    for batch in batches:
        length = batch.column("dim").to_numpy()
        for n in np.unique(length):
            yield int(n), batch.filter(pa.array(length == n))


def _norms(top: float):
    def run(batches):
        for _, rows in _by_length(batches):
            norm = (in_units(matrix(rows.column("v")), top) ** 2).sum(axis=1)
            yield pa.record_batch([pa.array([norm.max()])], names=["norm"])

    return run


def _assign(space: Space):
    def run(batches):
        for n, rows in _by_length(batches):
            away = space.distances(matrix(rows.column("v")))
            cell = away.argmin(axis=1)
            yield pa.record_batch(
                [pa.array(n * CELLS + cell), pa.array(away[np.arange(len(cell)), cell]), rows.column("vec_id"), rows.column("v")],
                names=["cell", "away", "vec_id", "v"],
            )

    return run


def _runs(batches, size: int, key: str):
    """Consecutive rows with the same key, at most ``size`` together, as record batches."""
    held_ = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([batch]) if held_ is None else pa.concat_tables([held_, pa.Table.from_batches([batch])])
        value = rows.column(key).to_numpy()
        cut = [0]
        while cut[-1] < len(value):
            end = cut[-1] + int(np.searchsorted(value[cut[-1] :], value[cut[-1]], side="right"))
            cut += [*range(cut[-1] + size, end, size), end]
        for a, b in zip(cut[:-2], cut[1:-1], strict=True):
            yield rows.slice(a, b - a).combine_chunks()
        held_ = rows.slice(cut[-2])
    if held_ is not None and held_.num_rows:
        yield held_.combine_chunks()


def _raw(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())


def _blocks(batches):
    for i, rows in enumerate(_runs(batches, BLOCK, "cell")):
        away = rows.column("away").to_numpy()
        yield pa.record_batch([
            pa.array([rows.column("cell")[0].as_py()]), pa.array([i % PARTS], pa.int32()), pa.array([away.min()]), pa.array([away.max()]),
            _raw(rows.column("vec_id").to_numpy()), _raw(matrix(rows.column("v"))),
        ], names=["cell", "part", "lo", "hi", "ids", "vectors"])


def _seed(space: Space, k: int):
    """A first k-th best score of every query, from the sample, and its distances from the pivots."""
    def run(batches):
        for n, rows in _by_length(batches):
            same = np.flatnonzero(space.lengths == n)
            for first in range(0, rows.num_rows, PACK):
                part = rows.slice(first, PACK)
                v = matrix(part.column("v"))
                near = in_units(v, space.top) @ space.sample[same][:, :n].T if len(same) else np.zeros((len(v), 0))
                near[part.column("vec_id").to_numpy()[:, None] == space.ids[same]] = -np.inf
                kth = np.sort(near, axis=1)[:, -k] if near.shape[1] >= k else np.full(len(v), -np.inf)
                away = space.distances(v, query=True)
                yield pa.record_batch([
                    part.column("vec_id"), part.column("dim"), part.column("v"), pa.array([r.tolist() for r in away], pa.list_(pa.float64())),
                    pa.array(away.argmin(axis=1), pa.int32()), pa.array(kth),
                ], names=["query_id", "dim", "v", "away", "own", "kth"])

    return run


def _packs(space: Space):
    def run(batches):
        for rows in _runs(batches, PACK, "cell"):
            v, away, kth = matrix(rows.column("v")), rows.column("away").to_numpy(), rows.column("kth").to_numpy()
            radius = space.radius(v, kth)
            yield pa.record_batch([
                pa.array([rows.column("cell")[0].as_py()]), pa.array([(away - radius).min()]), pa.array([(away + radius).max()]),
                *map(_raw, (rows.column("query_id").to_numpy(), v, away - radius, away + radius, kth)),
            ], names=["cell", "least", "most", "queries", "asked", "near", "far", "kth"])

    return run


def _within(space: Space):
    """The queries of ``others`` that reach some annulus of the cell."""
    def run(batches):
        for _, rows in _by_length(batches):
            away, radius = rows.column("away").to_numpy(), space.radius(matrix(rows.column("v")), rows.column("kth").to_numpy())
            reached = (away - radius <= rows.column("hi").to_numpy()) & (away + radius >= rows.column("lo").to_numpy())
            yield rows.filter(pa.array(reached)).select(["query_id", "v", "cell", "away", "kth"])

    return run


def _search(space: Space, k: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                queries, ids = np.frombuffer(row["queries"], np.int64), np.frombuffer(row["ids"], np.int64)
                least, most, kth = (np.frombuffer(row[c], np.float64) for c in ("near", "far", "kth"))
                open_ = np.flatnonzero((least <= row["hi"]) & (most >= row["lo"]))
                order = np.argsort(ids, kind="stable")
                queries, ids, kth = queries[open_], ids[order], kth[open_]
                asked = np.frombuffer(row["asked"], np.float64).reshape(len(least), -1)[open_]
                vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)[order]
                if len(open_) == 0:
                    continue
                near = space.near(asked, vectors)
                good = (near >= (kth - 2 * space.margin(asked))[:, None]) & (ids != queries[:, None])
                scores, good = space.scores(asked, vectors, good, near, k)
                best = best_first(scores, good)[:, :k]
                which, column = np.nonzero(np.take_along_axis(good, best, axis=1))
                at = best[which, column]
                yield pa.record_batch(
                    [pa.array(queries[which]), pa.array(ids[at]), pa.array(near[which, at]), ordered(scores[which, at])],
                    names=["query_id", "vec_id", "near", "score"],
                )

    return run


def _shown(batches):
    for batch in batches:
        score = pa.array([held(number(mark)) for mark in batch.column("score").to_pylist()], pa.decimal128(38, 0))
        yield pa.record_batch([*(batch.column(c) for c in ("query_id", "rank", "vec_id")), score], names=["query_id", "rank", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``embeddings`` (vec_id, embedding) for each row of ``queries`` (same columns)."""
    spark = embeddings.sparkSession
    work = Workspace(spark)
    rows = work.stage(usable(embeddings.select("vec_id", "embedding")))
    asked = work.stage(usable(queries.select("vec_id", "embedding")))
    size = F.max(F.array_max(F.transform("v", F.abs))).alias("top")
    top = rows.agg(size).first()[0]
    if top is None:
        return spark.createDataFrame([], RESULT)
    # Queries may be larger than all vectors; with units of the largest of both no square overflows.
    top = max(top, asked.agg(size).first()[0] or 0.0, 1 / SCALE)
    largest = rows.mapInArrow(_norms(top), "norm double").agg(F.max("norm")).first()[0]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).toArrow()
    space = Space(sample.column("v").to_pylist(), sample.column("vec_id").to_numpy(), top, largest)

    keyed = rows.mapInArrow(_assign(space), "cell long, away double, vec_id long, v array<double>")
    keyed = keyed.repartitionByRange("cell", "away", "vec_id").sortWithinPartitions("cell", "away", "vec_id")
    index = work.stage(keyed.mapInArrow(_blocks, INDEX))

    least = F.struct(F.transform("v", lambda x: F.floor(SCALE * x)).alias("floor"), "v", "dim")
    asked = asked.groupBy("vec_id").agg(F.min(least).alias("least")).select("vec_id", "least.dim", "least.v")
    asked = work.stage(asked.mapInArrow(_seed(space, k), "query_id long, dim int, v array<double>, away array<double>, own int, kth double"))

    def scan(open_: DataFrame) -> DataFrame:
        """Scores that reach kth, from the annuli that lie in reach of each (query, cell)."""
        packs = open_.repartitionByRange("cell", "away", "query_id").sortWithinPartitions("cell", "away", "query_id")
        packs = packs.mapInArrow(_packs(space), PACKED)
        packs = packs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        pairs = packs.join(index, ["cell", "part"]).where("least <= hi and most >= lo").drop("cell", "part", "least", "most")
        return pairs.mapInArrow(_search(space, k), FOUND)

    cell = f"cast(dim as long) * {CELLS} + "
    own = asked.select("query_id", "v", F.expr(f"{cell} own").alias("cell"), F.expr("away[own]").alias("away"), "kth")
    first = work.stage(_best(scan(own), k).drop("rank"))
    known = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("near").alias("least"))
    asked = asked.join(known, "query_id", "left").withColumn("kth", F.expr(f"if(n = {k}, greatest(kth, least), kth)"))
    # The bound lets a cell through only if some annulus of it may lie within the radius.
    reach = index.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    others = asked.select("query_id", "dim", "v", "kth", "own", F.posexplode("away").alias("pivot", "away")).where("pivot <> own")
    others = others.withColumn("cell", F.expr(f"{cell} pivot")).drop("own", "pivot").join(reach, "cell")
    others = others.mapInArrow(_within(space), "query_id long, v array<double>, cell long, away double, kth double")
    return _best(first.union(scan(others)), k).select("query_id", "rank", "vec_id", "score").mapInArrow(_shown, RESULT)
