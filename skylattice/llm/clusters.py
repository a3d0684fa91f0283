"""Centroid clustering with ns-bounds.

Lloyd's rounds over whole-number vectors. A vector keeps an upper bound of the
distance to its centroid and a lower bound of that to every other, each the
distance as it was when last evaluated, and the round of that. The history of
the centroids is kept, so that a bound is loosened by the norm of the centroid's
total displacement since then, not by the sum of its drifts, round by round. A
centroid that moves back and forth costs little that way. Only where a loosened
lower bound does not exceed the upper one are distances evaluated again: first
that to the own centroid, then, of those still in doubt, the others'. What is
compared in the end are exact squares of whole numbers; bounds leave room for
rounding, so ties are always evaluated and go to the smaller number.

The history is k vectors a round and travels with the tasks; vectors and bounds
are a table, written once a round, so that a lost executor costs its part of one
round. New centroids come from sums by cluster and component, added up in each
task before the shuffle; k times length numbers reach the driver.

Rows whose vector is null, of another length than ``length``, or with null or
non-finite components are left out. Rows without an id are clustered but start
no centroid; rows that repeat an id are rows of their own, and of equal hashes
the least vector comes first. With fewer rows than k there are as many centroids
as rows with an id, with none nothing is returned. A cluster that is empty keeps
its centroid. Other columns are not read. A square beyond 38 digits is held there.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.llm.text import lists
from skylattice.llm.vectors import WIDE, decimals, finite, matrix, products, whole
from skylattice.llm.workspace import Workspace

K, ROUNDS, SCALE, LENGTH = 16, 3, 64, 64
LIMB = 60
STATE = "vec_id long, v array<{kind}>, cluster int, upper double, seen int, lower array<double>, at array<int>, evaluated int, distance decimal(38,0)"

Centroids = list[list[int]]


def _whole_array(rows: Centroids) -> np.ndarray:
    out = np.array(rows, object).reshape(len(rows), -1)
    return out.astype(np.int64) if all(abs(x) < 1 << 62 for row in rows for x in row) else out


def alike(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers where every squared distance fits, else as Python integers."""
    if x.dtype != object and c.dtype != object:
        far = 2.0 * max(float(np.abs(x).max(initial=0)), float(np.abs(c).max(initial=0)))
        if far * far * x.shape[1] < 1 << 62:
            return x, c
    return x.astype(object), c.astype(object)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x from one row c."""
    return ((x - c) ** 2).sum(axis=1)


def all_squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * products(x, c)


def _roots(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def displaced(history: list[Centroids]) -> np.ndarray:
    """[round, centroid]: the norm of what the centroid has moved from then until the last round."""
    now = history[-1]
    return np.array([
        [math.sqrt(sum((a - b) ** 2 for a, b in zip(then[j], now[j], strict=True))) for j in range(len(now))] for then in history
    ])


def assign(x: np.ndarray, centroids: np.ndarray, moved: np.ndarray, state: tuple | None) -> tuple:
    """(cluster, upper, seen, lower, at, evaluated) of the vectors after one more round; ``state`` is what was before it."""
    n, k, now = len(x), len(centroids), len(moved) - 1
    x, centroids = alike(x, centroids)
    everyone = np.arange(n)
    if state is None:
        square = all_squares(x, centroids)
        cluster, lower = square.argmin(axis=1), _roots(square)
        return cluster, lower[everyone, cluster], np.full(n, now), lower, np.full((n, k), now), np.full(n, k)
    cluster, upper, seen, lower, at, evaluated = (a.copy() for a in state)
    widened = (upper + moved[seen, cluster]) * (1 + 1e-9) + 1e-6
    loosened = (lower - moved[at, np.arange(k)]) * (1 - 1e-9) - 1e-6
    loosened[everyone, cluster] = np.inf
    rows = np.flatnonzero((loosened <= widened[:, None]).any(axis=1))
    if len(rows) == 0:
        return cluster, upper, seen, lower, at, evaluated
    # The own distance first, which settles most.
    square = np.full((len(rows), k), np.iinfo(np.int64).max if x.dtype != object else 1 << 5000, x.dtype)
    own = cluster[rows]
    for j in np.unique(own):
        mine = own == j
        square[mine, j] = squares(x[rows[mine]], centroids[j])
    exact = _roots(square[np.arange(len(rows)), own])
    upper[rows], seen[rows] = exact, now
    lower[rows, own], at[rows, own] = exact, now
    evaluated[rows] += 1
    open_ = loosened[rows] <= (exact * (1 + 1e-9) + 1e-6)[:, None]
    for j in range(k):
        mine = np.flatnonzero(open_[:, j])
        if len(mine):
            square[mine, j] = squares(x[rows[mine]], centroids[j])
            lower[rows[mine], j], at[rows[mine], j] = _roots(square[mine, j]), now
            evaluated[rows[mine]] += 1
    nearest = square.argmin(axis=1)  # the first of equals
    cluster[rows], upper[rows] = nearest, lower[rows, nearest]
    return cluster, upper, seen, lower, at, evaluated


def _round(history: list[Centroids], last: bool, scale: int):
    centroids, moved = _whole_array(history[-1]), displaced(history)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = whole(matrix(batch.column("v")), scale)
            state = None
            if "cluster" in batch.schema.names:
                wide = lambda name: matrix(batch.column(name))
                one = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
                state = (
                    one("cluster").astype(np.int64), one("upper"), one("seen").astype(np.int64), wide("lower"),
                    wide("at").astype(np.int64), one("evaluated").astype(np.int64),
                )
            cluster, upper, seen, lower, at, evaluated = assign(x, centroids, moved, state)
            distance = pa.nulls(len(x), WIDE)
            if last:
                x, exact = alike(x, centroids)
                square = np.empty(len(x), x.dtype)
                for j in np.unique(cluster):
                    square[cluster == j] = squares(x[cluster == j], exact[j])
                distance = decimals(square)
            each = np.full(len(x), len(centroids))
            yield pa.record_batch([
                batch.column("vec_id"), batch.column("v"), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(seen, pa.int32()),
                lists(lower.ravel(), each, pa.float64()), lists(at.ravel().astype(np.int32), each, pa.int32()),
                pa.array(evaluated, pa.int32()), distance,
            ], names=["vec_id", "v", "cluster", "upper", "seen", "lower", "at", "evaluated", "distance"])

    return run


def _sums(scale: int):
    """Sums by cluster and component of what a task reads, in two limbs."""
    def run(batches):
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = whole(matrix(batch.column("v")), scale)
            if float(np.abs(x).max(initial=0)) * len(x) >= 1 << 62:
                x = x.astype(object)
            cluster = batch.column("cluster").to_numpy()
            for j in np.unique(cluster).tolist():
                n, sums = total.get(j, (0, np.zeros(x.shape[1], object)))
                mine = cluster == j
                total[j] = n + int(mine.sum()), sums + x[mine].sum(axis=0).astype(object)
        for j, (n, sums) in total.items():
            size, parts = len(sums), [int(s) for s in sums]
            yield pa.record_batch([
                pa.array([j] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                pa.array([Decimal(s >> LIMB) for s in parts], WIDE), pa.array([Decimal(s & ((1 << LIMB) - 1)) for s in parts], WIDE),
            ], names=["cluster", "place", "n", "high", "low"])

    return run


def moved_to(assigned: DataFrame, centroids: Centroids, scale: int) -> Centroids:
    """The floor of the mean of each cluster's vectors; an empty one stays."""
    sums = assigned.select("cluster", "v").mapInArrow(_sums(scale), "cluster int, place int, n long, high decimal(38,0), low decimal(38,0)")
    out = [list(c) for c in centroids]
    for row in sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        out[row.cluster][row.place] = ((int(row.high) << LIMB) + int(row.low)) // row.n
    return out


def starts(rows: DataFrame, k: int, scale: int, seed: str) -> Centroids:
    """The k vectors with the smallest hash of seed and id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return [[int(v) for v in whole(np.array([r.v], np.float64), scale)[0]] for r in first]


def cluster(
    embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, length: int = LENGTH, seed: str = "1",
) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance, evaluated) of every vector of ``embeddings`` (vec_id, embedding), and the centroids.

    ``distance`` is the squared one to its centroid, ``evaluated`` how many distances were worked out for the vector.
    """
    work = Workspace(embeddings.sparkSession)
    kept = embeddings.where(finite() & (F.size("embedding") == length))
    rows = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    state = STATE.format(kind=rows.schema["v"].dataType.elementType.simpleString())
    history = [starts(rows, k, scale, seed)]
    if not history[0]:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, cluster int, distance decimal(38,0), evaluated int"), []
    for n in range(rounds + 1):
        before = rows
        rows = work.stage(before.mapInArrow(_round(history, n == rounds, scale), state))
        if n:
            work.drop(before)
        if n < rounds:
            history.append(moved_to(rows, history[-1], scale))
    return rows.select("vec_id", "cluster", "distance", "evaluated"), history[-1]


def described(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256; a number that no long holds is null."""
    spark = assigned.sparkSession
    marks = spark.createDataFrame(
        [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)], "cluster int, centroid_sha256 string",
    )
    sums = assigned.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = assigned.agg(F.try_sum("distance")).scalar()
    sums = sums.join(marks, "cluster").withColumn("inertia", total)
    long = [F.col(c).try_cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")]
    found = assigned.join(F.broadcast(sums), "cluster")  # k rows
    return found.select("vec_id", "cluster", *long, "centroid_sha256", *(c for c in assigned.columns if c == "evaluated"))


def plain_sql() -> str:
    """What the query returns, as SQL that works every distance out in every round."""
    steps = [f"""
        with v as (
            select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x
            from embeddings where len(embedding) = {LENGTH} and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        c0 as (
            select row_number() over (order by sha256('1:' || vec_id), x) - 1 as j, x from v
            where vec_id is not null qualify j < {K})"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
        a{n} as (
            select r, any_value(vec_id) as vec_id, any_value(vx) as x, min(struct_pack(d := d, j := j)) as best from (
                select v.r, v.vec_id, v.x as vx, c.j, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
                from v, c{n} c)
            group by r)""")
        if n < ROUNDS:
            steps.append(f"""
        s{n} as (
            select j, list((s - ((s % n) + n) % n) // n order by place) as x from (
                select best.j as j, place, sum(x[place])::bigint as s, count(*) as n
                from a{n}, (select unnest(range(1, {LENGTH + 1})) as place) group by all)
            group by j),
        c{n + 1} as (select c.j, coalesce(s.x, c.x) as x from c{n} c left join s{n} s using (j))""")
    return ",".join(steps) + f"""
        select vec_id, best.j::integer as cluster, best.d as distance, sum(best.d) over (partition by best.j)::bigint as cluster_inertia,
            sum(best.d) over ()::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
        from a{ROUNDS} a join c{ROUNDS} c on c.j = a.best.j"""
