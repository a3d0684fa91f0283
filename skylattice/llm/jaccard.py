"""Exact Jaccard join of documents on word shingles by PartEnum signatures.

Two sets whose Jaccard similarity reaches the threshold have sizes within a
factor of it and a Hamming distance of at most k, which the larger size bounds.
Sizes are cut into bands; a set takes part in the instance of its own band and
of the next one up, so that a pair meets in the instance of the larger set. In
an instance the feature domain is dealt by hash into n1 = k // 2 + 1 partitions:
in one of them at least, two linked sets differ in one feature or none. Each
partition is dealt once more into three, and for every choice of two of the
three the features there make one signature: one of these is equal for both.

A signature of no features says nothing, and large sets would meet in thousands
of them. So an instance gets ``slack`` more partitions, and a set leaves its empty
signatures out if they lie in at most that many partitions. Linked sets agree in
more than ``slack`` partitions: if one of the two leaves empty signatures out,
they still share one that is not empty, and otherwise both keep theirs.

What shares a signature is a candidate. Candidates are settled in two steps that
lose no link: first every set is compared with one pivot, which joins the groups
of copies; then members of one bucket that are still in different components are
compared, unless parity bits of both sets already prove them too far apart. The
test runs inside the join, so that no pair of a group is a row unless it may link.
Every link rests on the exact sizes of sets and intersections.

Most signatures are of one set only, and a row for each would be more than the
texts. So signatures are dealt into parts by their upper bits, and of each piece of
text a part gets one row: 32 more bits of each signature, and for each set its class
and how many there are. Only what several classes hold becomes rows. Signatures that
differ in other bits alone are taken for one, which makes candidates, not links.

Skew. Exact copies are one class from the start. A set gives hundreds of
signatures, so that one bucket, even of a group that holds a third of all sets,
is a small part of a partition. Nothing is collected or broadcast by hint.

Texts that are null, empty or without words have no shingles and link with
nothing, copies of them neither. Rows without an id link with nothing. Rows that
repeat an id are rows of their own. Other columns are not read. Features are
64-bit hashes of shingles, classes 64-bit hashes of sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skylattice.llm.graph import components
from skylattice.llm.text import NOT_SPACE, U64, lists, mix, pieces, shingles, word_bounds, word_hashes
from skylattice.llm.workspace import Workspace

WORDS = 5
PERCENT = 80
PARITY_LONGS = 16
SEEN = 1_000_000
#: Signatures of a part, as expected, and of a step in which a task looks at them.
HELD, STEP = 8_000_000, 2_000_000
#: Parts that keep a small cluster busy.
BUSY = 48


@cache
def bands(percent: int, largest: int = 1 << 31) -> tuple[np.ndarray, np.ndarray]:
    """First size of each band, and n1 of the instance in which it is the upper band (0: equal sets only)."""
    first, parts, low = [], [], 1
    while low <= largest:
        high = low * 100 // percent
        k = 2 * high * (100 - percent) // (100 + percent)
        first.append(low)
        parts.append(k // 2 + 1 if k else 0)
        low = high + 1
    return np.array(first, np.int64), np.array(parts, np.int64)


def slack(parts: np.ndarray, percent: int) -> np.ndarray:
    """More partitions than are needed: a quarter above the share that is expected to have an empty signature.

    In the instance above its own band a set has the fewest features for a
    partition; the signatures of one are of two thirds of them.
    """
    features = (percent / 100) ** 2 * (100 + percent) / (100 - percent)
    share = 0.0
    for _ in range(10):
        share = min(0.25, 1.25 * (1 + share) * 3 * np.exp(-2 / 3 * features / (1 + share)))
    return (parts * max(share, 0.02)).astype(np.int64) + np.minimum(parts // 12, 2)


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each feature, feature) for pieces of a text column."""
    for first, end, data, offsets in pieces(column):
        starts, ends, rows = word_bounds(data, offsets, NOT_SPACE)
        row, value = shingles(word_hashes(data, starts, ends), rows, end - first, words)
        yield first, end - first, row, value


def _sums(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, U64)
    np.add.at(out, row, value)
    return out


def class_of(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """A hash of each whole set."""
    return mix(_sums(row, mix(value, 3), n), 4).view(np.int64)


def _describe(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("bits", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for first, n, row, value in shingle_sets(batch.column("text"), words):
                cell = (mix(value, 5) >> U64(32)).astype(np.int64) % (64 * PARITY_LONGS)
                word = np.zeros(n * PARITY_LONGS, U64)
                np.bitwise_xor.at(word, row * PARITY_LONGS + cell // 64, U64(1) << (cell % 64).astype(U64))
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, n),
                    pa.array(np.bincount(row, minlength=n)),
                    pa.array(class_of(row, value, n)),
                    lists(word.view(np.int64), np.full(n, PARITY_LONGS), pa.int64()),
                ], schema=schema)

    return run


def signatures(row: np.ndarray, value: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """PartEnum signatures of n sets, flat, with the number of each set."""
    first, parts = bands(percent)
    size = np.bincount(row, minlength=n)
    band = np.searchsorted(first, np.maximum(size, 1), side="right") - 1
    part, third = value >> U64(32), ((value & U64(0xFFFFFFFF)) * U64(3) >> U64(32)).astype(np.int64)
    weight = mix(value, 7)
    flat, owner = [], []
    for step in (0, 1):
        spare = slack(parts[band + step], percent)
        n1 = np.where(size > 0, parts[band + step] + spare, 0)
        base = np.concatenate(([0], np.cumsum(n1)))
        if base[-1] == 0:
            continue
        use = n1[row] > 0
        at = base[row[use]] + (part[use] * n1[row[use]].astype(U64) >> U64(32)).astype(np.int64)
        thirds = _sums(at * 3 + third[use], weight[use], int(base[-1]) * 3).reshape(-1, 3)
        whose = np.repeat(np.arange(n), n1)
        tag = (band[whose] + step).astype(U64) << U64(40) | (np.arange(base[-1]) - base[whose]).astype(U64) << U64(2)
        two = thirds.sum(axis=1, keepdims=True, dtype=U64) - thirds
        held = np.bincount(at * 3 + third[use], minlength=int(base[-1]) * 3).reshape(-1, 3)
        empty = held.sum(axis=1, keepdims=True) == held
        holes = np.bincount(whose, weights=empty.any(axis=1), minlength=n)
        kept = ~(empty & (holes <= spare)[whose][:, None]).ravel()
        flat.append(mix(mix(two, 8) ^ (tag[:, None] | np.arange(3, dtype=U64)), 9).ravel()[kept])
        owner.append(np.repeat(whose, 3)[kept])
    if not flat:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    flat, owner = np.concatenate(flat), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return flat[order].view(np.int64), np.bincount(owner, minlength=n)


PACKED = "part int, cls binary, counts binary, sigs binary"


def _sign(words: int, percent: int, parts: int):
    """Signatures of each class that the task has not met, a row for each piece and part."""
    schema = pa.schema([("part", pa.int32()), ("cls", pa.binary()), ("counts", pa.binary()), ("sigs", pa.binary())])

    def run(batches):
        seen: set[int] = set()  # a class that this task has signed need not be signed again
        for batch in batches:
            for at, n, row, value in shingle_sets(batch.column("text"), words):
                cls = class_of(row, value, n)
                known = ~np.asarray(batch.column("doc_id").slice(at, n).is_null())
                fresh = np.array([known[i] and c not in seen and not seen.add(c) for i, c in enumerate(cls.tolist())], bool)
                if len(seen) > SEEN:
                    seen.clear()
                use = fresh[row]
                yield pa.record_batch(packed(cls, *signatures(row[use], value[use], n, percent), parts), schema=schema)

    return run


def packed(cls: np.ndarray, flat: np.ndarray, count: np.ndarray, parts: int) -> list[pa.Array]:
    """Signatures by part: the classes there, how many each has, and the lower 32 bits of all."""
    sig = flat.view(U64)
    part = ((sig >> U64(32)) * U64(parts) >> U64(32)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, low, owner = part[order], sig.astype(np.uint32)[order], np.repeat(np.arange(len(cls)), count)[order]
    first = np.ones(len(part), bool)  # of a class in a part
    first[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(first)
    counts, classes = np.diff(np.append(first, len(part))).astype(np.uint32), cls[owner[first]]
    there = np.unique(part)
    ends, sets = np.searchsorted(part, there, side="right"), np.searchsorted(part[first], there, side="right")
    cut = [np.split(x, at[:-1]) if len(there) else [] for x, at in ((classes, sets), (counts, sets), (low, ends))]
    return [pa.array(there, pa.int32()), *(pa.array([x.tobytes() for x in column], pa.binary()) for column in cut)]


def _shared(batches):
    """(sig, cls) of the signatures that several classes hold, once each; batches are in order of ``part``."""
    part, held = None, []
    for batch in batches:
        numbers = batch.column("part").to_numpy()
        for i, number in enumerate(numbers.tolist()):
            if number != part:
                yield from several(part, held)
                part, held = number, []
            held.append([batch.column(c)[i].as_py() for c in ("cls", "counts", "sigs")])
    yield from several(part, held)


def several(part: int | None, held: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """What several classes hold of a part, looked at in steps by range."""
    if not held:
        return
    classes, counts, low = (np.frombuffer(b"".join(row[i] for row in held), kind) for i, kind in enumerate((np.int64, np.uint32, np.uint32)))
    held.clear()
    owner = np.repeat(np.arange(len(classes), dtype=np.uint32), counts)
    steps = -(-len(low) // STEP)
    step = (low.astype(U64) * U64(steps) >> U64(32)).astype(np.uint32) if steps > 1 else np.zeros(len(low), np.uint32)
    for i in range(steps):
        here = np.flatnonzero(step == i)
        order = here[np.argsort(low[here], kind="stable")]
        value, cls = low[order], classes[owner[order]]
        if not len(value):
            continue
        first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        shared = np.minimum.reduceat(cls, first) != np.maximum.reduceat(cls, first)
        shared = np.repeat(shared, np.diff(np.append(first, len(value))))
        value, cls = value[shared], cls[shared]
        order = np.lexsort((cls, value))
        value, cls = value[order], cls[order]
        once = np.ones(len(value), bool)
        once[1:] = (value[1:] != value[:-1]) | (cls[1:] != cls[:-1])
        found = pa.record_batch([pa.array(value[once].astype(np.int64) | part << 32), pa.array(cls[once])], names=["sig", "cls"])
        for at in range(0, found.num_rows, 50_000):
            yield found.slice(at, 50_000)


def _features(words: int):
    schema = pa.schema([("cls", pa.int64()), ("features", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for _, n, row, value in shingle_sets(batch.column("text"), words):
                yield pa.record_batch([
                    pa.array(class_of(row, value, n)),
                    lists(value.view(np.int64), np.bincount(row, minlength=n), pa.int64()),
                ], schema=schema)

    return run


def linked(pairs: DataFrame, described: DataFrame, texts: DataFrame, words: int, percent: int, work: Workspace) -> DataFrame:
    """The pairs (a, b) of classes that really link, by the exact sizes of both sets and their intersection."""
    chosen = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    ids = described.where("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(chosen, "cls", "left_semi")
    sets = work.stage(
        texts.join(ids.select("doc_id"), "doc_id", "left_semi").select("text")
        .mapInArrow(_features(words), "cls long, features array<long>").dropDuplicates(["cls"])
    )
    both = (
        pairs.join(sets.select(F.col("cls").alias("a"), F.col("features").alias("x")), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("features").alias("y")), "b")
    )
    shared = F.size(F.array_intersect("x", "y"))
    edges = work.stage(
        both.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("total"))
        .where(f"100L * i >= {percent}L * (total - i)").select("a", "b")
    )
    work.drop(sets)
    return edges


def jaccard_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents`` (doc_id, text).

    Documents link when 100 * intersection >= percent * union of their sets of
    ``words``-word shingles; component_id is the smallest doc_id that links reach.
    """
    labelled, least = _labels(documents, words, percent, Workspace(documents.sparkSession))
    return labelled.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"),
    )


def _labels(documents: DataFrame, words: int, percent: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, cls, label) of every row, label null where it links with nothing; (label, least): the smallest doc_id."""
    texts = documents.select("doc_id", "text")
    described = work.stage(texts.mapInArrow(_describe(words), "doc_id long, n long, cls long, bits array<long>"))

    # A set has about as many signatures as shingles.
    n_features = described.agg(F.sum("n")).first()[0] or 0
    busy = min(BUSY, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    signed = texts.mapInArrow(_sign(words, percent, max(busy, -(-n_features // HELD))), PACKED)
    members = work.stage(signed.repartition("part").sortWithinPartitions("part").mapInArrow(_shared, "sig long, cls long"))
    bucket = Window.partitionBy("sig")
    info = work.stage(described.groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits")).join(members.select("cls").distinct(), "cls", "left_semi"))

    # Each class with the one pivot with which it shares the most signatures.
    share = members.groupBy("cls").agg(F.count("*").alias("degree"))
    pivot = F.max(F.struct("degree", "cls")).over(bucket)["cls"]
    star = members.join(share, "cls").select("cls", pivot.alias("pivot")).where("cls <> pivot").groupBy("cls", "pivot").count()
    best = Window.partitionBy("cls").orderBy(F.desc("count"), "pivot")
    star = star.withColumn("rank", F.row_number().over(best)).where("rank = 1").select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
    left, right = (info.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    star = work.stage(star.join(left, "a").join(right, "b").where(_may_link(percent)).select("a", "b"))
    edges = linked(star, described, texts, words, percent, work)
    groups = work.stage(components(edges, work))

    # Members of a bucket that are still apart: each against all but its own component.
    placed = members.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select("sig", "cls", F.coalesce("root", "cls").alias("root"))
    open_ = placed.select("*", F.min("root").over(bucket).alias("lo"), F.max("root").over(bucket).alias("hi")).where("lo <> hi").drop("lo", "hi")
    open_ = work.stage(open_.join(info, "cls"))
    sizes = open_.groupBy("sig", "root").count()
    main = sizes.groupBy("sig").agg(F.max(F.struct("count", "root"))["root"].alias("main"))
    few = open_.join(main, "sig").where("root <> main").select("sig", "main", *(F.col(c).alias(f"{c}_a") for c in ("cls", "root", "n", "bits")))
    all_ = open_.select("sig", *(F.col(c).alias(f"{c}_b") for c in ("cls", "root", "n", "bits")))
    apart = few.join(all_, "sig").where("root_a <> root_b and (root_b = main or cls_a < cls_b)").where(_may_link(percent))
    rest = work.stage(apart.select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct())
    more = linked(rest, described, texts, words, percent, work)
    groups = work.stage(components(edges.union(more), work))

    labelled = described.select("doc_id", "n", "cls").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    alone = "n = 0 or doc_id is null"
    labelled = work.stage(labelled.select("doc_id", "n", "cls", F.expr(f"if({alone}, null, coalesce(root, cls))").alias("label")))
    # Stored, so that a join with it is one whose hot labels can be split.
    least = work.stage(labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")))
    work.drop(members, info, star, open_, rest)
    return labelled, least


def _may_link(percent: int) -> str:
    """False only if sizes or parity bits prove that two sets are too far apart.

    A cell whose parity differs holds at least one feature of one set only.
    """
    odd = " + ".join(f"bit_count(bits_a[{i}] ^ bits_b[{i}])" for i in range(PARITY_LONGS))
    return (
        f"100L * least(n_a, n_b) >= {percent}L * greatest(n_a, n_b) "
        f"and ({odd}) * {100 + percent}L <= (n_a + n_b) * {100 - percent}L"
    )


def _classed(words: int):
    def run(batches):
        for batch in batches:
            for first, n, row, value in shingle_sets(batch.column("text"), words):
                yield pa.record_batch([
                    batch.column("row").slice(first, n), batch.column("doc_id").slice(first, n),
                    pa.array(np.bincount(row, minlength=n)), pa.array(class_of(row, value, n)),
                ], names=["row", "doc_id", "n", "cls"])

    return run


def one_per_component(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``documents`` for each component; rows without an id or without words stay.

    The row of the smallest doc_id stays. Of several rows with that id it is one
    of the least class, of these the least in order. Rows that repeat an id are
    judged each by its own text.
    """
    work = Workspace(documents.sparkSession)
    labelled, least = _labels(documents, words, percent, work)
    rows = labelled.join(least, "label")
    again = work.stage(labelled.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        drop = rows.where("doc_id <> least").select("doc_id")
        return documents.join(drop.distinct(), "doc_id", "left_anti").select(*documents.columns)
    first = work.stage(rows.where("doc_id = least").groupBy("label").agg(F.min("cls").alias("first")))
    gone = work.stage(rows.join(first, "label").where("doc_id <> least or cls <> first").select("doc_id", "cls").distinct())
    once = gone.join(again, "doc_id", "left_anti").select("doc_id")
    unique = documents.join(again.union(once), "doc_id", "left_anti").select(*documents.columns)
    schema = StructType().add("row", documents.schema).add("doc_id", "long").add("n", "long").add("cls", "long")
    repeated = documents.join(again, "doc_id", "left_semi").select(F.struct(*documents.columns).alias("row"), "doc_id", "text")
    repeated = repeated.mapInArrow(_classed(words), schema).join(gone, ["doc_id", "cls"], "left_anti")
    # Rows without words are a group each.
    repeated = repeated.withColumn("alone", F.when(F.col("n") == 0, F.monotonically_increasing_id()))
    order = Window.partitionBy("doc_id", "cls", "alone").orderBy("row.text", F.to_json("row"))
    repeated = repeated.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return unique.union(repeated.select("row.*"))
