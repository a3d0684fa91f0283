"""Keyed upserts as DataFrame expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_last_wins(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The last row of every key in arrival order.

    A hash of the other columns settles what arrival leaves open, so the outcome
    never depends on how the input was split. Each task keeps one row per key
    before the shuffle, so a key repeated without bound costs no more than any
    other.
    """
    rest = [c for c in df.columns if c not in keys and c not in arrival]
    order = [F.col(c).desc() for c in arrival]
    if rest:
        order.append(F.xxhash64(*rest).desc())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def assign_keys(
    rows: DataFrame,
    id_col: str,
    id_type: str,
    order: Sequence[Column],
    bucket: Column,
    start: Column,
    scope: Sequence[str] = (),
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Number ``rows`` from ``start + 1`` without gaps, in ``order`` within ``scope``.

    ``bucket`` must rise with ``order`` and be even in size. Rows are ranked
    inside their bucket and moved up by the size of the buckets before it, so
    the window over a whole scope sees one count per bucket, never the rows.
    The numbers depend on the values alone, so a retried task repeats them.
    Rows are shuffled once, for both the sizes and the ranks, and before the
    texts of ``order`` are worked out. ``start`` may use the columns of ``bounds``, one row per scope.
    """
    scope = list(scope)
    keyed = rows.drop(id_col).withColumn("_bucket", bucket).repartition(*scope, "_bucket")
    sizes = keyed.groupBy(*scope, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    if bounds is not None:
        sizes = sizes.join(bounds, scope, "left")
    earlier = Window.partitionBy(*scope).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = sizes.select(*scope, "_bucket", (start + before).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(*scope, "_bucket").orderBy(*order))
    numbered = keyed.withColumn("_rank", rank).join(offsets, [*scope, "_bucket"])
    return numbered.withColumn(
        id_col, (F.col("_offset") + F.col("_rank")).cast(id_type)
    ).drop("_bucket", "_offset", "_rank")


def digest(*keys: str) -> Column:
    """Even, engine-independent ordering text of a key."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def digest_bucket(*keys: str) -> Column:
    """4,096 even buckets in digest order."""
    return F.substring(digest(*keys), 1, 3)


def split_merge(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], keep: Sequence[str], stays: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(updated, fresh)`` of an upsert by a ``batch`` that is unique on ``keys``.

    ``updated`` are the target rows, with the values of the batch row that
    replaces them, NULLs included, but for the ``keep`` columns; they come from
    one pass over the target, which against a small batch is not shuffled.
    ``fresh`` are the batch rows with new keys, without the ``keep`` columns.
    Target rows that no batch row replaces are dropped where ``stays`` does not hold.
    """
    keys, keep = list(keys), list(keep)
    moving = [c for c in target.columns if c not in keys and c not in keep]
    replacing = batch.select(*keys, F.struct(*moving).alias("_new"))
    joined = target.join(replacing, keys, "left")
    taken = F.col("_new").isNotNull()
    if stays is not None:
        joined = joined.filter(taken | stays)
    updated = joined.select(*[
        F.when(taken, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in moving else F.col(c)
        for c in target.columns
    ])
    fresh = batch.select(*keys, *moving).join(target.select(*keys), keys, "left_anti")
    return updated, fresh


def merge_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    id_col: str,
    arrival: Sequence[str],
    now: Column,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    gone: DataFrame | None = None,
) -> DataFrame:
    """``target`` after upserting a fact ``batch``; ``keys`` end with the time.

    The incoming row replaces everything, NULLs included, but the id and
    ``created_at`` of a row that is already there. Of the places in ``gone``
    (the first key) target rows without an incoming row are dropped. Both sides
    are passed over twice: narrow, by keys and id, for the new keys and the
    highest id of each day, and once whole, grouped by key. The batch's rows are
    in one shuffle for those that replace and those that are new, and not stored
    in between. ``stage`` may write out the narrow intermediates.
    """
    keys, columns = list(keys), target.columns
    keep = [id_col, "created_at"]
    moving = [c for c in columns if c not in keys and c not in keep]
    unique = dedupe_last_wins(batch, keys, arrival).select(*keys, *moving)
    narrow = stage(target.select(*keys, id_col))
    new = batch.select(*keys).distinct().join(narrow.select(*keys), keys, "left_anti")
    numbered = stage(assign_fact_keys(new, narrow, keys, id_col))
    stays = None
    if gone is not None:
        target = target.join(gone.select(keys[0], F.lit(True).alias("_gone")), keys[0], "left")
        stays, keep = F.col("_gone").isNull(), [*keep, "_gone"]
    updated, _ = split_merge(target, unique, keys, keep, stays)
    added = unique.join(numbered, keys).withColumn("created_at", now)
    return updated.select(*columns).unionByName(added.select(*columns))


# A fact id is the day number of its row in the high bits and a running number
# of that day below, so new ids need only the days being written, not the table.
# Days count from the first of the calendar, so that every id is positive.
DAY_BITS = 40
FIRST_DAY = "0001-01-01"


def day_of_id(id_col: str) -> Column:
    """The day that a fact id belongs to."""
    number = F.shiftright(F.col(id_col), DAY_BITS).cast("int")
    return F.date_add(F.lit(FIRST_DAY).cast("date"), number)


def assign_fact_keys(
    fresh: DataFrame, target: DataFrame, keys: Sequence[str], id_col: str
) -> DataFrame:
    """Ids for new fact rows, counting on from the highest id of their day."""
    day = F.to_date(keys[-1])
    highest = target.groupBy(day.alias("_day")).agg(F.max(id_col).alias("_top"))
    number = F.datediff("_day", F.lit(FIRST_DAY).cast("date")).cast("bigint")
    first = F.shiftleft(number, DAY_BITS)
    return assign_keys(
        fresh.withColumn("_day", day),
        id_col,
        "bigint",
        order=[digest(*keys), *[F.col(k) for k in keys]],
        bucket=digest_bucket(*keys),
        start=F.greatest(first, F.coalesce("_top", first)),
        scope=["_day"],
        bounds=highest,
    ).drop("_day")


def cascaded(fact: DataFrame, deleted_locations: DataFrame) -> DataFrame:
    """The rows of ``fact`` that go with deleted locations."""
    gone = deleted_locations.select("location_id").distinct()
    return fact.join(gone, "location_id", "left_semi")


def cascade_delete(fact: DataFrame, deleted_locations: DataFrame) -> DataFrame:
    """``fact`` without the rows of deleted locations."""
    gone = deleted_locations.select("location_id").distinct()
    return fact.join(gone, "location_id", "left_anti").select(*fact.columns)
