"""Location and date dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.functions.times import date_parts
from skylattice.operators.merge import (
    assign_keys, dedupe_last_wins, digest, digest_bucket, split_merge,
)
from skylattice.schemas import DEFAULT_TIMEZONE, DIM_DATE, DIM_LOCATION

COORDS = ["latitude", "longitude"]


def upsert_location(
    locations: DataFrame, batch: DataFrame, arrival: list[str], now: Column,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    start: Column | None = None,
) -> DataFrame:
    """``locations`` after taking in the places of ``batch``; new ids count on from ``start`` or the highest one.

    A known coordinate pair keeps its id, zone and ``created_at`` and takes the
    incoming name; ``updated_at`` moves to ``now`` even if the name is the same.
    """
    named = batch.select("neighborhood_name", *COORDS, *arrival)
    unique = stage(dedupe_last_wins(named, COORDS, arrival).drop(*arrival))
    incoming = unique.withColumn("updated_at", now)
    updated, fresh = split_merge(
        locations, incoming, COORDS, ["location_id", "timezone", "created_at"]
    )
    added = assign_keys(
        fresh,
        "location_id",
        "int",
        order=[digest(*COORDS), *[F.col(c) for c in COORDS]],
        bucket=digest_bucket(*COORDS),
        start=_highest(locations, "location_id") if start is None else start,
    ).withColumns({"timezone": F.lit(DEFAULT_TIMEZONE), "created_at": now})
    return updated.unionByName(added).select(*DIM_LOCATION.names)


def new_dates(dates: DataFrame, batch: DataFrame, date_col: str = "date") -> DataFrame:
    """The days of ``batch`` that ``dates`` lacks."""
    days = batch.select(F.col(date_col).alias("date")).filter("date IS NOT NULL").distinct()
    return days.join(dates.select("date"), "date", "left_anti")


def get_or_create_date(dates: DataFrame, batch: DataFrame, date_col: str = "date") -> DataFrame:
    """``dates`` plus the days of ``batch`` it lacks; known days stay as they are."""
    fresh = new_dates(dates, batch, date_col)
    added = assign_keys(
        fresh,
        "date_id",
        "int",
        order=[F.col("date")],
        bucket=F.year("date"),
        start=_highest(dates, "date_id"),
    )
    return dates.unionByName(describe_dates(added))


def describe_dates(days: DataFrame) -> DataFrame:
    """``date_id, date`` with the calendar columns worked out."""
    return days.withColumns(date_parts(F.col("date"))).select(*DIM_DATE.names)


def _highest(df: DataFrame, id_col: str) -> Column:
    """The highest id so far, as a one-row subquery; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """``date_day`` for every day from ``start`` up to but not including ``end``."""
    days = F.sequence(F.col(start), F.date_sub(F.col(end), 1))
    some = bounds.filter(F.col(start) < F.col(end))
    return some.select(F.explode(days).alias("date_day"))


# The default span.
SPINE_START, SPINE_END = "2026-01-01", "2030-12-31"


def default_date_spine(spark: SparkSession) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(SPINE_START).cast("date").alias("start"), F.lit(SPINE_END).cast("date").alias("end")
    )
    return date_spine(bounds)
