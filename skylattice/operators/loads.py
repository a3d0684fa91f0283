"""The hourly loads: landed responses into dimensions and facts.

A run is told by the feed: responses with the same ``run_id`` are one run, and a
higher id is newer. Responses without an id are a run of their own, older than
any with one. Within a run, the response of a place that arrived last stands for
the place, whole; arrival is the number in the feed, or else the landed file.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions.times import ny_now
from skylattice.operators import quality, reports
from skylattice.operators.dims import COORDS, get_or_create_date, new_dates, upsert_location
from skylattice.operators.merge import cascade_delete, cascaded, dedupe_last_wins, digest, merge_frames
from skylattice.operators.storage import (
    Change, Snapshot, days_of, hold, partition_of, pinned, read_batches, read_mart, read_stored,
    replace_partitions, sink_batch, snapshot, update, version_exists,
)
from skylattice.plans import marts
from skylattice.schemas import (
    CURRENT_METRICS, FACT_CURRENT, FACT_FORECAST, FOREIGN_KEYS, FORECAST_METRICS, TABLES, UNIQUE_KEYS,
)
from skylattice.session import materialize, scratch
from skylattice.sources.responses import flatten_current, flatten_hourly, route_rejects
from skylattice.sources.tables import schema_drift

CURRENT_ARRIVAL = ["run_id", "arrival"]
HOURLY_ARRIVAL = ["run_id", "arrival", "hour_pos"]
PLAIN_RUN = 0

# Rows of so few days are written as the merge leaves them, by key: a file of each day and task,
# in place of a second shuffle of all columns.
FEW_DAYS = 32

ARRIVAL = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("at", T.TimestampType()),
    T.StructField("file", T.StringType()), T.StructField("first", T.StringType()),
    T.StructField("mark", T.LongType()),
])

# How the two growing tables are stored: by day, forecasts also by the run they
# came from. A forecast row keeps the arrival of its response.
STORED = {
    **TABLES,
    "fact_current_weather": T.StructType(
        [*FACT_CURRENT, T.StructField("part_date", T.DateType())]
    ),
    "fact_hourly_forecast": T.StructType([
        *FACT_FORECAST, T.StructField("arrival", ARRIVAL),
        T.StructField("run_id", T.LongType()), T.StructField("part_date", T.DateType()),
    ]),
}
PARTITIONS = {
    "fact_current_weather": ["part_date"], "fact_hourly_forecast": ["run_id", "part_date"],
}
# Places lie in folders by the first digits of their coordinates' digest, a column that only the folders have.
BUCKET = "bucket"

# One row per load or build; counts that a kind of load has none of are NULL.
SUMMARY = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("total_responses", T.LongType()),
    T.StructField("successful_loads", T.LongType()),
    T.StructField("failed_loads", T.LongType()),
    T.StructField("ignored_loads", T.LongType()),
    T.StructField("total_forecasts", T.LongType()),
    T.StructField("distinct_forecasts", T.LongType()),
    T.StructField("success_rate", T.DoubleType()),
    T.StructField("rows_cleared", T.LongType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("finished_at", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables under one folder that every executor can reach."""

    spark: SparkSession
    root: str
    #: Places are stored in 16 ** bucket_digits folders; more digits are for more places and take effect as folders are rewritten.
    bucket_digits: int = 1

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def snapshot(self, table: str) -> Snapshot:
        return snapshot(self.spark, self.path(table))

    def stored(
        self, table: str, chosen: Callable[[dict[str, str]], bool] = lambda partition: True,
        at: Snapshot | None = None, **how,
    ) -> DataFrame:
        """The table as it is stored, or was ``at`` a version; one that drifted from its contract is an error."""
        return read_stored(
            self.spark, self.path(table), STORED[table], PARTITIONS.get(table, ()), chosen, at, **how
        )

    def read(self, table: str, at: Snapshot | None = None, **how) -> DataFrame:
        return self.stored(table, at=at, **how).select(*TABLES[table].names)

    def mart(self, name: str, **how) -> DataFrame:
        return read_mart(self.spark, self.path(name), marts.mart_schema(self.spark, name), **how)


@dataclass(frozen=True)
class Mark:
    """A batch of a feed whose batches come one after the other; a batch that is stored is not loaded again."""

    feed: str
    number: int


def resolve_keys(
    rows: DataFrame,
    locations: DataFrame,
    dates: DataFrame,
    time_col: str,
    columns: Sequence[str],
) -> DataFrame:
    """Fact rows: place and day replaced by their dimension ids."""
    placed = rows.join(
        locations.select("location_id", "latitude", "longitude"), ["latitude", "longitude"]
    )
    day = dates.select("date_id", "date")
    dated = placed.withColumn("date", F.to_date(time_col)).join(day, "date")
    return dated.select("location_id", "date_id", time_col, *columns)


def upsert_current(
    target: DataFrame, batch: DataFrame, now: Column,
    arrival: Sequence[str] = CURRENT_ARRIVAL,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Current readings after a batch; keyed by place and time."""
    keys = ["location_id", "observation_time"]
    return merge_frames(target, batch, keys, "weather_id", arrival, now, stage)


def upsert_forecast(
    target: DataFrame, batch: DataFrame, now: Column,
    arrival: Sequence[str] = HOURLY_ARRIVAL,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Forecast rows after a batch, earlier runs kept; keyed by place and time."""
    keys = ["location_id", "forecast_time"]
    return merge_frames(target, batch, keys, "forecast_id", arrival, now, stage)


def replace_forecast(
    target: DataFrame, batch: DataFrame, now: Column,
    arrival: Sequence[str] = HOURLY_ARRIVAL,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    winners: DataFrame | None = None,
) -> DataFrame:
    """Only the newest run's rows, of each place those of its last response.

    Both sides carry ``run_id`` and the ``arrival`` of their response. A newer run
    clears the table; an older run, or an older response of the same run, changes
    nothing. So the outcome does not depend on how a run was cut into batches.
    """
    runs = target.select("run_id").union(batch.select("run_id"))
    is_newest = F.col("run_id") == runs.agg(F.max("run_id")).scalar()
    target, batch = target.filter(is_newest), batch.filter(is_newest)
    winners = stage(newest_responses(target, batch)) if winners is None else winners
    taken = batch.join(winners, ["location_id", "arrival"])
    return merge_frames(
        target, taken.select(*batch.columns), ["location_id", "forecast_time"], "forecast_id",
        arrival, now, stage, gone=winners,
    )


def newest_responses(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``location_id, arrival`` of the responses of ``batch`` that are the last of their place.

    One row per place and task is what is shuffled, however often a place reports.
    """
    last = batch.groupBy("location_id").agg(F.max("arrival").alias("arrival"))
    stored = target.groupBy("location_id").agg(F.max("arrival").alias("_stored"))
    newer = F.col("_stored").isNull() | (F.col("arrival") > F.col("_stored"))
    return last.join(stored, "location_id", "left").filter(newer).select("location_id", "arrival")


def load_summary(
    flat: DataFrame, now: Column, rows_cleared: Column | None = None
) -> DataFrame:
    """One row on a batch: responses in, loaded, failed, and the success rate.

    For hourly responses also the hours loaded, with a repeated hour counted each
    time it came and counted once, and the rows the replacement cleared. Where
    ``flat`` has a flag ``ignored``, responses older than what is stored are
    counted apart, and neither they nor their hours count as loaded.
    """
    hourly = "hour_pos" in flat.columns
    first = F.coalesce("hour_pos", F.lit(0)) == 0 if hourly else F.lit(True)
    usable = F.col("reason").isNull()
    told = "ignored" in flat.columns
    good = usable & ~F.col("ignored") if told else usable
    counts = [
        F.count_if(first).alias("total_responses"),
        F.count_if(first & good).alias("successful_loads"),
        F.count_if(first & ~usable).alias("failed_loads"),
    ]
    if told:
        counts.append(F.count_if(first & usable & F.col("ignored")).alias("ignored_loads"))
    if hourly:
        hour = F.when(good, F.struct("latitude", "longitude", "forecast_time"))
        counts.append(F.count_if(good).alias("total_forecasts"))
        counts.append(F.count_distinct(hour).alias("distinct_forecasts"))
    total = F.col("total_responses")
    rate = F.when(total > 0, F.round(F.col("successful_loads") / total * 100, 1))
    summary = flat.agg(*counts).withColumn("success_rate", rate)
    if rows_cleared is not None:
        summary = summary.withColumn("rows_cleared", rows_cleared)
    return summary.withColumn("finished_at", now)


def _bucket(house: Warehouse) -> Column:
    return F.substring(digest(*COORDS), 1, house.bucket_digits)


def _holding(buckets: set[str]) -> Callable[[dict[str, str]], bool]:
    """Whether a folder may hold places of the buckets; one of fewer digits, or of none, holds several."""
    def holds(partition: dict[str, str]) -> bool:
        name = partition.get(BUCKET, "")
        return any(b.startswith(name) or name.startswith(b) for b in buckets)
    return holds


#: What the log notes of a folder whose ids its counter has seen.
COUNTED = {"counted": True}


def _highest_place(house: Warehouse, base: Snapshot) -> int:
    """The highest id given so far, by the counter in the log; ids that other writers have stored are looked up."""
    highest = base.notes.get("location_id", 0)
    if all(entry.get("counted") for entry in base.folders.values()):
        return highest
    return max(highest, house.stored("dim_location", at=base).agg(F.max("location_id")).first()[0] or 0)


def _update_dims(
    house: Warehouse, valid: DataFrame, time_col: str, now: Column,
    stage: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Bring places and days up to date; taken up again if another load has published in between.

    Only the buckets that the batch has places in are read and written. Returns
    the ids of the places and days of the batch, as copies that no publication clears.
    """
    # The hours of a response share its place, so one of them stands for all.
    places = valid.filter("hour_pos = 0") if "hour_pos" in valid.columns else valid
    places = stage(dedupe_last_wins(places.select("neighborhood_name", *COORDS, *CURRENT_ARRIVAL), COORDS, CURRENT_ARRIVAL))
    days = stage(valid.select(F.to_date(time_col).alias("date")).distinct())
    buckets = {row[0] for row in places.select(_bucket(house)).distinct().collect()}
    touched = _holding(buckets)

    def with_places(base: Snapshot) -> Change | None:
        if not buckets:
            return None
        stored, highest = house.stored("dim_location", touched, at=base), _highest_place(house, base)
        after = stage(upsert_location(stored, places, CURRENT_ARRIVAL, now, start=F.lit(highest)))
        top = after.agg(F.max("location_id")).first()[0] or 0
        # A counter that others have moved meanwhile is a conflict, so that no id is given twice.
        notes = {**base.notes, "location_id": top} if top > highest else None
        return Change(after.withColumn(BUCKET, _bucket(house)), touched, touched, notes=notes, noted=lambda p: COUNTED)

    def with_days(base: Snapshot) -> Change | None:
        dates = house.stored("dim_date", at=base)
        fresh = stage(new_dates(dates, days))
        return None if fresh.isEmpty() else Change(get_or_create_date(dates, fresh), lambda p: True)

    at = update(house.spark, house.path("dim_location"), with_places, [BUCKET])
    known = house.stored("dim_location", touched, at).select("location_id", *COORDS).join(places, COORDS, "left_semi")
    known = stage(known.select("location_id", *COORDS))
    at = update(house.spark, house.path("dim_date"), with_days)
    dated = house.stored("dim_date", at=at).select("date_id", "date").join(days, "date", "left_semi")
    return known, stage(dated.select("date_id", "date"))


def _replayed(house: Warehouse, table: str, kind: str, mark: Mark | None) -> DataFrame | None:
    """The report of a batch whose rows are stored already, stored once more; a feed may come back after a failure."""
    known = house.snapshot(table).marks.get(mark.feed) if mark else None
    if known is None or known["number"] < mark.number:
        return None
    if known["number"] > mark.number:
        raise ValueError(f"{mark.feed}: batch {mark.number} comes after batch {known['number']}")
    schema = T.StructType.fromJson(known["schema"])
    row = house.spark.createDataFrame([json.dumps(known["report"])], "string")
    return _report(house, kind, row.select(F.from_json("value", schema).alias("row")).select("row.*"))


def _marks(mark: Mark | None, summary: DataFrame) -> dict[str, dict]:
    """What a publication notes of a batch: its number and its report."""
    if mark is None:
        return {}
    report = json.loads(summary.toJSON().first())
    return {mark.feed: {"number": mark.number, "report": report, "schema": summary.schema.jsonValue()}}


def _report(house: Warehouse, kind: str, summary: DataFrame) -> DataFrame:
    """Store the row of a load, the last of its kind, and return it as it was."""
    row = house.spark.createDataFrame([summary.first()], summary.schema)
    full = row.withColumn("kind", F.lit(kind)).select(*[
        (F.col(f.name) if f.name in [*row.columns, "kind"] else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SUMMARY
    ])
    replace_partitions(full, house.path("load_report"), ["kind"])
    return row


def run_report(house: Warehouse) -> DataFrame:
    """The last current load, forecast load, mart builds and checks, a row each."""
    return read_stored(house.spark, house.path("load_report"), SUMMARY, ["kind"])


def load_current(
    house: Warehouse, landed: DataFrame, batch_id: str, now: Column | None = None,
    mark: Mark | None = None,
) -> DataFrame:
    """Load landed current responses; returns the summary row."""
    now = ny_now() if now is None else now
    table = "fact_current_weather"
    replayed = _replayed(house, table, "load_current", mark)
    if replayed is not None:
        return replayed
    with scratch(house.spark) as stage:
        flat = stage(flatten_current(landed))
        valid, rejects = route_rejects(flat)
        sink_batch(rejects, house.path("rejects_current"), batch_id)
        locations, dates = _update_dims(house, valid, "observation_time", now, stage)
        batch = resolve_keys(
            valid, locations, dates, "observation_time", [*CURRENT_METRICS, *CURRENT_ARRIVAL]
        ).withColumn("part_date", F.to_date("observation_time"))
        days = days_of(dates, "date")
        summary = load_summary(flat, now)
        summary = house.spark.createDataFrame([summary.first()], summary.schema)

        def merged(base: Snapshot) -> Change:
            touched = lambda partition: partition["part_date"] in days
            target = house.stored(table, touched, at=base)
            return Change(upsert_current(target, batch, now, stage=stage), read=touched, marks=_marks(mark, summary))

        update(house.spark, house.path(table), merged, PARTITIONS[table], ["location_id", "observation_time"])
        return _report(house, "load_current", summary)


def load_forecast(
    house: Warehouse, landed: DataFrame, batch_id: str, now: Column | None = None,
    clear: bool = True, mark: Mark | None = None,
) -> DataFrame:
    """Load landed hourly responses; returns the summary row.

    ``clear`` keeps only the newest run, as the scheduled job does, and of each
    place its last response; without it rows of earlier runs stay, and for the
    same place and hour the row that is loaded last stands, whatever its run. A
    run of which nothing could be loaded leaves the earlier forecast in place.

    A new run is new folders, and clearing is naming none of the old ones; more
    of the same run reads and rewrites the days it touches.
    """
    now = ny_now() if now is None else now
    table, path = "fact_hourly_forecast", house.path("fact_hourly_forecast")
    replayed = _replayed(house, table, "load_forecast", mark)
    if replayed is not None:
        return replayed
    with scratch(house.spark) as stage:
        flat = stage(flatten_hourly(landed))
        valid, rejects = route_rejects(flat)
        sink_batch(rejects, house.path("rejects_forecast"), batch_id)
        valid = valid.withColumn("run_id", F.coalesce("run_id", F.lit(PLAIN_RUN).cast("bigint")))
        locations, dates = _update_dims(house, valid, "forecast_time", now, stage)
        # Joined anew wherever it is used, of few columns but for the merge: the wide rows are not copied for it.
        batch = resolve_keys(
            valid, locations, dates, "forecast_time", [*FORECAST_METRICS, *HOURLY_ARRIVAL]
        ).withColumn("part_date", F.to_date("forecast_time"))
        places = stage(batch.select("location_id", "run_id").distinct())
        summary = None

        def summed(ignored: DataFrame, cleared: int) -> DataFrame:
            older = ignored.join(locations, "location_id").select(
                "latitude", "longitude", "run_id", F.lit(True).alias("ignored")
            )
            run = F.coalesce("run_id", F.lit(PLAIN_RUN).cast("bigint"))
            marked = flat.withColumn("run_id", run).join(older, ["latitude", "longitude", "run_id"], "left")
            told = marked.withColumn("ignored", F.coalesce("ignored", F.lit(False)))
            row = load_summary(told, now, F.lit(cleared).cast("bigint"))
            return house.spark.createDataFrame([row.first()], row.schema)

        def newest(base: Snapshot) -> Change | None:
            nonlocal summary
            change, ignored, cleared = _newest_run(house, batch, places, base, now, stage)
            summary = summed(ignored, cleared)
            return change and replace(change, marks=_marks(mark, summary))

        def added(base: Snapshot) -> Change:
            nonlocal summary
            days = days_of(dates, "date")
            touched = lambda partition: partition["part_date"] in days
            merged = upsert_forecast(house.stored(table, touched, at=base), batch, now, stage=stage)
            summary = summed(places.limit(0), 0)
            return Change(merged, touched, marks=_marks(mark, summary), in_place=len(days) <= FEW_DAYS)

        update(
            house.spark, path, newest if clear else added, PARTITIONS[table], ["location_id", "forecast_time"]
        )
        return _report(house, "load_forecast", summary)


def _newest_run(
    house: Warehouse, batch: DataFrame, places: DataFrame, base: Snapshot, now: Column,
    stage: Callable[[DataFrame], DataFrame],
) -> tuple[Change | None, DataFrame, int]:
    """What brings the stored forecast to the newest run.

    Also ``location_id, run_id`` of the ``places`` whose responses change nothing,
    and how many rows are cleared.
    """
    table = "fact_hourly_forecast"
    there = {int(partition_of(f)["run_id"]) for f in base.folders}
    newest = max([*there, *(r[0] for r in places.agg(F.max("run_id")).collect() if r[0] is not None)], default=None)
    current = batch.filter(F.col("run_id") == F.lit(newest))
    stored = house.stored(table, lambda partition: partition["run_id"] == str(newest), at=base)
    winners = stage(newest_responses(stored, current))
    ignored = stage(places.join(
        winners.select("location_id", F.lit(newest).cast("bigint").alias("run_id")),
        ["location_id", "run_id"], "left_anti",
    ))
    if winners.isEmpty():
        return None, ignored, 0
    older = lambda partition: partition["run_id"] != str(newest)
    # The days of the new rows, and those on which the places had rows before.
    taken = current.join(winners, ["location_id", "arrival"], "left_semi")
    days = days_of(taken) | days_of(stored.join(winners, "location_id", "left_semi"))
    touched = house.stored(table, lambda p: not older(p) and p["part_date"] in days, at=base)
    rows = replace_forecast(touched, current, now, stage=stage, winners=winners)
    replaced = lambda p: older(p) or p["part_date"] in days
    return Change(rows, replaced, read=lambda p: True, in_place=len(days) <= FEW_DAYS), ignored, base.rows(older)


#: Ids that Spark broadcasts by itself: 10 MB of longs. A fact without their rows is then left as it lies.
BROADCAST_IDS = 1_250_000


def delete_places(house: Warehouse, gone: DataFrame) -> None:
    """Delete the places of ``gone`` (location_id) with all that refers to them.

    Of a fact only the partitions are written anew that hold such a place; they
    are told by a scan of the two columns. Facts go before their place, so that a
    stop leaves no row without one, and once more after it, for what a load has
    stored meanwhile. Deleting again changes nothing.
    """
    with scratch(house.spark) as stage:
        gone = stage(gone.select("location_id").distinct())
        facts = [t for t, keys in FOREIGN_KEYS.items() if "location_id" in keys]
        few = gone.count() <= BROADCAST_IDS
        for table in [*facts, "dim_location", *facts]:
            if table == "dim_location":
                update(house.spark, house.path(table), lambda base: _without_places(house, gone, base), [BUCKET])
                continue
            columns = PARTITIONS.get(table, [])

            def without(base: Snapshot, table=table, columns=columns) -> Change | None:
                rows = house.stored(table, at=base)
                held = cascaded(rows, gone).select(*[F.col(c).cast("string").alias(c) for c in columns], F.lit(1).alias("one"))
                found = [{c: row[c] for c in columns} for row in held.distinct().collect()]
                if not found:
                    return None
                holds = lambda partition: partition in found
                left = cascade_delete(house.stored(table, holds, at=base), gone)
                return Change(left, holds, read=lambda p: True, in_place=few and bool(columns))

            time_col = [UNIQUE_KEYS[table][-1]] if columns else []
            update(house.spark, house.path(table), without, columns, ["location_id", *time_col] if columns else [])


def _without_places(house: Warehouse, gone: DataFrame, base: Snapshot) -> Change | None:
    """The buckets that hold deleted places without them; their ids are not given again."""
    rows, highest = house.stored("dim_location", at=base), _highest_place(house, base)
    touched = _holding({row[0] for row in cascaded(rows, gone).select(_bucket(house)).distinct().collect()})
    if not base.named(touched):
        return None
    left = cascade_delete(house.stored("dim_location", touched, at=base), gone).withColumn(BUCKET, _bucket(house))
    notes = {**base.notes, "location_id": highest}
    return Change(left, touched, lambda p: True, notes=notes, noted=lambda p: COUNTED)


#: How a mart is built: from a fact, by day of its time.
MARTS = {
    "weather_readings": (marts.weather_readings, "fact_current_weather", "observation_time_est"),
    "forecast": (marts.forecast, "fact_hourly_forecast", "forecast_time"),
}
DIMS = ("dim_location", "dim_date")


def build_marts(house: Warehouse, now: Column | None = None, whole: bool = False) -> dict[str, set[str]]:
    """Bring both marts up to date with the star tables; returns the days that were built anew.

    The star is read as it is at the start, pinned, however many loads publish
    meanwhile. A day is built again if its fact folders are others than those it
    was built from, or if a place or the day itself has changed since. ``whole``
    builds all days, as does a change of the mart's columns.
    """
    now = ny_now() if now is None else now
    built = {}
    with pinned(house.spark, house.root, [*DIMS, *(fact for _, fact, _ in MARTS.values())]) as at:
        for name in MARTS:
            built[name] = _build_mart(house, name, at, whole)
            rows = house.spark.createDataFrame([(house.snapshot(name).rows(),)], "n_rows long")
            _report(house, f"mart_{name}", rows.withColumn("finished_at", now))
    return built


def _build_mart(house: Warehouse, name: str, at: dict[str, Snapshot], whole: bool) -> set[str]:
    build, fact, time_col = MARTS[name]
    stored = T.StructType([f for f in marts.mart_schema(house.spark, name) if f.name != "date"])
    sources: dict[str, list[str]] = {}
    for folder in sorted(at[fact].folders):
        sources.setdefault(partition_of(folder)["part_date"], []).append(folder)
    stale: set[str] = set()

    def difference(base: Snapshot) -> Change | None:
        nonlocal stale
        known = {partition_of(f)["date"]: e for f, e in base.folders.items()}
        same = not any(schema_drift(T.StructType.fromJson(json.loads(x)), stored) for x in {e["schema"] for e in known.values()})
        if whole or not same or not base.notes:
            stale = {*sources, *known}
        else:
            stale = {d for d in {*sources, *base.notes["days"]} if sources.get(d) != base.notes["days"].get(d)}
            changed = _days_of_changed_dims(house, fact, base.notes["dims"], at)
            stale |= {*sources} if changed is None else changed
        if not stale and base.number:
            return None
        rows = build(
            house.stored(fact, lambda p: p["part_date"] in stale, at=at[fact]).select(*TABLES[fact].names),
            house.read("dim_location", at["dim_location"]), house.read("dim_date", at["dim_date"]),
        )
        notes = {"days": sources, "dims": {d: at[d].number for d in DIMS}}
        return Change(rows, lambda p: p["date"] in stale, read=lambda p: True, notes=notes)

    made = update(house.spark, house.path(name), difference, ["date"], ["neighborhood_name", time_col])
    if made.notes.get("dims") == {d: at[d].number for d in DIMS}:
        hold(house.spark, house.root, {d: at[d] for d in DIMS}, f"mart-{name}")
    return stale


#: What the marts do not show of a dimension.
UNSHOWN = {"dim_location": ["updated_at"], "dim_date": []}


def _days_of_changed_dims(house: Warehouse, fact: str, built: dict[str, int], at: dict[str, Snapshot]) -> set[str] | None:
    """Days with rows whose place or day is not what it was at the versions that a mart was ``built`` from.

    None if these versions are no longer there to tell.
    """
    days: set[str] = set()
    for dim, key in (("dim_location", "location_id"), ("dim_date", "date_id")):
        if built[dim] == at[dim].number:
            continue
        if not version_exists(house.spark, house.path(dim), built[dim]):
            return None
        before = house.read(dim, snapshot(house.spark, house.path(dim), built[dim]))
        shown = [c for c in before.columns if c not in UNSHOWN[dim]]
        now, before = house.read(dim, at[dim]).select(*shown), before.select(*shown)
        changed = before.exceptAll(now).select(key).distinct()
        rows = house.stored(fact, at=at[fact]).select(key, "part_date").join(changed, key, "left_semi")
        days |= days_of(rows)
    return days


def run_checks(house: Warehouse, batch_id: str, now: Column | None = None, whole: bool = False) -> DataFrame:
    """Check every table of the warehouse; violations are stored, and a row per check returned.

    What is wrong with a day is kept with the folders that it was found in. Only
    days with other folders are read again, and days that refer to a place or a
    day which has gone or was missing; the report is that of a check of all, which
    ``whole`` makes. A unique key holds its day, so that no key lies in two of them.
    """
    now = ny_now() if now is None else now
    with pinned(house.spark, house.root, list(TABLES)) as at, scratch(house.spark) as stage:
        tables = {name: house.read(name, at[name]) for name in TABLES}
        state = house.path("check_state")
        made = update(
            house.spark, state, lambda base: _checked_again(house, tables, base, at, whole), CHECK_STATE_PARTITIONS
        )
        dims = {d: at[d] for d in DIMS}
        if made.notes["dims"] == {d: s.number for d, s in dims.items()}:
            hold(house.spark, house.root, dims, "checks")
        known = read_stored(house.spark, state, CHECK_STATE, CHECK_STATE_PARTITIONS, at=made)
        failures = stage(known.groupBy(*quality.FAILURES.names[:-1]).agg(F.sum("n_rows").alias("n_rows")))
        sink_batch(failures, house.path("check_failures"), batch_id)
        report = quality.check_report(tables, failures)
        report = house.spark.createDataFrame(report.collect(), report.schema)
    total = report.agg(F.sum("n_failed").alias("n_rows")).withColumn("finished_at", now)
    _report(house, "checks", total)
    return report


#: What broke a constraint, by the day of its rows; tables that are not stored by day are one day, ``all``.
CHECK_STATE = T.StructType([*quality.FAILURES, T.StructField("checked_day", T.StringType())])
CHECK_STATE_PARTITIONS = ["table_name", "checked_day"]


def _check_day(partition: dict[str, str]) -> str:
    day = partition.get("part_date", "all")
    return "none" if day.startswith("__HIVE") else day


def _checked_again(
    house: Warehouse, tables: dict[str, DataFrame], base: Snapshot, at: dict[str, Snapshot], whole: bool
) -> Change | None:
    """The state of the checks after what has changed since ``base`` was checked; None if nothing has."""
    sources: dict[str, dict[str, list[str]]] = {name: {} for name in TABLES}
    for name in TABLES:
        for folder in sorted(at[name].folders):
            sources[name].setdefault(_check_day(partition_of(folder)), []).append(folder)
    known = base.notes.get("days", {name: {} for name in TABLES})
    days = {name: {*sources[name], *known[name]} for name in TABLES}
    if not whole and base.number:
        moved = _days_of_moved_keys(house, tables, base, at)
        days = {
            name: {d for d in days[name] if sources[name].get(d) != known[name].get(d) or d in moved.get(name, days[name])}
            for name in TABLES
        }
    if base.number and not any(days.values()):
        return None
    parts = {}
    for name in TABLES:
        day = F.coalesce(F.col("part_date").cast("string"), F.lit("none")) if name in PARTITIONS else F.lit("all")
        if days[name]:
            rows = house.stored(name, lambda p, name=name: _check_day(p) in days[name], at=at[name])
            parts[name] = rows.withColumn("checked_day", day).select(*TABLES[name].names, "checked_day")
    found = quality.violations(parts or {n: df.limit(0).withColumn("checked_day", F.lit("all")) for n, df in tables.items()}, ["checked_day"], tables)
    notes = {"days": sources, "dims": {d: at[d].number for d in DIMS}}
    return Change(found, lambda p: p["checked_day"] in days[p["table_name"]], read=lambda p: True, notes=notes)


def _days_of_moved_keys(
    house: Warehouse, tables: dict[str, DataFrame], base: Snapshot, at: dict[str, Snapshot]
) -> dict[str, set[str]]:
    """Days of each fact with rows whose place or day has gone since ``base``, or was missing then.

    A fact is left out if the versions of that time are no longer there to tell.
    """
    state = read_stored(house.spark, house.path("check_state"), CHECK_STATE, CHECK_STATE_PARTITIONS, at=base)
    days: dict[str, set[str]] = {name: set() for name in TABLES}
    for fact, keys in FOREIGN_KEYS.items():
        for key, dim in keys.items():
            before = base.notes["dims"][dim]
            if before == at[dim].number:
                continue
            if not version_exists(house.spark, house.path(dim), before):
                days.pop(fact, None)
                break
            missing = state.filter((F.col("table_name") == fact) & (F.col("check_name") == "foreign_key") & (F.col("column_name") == key))
            days[fact] |= days_of(missing, "checked_day")
            gone = house.read(dim, snapshot(house.spark, house.path(dim), before)).select(key)
            gone = gone.join(tables[dim].select(key), key, "left_anti")
            if not gone.isEmpty():
                day = F.coalesce(F.col("part_date").cast("string"), F.lit("none")) if fact in PARTITIONS else F.lit("all")
                rows = house.stored(fact, at=at[fact]).withColumn("checked_day", day).select(key, "checked_day")
                days[fact] |= days_of(rows.join(gone, key, "left_semi"), "checked_day")
    return days


def latest_readings(house: Warehouse, stage: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """The newest reading of every neighbourhood name, from the last days of the stored mart."""
    at = house.snapshot("weather_readings")
    built = at.notes.get("dims", {}).get("dim_location", 0)
    if not at.number or not version_exists(house.spark, house.path("dim_location"), built):
        return reports.latest_per_neighborhood(house.mart("weather_readings", at=at))
    # All names that the mart shows are those of the places that it was built from.
    places = house.read("dim_location", snapshot(house.spark, house.path("dim_location"), built))
    return reports.latest_by_day(
        {partition_of(f)["date"] for f in at.folders},
        lambda days: house.mart("weather_readings", at=at, chosen=lambda p: p["date"] in days), places, stage,
    )


def forecast_horizon(
    house: Warehouse, days: int, stage: Callable[[DataFrame], DataFrame] = materialize
) -> DataFrame:
    """What the forecast page shows of the next ``days`` days of every neighbourhood."""
    page = house.mart("forecast").select(*reports.FORECAST_PAGE, "date")
    return reports.filter_horizon(page, days, stage, "date").select(*reports.FORECAST_PAGE)


def read_rejects(house: Warehouse, feed: str) -> DataFrame:
    """Stored rejects of ``current`` or ``forecast`` responses, with their batch."""
    return read_batches(house.spark, house.path(f"rejects_{feed}"), REJECTS)


def read_failures(house: Warehouse) -> DataFrame:
    """Stored rows that failed a check, with their batch."""
    return read_batches(house.spark, house.path("check_failures"), quality.FAILURES)


REJECTS = T.StructType([
    T.StructField("neighborhood_name", T.StringType()),
    T.StructField("latitude", T.DecimalType(9, 6)), T.StructField("longitude", T.DecimalType(9, 6)),
    T.StructField("run_id", T.LongType()), T.StructField("arrival_seq", T.LongType()),
    T.StructField("reason", T.StringType()),
])
