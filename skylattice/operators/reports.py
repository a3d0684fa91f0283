"""What the map and the forecast page read from the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions import (
    cardinal_16, display_group, hpa_to_inhg, last_updated_text, m_to_miles, temp_color,
)

# Columns and labels of the two pages.
LATEST = [
    "neighborhood_name", "temp_fahrenheit", "feels_like_fahrenheit", "weather_condition",
    "cloud_cover_percent", "wind_speed_mph", "wind_direction_degrees", "wind_gusts_mps",
    "humidity_percent", "pressure_sea_level_hpa", "observation_time_est", "latitude", "longitude",
    "weather_code", "day_night", "total_precip_mm", "is_precipitating",
]
CURRENT_TABLE = {
    "neighborhood_name": "Neighborhood",
    "temp_fahrenheit": "Temp (°F)",
    "feels_like_fahrenheit": "Feels Like (°F)",
    "weather_condition": "Condition",
    "cloud_cover_percent": "Cloud Cover (%)",
    "wind_speed_mph": "Wind (mph)",
    "humidity_percent": "Humidity (%)",
    "observation_time_est": "Observation Time",
}
FORECAST_PAGE = [
    "neighborhood_name", "forecast_time", "temp_fahrenheit_2m", "feels_like_fahrenheit", "rain",
    "showers", "snowfall", "snow_depth", "surface_pressure", "cloud_cover", "visibility",
    "precipitation_probability", "updated_at",
]
METRICS = {
    "Temperature (°F)": "temp_fahrenheit_2m",
    "Feels Like (°F)": "feels_like_fahrenheit",
    "Precipitation Probability (%)": "precipitation_probability",
    "Rain (mm)": "rain",
    "Snowfall (mm)": "snowfall",
    "Cloud Cover (%)": "cloud_cover",
    "Visibility (m)": "visibility",
    "Surface Pressure (hPa)": "surface_pressure",
}
HORIZONS = range(1, 8)
POPUP = [
    "temp_fahrenheit", "feels_like_fahrenheit", "weather_condition", "cloud_cover_percent",
    "wind_speed_mph", "humidity_percent", "observation_time_est",
]


def latest_per_neighborhood(readings: DataFrame) -> DataFrame:
    """The newest reading of every neighbourhood name; the higher id breaks a tie.

    Each task passes on one row per name, so a name that holds much of the
    table is no slower than the rest.
    """
    newest = Window.partitionBy("neighborhood_name").orderBy(
        F.col("observation_time_est").desc(), F.col("weather_id").desc()
    )
    ranked = readings.select("weather_id", *LATEST).withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).select(*LATEST)


def latest_by_day(
    days: Iterable[str], read: Callable[[set[str]], DataFrame], places: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``latest_per_neighborhood`` of readings that are stored by the day of their time.

    ``read`` gives the rows of some days. They are read from the last day
    backwards, one day first and twice as many each time, without the names found
    already, until all names of ``places`` are found or no day is left: as many
    steps as the doubling takes, and no older day while all places report. A
    place that has never reported makes it read all days.
    """
    left, parts, size = stage(places.select("neighborhood_name").distinct()), [], 1
    order = sorted(days, reverse=True)
    while order and (not parts or not left.isEmpty()):
        group, order, size = set(order[:size]), order[size:], 2 * size
        rows = read(group)
        # A name that is NULL is one of its own.
        rows = rows.join(left.select(F.col("neighborhood_name").alias("_name")), F.col("neighborhood_name").eqNullSafe(F.col("_name")), "left_semi")
        parts.append(stage(latest_per_neighborhood(rows)))
        known = parts[-1].select(F.col("neighborhood_name").alias("_name"))
        left = stage(left.join(known, F.col("neighborhood_name").eqNullSafe(F.col("_name")), "left_anti"))
    return reduce(DataFrame.union, parts) if parts else latest_per_neighborhood(read(set()))


def current_table(latest: DataFrame) -> DataFrame:
    return latest.select(*[F.col(c).alias(label) for c, label in CURRENT_TABLE.items()])


def filter_neighborhood(mart: DataFrame, name: str) -> DataFrame:
    return mart.filter(F.col("neighborhood_name") == name)


def series_start(forecast: DataFrame) -> DataFrame:
    """First forecast time of every neighbourhood."""
    return forecast.groupBy("neighborhood_name").agg(F.min("forecast_time").alias("series_start"))


def current_card(latest: DataFrame) -> DataFrame:
    """What the card of current conditions shows of every place.

    Readings hold no visibility or dew point, so both are NULL unless ``latest``
    has a column of that name.
    """
    def given(name: str):
        return F.col(name) if name in latest.columns else F.lit(None).cast("decimal(8,2)")

    return latest.select(
        "neighborhood_name",
        display_group(F.col("weather_code")).alias("display_group"),
        "temp_fahrenheit", "weather_condition", "feels_like_fahrenheit",
        "wind_speed_mph", cardinal_16(F.col("wind_direction_degrees")).alias("wind_direction"),
        "humidity_percent", hpa_to_inhg(F.col("pressure_sea_level_hpa")).alias("pressure_in"),
        "cloud_cover_percent", m_to_miles(given("visibility")).alias("visibility_mi"),
        given("dew_point_fahrenheit").alias("dew_point_fahrenheit"),
    )


def filter_horizon(
    forecast: DataFrame, days: int,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df, date: str | None = None,
) -> DataFrame:
    """Rows within ``days`` days of their neighbourhood's first hour, end excluded.

    The starts are aggregated and joined back rather than taken over a window,
    which would sort each neighbourhood whole in one task. Nothing runs before
    the result is asked for, unless the caller's ``stage`` writes the starts out,
    from whose true size the join is then planned. If ``date`` names a column with
    the day of each row, which a stored mart is partitioned by, only the days from
    the first start to the last end are read; they are told when the scan begins.
    """
    if days not in HORIZONS:
        raise ValueError(f"days must be in {HORIZONS.start}..{HORIZONS.stop - 1}")
    starts = stage(series_start(forecast))
    cutoff = F.col("series_start") + F.make_dt_interval(days=F.lit(days))
    if date is not None:
        first = starts.agg(F.to_date(F.min("series_start"))).scalar()
        last = starts.agg(F.to_date(F.max(cutoff))).scalar()
        forecast = forecast.filter((F.col(date) >= first) & (F.col(date) <= last))
    joined = forecast.join(starts, "neighborhood_name").filter(F.col("forecast_time") < cutoff)
    return joined.select(*forecast.columns)


def metric_series(forecast: DataFrame, label: str) -> DataFrame:
    """One metric, by its label on the page, over time."""
    return forecast.select(
        "neighborhood_name", "forecast_time", F.col(METRICS[label]).alias("value")
    )


def metric_long(forecast: DataFrame) -> DataFrame:
    """All metrics of the page as ``metric, value`` rows."""
    keys = ["neighborhood_name", "forecast_time"]
    values = [F.col(c).cast("decimal(12,2)").alias(label) for label, c in METRICS.items()]
    return forecast.select(*keys, *values).unpivot(keys, list(METRICS), "metric", "value")


def forecast_ordered(forecast: DataFrame) -> DataFrame:
    return forecast.select(*FORECAST_PAGE).orderBy("neighborhood_name", "forecast_time")


def distinct_neighborhoods(mart: DataFrame) -> DataFrame:
    return mart.select("neighborhood_name").distinct().orderBy("neighborhood_name")


def last_updated(mart: DataFrame) -> DataFrame:
    """Newest ``updated_at`` and its caption."""
    newest = mart.agg(F.max("updated_at").alias("last_updated"))
    return newest.withColumn("caption", last_updated_text(F.col("last_updated")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def join_feature_weather(features: DataFrame, latest: DataFrame) -> DataFrame:
    """Every polygon with the weather of the place it is named after, or none."""
    weather = latest.select(
        F.col("neighborhood_name").alias("hood"), *POPUP, "wind_direction_degrees",
        F.lit(True).alias("matched"),
    )
    joined = features.join(weather, "hood", "left")
    return joined.select(
        *features.columns,
        F.coalesce("matched", F.lit(False)).alias("has_data"),
        temp_color(F.col("temp_fahrenheit")).alias("fill_color"),
        *POPUP,
        F.when(F.col("matched"), cardinal_16(F.col("wind_direction_degrees"))).alias("wind_direction"),
    )
