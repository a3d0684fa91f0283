"""Source tables with their published names and units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.functions import c_to_f, day_night, mps_to_mph
from skylattice.schemas import DIM_DATE, DIM_LOCATION, FACT_FORECAST, FACT_HISTORY


def stg_current_weather(fact: DataFrame) -> DataFrame:
    col = F.col
    published = {
        "weather_id": col("weather_id"),
        "location_id": col("location_id"),
        "date_id": col("date_id"),
        "observation_time_est": col("observation_time"),
        "temp_celsius": col("temperature_2m"),
        "temp_fahrenheit": c_to_f(col("temperature_2m")),
        "feels_like_celsius": col("apparent_temperature"),
        "feels_like_fahrenheit": c_to_f(col("apparent_temperature")),
        "humidity_percent": col("relative_humidity_2m"),
        "wind_speed_mps": col("wind_speed_10m"),
        "wind_speed_mph": mps_to_mph(col("wind_speed_10m")),
        "wind_direction_degrees": col("wind_direction_10m"),
        "wind_gusts_mps": col("wind_gusts_10m"),
        "total_precip_mm": col("precipitation"),
        "rain_mm": col("rain"),
        "showers_mm": col("showers"),
        "snowfall_mm": col("snowfall"),
        "weather_code": col("weather_code"),
        "cloud_cover_percent": col("cloud_cover"),
        "day_night": day_night(col("is_day")),
        "pressure_sea_level_hpa": col("pressure_msl"),
        "pressure_surface_hpa": col("surface_pressure"),
        "loaded_at_est": col("created_at"),
    }
    return fact.select(*[value.alias(name) for name, value in published.items()])


def stg_hourly_forecast(fact: DataFrame) -> DataFrame:
    return fact.select(*FACT_FORECAST.names)


def stg_weather_history(fact: DataFrame) -> DataFrame:
    return fact.select(*FACT_HISTORY.names)


def stg_locations(locations: DataFrame) -> DataFrame:
    return locations.select(*DIM_LOCATION.names)


def stg_dates(dates: DataFrame) -> DataFrame:
    return dates.select(*DIM_DATE.names)
