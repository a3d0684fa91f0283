"""Star joins, categories and the two marts.

Dimensions are joined by plain equality. The optimizer broadcasts a dimension
read from storage if its files are under the threshold, and otherwise shuffles
and splits hot keys; nothing here forces either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions import (
    c_to_f, cardinal_8, comfort_level, is_freezing, is_precipitating, is_snowing, is_windy,
    precip_type, temp_category, temperature_category, visibility_category, weather_condition,
    wind_category_forecast, wind_category_mph,
)
from skylattice.plans.staging import (
    stg_current_weather, stg_dates, stg_hourly_forecast, stg_locations,
)
from skylattice.schemas import FORECAST, TABLES, WEATHER_READINGS


def _star_join(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return rows.join(dim, key).select(*rows.columns, *[c for c in dim.columns if c != key])


def join_current_location(current: DataFrame, locations: DataFrame) -> DataFrame:
    return _star_join(current, locations, "location_id")


def join_current_date(current: DataFrame, dates: DataFrame) -> DataFrame:
    return _star_join(current, dates, "date_id")


def join_forecast_location(forecast: DataFrame, locations: DataFrame) -> DataFrame:
    """The forecast's own ``created_at`` gives way to the location's."""
    return _star_join(forecast.drop("created_at"), locations, "location_id")


def join_forecast_date(forecast: DataFrame, dates: DataFrame) -> DataFrame:
    return _star_join(forecast, dates, "date_id")


def int_weather_categorized(joined: DataFrame) -> DataFrame:
    col = F.col
    return joined.withColumns({
        "temp_category": temp_category(col("temp_celsius")),
        "weather_condition": weather_condition(col("weather_code")),
        "wind_category": wind_category_mph(col("wind_speed_mph")),
        "precip_type": precip_type(
            col("total_precip_mm"), col("rain_mm"), col("showers_mm"), col("snowfall_mm")
        ),
        "is_precipitating": is_precipitating(col("total_precip_mm")),
        "is_snowing": is_snowing(col("snowfall_mm")),
        "is_freezing": is_freezing(col("temp_celsius")),
        "is_windy": is_windy(col("wind_speed_mph")),
        "comfort_level": comfort_level(col("feels_like_fahrenheit")),
    })


def int_forecast_add_categories(joined: DataFrame, unit: str = "C") -> DataFrame:
    col = F.col
    feels = col("apparent_temperature")
    derived = joined.withColumns({
        "temp_fahrenheit_2m": c_to_f(col("temperature_2m")),
        "feels_like_fahrenheit": c_to_f(feels),
        **{f"temp_fahrenheit_{m}m": c_to_f(col(f"temperature_{m}m")) for m in (80, 120, 180)},
        "temperature_category": temperature_category(feels, unit),
        "wind_category": wind_category_forecast(col("wind_speed_10m")),
        "wind_direction_cardinal": cardinal_8(col("wind_direction_10m")),
        "visibility_category": visibility_category(col("visibility")),
    })
    return derived.withColumnsRenamed({
        "temperature_2m": "temp_celsius_2m",
        "apparent_temperature": "feels_like_celsius",
        **{f"temperature_{m}m": f"temp_celcius_{m}m" for m in (80, 120, 180)},
    })


def weather_readings(fact: DataFrame, locations: DataFrame, dates: DataFrame) -> DataFrame:
    current = join_current_location(stg_current_weather(fact), stg_locations(locations))
    dated = join_current_date(current, stg_dates(dates))
    return int_weather_categorized(dated).select(*WEATHER_READINGS)


def forecast(
    fact: DataFrame, locations: DataFrame, dates: DataFrame, unit: str = "C"
) -> DataFrame:
    placed = join_forecast_location(stg_hourly_forecast(fact), stg_locations(locations))
    dated = join_forecast_date(placed, stg_dates(dates))
    return int_forecast_add_categories(dated, unit).select(*FORECAST)


def mart_schema(spark: SparkSession, name: str) -> T.StructType:
    """Columns and types of a mart; nothing is run for it."""
    build, fact = {
        "weather_readings": (weather_readings, "fact_current_weather"),
        "forecast": (forecast, "fact_hourly_forecast"),
    }[name]
    empty = (spark.createDataFrame([], TABLES[t]) for t in (fact, "dim_location", "dim_date"))
    return build(*empty).schema


def view_layer(
    current: DataFrame, hourly: DataFrame, locations: DataFrame, dates: DataFrame, prefix: str = ""
) -> list[str]:
    """Register every model as a temporary view, so it can be used from SQL."""
    stg = stg_current_weather(current)
    cur_loc = join_current_location(stg, stg_locations(locations))
    cur_date = join_current_date(cur_loc, stg_dates(dates))
    categorized = int_weather_categorized(cur_date)
    hourly_stg = stg_hourly_forecast(hourly)
    fc_loc = join_forecast_location(hourly_stg, stg_locations(locations))
    fc_date = join_forecast_date(fc_loc, stg_dates(dates))
    categories = int_forecast_add_categories(fc_date)
    views = {
        "stg_current_weather": stg,
        "stg_hourly_forecast": hourly_stg,
        "stg_locations": stg_locations(locations),
        "stg_dates": stg_dates(dates),
        "int_weather_joined_locations": cur_loc,
        "int_weather_joined_locations_and_dates": cur_date,
        "int_weather_categorized": categorized,
        "int_forecast_joined_locations": fc_loc,
        "int_forecast_joined_locations_and_dates": fc_date,
        "int_forecast_add_categories": categories,
        "weather_readings": categorized.select(*WEATHER_READINGS),
        "forecast": categories.select(*FORECAST),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]
