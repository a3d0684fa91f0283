"""Table contracts, landed-file schemas and output column orders (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, STR, BOOL, DATE = (
    T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.DateType(),
)
WALL = T.TimestampNTZType()  # local wall clock, no zone
COORD = T.DecimalType(9, 6)
D5, D6, D7, D8 = (T.DecimalType(p, 2) for p in (5, 6, 7, 8))


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Metric names and widths, in table order.
CURRENT_METRICS: dict[str, T.DataType] = {
    "temperature_2m": D5,
    "apparent_temperature": D5,
    "relative_humidity_2m": D5,
    "wind_speed_10m": D6,
    "wind_direction_10m": D5,
    "wind_gusts_10m": D6,
    "precipitation": D6,
    "rain": D6,
    "showers": D6,
    "snowfall": D6,
    "weather_code": INT,
    "cloud_cover": D5,
    "is_day": INT,
    "pressure_msl": D7,
    "surface_pressure": D7,
}

FORECAST_METRICS: dict[str, T.DataType] = {
    "temperature_2m": D5,
    "relative_humidity_2m": D5,
    "dew_point_2m": D5,
    "apparent_temperature": D5,
    "temperature_80m": D5,
    "temperature_120m": D5,
    "temperature_180m": D5,
    "precipitation_probability": D5,
    "precipitation": D6,
    "rain": D6,
    "showers": D6,
    "snowfall": D6,
    "snow_depth": D6,
    "weather_code": INT,
    "pressure_msl": D7,
    "surface_pressure": D7,
    "cloud_cover": D5,
    "cloud_cover_low": D5,
    "cloud_cover_mid": D5,
    "cloud_cover_high": D5,
    "visibility": D8,
    "evapotranspiration": D6,
    "et0_fao_evapotranspiration": D6,
    "vapour_pressure_deficit": D6,
    "wind_speed_10m": D6,
    "wind_direction_10m": D5,
    "wind_gusts_10m": D6,
    "wind_speed_80m": D6,
    "wind_direction_80m": D5,
    "wind_speed_120m": D6,
    "wind_direction_120m": D5,
    "wind_speed_180m": D6,
    "wind_direction_180m": D5,
}

DIM_LOCATION = _struct({
    "location_id": INT,
    "neighborhood_name": STR,
    "latitude": COORD,
    "longitude": COORD,
    "timezone": STR,
    "created_at": WALL,
    "updated_at": WALL,
})

DIM_DATE = _struct({
    "date_id": INT,
    "date": DATE,
    "year": INT,
    "month": INT,
    "day": INT,
    "day_of_week": INT,
    "day_name": STR,
    "week_of_year": INT,
    "quarter": INT,
    "is_weekend": BOOL,
    "is_holiday": BOOL,
})


def _fact(id_col: str, time_col: str, metrics: dict[str, T.DataType]) -> T.StructType:
    return _struct({
        id_col: LONG, "location_id": INT, "date_id": INT, time_col: WALL,
        **metrics, "created_at": WALL,
    })


FACT_CURRENT = _fact("weather_id", "observation_time", CURRENT_METRICS)
FACT_FORECAST = _fact("forecast_id", "forecast_time", FORECAST_METRICS)

# Same columns and order as the current fact, under another id.
FACT_HISTORY = _fact("history_id", "observation_time", CURRENT_METRICS)

TABLES: dict[str, T.StructType] = {
    "dim_location": DIM_LOCATION,
    "dim_date": DIM_DATE,
    "fact_current_weather": FACT_CURRENT,
    "fact_hourly_forecast": FACT_FORECAST,
    "fact_weather_history": FACT_HISTORY,
}

# Declared constraints.
UNIQUE_KEYS = {
    "dim_location": ["latitude", "longitude"],
    "dim_date": ["date"],
    "fact_current_weather": ["location_id", "observation_time"],
    "fact_hourly_forecast": ["location_id", "forecast_time"],
}
NOT_NULL = {
    "dim_location": ["location_id", "neighborhood_name", "latitude", "longitude"],
    "dim_date": ["date_id", "date", "year", "month", "day", "day_of_week", "day_name",
                 "week_of_year", "quarter", "is_weekend"],
    "fact_current_weather": ["weather_id", "location_id", "date_id", "observation_time"],
    "fact_hourly_forecast": ["forecast_id", "location_id", "date_id", "forecast_time"],
}
FOREIGN_KEYS = {
    name: {"location_id": "dim_location", "date_id": "dim_date"}
    for name in ("fact_current_weather", "fact_hourly_forecast", "fact_weather_history")
}
NAME_LIMIT = 100
DEFAULT_TIMEZONE = "America/New_York"

# Landed files. Numbers are read as text so that a value too wide for its column
# can be told from a missing one. run_id orders the fetch runs and arrival_seq
# the responses within a run; both may be absent.
CORRUPT = "_corrupt_record"


def _landed(payload: str, body: T.StructType) -> T.StructType:
    return _struct({
        "neighborhood_name": STR, "latitude": STR, "longitude": STR,
        "run_id": LONG, "arrival_seq": LONG, payload: body, CORRUPT: STR,
    })


LANDED_CURRENT = _landed(
    "weather_data",
    _struct({"current": _struct({"time": STR, **dict.fromkeys(CURRENT_METRICS, STR)})}),
)
LANDED_HOURLY = _landed(
    "forecast_data",
    _struct({"hourly": _struct(dict.fromkeys(["time", *FORECAST_METRICS], T.ArrayType(STR)))}),
)
LOCATION_LIST = _struct({
    "city": STR,
    "state": STR,
    "neighborhoods": T.ArrayType(_struct({"name": STR, "latitude": COORD, "longitude": COORD})),
})
FEATURE = _struct({"properties": T.MapType(STR, STR), "geometry": STR})
FEATURE_COLLECTION = _struct({"features": T.ArrayType(FEATURE)})

# Output column orders.
LOCATION_DETAILS = ["neighborhood_name", "latitude", "longitude", "timezone"]
DATE_DETAILS = ["date", "year", "month", "day", "day_of_week", "day_name", "week_of_year",
                "quarter", "is_weekend", "is_holiday"]

WEATHER_READINGS = [
    "weather_id", "location_id", "date_id",
    *LOCATION_DETAILS,
    *DATE_DETAILS,
    "observation_time_est", "loaded_at_est",
    "temp_celsius", "temp_fahrenheit", "feels_like_celsius", "feels_like_fahrenheit",
    "temp_category",
    "weather_code", "weather_condition", "cloud_cover_percent", "day_night",
    "wind_speed_mps", "wind_speed_mph", "wind_direction_degrees", "wind_gusts_mps",
    "wind_category", "is_windy",
    "total_precip_mm", "rain_mm", "showers_mm", "snowfall_mm", "precip_type",
    "is_precipitating", "is_snowing",
    "humidity_percent", "pressure_sea_level_hpa", "pressure_surface_hpa",
    "comfort_level", "is_freezing",
    "created_at", "updated_at",
]

# "celcius" in the altitude columns is part of the published column names.
FORECAST = [
    "forecast_id", "location_id", "date_id",
    "forecast_time", *LOCATION_DETAILS,
    *DATE_DETAILS,
    "temp_celsius_2m", "temp_fahrenheit_2m", "feels_like_celsius", "feels_like_fahrenheit",
    "relative_humidity_2m", "dew_point_2m",
    "temp_celcius_80m", "temp_fahrenheit_80m", "temp_celcius_120m", "temp_fahrenheit_120m",
    "temp_celcius_180m", "temp_fahrenheit_180m",
    "precipitation_probability", "precipitation", "rain", "showers", "snowfall", "snow_depth",
    "pressure_msl", "surface_pressure",
    "cloud_cover", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high",
    "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
    "wind_speed_80m", "wind_direction_80m",
    "wind_speed_120m", "wind_direction_120m",
    "wind_speed_180m", "wind_direction_180m",
    "visibility", "weather_code",
    "evapotranspiration", "et0_fao_evapotranspiration", "vapour_pressure_deficit",
    "temperature_category", "wind_category", "wind_direction_cardinal", "visibility_category",
    "created_at", "updated_at",
]
