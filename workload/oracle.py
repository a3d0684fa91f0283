"""The same results in SQL, written from the published rules, for DuckDB."""

from __future__ import annotations

import re

from skylattice.operators.reports import CURRENT_TABLE, FORECAST_PAGE, LATEST, METRICS, POPUP
from skylattice.schemas import (
    CURRENT_METRICS, DATE_DETAILS, DIM_DATE, DIM_LOCATION, FACT_CURRENT, FACT_FORECAST,
    FACT_HISTORY, FORECAST, FORECAST_METRICS, LOCATION_DETAILS, TABLES, WEATHER_READINGS,
)
from workload import landing
from workload.queries import NOW
from workload.tables import CTE, LINE_ARRIVAL, WITHIN_A_MONTH

# Columns that are decimals on both sides and leave as doubles.
DECIMALS = {
    *CURRENT_METRICS, *FORECAST_METRICS, "latitude", "longitude",
    "temp_celsius", "temp_fahrenheit", "feels_like_celsius", "feels_like_fahrenheit",
    "humidity_percent", "wind_speed_mps", "wind_speed_mph", "wind_direction_degrees",
    "wind_gusts_mps", "total_precip_mm", "rain_mm", "showers_mm", "snowfall_mm",
    "cloud_cover_percent", "pressure_sea_level_hpa", "pressure_surface_hpa",
    "temp_celsius_2m", "temp_fahrenheit_2m", *[
        f"temp_{unit}_{m}m" for unit in ("celcius", "fahrenheit") for m in (80, 120, 180)
    ],
    "pressure_in", "visibility_mi", "value",
} - {"weather_code", "is_day"}


def out(columns, source: str) -> str:
    """Final projection: decimals as doubles."""
    listed = [f"CAST({c} AS DOUBLE) AS {c}" if c in DECIMALS else c for c in columns]
    return f"SELECT {', '.join(listed)} FROM {source}"


def cols(names, alias: str = "") -> str:
    return ", ".join(f"{alias}.{n}" if alias else n for n in names)


# Fixed values down to the captions: the published columns, limits, codes and labels.
STG_CURRENT = [
    "weather_id", "location_id", "date_id", "observation_time_est", "temp_celsius",
    "temp_fahrenheit", "feels_like_celsius", "feels_like_fahrenheit", "humidity_percent",
    "wind_speed_mps", "wind_speed_mph", "wind_direction_degrees", "wind_gusts_mps",
    "total_precip_mm", "rain_mm", "showers_mm", "snowfall_mm", "weather_code",
    "cloud_cover_percent", "day_night", "pressure_sea_level_hpa", "pressure_surface_hpa",
    "loaded_at_est",
]
PLACE_COLUMNS = [*LOCATION_DETAILS, "created_at", "updated_at"]
CATEGORIES = ["temp_category", "weather_condition", "wind_category", "precip_type",
              "is_precipitating", "is_snowing", "is_freezing", "is_windy", "comfort_level"]
FORECAST_ROW = [c for c in FACT_FORECAST.names if c != "created_at"]


def in_f(column: str) -> str:
    return f"round({column} * 1.8 + 32, 1)"


FEELS = """CASE WHEN {0} < 32 THEN 'Freezing' WHEN {0} < 50 THEN 'Cold' WHEN {0} < 65 THEN 'Cool'
    WHEN {0} < 75 THEN 'Comfortable' WHEN {0} < 85 THEN 'Warm' ELSE 'Hot' END"""
WIND_FORECAST = """CASE WHEN wind_speed_10m < 5 THEN 'Calm' WHEN wind_speed_10m < 15 THEN 'Breezy'
    WHEN wind_speed_10m < 25 THEN 'Windy' ELSE 'Very Windy' END"""
CARDINAL_8 = """CASE
    WHEN {0} >= 0 AND {0} <= 22.5 OR {0} >= 337.5 AND {0} <= 360 THEN 'N'
    WHEN {0} >= 22.5 AND {0} <= 67.5 THEN 'NE' WHEN {0} >= 67.5 AND {0} <= 112.5 THEN 'E'
    WHEN {0} >= 112.5 AND {0} <= 157.5 THEN 'SE' WHEN {0} >= 157.5 AND {0} <= 202.5 THEN 'S'
    WHEN {0} >= 202.5 AND {0} <= 247.5 THEN 'SW' WHEN {0} >= 247.5 AND {0} <= 292.5 THEN 'W'
    WHEN {0} >= 292.5 AND {0} <= 337.5 THEN 'NW' END""".format("wind_direction_10m")
VISIBILITY = """CASE WHEN visibility >= 10000 THEN 'Excellent' WHEN visibility >= 5000 THEN 'Good'
    WHEN visibility >= 2000 THEN 'Moderate' ELSE 'Poor' END"""
DAY_NIGHT = "CASE is_day WHEN 1 THEN 'Day' WHEN 0 THEN 'Night' ELSE 'Unknown' END"
TEMP_CATEGORY = """CASE WHEN temp_celsius < 0 THEN 'Freezing' WHEN temp_celsius < 10 THEN 'Cold'
    WHEN temp_celsius < 20 THEN 'Mild' WHEN temp_celsius < 30 THEN 'Warm' ELSE 'Hot' END"""
CONDITION = """CASE WHEN weather_code = 0 THEN 'Clear sky'
    WHEN weather_code BETWEEN 1 AND 3 THEN 'Partly cloudy'
    WHEN weather_code IN (45, 48) THEN 'Foggy'
    WHEN weather_code IN (51, 53, 55, 56, 57) THEN 'Drizzle'
    WHEN weather_code IN (61, 63, 65, 66, 67) THEN 'Rain'
    WHEN weather_code IN (71, 73, 75, 77) THEN 'Snow'
    WHEN weather_code BETWEEN 80 AND 82 THEN 'Rain showers'
    WHEN weather_code IN (85, 86) THEN 'Snow showers'
    WHEN weather_code IN (95, 96, 99) THEN 'Thunderstorm' ELSE 'Unknown' END"""
WIND_MPH = """CASE WHEN wind_speed_mph < 1 THEN 'Calm' WHEN wind_speed_mph < 8 THEN 'Light air'
    WHEN wind_speed_mph < 13 THEN 'Light breeze' WHEN wind_speed_mph < 25 THEN 'Moderate breeze'
    WHEN wind_speed_mph < 39 THEN 'Strong breeze' ELSE 'High wind' END"""
PRECIP = """CASE WHEN snowfall_mm > 0 THEN 'Snow' WHEN rain_mm > 0 THEN 'Rain'
    WHEN showers_mm > 0 THEN 'Showers' WHEN total_precip_mm > 0 THEN 'Other precipitation'
    ELSE 'No precipitation' END"""
COMFORT = """CASE WHEN feels_like_fahrenheit < 32 THEN 'Very uncomfortable (freezing)'
    WHEN feels_like_fahrenheit < 50 THEN 'Uncomfortable (cold)'
    WHEN feels_like_fahrenheit < 65 THEN 'Cool' WHEN feels_like_fahrenheit < 75 THEN 'Comfortable'
    WHEN feels_like_fahrenheit < 85 THEN 'Warm' ELSE 'Uncomfortable (hot)' END"""
CARDINAL_16 = """CASE WHEN wind_direction_degrees IS NULL THEN 'N/A' ELSE
    ['N', 'NNE', 'NE', 'ENE', 'E', 'ESE', 'SE', 'SSE', 'S', 'SSW', 'SW', 'WSW', 'W', 'WNW', 'NW',
     'NNW'][1 + CAST(floor((CAST(wind_direction_degrees AS DOUBLE) + 11.25) / 22.5) AS INT) % 16]
    END"""
DISPLAY = """CASE WHEN weather_code IN (71, 73, 75, 77, 85, 86) THEN 'Snow'
    WHEN weather_code IN (51, 53, 55, 61, 63, 65, 66, 67, 80, 81, 82) THEN 'Rain'
    WHEN weather_code IN (95, 96, 99) THEN 'Thunderstorm' WHEN weather_code IN (45, 48) THEN 'Fog'
    WHEN weather_code IN (2, 3) THEN 'Cloudy' WHEN weather_code = 1 THEN 'Partly cloudy'
    ELSE 'Clear' END"""
CAPTION = """COALESCE(strftime({0}, '%B %d, %Y') || ' at ' || strftime({0}, '%-I:%M') || ' '
    || lower(strftime({0}, '%p')) || ' EST', 'Not available')"""


def color(column: str) -> str:
    """Channels are cut, not rounded, so trunc comes before the integer cast."""
    t = f"CAST({column} AS DOUBLE)"
    cold = f"greatest(0.0, least(1.0, ({t} + 20) / 52))"
    hot = f"least(1.0, ({t} - 80) / 20)"
    bands = [
        (32, cold, (74, 126), (20, 87), (140, 194)),
        (50, f"(({t} - 32) / 17)", (100, 21), (181, 101), (246, 192)),
        (65, f"(({t} - 50) / 14)", (129, 46), (199, 125), (132, 50)),
        (80, f"(({t} - 65) / 14)", (255, 230), (183, 81), (77, 0)),
        (9999, hot, (211, 183), (47, 28), (47, 28)),
    ]
    whens = []
    for limit, ratio, *channels in bands:
        parts = ", ".join(
            f"greatest(0, CAST(trunc({low} + ({high - low}) * {ratio}) AS INT))"
            for low, high in channels
        )
        whens.append(f"WHEN {t} < {limit} THEN printf('#%02x%02x%02x', {parts})")
    return f"CASE WHEN {column} IS NULL THEN '#808080' {' '.join(whens)} END"


def latest(source: str, columns, extra: str = "") -> str:
    return f"""SELECT {cols(columns)}{extra} FROM (
        SELECT *, row_number() OVER (PARTITION BY neighborhood_name
            ORDER BY observation_time_est DESC, weather_id DESC) AS rn FROM {source}) WHERE rn = 1"""


def last_wins(source: str, keys: str, arrival: list[str]) -> str:
    order = ", ".join(f"{c} DESC" for c in arrival)
    return f"""SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source})
        WHERE rn = 1"""


def star(rows: str, row_columns, dim: str, dim_columns, key: str) -> str:
    return (
        f"SELECT {cols(row_columns, 'r')}, {cols(dim_columns, 'd')} "
        f"FROM {rows} AS r, {dim} AS d WHERE r.{key} = d.{key}"
    )


def categorize(source: str) -> str:
    return f"""
        SELECT *, {TEMP_CATEGORY} AS temp_category, {CONDITION} AS weather_condition,
               {WIND_MPH} AS wind_category, {PRECIP} AS precip_type,
               COALESCE(total_precip_mm > 0, FALSE) AS is_precipitating,
               COALESCE(snowfall_mm > 0, FALSE) AS is_snowing,
               COALESCE(temp_celsius <= 0, FALSE) AS is_freezing,
               COALESCE(wind_speed_mph >= 25, FALSE) AS is_windy, {COMFORT} AS comfort_level
        FROM {source}"""


def fact_ids(time_col: str) -> str:
    """Day number of the calendar in the high bits, running number of the day below."""
    return f"""
        CAST(date_diff('day', DATE '0001-01-01', CAST({time_col} AS DATE)) AS BIGINT) * 1099511627776
        + row_number() OVER (PARTITION BY CAST({time_col} AS DATE)
              ORDER BY md5(concat_ws('|', CAST(location_id AS VARCHAR),
                                     CAST({time_col} AS VARCHAR))))"""


def id_check(time_col: str) -> str:
    """What must hold of the ids, whatever they are."""
    return f"CAST({time_col} AS DATE) AS id_day, TRUE AS id_positive, CAST(1 AS BIGINT) AS n_same_id"


def later(base: str, time_col: str, odd: str) -> str:
    """The second batch: odd rows a day later, two metrics exchanged."""
    moved = f"{time_col} + INTERVAL '1' DAY * ({odd} % 2)"
    return f"""
        SELECT * REPLACE ({moved} AS {time_col},
                          CAST(strftime({moved}, '%Y%m%d') AS INT) AS date_id,
                          apparent_temperature AS temperature_2m,
                          temperature_2m AS apparent_temperature) FROM {base}"""


def merged(target: str, batch: str, id_col: str, time_col: str, metrics) -> str:
    """Target rows no batch row replaces, replaced rows, new rows."""
    moving = ["location_id", "date_id", time_col, *metrics]
    on = f"t.location_id = b.location_id AND t.{time_col} = b.{time_col}"
    now = f"TIMESTAMP '{NOW}'"
    return f"""
        SELECT {cols([id_col, *moving, 'created_at'], 't')} FROM {target} AS t
        LEFT JOIN {batch} AS b ON {on} WHERE b.location_id IS NULL
        UNION ALL
        SELECT t.{id_col}, {cols(moving, 'b')}, t.created_at FROM {target} AS t
        JOIN {batch} AS b ON {on}
        UNION ALL
        SELECT {fact_ids(time_col)} AS {id_col}, * , {now} FROM (
            SELECT {cols(moving, 'b')} FROM {batch} AS b
            LEFT JOIN {target} AS t ON {on} WHERE t.location_id IS NULL)"""


def forecast_hours(source: str) -> str:
    return f"""
        SELECT * RENAME (temperature_2m AS temp_celsius_2m,
                         apparent_temperature AS feels_like_celsius,
                         temperature_80m AS temp_celcius_80m, temperature_120m AS temp_celcius_120m,
                         temperature_180m AS temp_celcius_180m),
               {in_f('temperature_2m')} AS temp_fahrenheit_2m,
               {in_f('apparent_temperature')} AS feels_like_fahrenheit,
               {in_f('temperature_80m')} AS temp_fahrenheit_80m,
               {in_f('temperature_120m')} AS temp_fahrenheit_120m,
               {in_f('temperature_180m')} AS temp_fahrenheit_180m,
               {FEELS.format('apparent_temperature')} AS temperature_category,
               {WIND_FORECAST} AS wind_category, {CARDINAL_8} AS wind_direction_cardinal,
               {VISIBILITY} AS visibility_category
        FROM {source}"""


# How the forecast's columns are called once they are published.
PUBLISHED = {"temperature_2m": "temp_celsius_2m", "apparent_temperature": "feels_like_celsius",
             "temperature_80m": "temp_celcius_80m", "temperature_120m": "temp_celcius_120m",
             "temperature_180m": "temp_celcius_180m"}
VIEW_HOURS = [PUBLISHED.get(c, c) for c in [*FORECAST_ROW, *PLACE_COLUMNS, *DATE_DETAILS]] + [
    "temp_fahrenheit_2m", "feels_like_fahrenheit", "temp_fahrenheit_80m", "temp_fahrenheit_120m",
    "temp_fahrenheit_180m", "temperature_category", "wind_category", "wind_direction_cardinal",
    "visibility_category",
]

NAMED = {
    **CTE,
    "stg_current": f"""
        SELECT weather_id, location_id, date_id, observation_time AS observation_time_est,
               temperature_2m AS temp_celsius, {in_f('temperature_2m')} AS temp_fahrenheit,
               apparent_temperature AS feels_like_celsius,
               {in_f('apparent_temperature')} AS feels_like_fahrenheit,
               relative_humidity_2m AS humidity_percent, wind_speed_10m AS wind_speed_mps,
               round(wind_speed_10m * 2.237, 1) AS wind_speed_mph,
               wind_direction_10m AS wind_direction_degrees, wind_gusts_10m AS wind_gusts_mps,
               precipitation AS total_precip_mm, rain AS rain_mm, showers AS showers_mm,
               snowfall AS snowfall_mm, weather_code, cloud_cover AS cloud_cover_percent,
               {DAY_NIGHT} AS day_night, pressure_msl AS pressure_sea_level_hpa,
               surface_pressure AS pressure_surface_hpa, created_at AS loaded_at_est
        FROM fact_current""",
    "cur_place": star("stg_current", STG_CURRENT, "places", PLACE_COLUMNS, "location_id"),
    "cur_day": star("cur_place", [*STG_CURRENT, *PLACE_COLUMNS], "dates", DATE_DETAILS, "date_id"),
    "readings": categorize("cur_day"),
    "shared_place": star("stg_current", STG_CURRENT, "shared_places", PLACE_COLUMNS, "location_id"),
    "shared_readings": categorize("(" + star(
        "shared_place", [*STG_CURRENT, *PLACE_COLUMNS], "dates", DATE_DETAILS, "date_id") + ")"),
    "fc_place": star("fact_forecast", FORECAST_ROW, "forecast_places", PLACE_COLUMNS, "location_id"),
    "fc_day": star(
        "fc_place", [*FORECAST_ROW, *PLACE_COLUMNS], "forecast_dates", DATE_DETAILS, "date_id"),
    "hours": forecast_hours("fc_day"),
    "view_place": star("fact_forecast", FORECAST_ROW, "places", PLACE_COLUMNS, "location_id"),
    "view_day": star("view_place", [*FORECAST_ROW, *PLACE_COLUMNS], "dates", DATE_DETAILS, "date_id"),
    "view_hours": forecast_hours("view_day"),
    "current_target": f"""
        SELECT event_id AS weather_id, *, observation_time + INTERVAL '5' MINUTE AS created_at
        FROM ({last_wins('batch_current', 'location_id, observation_time', ['event_id'])})""",
    "current_second": later("batch_current", "observation_time", "event_id"),
    "current_incoming": last_wins(
        "current_second", "location_id, observation_time", ["event_id"]),
    "forecast_target": f"""
        SELECT l_orderkey * 8 + l_linenumber AS forecast_id, *,
               forecast_time - INTERVAL '1' DAY AS created_at
        FROM ({last_wins('batch_forecast', 'location_id, forecast_time', LINE_ARRIVAL)})""",
    "forecast_second": later("batch_forecast", "forecast_time", "l_orderkey"),
    "forecast_incoming": last_wins(
        "forecast_second", "location_id, forecast_time", LINE_ARRIVAL),
    "landed_current": landing.current_sql(),
    "landed_current_2": landing.current_sql(2),
    "landed_hourly": landing.hourly_sql(),
    "landed_hourly_2": landing.hourly_sql(2),
    # The five tables with faults in them.
    "bad_places": """SELECT * REPLACE (CASE WHEN location_id % 70 > 0 THEN neighborhood_name END AS neighborhood_name)
        FROM (SELECT * FROM places UNION ALL SELECT * FROM places WHERE location_id % 50 = 0)""",
    "bad_dates": "SELECT * REPLACE (CASE WHEN day <> 13 THEN day_name END AS day_name) FROM dates",
    "bad_current": """SELECT * REPLACE (CASE WHEN location_id % 41 > 0 THEN location_id END AS location_id)
        FROM fact_current""",
    "bad_forecast": f"""SELECT * REPLACE (CASE WHEN location_id % 37 = 0 THEN -location_id ELSE location_id END
        AS location_id, {WITHIN_A_MONTH.format(time='forecast_time', kind='TIMESTAMP')} AS forecast_time)
        FROM fact_forecast""",
    "bad_history": """SELECT * REPLACE (CASE WHEN location_id % 37 = 0 THEN -location_id ELSE location_id END
        AS location_id) FROM fact_history""",
}

# The constraints declared of each table.
BAD = {"dim_location": "bad_places", "dim_date": "bad_dates", "fact_current_weather": "bad_current",
       "fact_hourly_forecast": "bad_forecast", "fact_weather_history": "bad_history"}
UNIQUE = {"dim_location": "latitude, longitude", "dim_date": "date",
          "fact_current_weather": "location_id, observation_time",
          "fact_hourly_forecast": "location_id, forecast_time"}
REQUIRED = {
    "dim_location": ["location_id", "neighborhood_name", "latitude", "longitude"],
    "dim_date": ["date_id", "date", "year", "month", "day", "day_of_week", "day_name",
                 "week_of_year", "quarter", "is_weekend"],
    "fact_current_weather": ["weather_id", "location_id", "date_id", "observation_time"],
    "fact_hourly_forecast": ["forecast_id", "location_id", "date_id", "forecast_time"],
}
REFERS = {"location_id": "bad_places", "date_id": "bad_dates"}


def checks() -> str:
    """A row for every constraint: violations, rows concerned, violations stored."""
    parts = []

    def add(table: str, check: str, column: str, failed: str) -> None:
        parts.append(f"""SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
            count(*) AS n_failed, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_stored FROM ({failed})""")

    for table, source in BAD.items():
        add(table, "schema", "", f"SELECT 1 AS n FROM {source} WHERE FALSE")
        if table in UNIQUE:
            keys = UNIQUE[table]
            add(table, "unique", keys, f"SELECT count(*) AS n FROM {source} GROUP BY {keys} HAVING count(*) > 1")
        for column in REQUIRED.get(table, []):
            add(table, "not_null", column, f"SELECT * FROM (SELECT count(*) - count({column}) AS n FROM {source}) WHERE n > 0")
        for column, dim in REFERS.items():
            if table.startswith("fact"):
                add(table, "foreign_key", column, f"""SELECT count(*) AS n FROM {source} WHERE {column} IS NOT NULL
                    AND {column} NOT IN (SELECT {column} FROM {dim} WHERE {column} IS NOT NULL) GROUP BY {column}""")
    return " UNION ALL ".join(parts)


def scanned(label: str, sources: dict[str, tuple[str, object]]) -> str:
    """Rows and values of each named source."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS n_rows, "
        f"CAST({' + '.join(f'count({c})' for c in columns)} AS BIGINT) AS n_values FROM {source}"
        for name, (source, columns) in sources.items()
    )


# A response of a run, its place's last by number; of the plain feed the odd orders' comes last.
def last_response(rows: str, order: str) -> str:
    return f"""SELECT * FROM {rows} AS h WHERE reason IS NULL AND NOT EXISTS (
        SELECT 1 FROM {rows} AS l WHERE l.reason IS NULL AND l.hour_pos = 0
            AND l.latitude = h.latitude AND l.longitude = h.longitude AND l.{order} > h.{order})"""


def report_row(kind: str, **given: str) -> str:
    numbers = ["total_responses", "successful_loads", "failed_loads", "ignored_loads",
               "total_forecasts", "distinct_forecasts", "rows_cleared", "n_rows"]
    picked = [f"CAST({given.get(c, 'NULL')} AS BIGINT) AS {c}" for c in numbers]
    rate = f"CAST({given.get('success_rate', 'NULL')} AS DOUBLE) AS success_rate"
    source = given.get("source", "(SELECT 1)")
    return f"SELECT '{kind}' AS kind, {', '.join(picked)}, {rate}, TIMESTAMP '{NOW}' AS finished_at FROM {source}"


def with_named(body: str) -> str:
    """Put the named subqueries a text uses in front of it, in order."""
    used: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & NAMED.keys()) - used:
            used.add(name)
            todo.append(NAMED[name])
    listed = [f"{name} AS ({text})" for name, text in NAMED.items() if name in used]
    return f"WITH {', '.join(listed)} {body}" if listed else body


def on_current(alias: str, expr: str) -> str:
    value = f"CAST({expr} AS DOUBLE)" if alias in DECIMALS else expr
    return f"SELECT weather_id, {value} AS {alias} FROM stg_current"


def on_hours(alias: str, expr: str) -> str:
    value = f"CAST({expr} AS DOUBLE)" if alias in DECIMALS else expr
    return f"SELECT forecast_id, location_id, forecast_time, {value} AS {alias} FROM fact_forecast"


FLAT_CURRENT = ["neighborhood_name", "latitude", "longitude", "run_id", "arrival_seq",
                "observation_time", *CURRENT_METRICS, "reason"]
FLAT_HOURLY = ["neighborhood_name", "latitude", "longitude", "run_id", "arrival_seq", "hour_pos",
               "forecast_time", *FORECAST_METRICS, "reason"]
ID_CHECK = ["id_day", "id_positive", "n_same_id"]
REJECTS = ["neighborhood_name", "latitude", "longitude", "run_id", "arrival_seq", "reason"]
FEATURES = """
    SELECT CASE WHEN c_custkey % 10 > 0 THEN c_name ELSE 'Unknown' END AS hood,
           printf('{"type":"Point","coordinates":[%d,%d]}', c_custkey, c_nationkey) AS geometry
    FROM customer"""
NOT_NULL_COLUMNS = ["weather_id", "location_id", "date_id", "observation_time", *CURRENT_METRICS]
PARSE = """
    SELECT event_id, CASE event_id % 6
        WHEN 0 THEN full_hour + INTERVAL '30' MINUTE
        WHEN 1 THEN full_hour + INTERVAL '30' MINUTE
        WHEN 2 THEN full_hour + INTERVAL '30' MINUTE + INTERVAL '15' SECOND
        WHEN 3 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
        WHEN 4 THEN full_hour + INTERVAL '30' MINUTE - INTERVAL '5' HOUR
        END AS parsed
    FROM (SELECT event_id, ts, date_trunc('hour', ts) AS full_hour FROM events)"""
MOVED_PLACES = """
    SELECT p.neighborhood_name || ' ' || e.event_type AS neighborhood_name,
           CAST(p.latitude + CASE WHEN e.event_id % 2 = 1 THEN 0.005 ELSE 0 END AS DECIMAL(9, 6))
               AS latitude, p.longitude, e.event_id
    FROM events AS e JOIN places AS p ON p.location_id = e.user_id"""
BY_DIGEST = """row_number() OVER (ORDER BY md5(concat_ws('|', CAST(latitude AS VARCHAR),
                                                   CAST(longitude AS VARCHAR))))"""

BODIES: dict[str, str] = {
    # sources and sinks
    "src_locations": "SELECT neighborhood_name AS name, CAST(latitude AS DOUBLE) AS latitude, "
                     "CAST(longitude AS DOUBLE) AS longitude FROM places",
    "src_current_raw": out(FLAT_CURRENT, "landed_current"),
    "src_hourly_raw": out(FLAT_HOURLY, "landed_hourly"),
    "src_features": FEATURES,
    "src_star": scanned("table_name", {
        "dim_location": ("places", DIM_LOCATION.names), "dim_date": ("dates", DIM_DATE.names),
        "fact_current_weather": ("fact_current", FACT_CURRENT.names),
        "fact_hourly_forecast": ("fact_forecast", FACT_FORECAST.names),
        "fact_weather_history": ("fact_history", FACT_HISTORY.names)}),
    "sink_mart": out(WEATHER_READINGS, "readings"),
    "view_layer": scanned("view_name", {f"skylattice_{name}": source for name, source in {
        "stg_current_weather": ("stg_current", STG_CURRENT),
        "stg_hourly_forecast": ("fact_forecast", FACT_FORECAST.names),
        "stg_locations": ("places", DIM_LOCATION.names), "stg_dates": ("dates", DIM_DATE.names),
        "int_weather_joined_locations": ("cur_place", [*STG_CURRENT, *PLACE_COLUMNS]),
        "int_weather_joined_locations_and_dates": ("cur_day", [*STG_CURRENT, *PLACE_COLUMNS, *DATE_DETAILS]),
        "int_weather_categorized": ("readings", [*STG_CURRENT, *PLACE_COLUMNS, *DATE_DETAILS, *CATEGORIES]),
        "int_forecast_joined_locations": ("view_place", [*FORECAST_ROW, *PLACE_COLUMNS]),
        "int_forecast_joined_locations_and_dates": ("view_day", [*FORECAST_ROW, *PLACE_COLUMNS, *DATE_DETAILS]),
        "int_forecast_add_categories": ("view_hours", VIEW_HOURS),
        "weather_readings": ("readings", WEATHER_READINGS), "forecast": ("view_hours", FORECAST)}.items()}),
    "sink_rejects_hourly": out(REJECTS, "landed_hourly WHERE reason IS NOT NULL"),
    "current_card": f"""SELECT neighborhood_name, {DISPLAY} AS display_group,
        CAST(temp_fahrenheit AS DOUBLE) AS temp_fahrenheit, weather_condition,
        CAST(feels_like_fahrenheit AS DOUBLE) AS feels_like_fahrenheit,
        CAST(wind_speed_mph AS DOUBLE) AS wind_speed_mph, {CARDINAL_16} AS wind_direction,
        CAST(humidity_percent AS DOUBLE) AS humidity_percent,
        CAST(round(pressure_sea_level_hpa * 0.02953, 2) AS DOUBLE) AS pressure_in,
        CAST(cloud_cover_percent AS DOUBLE) AS cloud_cover_percent, CAST(NULL AS DOUBLE) AS visibility_mi,
        CAST(NULL AS DOUBLE) AS dew_point_fahrenheit
        FROM ({latest('readings', LATEST)})""",
    "assign_fact_keys": f"""SELECT location_id, observation_time, {id_check('observation_time')} FROM (
        SELECT DISTINCT CAST(o_custkey AS INT) AS location_id,
               CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE)
                    ELSE CAST(CAST(o_orderdate AS DATE) - INTERVAL '480' MONTH AS DATE) END AS TIMESTAMP)
                   AS observation_time FROM orders)""",
    "run_checks": checks(),
    "load_summary_hourly": f"""
        SELECT count(*) FILTER (first) AS total_responses,
               count(*) FILTER (first AND reason IS NULL AND run_id = 2) AS successful_loads,
               count(*) FILTER (first AND reason IS NOT NULL) AS failed_loads,
               count(*) FILTER (first AND reason IS NULL AND run_id = 1) AS ignored_loads,
               count(*) FILTER (reason IS NULL AND run_id = 2) AS total_forecasts,
               count(DISTINCT CASE WHEN reason IS NULL AND run_id = 2
                   THEN (latitude, longitude, forecast_time) END) AS distinct_forecasts,
               round(count(*) FILTER (first AND reason IS NULL AND run_id = 2)
                   / count(*) FILTER (first) * 100, 1) AS success_rate,
               CAST(0 AS BIGINT) AS rows_cleared, TIMESTAMP '{NOW}' AS finished_at
        FROM (SELECT *, coalesce(hour_pos, 0) = 0 AS first
              FROM (SELECT * FROM landed_hourly UNION ALL SELECT * FROM landed_hourly_2))""",
    "run_report": " UNION ALL ".join([
        report_row("load_current", total_responses="count(*)", successful_loads="count(*) FILTER (reason IS NULL)",
                   failed_loads="count(reason)", success_rate="round(count(*) FILTER (reason IS NULL) / count(*) * 100, 1)",
                   source="landed_current"),
        report_row("load_forecast", total_responses="count(*) FILTER (coalesce(hour_pos, 0) = 0)",
                   successful_loads="count(*) FILTER (hour_pos = 0)", failed_loads="count(reason)", ignored_loads="0",
                   total_forecasts="count(hour_pos)",
                   distinct_forecasts="count(DISTINCT CASE WHEN reason IS NULL THEN (latitude, longitude, forecast_time) END)",
                   success_rate="round(count(*) FILTER (hour_pos = 0) / count(*) FILTER (coalesce(hour_pos, 0) = 0) * 100, 1)",
                   rows_cleared="0", source="landed_hourly"),
        report_row("mart_weather_readings", n_rows="count(*)", source="""(SELECT DISTINCT latitude, longitude, observation_time
                   FROM landed_current WHERE reason IS NULL)"""),
        report_row("mart_forecast", n_rows="count(*)", source=f"({last_response('landed_hourly', 'arrival_seq')})"),
        report_row("checks", n_rows="0"),
    ]),
    "sink_rejects": out(REJECTS, "landed_current WHERE reason IS NOT NULL"),
    # loads
    "upsert_location": out(DIM_LOCATION.names, f"""(
        WITH incoming AS ({last_wins(f'({MOVED_PLACES})', 'latitude, longitude', ['event_id'])}),
             known AS (SELECT p.location_id, i.neighborhood_name, p.latitude, p.longitude,
                              p.timezone, p.created_at, TIMESTAMP '{NOW}' AS updated_at
                       FROM places AS p JOIN incoming AS i USING (latitude, longitude)),
             added AS (SELECT CAST((SELECT max(location_id) FROM places) + {BY_DIGEST} AS INT)
                                  AS location_id, neighborhood_name, latitude, longitude,
                              'America/New_York' AS timezone, TIMESTAMP '{NOW}' AS created_at,
                              TIMESTAMP '{NOW}' AS updated_at
                       FROM incoming ANTI JOIN places USING (latitude, longitude))
        SELECT * FROM known UNION ALL SELECT * FROM added UNION ALL
        SELECT * FROM places ANTI JOIN incoming USING (latitude, longitude))"""),
    "get_or_create_date": out(DIM_DATE.names, """(
        SELECT * FROM dates UNION ALL
        SELECT CAST((SELECT max(date_id) FROM dates) + row_number() OVER (ORDER BY date) AS INT),
               date, CAST(year(date) AS INT), CAST(month(date) AS INT), CAST(day(date) AS INT),
               CAST(isodow(date) - 1 AS INT), dayname(date), CAST(weekofyear(date) AS INT),
               CAST(quarter(date) AS INT), isodow(date) > 5, FALSE
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) ANTI JOIN dates
             USING (date))"""),
    "upsert_current": out(FACT_CURRENT.names, "(" + merged(
        "current_target", "current_incoming", "weather_id", "observation_time",
        CURRENT_METRICS) + ")"),
    "upsert_forecast": out(FACT_FORECAST.names, "(" + merged(
        "forecast_target", "forecast_incoming", "forecast_id", "forecast_time",
        FORECAST_METRICS) + ")"),
    "replace_forecast": out([*FACT_FORECAST.names, "run_id"], f"""(
        SELECT *, {fact_ids('forecast_time')} AS forecast_id, TIMESTAMP '{NOW}' AS created_at,
               CAST(2 AS BIGINT) AS run_id FROM forecast_incoming)"""),
    "assign_keys": f"""SELECT CAST({BY_DIGEST} AS INT) AS location_id,
        CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude FROM places""",
    "load_summary": f"""
        SELECT count(*) AS total_responses, count(*) FILTER (reason IS NULL) AS successful_loads,
               count(reason) AS failed_loads,
               round(count(*) FILTER (reason IS NULL) / count(*) * 100, 1) AS success_rate,
               TIMESTAMP '{NOW}' AS finished_at
        FROM landed_current""",
    "route_rejects": out(REJECTS, "landed_hourly WHERE reason IS NOT NULL"),
    "cascade_delete": out(FACT_CURRENT.names, """fact_current WHERE location_id NOT IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""),
    # quality
    "check_unique": """SELECT location_id, observation_time, count(*) AS n_rows
        FROM batch_current GROUP BY location_id, observation_time HAVING count(*) > 1""",
    "check_not_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM fact_current"
        for c in NOT_NULL_COLUMNS),
    "check_foreign_key": """SELECT location_id, count(*) AS n_rows FROM fact_current
        WHERE location_id NOT IN (SELECT location_id FROM forecast_places) GROUP BY location_id""",
    "check_schema": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {len(TABLES[name])} AS n_columns, 0 AS n_drifted, "
        f"count(*) AS n_rows FROM {source}"
        for name, source in [
            ("dim_location", "places"), ("dim_date", "dates"),
            ("fact_current_weather", "fact_current"), ("fact_hourly_forecast", "fact_forecast"),
            ("fact_weather_history", "fact_history")]),
    # staging, intermediate, marts
    "stg_current_weather": out(STG_CURRENT, "stg_current"),
    "stg_hourly_forecast": out(FACT_FORECAST.names, "fact_forecast"),
    "stg_locations": out(DIM_LOCATION.names, "places"),
    "stg_dates": out(DIM_DATE.names, "forecast_dates"),
    "stg_weather_history": out(FACT_HISTORY.names, "fact_history"),
    "join_current_location": out([*STG_CURRENT, *PLACE_COLUMNS], "cur_place"),
    "join_current_date": out([*STG_CURRENT, *PLACE_COLUMNS, *DATE_DETAILS], "cur_day"),
    "int_weather_categorized": out(
        [*STG_CURRENT, *PLACE_COLUMNS, *DATE_DETAILS, *CATEGORIES], "readings"),
    "mart_weather_readings": out(WEATHER_READINGS, "readings"),
    "join_forecast_location": out([*FORECAST_ROW, *PLACE_COLUMNS], "fc_place"),
    "join_forecast_date": out([*FORECAST_ROW, *PLACE_COLUMNS, *DATE_DETAILS], "fc_day"),
    "int_forecast_add_categories": out(FORECAST, "hours"),
    "mart_forecast": out(FORECAST, "hours"),
    # reports
    "metric_series": "SELECT neighborhood_name, forecast_time, "
                     "CAST(temp_fahrenheit_2m AS DOUBLE) AS value FROM hours",
    "metric_long": " UNION ALL ".join(
        f"SELECT neighborhood_name, forecast_time, '{label}' AS metric, "
        f"CAST({column} AS DOUBLE) AS value FROM hours" for label, column in METRICS.items()),
    "current_table": "SELECT " + ", ".join(
        f'CAST({c} AS DOUBLE) AS "{label}"' if c in DECIMALS else f'{c} AS "{label}"'
        for c, label in CURRENT_TABLE.items()) + f" FROM ({latest('readings', CURRENT_TABLE)})",
    "filter_neighborhood": out(FORECAST, "hours WHERE neighborhood_name = 'NATION_7'"),
    "filter_horizon": out(FORECAST_PAGE, f"""(
        SELECT * FROM (SELECT *, min(forecast_time) OVER (PARTITION BY neighborhood_name) AS first
                       FROM hours) WHERE forecast_time < first + INTERVAL '7' DAY)"""),
    "horizon_stored": out(FORECAST_PAGE, f"""(
        SELECT * FROM (SELECT *, min(forecast_time) OVER (PARTITION BY neighborhood_name) AS first
                       FROM hours) WHERE forecast_time < first + INTERVAL '7' DAY)"""),
    "join_feature_weather": out(
        ["hood", "geometry", "has_data", "fill_color", *POPUP, "wind_direction"], f"""(
        SELECT f.hood, f.geometry, w.neighborhood_name IS NOT NULL AS has_data,
               {color('w.temp_fahrenheit')} AS fill_color, {cols(POPUP, 'w')},
               CASE WHEN w.neighborhood_name IS NOT NULL THEN {CARDINAL_16} END AS wind_direction
        FROM ({FEATURES}) AS f
        LEFT JOIN ({latest('readings', LATEST)}) AS w ON f.hood = w.neighborhood_name)"""),
    "last_updated": f"""SELECT max(updated_at) AS last_updated,
        {CAPTION.format('max(updated_at)')} AS caption FROM hours""",
    "series_start": """SELECT neighborhood_name, min(forecast_time) AS series_start
        FROM hours GROUP BY neighborhood_name""",
    "row_count": "SELECT count(*) AS n_rows FROM fact_forecast",
    "distinct_neighborhoods": "SELECT DISTINCT neighborhood_name FROM hours "
                              "ORDER BY neighborhood_name",
    "latest_per_neighborhood": out(LATEST, f"({latest('shared_readings', LATEST)})"),
    "latest_stored": out(LATEST, f"({latest('shared_readings', LATEST)})"),
    "dedupe_last_wins": out(
        ["location_id", "date_id", "observation_time", *CURRENT_METRICS, "event_id"],
        f"({last_wins('batch_current', 'location_id, observation_time', ['event_id'])})"),
    "forecast_ordered": out(FORECAST_PAGE, "hours") + " ORDER BY neighborhood_name, forecast_time",
    "date_spine": """SELECT CAST(unnest(generate_series(
            CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) - 1, INTERVAL '1' DAY))
            AS DATE) AS date_day FROM orders""",
    # streaming
    "stream_current": out(
        ["neighborhood_name", "observation_time", *CURRENT_METRICS, "created_at", *ID_CHECK], "(" + f"""
        SELECT *, TIMESTAMP '{NOW}' AS created_at, {id_check('observation_time')} FROM ({last_wins(
            '(SELECT * FROM landed_current UNION ALL SELECT * FROM landed_current_2)',
            'reason, neighborhood_name, observation_time', ['run_id', 'arrival_seq'])})
        WHERE reason IS NULL)"""),
    "stream_forecast": out(
        ["neighborhood_name", "forecast_time", *FORECAST_METRICS, "created_at", *ID_CHECK], f"""(
        SELECT *, TIMESTAMP '{NOW}' AS created_at, {id_check('forecast_time')}
        FROM ({last_response('landed_hourly_2', 'arrival_seq')}))"""),
    "stream_forecast_plain": out(
        ["neighborhood_name", "forecast_time", *FORECAST_METRICS, "created_at", *ID_CHECK], f"""(
        SELECT *, TIMESTAMP '{NOW}' AS created_at, {id_check('forecast_time')}
        FROM ({last_response('landed_hourly', 'half')}))"""),
    "parallel_loads": f"""SELECT * FROM (
        WITH readings AS (SELECT DISTINCT latitude, longitude, observation_time AS moment FROM landed_current WHERE reason IS NULL),
             hours AS (SELECT latitude, longitude, forecast_time AS moment FROM ({last_response('landed_hourly', 'arrival_seq')})),
             known AS (SELECT latitude, longitude, moment FROM readings
                       UNION ALL SELECT latitude, longitude, forecast_time FROM landed_hourly WHERE reason IS NULL),
             found AS (
                SELECT DISTINCT 'dim_location' AS table_name, latitude, longitude, CAST(NULL AS DATE) AS date, CAST(NULL AS TIMESTAMP) AS moment FROM known
                UNION ALL SELECT DISTINCT 'dim_date', NULL, NULL, CAST(moment AS DATE), NULL FROM known
                UNION ALL SELECT 'fact_current_weather', latitude, longitude, CAST(moment AS DATE), moment FROM readings
                UNION ALL SELECT 'fact_hourly_forecast', latitude, longitude, CAST(moment AS DATE), moment FROM hours)
        SELECT table_name, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, date, moment FROM found)""",
    "cascade_delete_stored": " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, location_id, count(*) AS n_rows FROM {source}
            WHERE location_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY location_id"""
        for name, source in [
            ("dim_location", "places"), ("fact_current_weather", "fact_current"), ("fact_hourly_forecast", "fact_forecast")]),
    # column functions
    "c_to_f": on_current("temp_fahrenheit", "temp_fahrenheit"),
    "mps_to_mph": on_current("wind_speed_mph", "wind_speed_mph"),
    "hpa_to_inhg": on_current("pressure_in", "round(pressure_sea_level_hpa * 0.02953, 2)"),
    "day_night": on_current("day_night", "day_night"),
    "temp_category": on_current("temp_category", TEMP_CATEGORY),
    "weather_condition": on_current("weather_condition", CONDITION),
    "wind_category_mph": on_current("wind_category", WIND_MPH),
    "precip_type": on_current("precip_type", PRECIP),
    "is_precipitating": on_current("is_precipitating", "COALESCE(total_precip_mm > 0, FALSE)"),
    "is_snowing": on_current("is_snowing", "COALESCE(snowfall_mm > 0, FALSE)"),
    "is_freezing": on_current("is_freezing", "COALESCE(temp_celsius <= 0, FALSE)"),
    "is_windy": on_current("is_windy", "COALESCE(wind_speed_mph >= 25, FALSE)"),
    "comfort_level": on_current("comfort_level", COMFORT),
    "cardinal_16": on_current("wind_direction", CARDINAL_16),
    "temp_color": on_current("fill_color", color("temp_fahrenheit")),
    "display_group": on_current("display_group", DISPLAY),
    "last_updated_text": on_current("caption", CAPTION.format("loaded_at_est")),
    "ny_now": on_current(
        "ny_time", "(observation_time_est AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'"),
    "m_to_miles": on_hours("visibility_mi", """CASE WHEN visibility > 100
        THEN round(visibility * 0.000621371, 1) ELSE round(visibility, 1) END"""),
    "temperature_category": on_hours("temperature_category", FEELS.format("apparent_temperature")),
    "wind_category_forecast": on_hours("wind_category", WIND_FORECAST),
    "cardinal_8": on_hours("wind_direction_cardinal", CARDINAL_8),
    "visibility_category": on_hours("visibility_category", VISIBILITY),
    "parse_local_ts": PARSE,
    "date_parts": """
        SELECT o_orderkey, date, CAST(year(date) AS INT) AS year,
               CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day,
               CAST(isodow(date) - 1 AS INT) AS day_of_week, dayname(date) AS day_name,
               CAST(weekofyear(date) AS INT) AS week_of_year, CAST(quarter(date) AS INT) AS quarter,
               isodow(date) > 5 AS is_weekend, FALSE AS is_holiday
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders)""",
}

ORACLE_SQL: dict[str, str] = {name: with_named(body) for name, body in BODIES.items()}
