"""Threshold and code classifiers.

A NULL input fails every comparison and so gets the final label of its scale,
and the flags come out false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _below(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit that ``value`` lies under."""
    chain = F
    for limit, label in steps:
        chain = chain.when(value < limit, label)
    return chain.otherwise(otherwise)


def _by_code(code: Column, groups: list[tuple[str, list[int]]], otherwise: str) -> Column:
    chain = F
    for label, codes in groups:
        chain = chain.when(code.isin(codes), label)
    return chain.otherwise(otherwise)


# Limits, codes and labels.
TEMP_STEPS = [(0, "Freezing"), (10, "Cold"), (20, "Mild"), (30, "Warm")]
WIND_MPH_STEPS = [
    (1, "Calm"), (8, "Light air"), (13, "Light breeze"), (25, "Moderate breeze"),
    (39, "Strong breeze"),
]
COMFORT_STEPS = [
    (32, "Very uncomfortable (freezing)"), (50, "Uncomfortable (cold)"), (65, "Cool"),
    (75, "Comfortable"), (85, "Warm"),
]
FEELS_STEPS = [(32, "Freezing"), (50, "Cold"), (65, "Cool"), (75, "Comfortable"), (85, "Warm")]
WIND_FORECAST_STEPS = [(5, "Calm"), (15, "Breezy"), (25, "Windy")]
VISIBILITY_STEPS = [(10000, "Excellent"), (5000, "Good"), (2000, "Moderate")]
CONDITIONS = [
    ("Clear sky", [0]),
    ("Partly cloudy", [1, 2, 3]),
    ("Foggy", [45, 48]),
    ("Drizzle", [51, 53, 55, 56, 57]),
    ("Rain", [61, 63, 65, 66, 67]),
    ("Snow", [71, 73, 75, 77]),
    ("Rain showers", [80, 81, 82]),
    ("Snow showers", [85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]
DISPLAY_GROUPS = [
    ("Snow", [71, 73, 75, 77, 85, 86]),
    ("Rain", [51, 53, 55, 61, 63, 65, 66, 67, 80, 81, 82]),
    ("Thunderstorm", [95, 96, 99]),
    ("Fog", [45, 48]),
    ("Cloudy", [2, 3]),
    ("Partly cloudy", [1]),
]
WINDY_FROM_MPH = 25


def day_night(is_day: Column) -> Column:
    return F.when(is_day == 1, "Day").when(is_day == 0, "Night").otherwise("Unknown")


def temp_category(celsius: Column) -> Column:
    return _below(celsius, TEMP_STEPS, "Hot")


def weather_condition(code: Column) -> Column:
    return _by_code(code, CONDITIONS, "Unknown")


def display_group(code: Column) -> Column:
    """The picture group of the current-conditions card; 56 and 57 count as clear."""
    return _by_code(code, DISPLAY_GROUPS, "Clear")


def wind_category_mph(mph: Column) -> Column:
    return _below(mph, WIND_MPH_STEPS, "High wind")


def precip_type(total: Column, rain: Column, showers: Column, snowfall: Column) -> Column:
    return (
        F.when(snowfall > 0, "Snow")
        .when(rain > 0, "Rain")
        .when(showers > 0, "Showers")
        .when(total > 0, "Other precipitation")
        .otherwise("No precipitation")
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_precipitating(total: Column) -> Column:
    return _flag(total > 0)


def is_snowing(snowfall: Column) -> Column:
    return _flag(snowfall > 0)


def is_freezing(celsius: Column) -> Column:
    return _flag(celsius <= 0)


def is_windy(mph: Column) -> Column:
    return _flag(mph >= WINDY_FROM_MPH)


def comfort_level(feels_fahrenheit: Column) -> Column:
    return _below(feels_fahrenheit, COMFORT_STEPS, "Uncomfortable (hot)")


def temperature_category(feels_like: Column, unit: str = "C") -> Column:
    """Feels-like class of the forecast.

    The limits look like Fahrenheit but the published mart compares them with
    Celsius; that is the default here. ``unit="F"`` converts first.
    """
    if unit not in ("C", "F"):
        raise ValueError("unit is 'C' or 'F'")
    if unit == "F":
        from skylattice.functions.units import c_to_f

        feels_like = c_to_f(feels_like)
    return _below(feels_like, FEELS_STEPS, "Hot")


def wind_category_forecast(speed: Column) -> Column:
    return _below(speed, WIND_FORECAST_STEPS, "Very Windy")


def visibility_category(metres: Column) -> Column:
    chain = F
    for limit, label in VISIBILITY_STEPS:
        chain = chain.when(metres >= limit, label)
    return chain.otherwise("Poor")
