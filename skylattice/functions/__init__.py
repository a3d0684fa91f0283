"""Column functions. All are built-in expressions; none is a Python UDF."""

from skylattice.functions.categories import (
    comfort_level, day_night, display_group, is_freezing, is_precipitating, is_snowing, is_windy,
    precip_type, temp_category, temperature_category, visibility_category, weather_condition,
    wind_category_forecast, wind_category_mph,
)
from skylattice.functions.directions import cardinal_8, cardinal_16
from skylattice.functions.display import last_updated_text, temp_color
from skylattice.functions.times import date_parts, ny_now, ny_wall, parse_local_ts
from skylattice.functions.units import c_to_f, hpa_to_inhg, m_to_miles, mps_to_mph

__all__ = [
    "c_to_f", "cardinal_16", "cardinal_8", "comfort_level", "date_parts", "day_night",
    "display_group", "hpa_to_inhg", "is_freezing", "is_precipitating", "is_snowing", "is_windy",
    "last_updated_text", "m_to_miles", "mps_to_mph", "ny_now", "ny_wall", "parse_local_ts",
    "precip_type", "temp_category", "temp_color", "temperature_category", "visibility_category",
    "weather_condition", "wind_category_forecast", "wind_category_mph",
]
