"""Compass names for wind directions in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compass points, clockwise from north.
POINTS_8 = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
POINTS_16 = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
             "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]
SECTOR_8, SECTOR_16 = 45.0, 22.5


def cardinal_8(degrees: Column) -> Column:
    """Sectors include both ends and the first match wins; NULL off the circle."""
    half = SECTOR_8 / 2
    chain = F.when(degrees.between(360 - half, 360) | degrees.between(0, half), POINTS_8[0])
    for i, point in enumerate(POINTS_8[1:], start=1):
        chain = chain.when(degrees.between(i * SECTOR_8 - half, i * SECTOR_8 + half), point)
    return chain


def cardinal_16(degrees: Column) -> Column:
    """Truncates towards zero, then wraps negatives round the circle; NULL is N/A."""
    sector = ((degrees.cast("double") + SECTOR_16 / 2) / SECTOR_16).cast("int")
    names = F.array(*[F.lit(point) for point in POINTS_16])
    named = F.get(names, F.pmod(sector, F.lit(len(POINTS_16))))
    return F.coalesce(named, F.lit("N/A"))
