"""Unit conversions, kept in decimal so that halves round away from zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors.
F_PER_C = Decimal("1.8")
F_OFFSET = Decimal("32")
MPH_PER_MPS = Decimal("2.237")
INHG_PER_HPA = Decimal("0.02953")
MILES_PER_METRE = Decimal("0.000621371")
METRES_ABOVE = 100


def c_to_f(celsius: Column) -> Column:
    return F.round(celsius * F.lit(F_PER_C) + F.lit(F_OFFSET), 1)


def mps_to_mph(speed: Column) -> Column:
    """Treats its input as metres per second, whatever unit the feed really sent."""
    return F.round(speed * F.lit(MPH_PER_MPS), 1)


def hpa_to_inhg(pressure: Column) -> Column:
    return F.round(pressure * F.lit(INHG_PER_HPA), 2)


def m_to_miles(visibility: Column) -> Column:
    """Values up to 100 are taken to be miles already."""
    miles = F.round(visibility * F.lit(MILES_PER_METRE), 1)
    return F.when(visibility > METRES_ABOVE, miles).otherwise(F.round(visibility, 1))
