"""Wall-clock parsing, calendar parts and the local audit clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylattice.schemas import DEFAULT_TIMEZONE

_CLOCK = r"[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
_ZONE = r"(Z|[+-]\d{2}:\d{2})$"
_LOCAL = rf"^\d{{4}}-\d{{2}}-\d{{2}}({_CLOCK})?$"
_ZONED = rf"^\d{{4}}-\d{{2}}-\d{{2}}{_CLOCK}{_ZONE}"


def parse_local_ts(text: Column) -> Column:
    """ISO text to wall clock: date, or date and time with ``T`` or a space.

    The feed sends local times without a zone. One that has a zone is moved to
    UTC, as a zone-less timestamp column would store it. NULL if unreadable.
    The session time zone plays no part. Only text of the right form is cast:
    a failing ``try_cast`` costs an exception.
    """
    zone = F.regexp_extract(text, _ZONE, 1)
    wall = F.regexp_replace(text, _ZONE, "").try_cast("timestamp_ntz")
    minutes = F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 5, 2).cast("int")
    ahead = (
        F.when(zone == "Z", 0).when(zone.startswith("-"), -minutes).otherwise(minutes)
    )
    return (
        F.when(text.rlike(_LOCAL), text.try_cast("timestamp_ntz"))
        .when(text.rlike(_ZONED), wall - F.make_dt_interval(mins=ahead))
    )


def date_parts(date: Column) -> dict[str, Column]:
    """Calendar columns of the date dimension; weeks start on Monday (0)."""
    weekday = F.weekday(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": weekday,
        "day_name": F.date_format(date, "EEEE"),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": weekday >= 5,
        "is_holiday": F.lit(False),
    }


def ny_wall(utc: Column) -> Column:
    """New York wall clock of a zone-less UTC time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(DEFAULT_TIMEZONE), utc)


def ny_now() -> Column:
    """The audit time: now, as New York wall clock."""
    utc = F.expr(
        "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        " + unix_micros(current_timestamp()) * INTERVAL '0.000001' SECOND"
    )
    return ny_wall(utc)
