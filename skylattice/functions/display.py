"""Values shown on the map and the forecast page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (below, origin, span, start colour, end colour) per Fahrenheit band.
RAMPS = [
    (32, -20, 52, (0x4A, 0x14, 0x8C), (0x7E, 0x57, 0xC2)),
    (50, 32, 17, (0x64, 0xB5, 0xF6), (0x15, 0x65, 0xC0)),
    (65, 50, 14, (0x81, 0xC7, 0x84), (0x2E, 0x7D, 0x32)),
    (80, 65, 14, (0xFF, 0xB7, 0x4D), (0xE6, 0x51, 0x00)),
    (None, 80, 20, (0xD3, 0x2F, 0x2F), (0xB7, 0x1C, 0x1C)),
]
NO_DATA_COLOR = "#808080"
NOT_AVAILABLE = "Not available"
ZONE_SUFFIX = "EST"


def temp_color(fahrenheit: Column) -> Column:
    """Hex fill colour of a temperature.

    Worked out in doubles, as truncating a channel is sensitive to how the ramp
    was rounded. A channel never goes under zero (79.2 to 79.9 would).
    """
    t = fahrenheit.cast("double")

    def packed(origin, span, start, end) -> Column:
        ratio = (t - origin) / span
        if origin == RAMPS[0][1]:
            ratio = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio))
        elif origin == RAMPS[-1][1]:
            ratio = F.least(F.lit(1.0), ratio)
        total = F.lit(0)
        for low, high in zip(start, end):
            channel = (F.lit(float(low)) + F.lit(float(high - low)) * ratio).cast("int")
            total = total * 256 + F.greatest(F.lit(0), channel)
        return total

    chain = F.when(t.isNull(), F.lit(None).cast("int"))
    for below, *ramp in RAMPS[:-1]:
        chain = chain.when(t < below, packed(*ramp))
    number = chain.otherwise(packed(*RAMPS[-1][1:]))
    code = F.concat(F.lit("#"), F.lower(F.lpad(F.hex(number), 6, "0")))
    return F.coalesce(code, F.lit(NO_DATA_COLOR))


def last_updated_text(moment: Column) -> Column:
    """``Month DD, YYYY at h:mm am/pm EST``; the zone is a fixed label all year."""
    hour = F.hour(moment)
    text = F.concat(
        F.date_format(F.to_date(moment), "MMMM dd, yyyy"),
        F.lit(" at "),
        (F.pmod(hour + 11, F.lit(12)) + 1).cast("string"),
        F.lit(":"),
        F.lpad(F.minute(moment).cast("string"), 2, "0"),
        F.when(hour < 12, " am ").otherwise(" pm "),
        F.lit(ZONE_SUFFIX),
    )
    return F.coalesce(text, F.lit(NOT_AVAILABLE))
