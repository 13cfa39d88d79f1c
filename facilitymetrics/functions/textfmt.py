"""Display text for indicators.

``format_number`` rounds half to even; ``format_string('%.2f')`` rounds half up and would
differ in the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"
NOT_RATED = "Not rated"
TOP_RATING = 5


def fixed(value: Column, decimals: int) -> Column:
    """Fixed decimals, no thousands separator."""
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", value, F.lit(pattern))


def grouped(value: Column, decimals: int) -> Column:
    """Fixed decimals with thousands separators."""
    return F.format_number(value, decimals)


def percent(fraction: Column, decimals: int = 1) -> Column:
    return F.concat(fixed(fraction * 100, decimals), F.lit("%"))


def ratio_to_one(ratio: Column) -> Column:
    return F.concat(fixed(ratio, 2), F.lit(":1"))


def or_not_available(text: Column) -> Column:
    return F.coalesce(text, F.lit(NOT_AVAILABLE))


def stars(rating: Column) -> Column:
    """Filled and hollow stars with the rating spelled out, e.g. ``★★★☆☆ (3/5)``."""
    whole = rating.cast("int")
    drawn = F.concat(
        F.repeat(F.lit("★"), whole),
        F.repeat(F.lit("☆"), F.lit(TOP_RATING) - whole),
        F.lit(" ("),
        whole.cast("string"),
        F.lit(f"/{TOP_RATING})"),
    )
    return F.coalesce(drawn, F.lit(NOT_RATED))
