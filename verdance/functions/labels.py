"""Classes, labels and texts derived from numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
GOOD_NDVI = 0.3
MODERATE_NDVI = 0.2
VERY_LOW_NDVI = 0.15
TREND_SLOPE = 0.001
STRONG_CORRELATION = 0.5


def scene_health(ndvi_mean: Column) -> Column:
    """Two classes; a scene without a valid pixel counts as 0."""
    return F.when(F.coalesce(ndvi_mean, F.lit(0.0)) > GOOD_NDVI, "Good").otherwise("Poor")


def coverage_percent(vegetation_pixels: Column, count: Column) -> Column:
    """Share of vegetation pixels in percent, 0 where there is no valid pixel."""
    return F.when(count > 0, vegetation_pixels / count * 100.0).otherwise(F.lit(0.0))


def percent_text(percent: Column) -> Column:
    """One decimal, correctly rounded from the stored binary value, half to even.

    Ten times the value is 8x + 2x; ``rest`` is what that sum lost, and it
    decides where the sum lies halfway between two tenths.
    """
    eight, two = percent * 8.0, percent * 2.0
    tenfold = eight + two
    back = tenfold - eight
    rest = (eight - (tenfold - back)) + (two - back)
    halfway = (tenfold - F.floor(tenfold)) == 0.5
    tenths = (
        F.when(halfway & (rest > 0), F.ceil(tenfold))
        .when(halfway & (rest < 0), F.floor(tenfold))
        .otherwise(F.rint(tenfold).cast("bigint"))
    )
    return F.format_string("%d.%d%%", F.floor(tenths / 10), tenths % 10)


def trend_direction(slope: Column) -> Column:
    return (
        F.when(slope > TREND_SLOPE, "improving")
        .when(slope < -TREND_SLOPE, "declining")
        .when(slope.isNotNull(), "stable")
    )


def current_health(recent_ndvi: Column) -> Column:
    return (
        F.when(recent_ndvi > GOOD_NDVI, "good")
        .when(recent_ndvi > MODERATE_NDVI, "moderate")
        .otherwise("poor")
    )


def confidence(n: Column) -> Column:
    return F.when(n >= 5, "high").when(n >= 3, "medium").otherwise("low")


# fixed values: the sentences of the trend report, here and below


def ndvi_interpretation(mean: Column) -> Column:
    return (
        F.when(mean > GOOD_NDVI, "Good vegetation health")
        .when(mean > MODERATE_NDVI, "Moderate vegetation")
        .otherwise("Sparse vegetation")
    )


def trend_interpretation(direction: Column) -> Column:
    return (
        F.when(direction == "improving", "Vegetation health is showing positive development")
        .when(direction == "declining", "Vegetation health shows concerning decline")
        .when(direction == "stable", "Vegetation health remains stable over time")
    )


def correlation_sign(r: Column) -> Column:
    return F.when(r > 0, "positive").when(r.isNotNull(), "negative")


def is_strong(r: Column) -> Column:
    return F.coalesce(F.abs(r) > STRONG_CORRELATION, F.lit(False))


def title(text: Column, default: str = "Unknown") -> Column:
    return F.initcap(F.coalesce(text, F.lit(default)))


def share_percent(part: Column, total: Column) -> Column:
    return part / total * 100.0


# fixed values: the forms of period and batch names


def period_label(start: Column, end: Column) -> Column:
    return F.concat_ws("_to_", start.cast("string"), end.cast("string"))


def batch_label(number: Column) -> Column:
    return F.format_string("batch_%d", number)
