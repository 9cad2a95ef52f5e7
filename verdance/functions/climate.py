"""Daily climate indices as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
GDD_BASE = 10.0
HEAT_STRESS_BASE = 35.0
HOT_DAY = 40.0
DRY_DAY = 0.1
STRESS_INDEX = 2.0
HUMIDITY_RANGE = (30.0, 90.0)
TEMPERATURE_CURVE = (32.0, 13.0, 100)
HUMIDITY_CURVE = (60.0, 20.0, 180)
RAINY_MONTHS = (12, 1, 2, 3)
MAX_OFFSET, MIN_OFFSET = 3.0, 8.0


def round_scaled(value: Column, digits: int) -> Column:
    """Round half to even on the scaled value, as array libraries do."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def _positive_part(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), value))


def growing_degree_days(temperature_avg: Column) -> Column:
    return _positive_part(temperature_avg - GDD_BASE)


def heat_stress_index(temperature: Column) -> Column:
    return round_scaled(_positive_part(temperature - HEAT_STRESS_BASE), 1)


def water_stress_risk(temperature_max: Column, precipitation: Column) -> Column:
    """1 on a hot and dry day, else 0 (also when a value is missing)."""
    risky = (temperature_max > HOT_DAY) & (precipitation < DRY_DAY)
    return F.coalesce(risky, F.lit(False)).cast("int")


def water_stressed(heat_stress: Column, precipitation: Column) -> Column:
    """Stress predicate of the joined log; missing counts as not stressed."""
    return F.coalesce((heat_stress > STRESS_INDEX) & (precipitation < DRY_DAY), F.lit(False))


def _curve(date: Column, mean: float, amplitude: float, phase: int) -> Column:
    angle = F.lit(2 * math.pi) * (F.dayofyear(date) - phase) / 365.0
    return F.lit(mean) + amplitude * F.sin(angle)


def expected_temperature(date: Column) -> Column:
    return _curve(date, *TEMPERATURE_CURVE)


def expected_humidity(date: Column) -> Column:
    return _curve(date, *HUMIDITY_CURVE)


def clamp_humidity(humidity: Column) -> Column:
    low, high = HUMIDITY_RANGE
    return F.when(humidity.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), humidity)))


def is_rainy_season(date: Column) -> Column:
    return F.month(date).isin(*RAINY_MONTHS)


def derived_temperatures(mean: Column) -> dict[str, Column]:
    """Daily maximum, minimum and mean from the unrounded mean."""
    return {
        "temperature_max": round_scaled(mean + MAX_OFFSET, 1),
        "temperature_min": round_scaled(mean - MIN_OFFSET, 1),
        "temperature_avg": round_scaled(mean, 1),
    }
