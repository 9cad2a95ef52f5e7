"""Daily climate indices, summary, seasonal baseline and calendar gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import climate as C
from verdance.plans.ordering import running_sum


def _keys(climate: DataFrame) -> list[str]:
    return ["aoi_id"] if "aoi_id" in climate.columns else []


def climate_indices(observed: DataFrame) -> DataFrame:
    """Add cumulative precipitation, growing-degree days and water-stress flag.

    The running total goes by month: totals of months first, then days inside
    their month.
    """
    keys = _keys(observed)
    keyed = observed.withColumn("_month", F.trunc("date", "month"))
    if not keys:
        keyed = keyed.withColumn("_all", F.lit(0))
    total = running_sum(
        keyed, keys or ["_all"], ["_month"], ["date"], "precipitation", "cumulative_precip"
    ).drop("_month", "_all")
    return total.withColumns(
        {
            "growing_degree_days": C.growing_degree_days(F.col("temperature_avg")),
            "water_stress_risk": C.water_stress_risk(
                F.col("temperature_max"), F.col("precipitation")
            ),
        }
    )


def daily_climate(raw: DataFrame) -> DataFrame:
    """Daily rows from the unrounded ``temperature``, ``precipitation`` and
    ``humidity``: rounded values, derived extremes and heat-stress index."""
    t = F.col("temperature")
    return raw.select(
        *_keys(raw),
        "date",
        *[c.alias(n) for n, c in C.derived_temperatures(t).items()],
        C.round_scaled(F.col("precipitation"), 2).alias("precipitation"),
        C.round_scaled(C.clamp_humidity(F.col("humidity")), 1).alias("humidity"),
        C.heat_stress_index(t).alias("heat_stress_index"),
    )


def _exact_sum(name: str) -> Column:
    """Sum of a daily value, which has few decimals, in any order of the rows alike."""
    return F.sum(F.col(name).cast("decimal(18,4)")).cast("double")


def climate_summary(indices: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Days, mean temperature, totals, and the days flagged as water stress."""
    keys = _keys(indices) if keys is None else list(keys)
    return indices.groupBy(*keys).agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("total_days"),
        C.round_scaled(_exact_sum("temperature_avg") / F.count("temperature_avg"), 1).alias("avg_temperature"),
        C.round_scaled(_exact_sum("precipitation"), 1).alias("total_precipitation"),
        F.sum("water_stress_risk").alias("heat_stress_days"),
        C.round_scaled(_exact_sum("growing_degree_days"), 1).alias("growing_degree_days"),
    )


def seasonal_baseline(climate: DataFrame) -> DataFrame:
    """Expected temperature and humidity of the day and the observation's departure."""
    date = F.col("date")
    expected = climate.withColumns(
        {
            "expected_temperature": C.expected_temperature(date),
            "expected_humidity": C.clamp_humidity(C.expected_humidity(date)),
            "rainy_season": C.is_rainy_season(date),
        }
    )
    return expected.withColumns(
        {
            "temperature_departure": F.col("temperature_avg") - F.col("expected_temperature"),
            "humidity_departure": F.col("humidity") - F.col("expected_humidity"),
        }
    )


def calendar_days(ranges: DataFrame, start: str = "first_date", end: str = "last_date") -> DataFrame:
    """Every day of each row's closed interval."""
    rest = [c for c in ranges.columns if c not in (start, end)]
    return ranges.select(*rest, F.explode(F.sequence(start, end)).alias("date"))


def calendar_gaps(climate: DataFrame) -> DataFrame:
    """Days without a row between the first and the last day."""
    keys = _keys(climate)
    ranges = climate.groupBy(*keys).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    present = climate.select(*keys, "date").distinct()
    return calendar_days(ranges).join(present, [*keys, "date"], "left_anti")
