"""Vegetation log against climate: join, correlations, water-stress impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.functions.climate import water_stressed
from verdance.plans.joins import lookup_join

# fixed values
VARIABLES = ("temperature_avg", "precipitation", "humidity", "heat_stress_index")


def climate_join(log: DataFrame, climate: DataFrame, bounded: bool | None = None) -> DataFrame:
    """Inner join by date (and area, if the climate is by area).

    Duplicate dates multiply rows.  ``bounded=True`` says the climate has one
    row per date, which the calendar bounds; by default it is counted.
    """
    by_area = "aoi_id" in climate.columns
    if by_area and bounded:
        raise ValueError("climate by area grows with the areas: its size must be counted")
    known = climate.where("date is not null")
    return lookup_join(log, known, ["aoi_id", "date"] if by_area else ["date"], bounded=bounded)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over pairs without missing; NULL if either is constant."""
    x_paired, y_paired = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_samp(x, y), F.stddev_samp(x_paired) * F.stddev_samp(y_paired)
    )


def climate_insights(
    joined: DataFrame,
    variables: Sequence[str] = VARIABLES,
    keys: Sequence[str] = ("aoi_id",),
) -> DataFrame:
    """Overview, correlations and stress impact in one aggregate.

    A variable is used only if the table has it; the stress part needs heat
    stress and precipitation.  A group without joined rows has no row.
    """
    y = F.col("ndvi_mean")
    present = [v for v in variables if v in joined.columns]
    aggregates = [
        F.count("*").alias("data_points"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        *[safe_corr(F.col(v), y).alias(f"corr_{v}") for v in present],
    ]
    has_stress = {"heat_stress_index", "precipitation"} <= set(joined.columns)
    if has_stress:
        stressed = water_stressed(F.col("heat_stress_index"), F.col("precipitation"))
        aggregates += [
            F.count_if(stressed).alias("water_stress_periods"),
            F.avg(F.when(stressed, y)).alias("ndvi_during_stress"),
            F.avg(F.when(~stressed, y)).alias("ndvi_normal"),
        ]
    found = joined.groupBy(*keys).agg(*aggregates)
    if not keys:
        found = found.where(F.col("data_points") > 0)
    if has_stress:
        any_stress = F.col("water_stress_periods") > 0
        found = found.withColumn(
            "ndvi_normal", F.when(any_stress, F.col("ndvi_normal"))
        ).withColumn("impact_magnitude", F.col("ndvi_normal") - F.col("ndvi_during_stress"))
    return found


def _corr_columns(insights: DataFrame) -> list[str]:
    return [c for c in insights.columns if c.startswith("corr_")]


def correlations(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """One row per variable with its sign and whether it is strong."""
    rows = F.array(
        *[
            F.struct(F.lit(c.removeprefix("corr_")).alias("variable"), F.col(c).alias("r"))
            for c in _corr_columns(insights)
        ]
    )
    r = F.col("r")
    return insights.select(*keys, F.inline(rows)).withColumns(
        {"sign": L.correlation_sign(r), "strong": L.is_strong(r)}
    )


def strong_correlations(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    return correlations(insights, keys).where("strong").drop("strong")


def stress_impact(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """Count of stress rows and NDVI under stress and otherwise; NULL without stress."""
    return insights.select(
        *keys, "water_stress_periods", "ndvi_during_stress", "ndvi_normal", "impact_magnitude"
    )


def join_overview(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    return insights.select(*keys, "data_points", "first_date", "last_date")


def quality_row(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """Overlap and number of strong correlations."""
    strong = sum(
        (L.is_strong(F.col(c)).cast("int") for c in _corr_columns(insights)), F.lit(0)
    )
    return insights.select(*keys, "data_points", strong.alias("strong_correlations"))


def correlation_document(insights: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """Nested form: correlations and strong ones as maps, optional stress impact."""
    pairs = F.map_from_entries(
        F.array(
            *[
                F.struct(F.lit(c.removeprefix("corr_")).alias("key"), F.col(c).alias("value"))
                for c in _corr_columns(insights)
            ]
        )
    )
    columns = [
        *[F.col(k) for k in keys],
        pairs.alias("correlations"),
        F.map_filter(pairs, lambda _, v: L.is_strong(v)).alias("strong_relationships"),
        F.col("data_points"),
        F.struct(
            F.date_format("first_date", "yyyy-MM-dd").alias("start"),
            F.date_format("last_date", "yyyy-MM-dd").alias("end"),
        ).alias("date_range"),
    ]
    if "water_stress_periods" in insights.columns:
        columns += [
            F.col("water_stress_periods"),
            F.when(
                F.col("water_stress_periods") > 0,
                F.struct("ndvi_during_stress", "ndvi_normal", "impact_magnitude"),
            ).alias("stress_impact"),
        ]
    return insights.select(*columns)
