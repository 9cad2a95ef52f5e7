"""Tables behind the dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.operators import anomalies as A
from verdance.operators import correlation as C
from verdance.operators import series as S


def status_row(analytics: DataFrame, log: DataFrame) -> DataFrame:
    """One row per area: size, range, health, trend and number of alerts."""
    overview = S.log_overview(log).select("aoi_id", "n_obs", "first_date", "last_date")
    facts = analytics.select(
        "aoi_id", "health_status", "trend_direction", F.size("alerts").alias("active_alerts")
    )
    return overview.join(facts, "aoi_id", "left").select(
        "aoi_id",
        "n_obs",
        "first_date",
        "last_date",
        L.title(F.col("health_status")).alias("current_health"),
        L.title(F.col("trend_direction")).alias("trend"),
        F.coalesce("active_alerts", F.lit(0)).alias("active_alerts"),
    )


def report_labels(log: DataFrame) -> DataFrame:
    """Interpretation texts of the trend report."""
    direction = F.col("direction")
    return S.series_summary(log).select(
        "aoi_id",
        "mean",
        L.ndvi_interpretation(F.col("mean")).alias("interpretation"),
        F.initcap(direction).alias("trend"),
        L.trend_interpretation(direction).alias("trend_text"),
    )


def processing_timeline(log: DataFrame) -> DataFrame:
    """A success mark per processed scene."""
    return log.select("aoi_id", "scene_id", "date", F.lit(1).alias("success"))


def climate_panels(insights: DataFrame) -> dict[str, DataFrame]:
    """Panels of the climate report: correlation bars, stress summary, data quality."""
    return {
        "correlations": C.correlations(insights),
        "stress_impact": C.stress_impact(insights),
        "overview": C.join_overview(insights),
        "quality": C.quality_row(insights),
    }


def dashboard_tables(log: DataFrame, analytics: DataFrame | None = None) -> dict[str, DataFrame]:
    """All panels, each a DataFrame that is computed only when it is used."""
    analytics = A.advanced_analytics(log) if analytics is None else analytics
    return {
        "trend_line": S.trend_line(log),
        "health_distribution": S.health_distribution(log),
        "histogram": S.histogram(log),
        "anomaly_split": A.anomaly_split(log),
        "status": status_row(analytics, log),
        "alerts": A.alert_rows(analytics, shown=3),
        "seasonal_pattern": S.seasonal_pattern(log),
        "processing_timeline": processing_timeline(log),
    }
