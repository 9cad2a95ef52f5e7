"""Z-score anomalies, alerts and the analytics envelope."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.operators.series import (
    BLOCK,
    MIN_ANOMALY,
    MIN_SEASONAL,
    _blocked,
    log_overview,
    recent_mean,
    series_summary,
    with_area,
)
from verdance.plans.joins import null_safe_join
from verdance.session import materialise

# fixed value
THRESHOLD = 2.0

# fixed values: the alert kinds in their order
TREND_ALERT = (
    "trend_alert",
    "medium",
    "Declining vegetation trend detected",
    "Investigate irrigation and soil conditions",
)
ANOMALY_ALERT = (
    "anomaly_alert",
    "high",
    "%d vegetation anomalies detected",
    "Check recent dates for crop stress or external factors",
)
HEALTH_ALERT = (
    "health_alert",
    "high",
    "Very low vegetation health detected",
    "Immediate intervention required - check irrigation and crop conditions",
)


def _z_score() -> Column:
    return F.when(
        F.col("n_obs") >= MIN_ANOMALY,
        (F.col("ndvi_mean") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0)),
    )


def _scored(log: DataFrame, overview: DataFrame) -> DataFrame:
    stats = overview.select("aoi_id", "n_obs", "mean", "std")
    return with_area(log, stats).withColumn("z_score", _z_score())


def with_zscores(log: DataFrame) -> DataFrame:
    """Log rows with the z-score in their area; NULL below four entries or for
    a constant series."""
    return _scored(log, log_overview(log))


def anomalies(log: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Entries whose z-score is beyond the threshold, all of them, as rows."""
    return with_zscores(log).where(F.abs("z_score") > threshold)


def _daily(log: DataFrame, overview: DataFrame, threshold: float) -> DataFrame:
    """One row per area and day: entries, their NDVI sum and their anomalies.

    Entries are merged before the shuffle; what is left per area is bounded by
    the calendar.
    """
    return (
        _scored(log, overview)
        .groupBy("aoi_id", "date")
        .agg(
            F.max("n_obs").alias("n_obs"),
            F.max("mean").alias("mean"),
            F.count("ndvi_mean").alias("_n"),
            F.sum("ndvi_mean").alias("_sum"),
            F.count_if(F.abs("z_score") > threshold).alias("_hits"),
        )
    )


def _found(threshold: float) -> list[Column]:
    """Aggregates over the days of an area: size, baseline, anomalies and their days."""
    hit = F.when(
        F.col("_hits") > 0,
        F.struct(F.date_format("date", "yyyy-MM-dd").alias("day"), F.col("_hits").alias("entries")),
    )
    return [
        F.max("n_obs").alias("n_obs"),
        F.sum("_hits").alias("total_anomalies"),
        F.lit(threshold).alias("anomaly_threshold"),
        F.max("mean").alias("baseline_ndvi"),
        F.sort_array(F.collect_list(hit)).alias("_days"),
    ]


def _with_days(found: DataFrame) -> DataFrame:
    return found.withColumns(
        {
            "anomaly_dates": F.transform("_days", lambda d: d["day"]),
            "anomaly_counts": F.transform("_days", lambda d: d["entries"]),
        }
    ).drop("_days")


def anomaly_summary(log: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per area with at least four entries: count, baseline and anomaly dates.

    ``anomaly_dates`` has each date once, in order, so that it is bounded by
    the calendar; ``anomaly_counts`` gives the entries of each of the dates.
    """
    found = _daily(log, log_overview(log), threshold).groupBy("aoi_id").agg(*_found(threshold))
    return _with_days(found.where(F.col("n_obs") >= MIN_ANOMALY))


def anomaly_split(log: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Log rows marked by date: every entry on a day with an anomaly is marked.

    The marks are joined to the blocks first and reach the entries by the
    block, as one day of one area may hold many entries.
    """
    days = (
        anomalies(log, threshold).select("aoi_id", "date").distinct().withColumn("_hit", F.lit(True))
    )
    blocked = _blocked(log)
    marked = null_safe_join(blocked.select(*BLOCK).distinct(), days, ["aoi_id", "date"], "left")
    return (
        null_safe_join(blocked, marked, BLOCK)
        .withColumn("is_anomaly", F.col("_hit").isNotNull())
        .drop("_hit", "_block")
    )


def _alert(condition: Column, kind: tuple[str, str, str, str], message: Column | None = None) -> Column:
    name, severity, text, recommendation = kind
    return F.when(
        condition,
        F.struct(
            F.lit(name).alias("type"),
            F.lit(severity).alias("severity"),
            (F.lit(text) if message is None else message).alias("message"),
            F.lit(recommendation).alias("recommendation"),
        ),
    )


def alert_list(direction: Column, total_anomalies: Column, current_ndvi: Column) -> Column:
    """The alerts that apply, in the order trend, anomaly, health."""
    kinds = F.array(
        _alert(direction == "declining", TREND_ALERT),
        _alert(
            total_anomalies > 0, ANOMALY_ALERT, F.format_string(ANOMALY_ALERT[2], total_anomalies)
        ),
        _alert(current_ndvi < L.VERY_LOW_NDVI, HEALTH_ALERT),
    )
    return F.filter(kinds, lambda a: a.isNotNull())


def _seasonal_map() -> Column:
    """Mean by calendar month from the days of an area, months without entry left out."""
    months = []
    for m in range(1, 13):
        is_month = F.month("date") == m
        mean = F.try_divide(
            F.sum(F.when(is_month, F.col("_sum"))), F.sum(F.when(is_month, F.col("_n")))
        )
        months.append(F.struct(F.lit(m).alias("month"), mean.alias("ndvi_mean")))
    present = F.filter(F.array(*months), lambda m: m["ndvi_mean"].isNotNull())
    return F.map_from_entries(present)


def advanced_analytics(log: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Trend, anomalies, health and alerts: one row per area.

    The per-area trend is written once; it serves the scores of the entries and
    the result.  Entries are shuffled only for their positions.
    """
    summary = materialise(
        series_summary(log).select("aoi_id", "n_obs", "mean", "std", "slope", "r_squared"), "trend"
    )
    days = _daily(log, summary, threshold).groupBy("aoi_id").agg(
        *_found(threshold), _seasonal_map().alias("_months")
    )
    trend = null_safe_join(days, summary.select("aoi_id", "slope", "r_squared"), ["aoi_id"])
    analytics = (
        null_safe_join(trend, recent_mean(log), ["aoi_id"], "left")
        .withColumnsRenamed({"slope": "trend_slope", "recent_ndvi": "current_ndvi"})
    )
    n = F.col("n_obs")
    direction = L.trend_direction(F.col("trend_slope"))
    return _with_days(analytics).select(
        "aoi_id",
        n.alias("data_points_analyzed"),
        "trend_slope",
        direction.alias("trend_direction"),
        "r_squared",
        F.when(n >= MIN_SEASONAL, F.col("_months")).alias("seasonal_pattern"),
        *[
            F.when(n >= MIN_ANOMALY, F.col(c)).alias(c)
            for c in (
                "total_anomalies", "anomaly_threshold", "baseline_ndvi",
                "anomaly_dates", "anomaly_counts",
            )
        ],
        "current_ndvi",
        L.current_health(F.col("current_ndvi")).alias("health_status"),
        L.confidence(n).alias("confidence"),
        alert_list(direction, F.col("total_anomalies"), F.col("current_ndvi")).alias("alerts"),
    )


def analytics_document(analytics: DataFrame, timestamp: dt.datetime | None = None) -> DataFrame:
    """Nested form of ``advanced_analytics``; a section with too little data is NULL.

    Months become text, as keys of JSON objects are.
    """
    stamp = F.current_timestamp() if timestamp is None else F.lit(timestamp)
    months = F.col("seasonal_pattern").cast("map<string,double>")
    no_months = F.create_map().cast("map<string,double>")
    return analytics.select(
        "aoi_id",
        F.when(
            F.col("trend_slope").isNotNull(),
            F.struct(
                "trend_slope",
                "trend_direction",
                "r_squared",
                F.coalesce(months, no_months).alias("seasonal_pattern"),
            ),
        ).alias("trend_analysis"),
        F.when(
            F.col("total_anomalies").isNotNull(),
            F.struct(
                "total_anomalies", "anomaly_threshold", "baseline_ndvi",
                "anomaly_dates", "anomaly_counts",
            ),
        ).alias("anomaly_detection"),
        F.struct("current_ndvi", "health_status", "confidence").alias("health_classification"),
        "alerts",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("analysis_timestamp"),
        "data_points_analyzed",
    )


def alert_rows(analytics: DataFrame, shown: int | None = None) -> DataFrame:
    """One row per alert; ``shown`` keeps the first few in creation order."""
    alerts = F.col("alerts") if shown is None else F.slice("alerts", 1, shown)
    return analytics.select("aoi_id", F.posexplode(alerts).alias("_pos", "_alert")).select(
        "aoi_id", (F.col("_pos") + 1).alias("alert_no"), "_alert.*"
    )
