"""Trends, anomalies and alerts against NumPy and pandas, at every size and for hot areas."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.operators import anomalies as A
from verdance.operators import dashboard, series, veglog

EIGHT = [0.42, 0.40, 0.41, 0.39, 0.38, 0.37, 0.36, 0.05]


def one(df, aoi="a"):
    return df.where(F.col("aoi_id") == aoi).first()


def test_hand_case(log_of):
    log = log_of({"a": EIGHT})
    s = one(series.series_summary(log))
    assert [round(v, 6) for v in (s.slope, s.intercept, s.r_squared, s["mean"], s["std"])] == [
        -0.034762, 0.469167, 0.488238, 0.3475, 0.121861,
    ]
    assert s.direction == "declining"
    z = [round(r.z_score, 6) for r in A.with_zscores(log).orderBy("date").collect()]
    assert z == [0.594942, 0.430820, 0.512881, 0.348759, 0.266698, 0.184637, 0.102576, -2.441315]
    c = one(series.recent_vs_historical(log))
    assert [round(v, 6) for v in (c.recent_ndvi, c.historical_ndvi, c.change)] == [0.26, 0.41, -0.15]
    a = one(A.advanced_analytics(log))
    assert (a.health_status, a.confidence, a.total_anomalies) == ("moderate", "high", 1)
    assert [(x.type, x.severity) for x in a.alerts] == [("trend_alert", "medium"), ("anomaly_alert", "high")]
    assert a.alerts[1].message == "1 vegetation anomalies detected"
    assert a.anomaly_dates == ["2020-08-01"]
    bins = {r.bin: r.scenes for r in series.histogram(log).collect()}
    assert [bins.get(i, 0) for i in range(10)] == [1, 0, 0, 0, 0, 0, 0, 0, 3, 4]


@pytest.mark.parametrize("n", range(1, 8))
def test_guards(log_of, n):
    values = EIGHT[:n]
    log = log_of({"a": values})
    s = one(series.series_summary(log))
    assert (s.slope is None) == (n < 3) and (s.r_squared is None) == (n < 3)
    assert (s["std"] is None) == (n < 2)
    assert (series.recent_vs_historical(log).count() == 1) == (n >= 6)
    assert (series.seasonal_pattern(log).count() > 0) == (n >= 6)
    assert (series.seasonal_pattern(log, series.MIN_SEASONAL_CHART).count() > 0) == (n >= 4)
    assert (A.anomaly_summary(log).count() == 1) == (n >= 4)
    a = one(A.advanced_analytics(log))
    assert (a.total_anomalies is None) == (n < 4) and (a.seasonal_pattern is None) == (n < 6)
    assert a.confidence == ("high" if n >= 5 else "medium" if n >= 3 else "low")
    assert a.current_ndvi == pytest.approx(np.mean(values[-3:]))
    document = one(A.analytics_document(A.advanced_analytics(log), dt.datetime(2024, 1, 1)))
    assert (document.trend_analysis is None) == (n < 3)
    assert (document.anomaly_detection is None) == (n < 4)
    if n >= 3:
        assert s.slope == pytest.approx(np.polyfit(np.arange(n), values, 1)[0])


def test_constant_series(log_of):
    log = log_of({"a": [0.1] * 7})
    s = one(series.series_summary(log))
    assert (s.slope, s.direction, s.r_squared, s["std"]) == (0.0, "stable", None, 0.0)
    assert A.anomalies(log).count() == 0
    a = one(A.advanced_analytics(log))
    assert a.total_anomalies == 0 and [x.type for x in a.alerts] == ["health_alert"]
    bins = series.histogram(log).collect()
    assert len(bins) == 1 and bins[0].bin == 5 and bins[0].scenes == 7


def test_empty_log(spark):
    log = spark.createDataFrame([], schemas.VEGLOG)
    assert series.vegetation_trends(log).count() == 0
    assert A.advanced_analytics(log).count() == 0


@pytest.mark.parametrize(
    "slope,direction", [(0.002, "improving"), (0.0005, "stable"), (-0.0005, "stable"), (-0.002, "declining")]
)
def test_direction(log_of, slope, direction):
    s = one(series.series_summary(log_of({"a": [0.3 + slope * i for i in range(6)]})))
    assert s.direction == direction


@pytest.mark.parametrize("value,status,alert", [(0.31, "good", False), (0.3, "moderate", False), (0.2, "poor", False), (0.15, "poor", False), (0.149, "poor", True)])
def test_health_limits(log_of, value, status, alert):
    a = one(A.advanced_analytics(log_of({"a": [value]})))
    assert a.health_status == status
    assert ("health_alert" in [x.type for x in a.alerts]) is alert


def _hot_log(spark):
    """Three areas, one of which owns most entries, most of them on one day."""
    rng = random.Random(11)
    rows, seq = [], 0
    for i in range(1500):
        aoi = "hot" if i % 5 else rng.choice(["b", "c"])
        day = dt.date(2024, 3, 5) if rng.random() < 0.5 else dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(700))
        ndvi = rng.gauss(0.3, 0.05) if rng.random() > 0.02 else rng.choice([0.9, -0.4])
        rows.append((aoi, f"s{i}", day, ndvi, "Good" if ndvi > 0.3 else "Poor", seq))
        seq += 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, schemas.VEGLOG).repartition(7)


def test_hot_area_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_BITS", 4)
    log = _hot_log(spark)
    frame = log.toPandas().sort_values(["aoi_id", "date", "seq"])
    positions = {(r.aoi_id, r.seq): r.idx for r in series.with_positions(log).collect()}
    summary = {r.aoi_id: r for r in series.series_summary(log).collect()}
    z = {(r.aoi_id, r.seq): r.z_score for r in A.with_zscores(log).collect()}
    split = {(r.aoi_id, r.seq): r.is_anomaly for r in A.anomaly_split(log).collect()}
    analytics = {r.aoi_id: r for r in A.advanced_analytics(log).collect()}
    bins = {}
    for r in series.histogram(log).collect():
        bins.setdefault(r.aoi_id, {})[r.bin] = r.scenes
    assert len(positions) == len(frame) == len(split)
    for aoi, g in frame.groupby("aoi_id"):
        y, x = g["ndvi_mean"].to_numpy(), np.arange(len(g))
        assert [positions[aoi, s] for s in g["seq"]] == list(x)
        slope, intercept = np.polyfit(x, y, 1)
        s = summary[aoi]
        assert s.n_obs == len(g)
        assert s.slope == pytest.approx(slope, abs=1e-12) and s.intercept == pytest.approx(intercept)
        assert s.r_squared == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2)
        assert s["std"] == pytest.approx(g["ndvi_mean"].std()) and s["mean"] == pytest.approx(y.mean())
        score = (g["ndvi_mean"] - y.mean()) / g["ndvi_mean"].std()
        assert [z[aoi, q] for q in g["seq"]] == pytest.approx(list(score), abs=1e-9)
        days = set(g.loc[score.abs() > 2, "date"])
        assert [split[aoi, q] for q in g["seq"]] == [d in days for d in g["date"]]
        a = analytics[aoi]
        assert a.total_anomalies == (score.abs() > 2).sum() == sum(a.anomaly_counts)
        assert a.anomaly_dates == sorted(d.isoformat() for d in days)
        assert a.current_ndvi == pytest.approx(y[-3:].mean())
        monthly = g.groupby(pd.to_datetime(g["date"]).dt.month)["ndvi_mean"].mean()
        assert a.seasonal_pattern == pytest.approx(monthly.to_dict())
        counts, _ = np.histogram(y, bins=10)
        assert [bins[aoi].get(i, 0) for i in range(10)] == list(counts)


def test_trend_report(log_of):
    r = one(series.vegetation_trends(log_of({"a": EIGHT, "b": [0.5, 0.2]})))
    assert (r.total_scenes, r.date_range.start, r.date_range.end) == (8, "2020-01-01", "2020-08-01")
    assert r.health_distribution == {"Good": 7, "Poor": 1}
    assert r.trend.direction == "declining" and round(r.comparison.change, 6) == -0.15
    b = one(series.vegetation_trends(log_of({"a": EIGHT, "b": [0.5, 0.2]})), "b")
    assert b.trend is None and b.comparison is None


def test_rolling_log_keeps_arrival_order(spark):
    rows = [("a", f"s{i}", dt.date(2024, 1, 1) - dt.timedelta(i), 0.1, "Poor", i) for i in range(30)]
    log = spark.createDataFrame(rows, schemas.VEGLOG)
    kept = sorted(r.seq for r in veglog.rolling_last(log).collect())
    assert kept == list(range(10, 30))


def test_append_keeps_duplicates(spark, log_of):
    log = log_of({"a": [0.1, 0.2]})
    again = log.withColumn("seq", F.col("seq") + 10).withColumn("ndvi_mean", F.lit(0.9))
    assert veglog.append(log, again).count() == 4
    deduped = veglog.append(log, again, dedupe=True).collect()
    assert len(deduped) == 2 and all(r.ndvi_mean == 0.9 for r in deduped)


def test_dashboard_tables(log_of):
    tables = dashboard.dashboard_tables(log_of({"a": EIGHT}))
    assert one(tables["status"]).trend == "Declining" and one(tables["status"]).active_alerts == 2
    assert tables["trend_line"].count() == 8 and tables["processing_timeline"].count() == 8
    assert {r.type for r in tables["alerts"].collect()} == {"trend_alert", "anomaly_alert"}
