"""SQL of the driver-table views, for the side-by-side check in another engine."""

from __future__ import annotations

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "pixels": (
        (),
        """
        SELECT l_suppkey AS aoi_id,
               cast(date_trunc('month', l_shipdate) AS date) AS scene_date,
               cast(round(l_extendedprice * 100) AS bigint) % 4000 AS red_dn,
               1500 + (l_partkey * 37 + l_linenumber * 911 + l_orderkey * 13) % 9500 AS nir_dn,
               (cast(round(l_extendedprice * 100) AS bigint) * 7 + l_orderkey) % 4200 AS green_dn,
               (cast(round(l_extendedprice * 100) AS bigint) * 13 + l_partkey) % 2600 AS blue_dn,
               557400 + (l_orderkey * 31 + l_linenumber * 7) % 100 AS lon_e4,
               242030 + (l_partkey * 17 + l_linenumber) % 100 AS lat_e4
        FROM lineitem
        """,
    ),
    "bands": (
        ("pixels",),
        """
        SELECT aoi_id, scene_date, lon_e4, lat_e4,
               CASE WHEN red_dn > 0 AND red_dn <= 10000 THEN cast(red_dn AS double) END AS red,
               CASE WHEN nir_dn > 0 AND nir_dn <= 10000 THEN cast(nir_dn AS double) END AS nir,
               CASE WHEN green_dn > 0 AND green_dn <= 10000 THEN cast(green_dn AS double) END AS green,
               CASE WHEN blue_dn > 0 AND blue_dn <= 10000 THEN cast(blue_dn AS double) END AS blue
        FROM pixels
        """,
    ),
    "indices": (
        ("bands",),
        """
        SELECT aoi_id, scene_date, lon_e4, lat_e4,
               CASE WHEN nir + red > 0 THEN (nir - red) / (nir + red) END AS ndvi,
               CASE WHEN nir + 6 * red - cast(7.5 AS double) * blue + 10000 > 0
                    THEN cast(2.5 AS double) * ((nir - red) / (nir + 6 * red - cast(7.5 AS double) * blue + 10000))
               END AS evi,
               CASE WHEN green + nir > 0 THEN (green - nir) / (green + nir) END AS ndwi
        FROM bands
        """,
    ),
    "stats": (
        ("indices",),
        """
        SELECT aoi_id, scene_date,
               avg(ndvi) AS ndvi_mean, stddev_pop(ndvi) AS ndvi_std, min(ndvi) AS ndvi_min,
               max(ndvi) AS ndvi_max, count(ndvi) AS ndvi_count,
               avg(evi) AS evi_mean, stddev_pop(evi) AS evi_std, min(evi) AS evi_min,
               max(evi) AS evi_max, count(evi) AS evi_count,
               avg(ndwi) AS ndwi_mean, stddev_pop(ndwi) AS ndwi_std, min(ndwi) AS ndwi_min,
               max(ndwi) AS ndwi_max, count(ndwi) AS ndwi_count,
               count(CASE WHEN ndvi > 0.3 THEN 1 END) AS vegetation_pixels,
               CASE WHEN coalesce(avg(ndvi), 0) > 0.3 THEN 'Good' ELSE 'Poor' END AS vegetation_health,
               CASE WHEN count(ndvi) > 0
                    THEN count(CASE WHEN ndvi > 0.3 THEN 1 END) / cast(count(ndvi) AS double) * 100
                    ELSE 0 END AS vegetation_coverage
        FROM indices GROUP BY aoi_id, scene_date
        """,
    ),
    "veglog": (
        ("stats",),
        """
        SELECT aoi_id, cast(aoi_id AS varchar) || '_' || cast(scene_date AS varchar) AS scene_id,
               scene_date AS date, coalesce(ndvi_mean, 0) AS ndvi_mean, vegetation_health,
               row_number() OVER (PARTITION BY aoi_id ORDER BY scene_date) AS seq
        FROM stats
        """,
    ),
    "numbered": (
        ("veglog",),
        """
        SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY date, seq) - 1 AS idx,
               row_number() OVER (PARTITION BY aoi_id ORDER BY date DESC, seq DESC) - 1 AS back_idx,
               count(*) OVER (PARTITION BY aoi_id) AS n_obs,
               avg(ndvi_mean) OVER (PARTITION BY aoi_id) AS mean,
               min(ndvi_mean) OVER (PARTITION BY aoi_id) AS lo,
               max(ndvi_mean) OVER (PARTITION BY aoi_id) AS hi,
               stddev_samp(ndvi_mean) OVER (PARTITION BY aoi_id) AS std
        FROM veglog
        """,
    ),
    "trends": (
        ("numbered",),
        """
        SELECT *, CASE WHEN slope > 0.001 THEN 'improving' WHEN slope < -0.001 THEN 'declining'
                       WHEN slope IS NOT NULL THEN 'stable' END AS direction
        FROM (SELECT aoi_id, count(*) AS n_obs, min(date) AS first_date, max(date) AS last_date,
                     avg(ndvi_mean) AS mean,
                     CASE WHEN count(*) >= 3 THEN regr_slope(ndvi_mean, idx) END AS slope,
                     CASE WHEN count(*) >= 3 THEN regr_intercept(ndvi_mean, idx) END AS intercept,
                     CASE WHEN count(*) >= 3 AND min(ndvi_mean) < max(ndvi_mean)
                          THEN power(corr(ndvi_mean, idx), 2) END AS r_squared,
                     avg(CASE WHEN back_idx < 3 THEN ndvi_mean END) AS recent_ndvi,
                     avg(CASE WHEN idx < 3 THEN ndvi_mean END) AS historical_ndvi
              FROM numbered GROUP BY aoi_id)
        """,
    ),
    "zscores": (
        ("numbered",),
        """
        SELECT *, CASE WHEN n_obs >= 4 AND lo < hi THEN (ndvi_mean - mean) / std END AS z_score
        FROM numbered
        """,
    ),
    "alert_flags": (
        ("trends", "zscores"),
        """
        SELECT t.*, coalesce(z.total_anomalies, 0) AS total_anomalies
        FROM trends t LEFT JOIN (SELECT aoi_id, count(*) AS total_anomalies FROM zscores
                                 WHERE abs(z_score) > 2 GROUP BY aoi_id) z ON t.aoi_id = z.aoi_id
        """,
    ),
    "alerts": (
        ("alert_flags",),
        """
        SELECT aoi_id, row_number() OVER (PARTITION BY aoi_id ORDER BY kind) AS alert_no,
               type, severity, message, recommendation
        FROM (SELECT aoi_id, 1 AS kind, 'trend_alert' AS type, 'medium' AS severity,
                     'Declining vegetation trend detected' AS message,
                     'Investigate irrigation and soil conditions' AS recommendation
              FROM alert_flags WHERE direction = 'declining'
              UNION ALL
              SELECT aoi_id, 2, 'anomaly_alert', 'high',
                     cast(total_anomalies AS varchar) || ' vegetation anomalies detected',
                     'Check recent dates for crop stress or external factors'
              FROM alert_flags WHERE total_anomalies > 0
              UNION ALL
              SELECT aoi_id, 3, 'health_alert', 'high', 'Very low vegetation health detected',
                     'Immediate intervention required - check irrigation and crop conditions'
              FROM alert_flags WHERE recent_ndvi < 0.15)
        """,
    ),
    "climate_days": (
        (),
        """
        SELECT date, temperature_avg, temperature_avg + 3 AS temperature_max,
               temperature_avg - 8 AS temperature_min, precipitation, humidity,
               round_even(greatest(0, temperature_avg - 35) * cast(10 AS double), 0) / 10 AS heat_stress_index
        FROM (SELECT cast(o_orderdate AS date) AS date,
                     20 + (sum(cast(round(o_totalprice * 100) AS bigint)) % 2600) / cast(100 AS double) AS temperature_avg,
                     CASE WHEN sum(o_custkey) % 100 < 30 THEN (sum(o_custkey) % 500) / cast(100 AS double)
                          ELSE 0 END AS precipitation,
                     30 + (sum(o_orderkey) % 6000) / cast(100 AS double) AS humidity
              FROM orders GROUP BY 1)
        """,
    ),
    "climate": (
        ("climate_days",),
        """
        SELECT *, sum(precipitation) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS cumulative_precip,
               greatest(0, temperature_avg - 10) AS growing_degree_days,
               CASE WHEN temperature_max > 40 AND precipitation < 0.1 THEN 1 ELSE 0 END AS water_stress_risk
        FROM climate_days
        """,
    ),
    "joined": (("veglog", "climate"), "SELECT v.*, c.* EXCLUDE (date) FROM veglog v JOIN climate c ON v.date = c.date"),
    "insights": (
        ("joined",),
        """
        SELECT aoi_id, count(*) AS data_points, min(date) AS first_date, max(date) AS last_date,
               corr(ndvi_mean, temperature_avg) AS temperature_avg,
               corr(ndvi_mean, precipitation) AS precipitation,
               corr(ndvi_mean, humidity) AS humidity,
               corr(ndvi_mean, heat_stress_index) AS heat_stress_index,
               count(CASE WHEN heat_stress_index > 2 AND precipitation < 0.1 THEN 1 END) AS water_stress_periods,
               avg(CASE WHEN heat_stress_index > 2 AND precipitation < 0.1 THEN ndvi_mean END) AS ndvi_during_stress,
               avg(CASE WHEN heat_stress_index > 2 AND precipitation < 0.1 THEN NULL ELSE ndvi_mean END) AS ndvi_normal
        FROM joined GROUP BY aoi_id
        """,
    ),
    "correlations": (
        ("insights",),
        """
        SELECT aoi_id, variable, CASE WHEN isnan(r) THEN NULL ELSE r END AS r
        FROM (SELECT aoi_id, 'temperature_avg' AS variable, temperature_avg AS r FROM insights
              UNION ALL SELECT aoi_id, 'precipitation', precipitation FROM insights
              UNION ALL SELECT aoi_id, 'humidity', humidity FROM insights
              UNION ALL SELECT aoi_id, 'heat_stress_index', heat_stress_index FROM insights)
        """,
    ),
    "scenes": (
        (),
        """
        SELECT o_orderkey AS scene_id, o_custkey % 25 AS aoi_id, o_orderdate AS datetime,
               CASE WHEN o_orderkey % 97 <> 0
                    THEN (cast(round(o_totalprice * 100) AS bigint) % 10000) / cast(100 AS double) END AS cloud_cover,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'sentinel-2-l1c' ELSE 'sentinel-2-l2a' END AS collection
        FROM orders
        """,
    ),
    "suitable": (
        ("scenes",),
        "SELECT * FROM scenes WHERE collection = 'sentinel-2-l2a' AND cloud_cover < 20",
    ),
    "log_stream": (
        (),
        """
        SELECT user_id AS aoi_id, cast(user_id AS varchar) || '_' || cast(event_id AS varchar) AS scene_id,
               cast(ts AS date) AS date,
               (cast(round(value * 100) AS bigint) % 10000) / cast(10000 AS double) AS ndvi_mean,
               event_id AS seq, ts AS arrived_at
        FROM events
        """,
    ),
    "rolling": (
        ("log_stream",),
        """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY seq DESC) AS age FROM log_stream)
        WHERE age <= 20
        """,
    ),
}


Views = dict[str, tuple[tuple[str, ...], str]]

# the analytics of the rolling log of events in place of the scene log
ROLLING_AS_LOG: Views = {
    **VIEWS,
    "veglog": (("rolling",), "SELECT aoi_id, scene_id, date, ndvi_mean, seq FROM rolling"),
}


def _closure(names: tuple[str, ...], views: Views, found: list[str]) -> list[str]:
    for name in names:
        _closure(views[name][0], views, found)
        if name not in found:
            found.append(name)
    return found


def with_views(sql: str, names: tuple[str, ...], views: Views = VIEWS) -> str:
    """``sql`` after a WITH clause of the views and those they read."""
    parts = [f"{n} AS ({views[n][1].strip()})" for n in _closure(names, views, [])]
    return f"WITH {', '.join(parts)} {sql.strip()}" if parts else sql.strip()
