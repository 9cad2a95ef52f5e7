"""More named queries: round trips through files, logs with gaps, late data, holes.

They belong to ``registry``, which imports this module.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators import anomalies as A
from verdance.operators import climate as CL
from verdance.operators import forecast as FC
from verdance.operators import periods as PE
from verdance.operators import pixels as PX
from verdance.operators import scenes as SC
from verdance.operators import series as SE
from verdance.oracle_views import ROLLING_AS_LOG, VIEWS, Views
from verdance.registry import _ALERT, _BATCH_VIEWS, _CLIPPED, _ROLLING, MODEL_AS_OF, _batch, query
from verdance.session import shared_dir
from verdance.sinks import files as K
from verdance.sources import driver_tables as D
from verdance.sources import files as S
from verdance.streaming import rolling_log as RL
from verdance.streaming import scene_results as SR
from verdance.streaming.versions import latest_rows, latest_version, run_available

STORED_AT = dt.datetime(2024, 7, 31, 9, 30, 5)

# --- logs and climate with missing values ----------------------------------------

_GAPS: Views = {
    **VIEWS,
    "gaps": (
        ("log_stream",),
        """SELECT aoi_id, scene_id, seq, CASE WHEN seq % 11 <> 0 THEN date END AS date,
                  CASE WHEN seq % 7 <> 0 THEN ndvi_mean END AS ndvi_mean FROM log_stream""",
    ),
    "placed": (
        ("gaps",),
        """SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY date NULLS FIRST, seq) - 1 AS idx FROM gaps""",
    ),
    "fits": (
        ("placed",),
        """SELECT aoi_id, count(*) AS entries, count(ndvi_mean) AS n_obs, avg(ndvi_mean) AS mean,
                  CASE WHEN count(ndvi_mean) >= 3 THEN regr_slope(ndvi_mean, idx) END AS slope,
                  CASE WHEN count(ndvi_mean) >= 3 THEN regr_intercept(ndvi_mean, idx) END AS intercept,
                  CASE WHEN count(ndvi_mean) >= 3 AND min(ndvi_mean) < max(ndvi_mean)
                       THEN power(corr(ndvi_mean, idx), 2) END AS r_squared,
                  stddev_samp(ndvi_mean) AS std
           FROM placed GROUP BY aoi_id""",
    ),
}


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The log of events without some dates and some NDVI."""
    log = D.log_stream(D.table(spark, sf, "events"))
    return log.withColumns(
        {
            "date": F.when(F.col("seq") % 11 != 0, F.col("date")),
            "ndvi_mean": F.when(F.col("seq") % 7 != 0, F.col("ndvi_mean")),
        }
    )


@query(
    "trend_gaps",
    "aoi_id:bigint entries:bigint n_obs:bigint mean:r10 slope:r10 intercept:r10 r_squared:r10",
    "SELECT * FROM fits",
    "fits",
    _GAPS,
)
def _(spark, sf):
    return SE.series_summary(_gaps(spark, sf))


@query(
    "trend_line_gaps",
    "aoi_id:bigint scene_id:varchar date:date idx:bigint ndvi_mean:r6 fitted:r6",
    "SELECT p.*, f.intercept + f.slope * p.idx AS fitted FROM placed p JOIN fits f ON p.aoi_id = f.aoi_id",
    ("placed", "fits"),
    _GAPS,
)
def _(spark, sf):
    return SE.trend_line(_gaps(spark, sf))


@query(
    "anomaly_split_gaps",
    "aoi_id:bigint scene_id:varchar date:date is_anomaly:boolean",
    """SELECT p.aoi_id, p.scene_id, p.date, h.hit IS NOT NULL AS is_anomaly
       FROM placed p LEFT JOIN (SELECT DISTINCT p.aoi_id, p.date, 1 AS hit
                                FROM placed p JOIN fits f ON p.aoi_id = f.aoi_id
                                WHERE f.n_obs >= 4 AND f.std > 0 AND abs((p.ndvi_mean - f.mean) / f.std) > 1.6) h
         ON p.aoi_id = h.aoi_id AND p.date IS NOT DISTINCT FROM h.date""",
    ("placed", "fits"),
    _GAPS,
)
def _(spark, sf):
    return A.anomaly_split(_gaps(spark, sf), threshold=1.6)


@query(
    "climate_gaps",
    "date:date precipitation:r6 cumulative_precip:r6 growing_degree_days:r6",
    """SELECT date, precipitation, CASE WHEN precipitation IS NOT NULL THEN cumulative_precip END AS cumulative_precip,
              growing_degree_days FROM climate""",
    "climate",
    {
        **VIEWS,
        "all_days": VIEWS["climate_days"],
        "climate_days": (
            ("all_days",),
            "SELECT * REPLACE (CASE WHEN dayofyear(date) % 5 <> 0 THEN precipitation END AS precipitation) FROM all_days",
        ),
    },
)
def _(spark, sf):
    rain = F.when(F.dayofyear("date") % 5 != 0, F.col("precipitation"))
    return CL.climate_indices(D.climate_observed(spark, sf).withColumn("precipitation", rain))


# --- areas with holes ------------------------------------------------------------


@query(
    "clip_with_hole",
    _CLIPPED,
    """SELECT *, lon_e4 / cast(10000 AS double) AS lon, lat_e4 / cast(10000 AS double) AS lat FROM pixels
       WHERE lon_e4 BETWEEN 557420 AND 557470 AND lat_e4 BETWEEN 242050 AND 242100
         AND NOT (lon_e4 > 557435 AND lon_e4 < 557455 AND lat_e4 > 242060 AND lat_e4 < 242080)""",
    "pixels",
)
def _(spark, sf):
    """The clip square without an inner square, whose border belongs to the area."""
    hole = [(55.7435, 24.206), (55.7455, 24.206), (55.7455, 24.208), (55.7435, 24.208), (55.7435, 24.206)]
    area = S.clip_aoi(spark).select(
        F.col("aoi_id").alias("clip_id"), F.array(F.col("ring"), G.ring_literal(hole)).alias("rings")
    )
    return PX.assign_aoi(D.pixels(spark, sf), area, cell=0.0007)


# --- streams in several micro-batches ---------------------------------------------


def _in_batches(spark: SparkSession, sf: str, batches: int = 4) -> DataFrame:
    """The log of events as a stream of so many micro-batches."""
    path, events = shared_dir(spark, "events"), D.table(spark, sf, "events")
    # As many tasks as the table's scan has, dealt evenly to the micro-batches.
    files = math.ceil(events.rdd.getNumPartitions() / batches)
    events.repartition(batches * files).write.parquet(path)
    return D.log_stream(SR.read_stream(spark, path, events.schema, files_per_batch=files))


@query("rolling_last20_batches", _ROLLING, "SELECT * FROM rolling", "rolling")
def _(spark, sf):
    base = shared_dir(spark, "rolling-log")
    run_available(RL.snapshot_writer(_in_batches(spark, sf), f"{base}/log", f"{base}/progress"))
    return latest_version(spark, f"{base}/log")


@query("alerts_batches", _ALERT, "SELECT * FROM alerts", "alerts", ROLLING_AS_LOG)
def _(spark, sf):
    base = shared_dir(spark, "alerts")
    run_available(RL.alert_writer(_in_batches(spark, sf), base, f"{base}/progress"))
    return latest_version(spark, f"{base}/alerts")


# --- model and late data ---------------------------------------------------------


@query(
    "ndvi_training_rows_nearest",
    "aoi_id:bigint date:date temperature_avg:r6 precipitation:r6 humidity:r6 label:r6",
    f"""SELECT v.aoi_id, v.date, c.temperature_avg, c.precipitation, c.humidity, l.label
        FROM veglog v JOIN climate c ON v.date = c.date
        JOIN (SELECT d.aoi_id, d.date, n.label
              FROM (SELECT DISTINCT aoi_id, date FROM veglog) d
              JOIN (SELECT aoi_id, date, avg(ndvi_mean) AS label FROM veglog GROUP BY aoi_id, date) n
                ON n.aoi_id = d.aoi_id AND abs(datediff('day', d.date + 30, n.date)) <= {FC.TOLERANCE_DAYS}
              QUALIFY row_number() OVER (PARTITION BY d.aoi_id, d.date
                                         ORDER BY abs(datediff('day', d.date + 30, n.date)), n.date) = 1) l
          ON l.aoi_id = v.aoi_id AND l.date = v.date
        WHERE v.date BETWEEN date '{MODEL_AS_OF}' - 120 AND date '{MODEL_AS_OF}'""",
    ("veglog", "climate"),
)
def _(spark, sf):
    """The default training period, with the NDVI nearest to thirty days later."""
    return FC.training_rows(D.stored_log(spark, sf), D.climate(spark, sf), MODEL_AS_OF, bounded=True)


_LATE_DAYS, _PERIOD_DAYS = 5, 2


@query(
    "period_stats_late",
    "period_start:varchar aoi_id:bigint scenes:bigint ndvi_min:double ndvi_max:double",
    f"""SELECT cast(period AS varchar) AS period_start, aoi_id, count(*) AS scenes, min(ndvi_mean) AS ndvi_min,
               max(ndvi_mean) AS ndvi_max
        FROM (SELECT *, cast(date '1970-01-01' + cast({_PERIOD_DAYS} * (datediff('day', date '1970-01-01', cast(arrived_at AS date)) // {_PERIOD_DAYS})
                                                      AS integer) AS date) AS period,
                     (SELECT max(arrived_at) FROM log_stream WHERE seq % 50 <> 0) AS newest FROM log_stream)
        WHERE seq % 50 <> 0 OR cast(period + {_PERIOD_DAYS} AS timestamp) > newest - INTERVAL {_LATE_DAYS} DAY
        GROUP BY ALL""",
    "log_stream",
)
def _(spark, sf):
    """Period statistics under a watermark: every fiftieth entry comes after all others, and
    counts only if its period is still open."""
    base, path = shared_dir(spark, "period-late"), shared_dir(spark, "late-events")
    events = D.table(spark, sf, "events")
    late = F.col("event_id") % 50 == 0
    newest = events.where(~late).agg(F.max("ts")).first()[0]
    # The watermark of a batch is that of the batches before it.
    first, second = ~late & (F.col("ts") != F.lit(newest)), ~late & (F.col("ts") == F.lit(newest))
    for part in (events.where(first), events.where(second), events.where(late)):
        part.write.mode("append").parquet(path)
        # All files of the part are one batch; the checkpoint hands the watermark on.
        stream = D.log_stream(SR.read_stream(spark, path, events.schema))
        stream = stream.withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))
        run_available(SR.period_stats_writer(stream, f"{base}/stats", f"{base}/progress", _PERIOD_DAYS, f"{_LATE_DAYS} days"))
    rows = latest_rows(spark, f"{base}/stats", ["period_start", "aoi_id"])
    return rows.withColumn("period_start", F.to_date("period_start").cast("string"))


# --- through files and back ------------------------------------------------------


@query(
    "log_stored",
    "aoi_id:varchar scene_id:varchar date:date ndvi_mean:r6 vegetation_health:varchar seq:bigint",
    "SELECT * REPLACE (seq - 1 AS seq) FROM veglog",
    "veglog",
)
def _(spark, sf):
    base = shared_dir(spark, "log")
    return S.read_log(spark, K.write_log(D.veglog(spark, sf), base, STORED_AT))


@query(
    "statistics_stored",
    "aoi_id:bigint scene_date:varchar ndvi_mean:r6 ndvi_count:bigint ndwi_std:r6 indices:varchar health:varchar",
    """SELECT aoi_id, scene_date, CASE WHEN ndvi_count > 0 THEN ndvi_mean END AS ndvi_mean,
              nullif(ndvi_count, 0) AS ndvi_count, CASE WHEN ndwi_count > 0 THEN ndwi_std END AS ndwi_std,
              'NDVI,EVI,NDWI' AS indices, vegetation_health AS health FROM stats""",
    "stats",
)
def _(spark, sf):
    stats = D.stats(spark, sf).withColumn("scene_id", F.concat_ws("_", "aoi_id", "scene_date"))
    stored = spark.read.json(K.write_scene_statistics(stats, shared_dir(spark, "statistics"), STORED_AT))
    return stored.select(
        "aoi_id", "scene_date", F.col("statistics.NDVI.mean").alias("ndvi_mean"),
        F.col("statistics.NDVI.count").alias("ndvi_count"), F.col("statistics.NDWI.std").alias("ndwi_std"),
        F.array_join("processed_indices", ",").alias("indices"), F.col("summary.vegetation_health").alias("health"),
    )


@query(
    "climate_stored",
    "date:date temperature_max:r6 precipitation:r6 humidity:r6 cumulative_precip:r6 water_stress_risk:int",
    "SELECT * FROM climate",
    "climate",
)
def _(spark, sf):
    """Of two files the one written last is read."""
    base = shared_dir(spark, "climate-files")
    climate = D.climate(spark, sf)
    K.write_climate(climate.limit(3), base, "1990-01-01", "1990-12-31")
    K.write_climate(climate, base, "1992-01-01", "1998-12-31")
    return S.read_newest_climate(spark, f"{base}/climate_data")


@query(
    "batch_stored",
    "aoi_id:bigint total_periods:bigint successful:bigint failed:bigint results:int",
    """SELECT aoi_id, count(*) AS total_periods, count(scene_id) AS successful,
              count(*) - count(scene_id) AS failed, count(*) AS results FROM batch GROUP BY aoi_id""",
    "batch",
    _BATCH_VIEWS,
)
def _(spark, sf):
    path = K.write_batch_summary(_batch(spark, sf), shared_dir(spark, "batch"), STORED_AT)
    return spark.read.json(path).withColumn("results", F.size("results"))


@query(
    "batch_all_periods",
    "aoi_id:bigint total_periods:bigint successful:bigint periods_total:int",
    """SELECT a.aoi_id, 70 AS total_periods, coalesce(n, 0) AS successful, 70 AS periods_total
       FROM (SELECT DISTINCT aoi_id FROM scenes) a
       LEFT JOIN (SELECT s.aoi_id, count(DISTINCT p.i) AS n
                  FROM suitable s JOIN (SELECT i, date '2001-08-01' - 2160 + cast(31 * i AS integer) AS first_day
                                        FROM range(0, 70) r(i)) p
                    ON cast(s.datetime AS date) BETWEEN p.first_day AND least(p.first_day + 30, date '2001-08-01')
                  GROUP BY 1) b ON a.aoi_id = b.aoi_id""",
    ("scenes", "suitable"),
)
def _(spark, sf):
    """No limit on the periods unless one is asked for."""
    scenes = D.scenes(spark, sf)
    batch = PE.multi_temporal_batch(scenes, scenes, "2001-08-01", 72)
    return batch.groupBy("aoi_id").agg(
        F.count("*").alias("total_periods"), F.count("scene_id").alias("successful"), F.max("periods_total").alias("periods_total")
    )


@query(
    "analytics_stored",
    "aoi_id:bigint data_points_analyzed:bigint trend_slope:r6 current_ndvi:r6 alerts:int",
    """SELECT f.aoi_id, n_obs AS data_points_analyzed, slope AS trend_slope, recent_ndvi AS current_ndvi,
              coalesce(alert_count, 0) AS alerts
       FROM alert_flags f LEFT JOIN (SELECT aoi_id, count(*) AS alert_count FROM alerts GROUP BY aoi_id) a
         ON f.aoi_id = a.aoi_id""",
    ("alert_flags", "alerts"),
)
def _(spark, sf):
    documents = A.analytics_document(A.advanced_analytics(D.stored_log(spark, sf)), STORED_AT)
    path = K.write_document(documents, shared_dir(spark, "analytics"), "advanced_analytics", STORED_AT)
    return spark.read.json(path).select(
        "aoi_id", "data_points_analyzed", "trend_analysis.trend_slope", "health_classification.current_ndvi",
        F.size("alerts").alias("alerts"),
    )


_ITEM_SQL = """SELECT cast(scene_id AS varchar) AS scene_id, collection, cast(datetime AS date) AS day, cloud_cover,
                      (scene_id * 37) % 6000 / cast(100 AS double) AS west FROM scenes"""


@query(
    "scenes_stored",
    "scene_id:varchar collection:varchar day:date cloud_cover:double west:r6",
    _ITEM_SQL,
    "scenes",
)
def _(spark, sf):
    path = shared_dir(spark, "scenes")
    assets = F.create_map().cast("map<string,string>")
    D.scene_footprints(spark, sf).select(
        F.col("scene_id").cast("string").alias("scene_id"), "collection", F.to_timestamp("datetime").alias("datetime"),
        "cloud_cover", "footprint", assets.alias("assets"),
    ).write.parquet(path)
    return S.read_scenes(spark, path).withColumns(
        {"day": F.to_date("datetime"), "west": F.col("footprint")[0]["lon"]}
    )


def _items(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue items as JSON lines, with an asset per band that the item has."""
    key = F.col("scene_id")
    bands = [F.when(key % n != 0, F.struct(F.lit(b).alias("key"), F.struct(F.concat(F.lit(f"{b}/"), key).alias("href")).alias("value"))) for b, n in (("red", 2), ("nir", 3), ("green", 5), ("blue", 7))]
    present = F.filter(F.array(*bands), lambda e: e.isNotNull())
    item = F.struct(
        key.cast("string").alias("id"),
        "collection",
        F.struct(F.col("cloud_cover").alias("eo:cloud_cover"), F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.transform("footprint", lambda p: F.array(p["lon"], p["lat"]))).alias("coordinates")).alias("geometry"),
        F.map_from_entries(present).alias("assets"),
    )
    path = shared_dir(spark, "items")
    D.scene_footprints(spark, sf).select(F.to_json(item)).write.text(path)
    return S.read_stac_items(spark, path)


@query(
    "catalogue_items",
    "scene_id:varchar collection:varchar day:date cloud_cover:double west:r6",
    _ITEM_SQL,
    "scenes",
)
def _(spark, sf):
    return _items(spark, sf).withColumns({"day": F.to_date("datetime"), "west": F.col("footprint")[0]["lon"]})


@query(
    "catalogue_assets",
    "scene_id:varchar band:varchar href:varchar",
    """SELECT cast(scene_id AS varchar) AS scene_id, band, band || '/' || cast(scene_id AS varchar) AS href
       FROM scenes CROSS JOIN (VALUES ('red', 2), ('nir', 3), ('green', 5), ('blue', 7)) b(band, n)
       WHERE scene_id % n <> 0""",
    "scenes",
)
def _(spark, sf):
    return SC.required_assets(_items(spark, sf))


@query(
    "catalogue_complete",
    "scene_id:varchar",
    """SELECT cast(scene_id AS varchar) AS scene_id FROM scenes
       WHERE scene_id % 2 <> 0 AND scene_id % 3 <> 0 AND scene_id % 5 <> 0 AND scene_id % 7 <> 0""",
    "scenes",
)
def _(spark, sf):
    return SC.with_all_bands(_items(spark, sf))


@query(
    "areas_stored",
    "aoi_id:varchar west:r6 south:r6 rings:int corners:int",
    """SELECT 's' || cast(s_suppkey AS varchar) AS aoi_id, (s_suppkey * 607) % 6000 / cast(100 AS double) AS west,
              (s_suppkey * 911) % 4000 / cast(100 AS double) AS south, 1 AS rings, 5 AS corners FROM supplier""",
)
def _(spark, sf):
    """Areas as GeoJSON, a file per nation, of which some hold multipolygons."""
    nation = D.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("area"), F.col("s_nationkey").alias("nation"))
    corners = F.array(F.transform("ring", lambda p: F.array(p["lon"], p["lat"])))
    many = F.col("nation") % 3 == 0
    text = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("s"), "area").alias("aoi_id")).alias("properties"),
        F.struct(F.when(many, "MultiPolygon").otherwise("Polygon").alias("type"), F.lit("@").alias("coordinates")).alias("geometry"),
    ))
    shape = F.when(many, F.concat(F.lit("["), F.to_json(corners), F.lit("]"))).otherwise(F.to_json(corners))
    feature = F.replace(text, F.lit('"@"'), shape)
    files = D.supplier_areas(spark, sf).join(nation, "area").groupBy("nation").agg(F.collect_list(feature).alias("f"))
    path = shared_dir(spark, "areas")
    document = F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join("f", ","), F.lit("]}"))
    files.select("nation", document.alias("value")).write.partitionBy("nation").text(path)
    return S.read_aoi(spark, path).select(
        "aoi_id", F.col("ring")[0]["lon"].alias("west"), F.col("ring")[0]["lat"].alias("south"),
        F.size("rings").alias("rings"), F.size("ring").alias("corners"),
    )


from verdance import registry_live  # noqa: E402, F401  adds its queries
