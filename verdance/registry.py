"""Every operator as a named query over the driver tables, with its check SQL.

A query's ``columns`` say its output types; the same list shapes the Spark
result and the SQL.  ``r6`` and ``r10`` are doubles rounded to so many digits:
sums differ in their last bits between engines (means of short decimals need ten,
as they often end in a 5 at the seventh).  Values that do not pass through a sum are
compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import climate as CF
from verdance.functions import geometry as G
from verdance.functions import labels as L
from verdance.functions.dates import run_stamp
from verdance.functions.documents import from_document, get_path
from verdance.functions.indices import BANDS, reflectance, with_indices
from verdance.operators import anomalies as A
from verdance.operators import climate as CL
from verdance.operators import correlation as CO
from verdance.operators import dashboard as DB
from verdance.operators import forecast as FC
from verdance.operators import periods as PE
from verdance.operators import pixels as PX
from verdance.operators import scenes as SC
from verdance.operators import series as SE
from verdance.operators import veglog as VL
from verdance.oracle_views import ROLLING_AS_LOG, VIEWS, Views, with_views
from verdance.session import materialise, shared_dir
from verdance.sources import driver_tables as D
from verdance.sources.files import clip_aoi
from verdance.streaming import rolling_log as RL
from verdance.streaming import scene_results as SR
from verdance.streaming.versions import latest_rows, latest_version, run_available

Run = Callable[[SparkSession, str], DataFrame]

ROUNDED = {"r6": 6, "r10": 10}

BATCH_AS_OF, BATCH_MONTHS, BATCH_SCENES = "2001-08-01", 72, 8
RANGE = ("1995-01-01", "2001-08-02")
MODEL_AS_OF = "2001-06-30"
SEASONS = (
    ("Recent Scene", "1998-07-01", "1998-07-31"),
    ("Winter Scene", "1998-01-01", "1998-01-31"),
    ("Spring Scene", "1998-04-01", "1998-04-30"),
)


@dataclass(frozen=True)
class Query:
    run: Run
    columns: str
    sql: str | None
    views: tuple[str, ...]
    view_set: Views

    def fields(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        def shaped(name: str, kind: str):
            value = F.col(name)
            if kind in ROUNDED:
                return F.round(value.cast("double"), ROUNDED[kind]).alias(name)
            return value.cast("string" if kind == "varchar" else kind).alias(name)

        return self.run(spark, sf_dir).select(*[shaped(n, k) for n, k in self.fields()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None

        def shaped(name: str, kind: str) -> str:
            if kind in ROUNDED:
                return f"round(cast({name} AS double), {ROUNDED[kind]}) AS {name}"
            return f"cast({name} AS {kind}) AS {name}"

        columns = ", ".join(shaped(n, k) for n, k in self.fields())
        return with_views(f"SELECT {columns} FROM ({self.sql.strip()}) q", self.views, self.view_set)


QUERIES: dict[str, Query] = {}


def query(
    name: str,
    columns: str,
    sql: str | None = None,
    views: tuple[str, ...] | str = (),
    view_set: Views = VIEWS,
):
    views = (views,) if isinstance(views, str) else views

    def register(run: Run) -> Run:
        QUERIES[name] = Query(run, columns, sql, views, view_set)
        return run

    return register


# --- pixels and scene statistics -------------------------------------------------

_SCENE = "aoi_id:bigint scene_date:date"
_STATS = " ".join(
    f"{i}_mean:r6 {i}_std:r6 {i}_min:double {i}_max:double {i}_count:bigint"
    for i in ("ndvi", "evi", "ndwi")
)
_CLIP = "lon_e4 BETWEEN 557420 AND 557470 AND lat_e4 BETWEEN 242050 AND 242100"


@query(
    "pixel_indices",
    f"{_SCENE} lon:double lat:double ndvi:double evi:double ndwi:double",
    "SELECT *, lon_e4 / cast(10000 AS double) AS lon, lat_e4 / cast(10000 AS double) AS lat FROM indices",
    "indices",
)
def _(spark, sf):
    return with_indices(D.pixels(spark, sf))


@query(
    "pixel_reflectance",
    f"{_SCENE} band:varchar valid:bigint mean:r10",
    """SELECT aoi_id, scene_date, band, count(v) AS valid, avg(v / 10000) AS mean
       FROM (SELECT aoi_id, scene_date, 'red' AS band, red AS v FROM bands
             UNION ALL SELECT aoi_id, scene_date, 'green', green FROM bands
             UNION ALL SELECT aoi_id, scene_date, 'blue', blue FROM bands
             UNION ALL SELECT aoi_id, scene_date, 'nir', nir FROM bands)
       GROUP BY aoi_id, scene_date, band""",
    "bands",
)
def _(spark, sf):
    aggregates = []
    for b in BANDS:
        value = reflectance(F.col(f"{b}_dn"))
        aggregates.append(F.struct(F.lit(b).alias("band"), F.count(value).alias("valid"), F.avg(value).alias("mean")))
    grouped = D.pixels(spark, sf).groupBy(*D.SCENE).agg(F.array(*aggregates).alias("_bands"))
    return grouped.select(*D.SCENE, F.inline("_bands"))


@query(
    "aoi_clip_counts",
    f"{_SCENE} pixels:bigint clipped_pixels:bigint reduction_percent:r6",
    f"""SELECT *, (1 - clipped_pixels / cast(pixels AS double)) * 100 AS reduction_percent
        FROM (SELECT aoi_id, scene_date, count(*) AS pixels,
                     count(CASE WHEN {_CLIP} THEN 1 END) AS clipped_pixels
              FROM pixels GROUP BY aoi_id, scene_date)""",
    "pixels",
)
def _(spark, sf):
    return PX.clip_reduction(D.pixels(spark, sf), keys=D.SCENE)


@query(
    "band_clip_reduction",
    f"{_SCENE} band:varchar pixels:bigint clipped_pixels:bigint reduction_percent:r6",
    f"""SELECT *, (1 - clipped_pixels / cast(pixels AS double)) * 100 AS reduction_percent
        FROM (SELECT aoi_id, scene_date, band, count(*) AS pixels,
                     count(CASE WHEN {_CLIP} THEN 1 END) AS clipped_pixels
              FROM pixels CROSS JOIN (VALUES ('red'), ('green'), ('blue'), ('nir')) b(band)
              GROUP BY aoi_id, scene_date, band)""",
    "pixels",
)
def _(spark, sf):
    return PX.band_reduction(D.pixels(spark, sf), keys=D.SCENE)


_CLIPPED_SQL = f"SELECT *, lon_e4 / cast(10000 AS double) AS lon, lat_e4 / cast(10000 AS double) AS lat FROM pixels WHERE {_CLIP}"
_CLIPPED = f"{_SCENE} lon:double lat:double red_dn:bigint nir_dn:bigint green_dn:bigint blue_dn:bigint"


@query("clip_rectangle", _CLIPPED, _CLIPPED_SQL, "pixels")
def _(spark, sf):
    return PX.clip(D.pixels(spark, sf))


@query("clip_polygon", _CLIPPED, _CLIPPED_SQL, "pixels")
def _(spark, sf):
    area = clip_aoi(spark).select(F.col("aoi_id").alias("clip_id"), "ring")
    return PX.assign_aoi(D.pixels(spark, sf), area)


def _supplier_diamonds(spark: SparkSession, sf: str) -> DataFrame:
    """A diamond-shaped area per supplier."""
    key, radius = F.col("s_suppkey"), 5.5
    x, y = 557400 + (key * 37) % 100, 242030 + (key * 53) % 100

    def corner(dx: float, dy: float):
        return F.struct(
            ((x + dx) / F.lit(10000.0)).alias("lon"), ((y + dy) / F.lit(10000.0)).alias("lat")
        )

    steps = [(radius, 0.0), (0.0, radius), (-radius, 0.0), (0.0, -radius), (radius, 0.0)]
    return D.table(spark, sf, "supplier").select(
        key.alias("area"), F.array(*[corner(*s) for s in steps]).alias("ring")
    )


@query(
    "polygon_join_counts",
    "area:bigint pixels:bigint",
    """SELECT s_suppkey AS area, count(*) AS pixels
       FROM pixels JOIN supplier
         ON abs(lon_e4 - (557400 + (s_suppkey * 37) % 100)) + abs(lat_e4 - (242030 + (s_suppkey * 53) % 100)) < 5.5
       GROUP BY s_suppkey""",
    "pixels",
)
def _(spark, sf):
    # Pixels of one place lie in the same areas, so each place of the grid is joined once, with its pixels counted.
    places = D.pixels(spark, sf).groupBy("lon", "lat").agg(F.count("*").alias("n"))
    joined = PX.assign_aoi(places, _supplier_diamonds(spark, sf), cell=0.00025)
    return joined.groupBy("area").agg(F.sum("n").alias("pixels"))


@query(
    "pixel_utm",
    f"{_SCENE} zone:int easting:bigint northing:bigint",
    """SELECT aoi_id, scene_date, 40 AS zone,
         round((500000 + 0.9996 * a * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta)
                + a3 * cos(6 * xi) * sinh(6 * eta))) * 100) AS easting,
         round(0.9996 * a * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta)
                + a3 * sin(6 * xi) * cosh(6 * eta)) * 100) AS northing
       FROM (SELECT *, atan2(t, cos(dlon)) AS xi, atanh(sin(dlon) / sqrt(1 + t * t)) AS eta,
                    6378137 / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) AS a,
                    n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1,
                    13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3
             FROM (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t
                   FROM (SELECT *, 2 * sqrt(n) / (1 + n) AS e
                         FROM (SELECT aoi_id, scene_date,
                                      radians(lat_e4 / cast(10000 AS double)) AS phi,
                                      radians(lon_e4 / cast(10000 AS double) - 57) AS dlon,
                                      1 / cast(298.257223563 AS double) / (2 - 1 / cast(298.257223563 AS double)) AS n
                               FROM pixels))))""",
    "pixels",
)
def _(spark, sf):
    """Projected pixel positions in centimetres."""
    placed = D.pixels(spark, sf).select(*D.SCENE, G.to_utm(F.col("lon"), F.col("lat")).alias("u"))
    return placed.select(
        *D.SCENE,
        "u.zone",
        F.round(F.col("u.easting") * 100).alias("easting"),
        F.round(F.col("u.northing") * 100).alias("northing"),
    )


@query(
    "scene_stats",
    f"{_SCENE} {_STATS} vegetation_pixels:bigint vegetation_health:varchar vegetation_coverage:r6",
    "SELECT * FROM stats",
    "stats",
)
def _(spark, sf):
    return D.stats(spark, sf)


_LONG = f"{_SCENE} index_name:varchar mean:r6 std:r6 min:double max:double count:bigint vegetation_pixels:bigint"
_LONG_SQL = """
    SELECT aoi_id, scene_date, 'NDVI' AS index_name, ndvi_mean AS mean, ndvi_std AS std, ndvi_min AS min,
           ndvi_max AS max, ndvi_count AS count, vegetation_pixels FROM stats WHERE ndvi_count > 0
    UNION ALL
    SELECT aoi_id, scene_date, 'EVI', evi_mean, evi_std, evi_min, evi_max, evi_count, NULL
    FROM stats WHERE evi_count > 0
    UNION ALL
    SELECT aoi_id, scene_date, 'NDWI', ndwi_mean, ndwi_std, ndwi_min, ndwi_max, ndwi_count, NULL
    FROM stats WHERE ndwi_count > 0"""


@query("scene_stats_long", _LONG, _LONG_SQL, "stats")
def _(spark, sf):
    return PX.scene_stats_long(D.stats(spark, sf), D.SCENE)


@query("scene_stats_map", _LONG, _LONG_SQL, "stats")
def _(spark, sf):
    mapped = PX.statistics_map(D.stats(spark, sf))
    return mapped.select(*D.SCENE, F.explode("statistics").alias("index_name", "s")).select(
        *D.SCENE, "index_name", "s.*"
    )


@query(
    "clipped_scene_stats",
    f"{_SCENE} ndvi_mean:r6 ndvi_count:bigint vegetation_pixels:bigint vegetation_health:varchar",
    f"""SELECT aoi_id, scene_date, avg(ndvi) AS ndvi_mean, count(ndvi) AS ndvi_count,
               count(CASE WHEN ndvi > 0.3 THEN 1 END) AS vegetation_pixels,
               CASE WHEN coalesce(avg(ndvi), 0) > 0.3 THEN 'Good' ELSE 'Poor' END AS vegetation_health
        FROM indices WHERE {_CLIP} GROUP BY aoi_id, scene_date""",
    "indices",
)
def _(spark, sf):
    return PX.scene_stats(PX.clip(D.pixels(spark, sf)), D.SCENE)


_TILE_BANDS = {"red": (10000, 0), "nir": (17000, 300), "green": (7000, 50), "blue": (3000, 20)}


def _tile_band(band: str) -> str:
    factor, base = _TILE_BANDS[band]
    dn = f"cast(floor(abs(cast(x AS double)) * {factor}) + {base} AS integer)"
    return f"CASE WHEN vec_id % 5 <> 0 THEN {dn} END" if band == "blue" else dn


_TILE_VIEWS: Views = {
    **VIEWS,
    "cells": (
        (),
        f"""SELECT vec_id AS scene_id, date '2024-01-01' + cast(vec_id % 28 AS integer) AS scene_date,
                   label AS tile_id, (p - 1) // 8 AS row, (p - 1) % 8 AS col,
                   55 + (vec_id % 100) / cast(100 AS double) + ((p - 1) % 8 + 0.5) * cast(0.125 AS double) AS lon,
                   cast(24.5 AS double) + ((p - 1) // 8 + 0.5) * cast(-0.125 AS double) AS lat,
                   {", ".join(f"{_tile_band(b)} AS {b}_dn" for b in _TILE_BANDS)}
            FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings)""",
    ),
    # the band masks of the pixel view, over the tiles' cells
    "pixels": (("cells",), "SELECT scene_id AS aoi_id, scene_date, 0 AS lon_e4, 0 AS lat_e4, * EXCLUDE (scene_date) FROM cells"),
}


@query(
    "tile_pixels",
    'scene_id:bigint scene_date:date tile_id:int row:int col:int lon:double lat:double '
    "red_dn:int nir_dn:int green_dn:int blue_dn:int",
    "SELECT * FROM cells",
    "cells",
    _TILE_VIEWS,
)
def _(spark, sf):
    return PX.tile_pixels(PX.wide_tiles(D.band_tiles(spark, sf)))


@query(
    "tile_scene_stats",
    "scene_id:bigint ndvi_mean:r6 ndvi_count:bigint evi_count:bigint ndwi_mean:r6 vegetation_pixels:bigint",
    "SELECT aoi_id AS scene_id, * EXCLUDE (aoi_id) FROM stats",
    "stats",
    _TILE_VIEWS,
)
def _(spark, sf):
    """Statistics of scenes whose bands come as tiles."""
    cells = PX.tile_pixels(PX.wide_tiles(D.band_tiles(spark, sf)))
    return PX.scene_stats(cells, ("scene_id", "scene_date"))


# --- log and trends --------------------------------------------------------------


@query(
    "vegetation_log",
    "aoi_id:bigint scene_id:varchar date:date ndvi_mean:r6 vegetation_health:varchar seq:bigint",
    "SELECT * FROM veglog",
    "veglog",
)
def _(spark, sf):
    return D.veglog(spark, sf)


@query(
    "health_distribution",
    "aoi_id:bigint vegetation_health:varchar scenes:bigint percent:r6",
    """SELECT aoi_id, vegetation_health, count(*) AS scenes,
              count(*) / cast(sum(count(*)) OVER (PARTITION BY aoi_id) AS double) * 100 AS percent
       FROM veglog GROUP BY aoi_id, vegetation_health""",
    "veglog",
)
def _(spark, sf):
    return SE.health_distribution(D.veglog(spark, sf))


@query(
    "log_overview",
    "aoi_id:bigint n_obs:bigint first_date:date last_date:date mean:r6 min:r6 max:r6 std:r6",
    """SELECT aoi_id, count(*) AS n_obs, min(date) AS first_date, max(date) AS last_date,
              avg(ndvi_mean) AS mean, min(ndvi_mean) AS min, max(ndvi_mean) AS max,
              stddev_samp(ndvi_mean) AS std FROM veglog GROUP BY aoi_id""",
    "veglog",
)
def _(spark, sf):
    return SE.log_overview(D.veglog(spark, sf))


@query(
    "trend",
    "aoi_id:bigint n_obs:bigint slope:r6 intercept:r6 r_squared:r6 direction:varchar",
    "SELECT * FROM trends",
    "trends",
)
def _(spark, sf):
    return SE.series_summary(D.stored_log(spark, sf))


@query(
    "trend_events",
    "aoi_id:bigint n_obs:bigint mean:r10 slope:r10 intercept:r10 r_squared:r10 direction:varchar",
    """SELECT *, CASE WHEN slope > 0.001 THEN 'improving' WHEN slope < -0.001 THEN 'declining'
                      WHEN slope IS NOT NULL THEN 'stable' END AS direction
       FROM (SELECT aoi_id, count(*) AS n_obs, avg(ndvi_mean) AS mean,
                    CASE WHEN count(*) >= 3 THEN regr_slope(ndvi_mean, idx) END AS slope,
                    CASE WHEN count(*) >= 3 THEN regr_intercept(ndvi_mean, idx) END AS intercept,
                    CASE WHEN count(*) >= 3 AND min(ndvi_mean) < max(ndvi_mean)
                         THEN power(corr(ndvi_mean, idx), 2) END AS r_squared
             FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY date, seq) - 1 AS idx
                   FROM log_stream) GROUP BY aoi_id)""",
    "log_stream",
)
def _(spark, sf):
    """Trend of a log with many entries per day."""
    events = D.log_stream(D.table(spark, sf, "events"))
    return SE.series_summary(events)


@query(
    "trend_line",
    "aoi_id:bigint scene_id:varchar date:date idx:bigint ndvi_mean:r6 fitted:r6",
    """SELECT n.*, t.intercept + t.slope * n.idx AS fitted
       FROM numbered n JOIN trends t ON n.aoi_id = t.aoi_id""",
    ("numbered", "trends"),
)
def _(spark, sf):
    return SE.trend_line(D.stored_log(spark, sf))


@query(
    "log_positions",
    "aoi_id:bigint seq:bigint date:date idx:bigint",
    "SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY date, seq) - 1 AS idx FROM log_stream",
    "log_stream",
)
def _(spark, sf):
    return SE.with_positions(D.log_stream(D.table(spark, sf, "events")))


@query(
    "seasonal_pattern",
    "aoi_id:bigint month:int ndvi_mean:r6 scenes:bigint",
    """SELECT aoi_id, month(date) AS month, avg(ndvi_mean) AS ndvi_mean, count(*) AS scenes
       FROM numbered WHERE n_obs >= 6 GROUP BY 1, 2""",
    "numbered",
)
def _(spark, sf):
    return SE.seasonal_pattern(D.veglog(spark, sf))


@query(
    "seasonal_chart",
    "aoi_id:bigint month:int ndvi_mean:r6 scenes:bigint",
    """SELECT aoi_id, month(date) AS month, avg(ndvi_mean) AS ndvi_mean, count(*) AS scenes
       FROM numbered WHERE n_obs >= 4 GROUP BY 1, 2""",
    "numbered",
)
def _(spark, sf):
    return SE.seasonal_pattern(D.veglog(spark, sf), SE.MIN_SEASONAL_CHART)


@query(
    "recent_vs_historical",
    "aoi_id:bigint n_obs:bigint recent_ndvi:r6 historical_ndvi:r6 change:r6",
    "SELECT *, recent_ndvi - historical_ndvi AS change FROM trends WHERE n_obs >= 6",
    "trends",
)
def _(spark, sf):
    return SE.recent_vs_historical(D.stored_log(spark, sf))


_STATUS_CASE = "CASE WHEN recent_ndvi > 0.3 THEN 'good' WHEN recent_ndvi > 0.2 THEN 'moderate' ELSE 'poor' END"


@query(
    "current_health",
    "aoi_id:bigint n_obs:bigint current_ndvi:r6 health_status:varchar confidence:varchar",
    f"""SELECT aoi_id, n_obs, recent_ndvi AS current_ndvi, {_STATUS_CASE} AS health_status,
               CASE WHEN n_obs >= 5 THEN 'high' WHEN n_obs >= 3 THEN 'medium' ELSE 'low' END AS confidence
        FROM trends""",
    "trends",
)
def _(spark, sf):
    return SE.current_health(D.stored_log(spark, sf))


_HIST_SQL = """
    SELECT aoi_id, bin, count(*) AS scenes, min(low + bin * step) AS low, min(low + (bin + 1) * step) AS high,
           min(mean) AS mean
    FROM (SELECT *, CASE WHEN ndvi_mean < low + raw * step THEN raw - 1
                         WHEN ndvi_mean >= low + (raw + 1) * step AND raw < 9 THEN raw + 1 ELSE raw END AS bin
          FROM (SELECT *, least(floor((ndvi_mean - low) / step), 9) AS raw
                FROM (SELECT *, (high - low) / 10 AS step
                      FROM (SELECT *, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS low,
                                   CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS high FROM numbered))))
    GROUP BY aoi_id, bin"""


@query("ndvi_histogram", "aoi_id:bigint bin:int scenes:bigint low:r6 high:r6 mean:r6", _HIST_SQL, "numbered")
def _(spark, sf):
    return SE.histogram(D.stored_log(spark, sf))


@query(
    "vegetation_trends",
    "aoi_id:bigint total_scenes:bigint start_day:varchar mean:r6 std:r6 good:bigint slope:r6 direction:varchar change:r6",
    """SELECT t.aoi_id, t.n_obs AS total_scenes, cast(t.first_date AS varchar) AS start_day, t.mean, s.std, s.good,
              t.slope, t.direction, CASE WHEN t.n_obs >= 6 THEN recent_ndvi - historical_ndvi END AS change
       FROM trends t JOIN (SELECT aoi_id, stddev_samp(ndvi_mean) AS std,
                                  coalesce(nullif(count(CASE WHEN vegetation_health = 'Good' THEN 1 END), 0), 0) AS good
                           FROM veglog GROUP BY aoi_id) s ON t.aoi_id = s.aoi_id""",
    ("trends", "veglog"),
)
def _(spark, sf):
    good = F.coalesce(F.try_element_at("health_distribution", F.lit("Good")), F.lit(0))
    return SE.vegetation_trends(D.stored_log(spark, sf)).select(
        "aoi_id", "total_scenes", F.col("date_range.start").alias("start_day"),
        "ndvi_stats.mean", "ndvi_stats.std", good.alias("good"),
        "trend.slope", "trend.direction", "comparison.change",
    )


# --- anomalies and alerts --------------------------------------------------------


@query(
    "zscore_anomalies",
    "aoi_id:bigint scene_id:varchar date:date ndvi_mean:r6 z_score:r6",
    "SELECT * FROM zscores WHERE abs(z_score) > 2",
    "zscores",
)
def _(spark, sf):
    return A.anomalies(D.stored_log(spark, sf))


@query(
    "anomaly_summary",
    "aoi_id:bigint n_obs:bigint total_anomalies:bigint anomaly_threshold:double baseline_ndvi:r6 anomaly_dates:varchar",
    """SELECT aoi_id, any_value(n_obs) AS n_obs, count(CASE WHEN abs(z_score) > 2 THEN 1 END) AS total_anomalies,
              2.0 AS anomaly_threshold, any_value(mean) AS baseline_ndvi,
              coalesce(string_agg(CASE WHEN abs(z_score) > 2 THEN cast(date AS varchar) END, ',' ORDER BY date), '')
                AS anomaly_dates
       FROM zscores WHERE n_obs >= 4 GROUP BY aoi_id""",
    "zscores",
)
def _(spark, sf):
    found = A.anomaly_summary(D.stored_log(spark, sf))
    return found.withColumn("anomaly_dates", F.array_join("anomaly_dates", ","))


@query(
    "anomaly_split",
    "aoi_id:bigint scene_id:varchar date:date is_anomaly:boolean",
    """SELECT v.aoi_id, v.scene_id, v.date, d.date IS NOT NULL AS is_anomaly
       FROM veglog v LEFT JOIN (SELECT DISTINCT aoi_id, date FROM zscores WHERE abs(z_score) > 2) d
         ON v.aoi_id = d.aoi_id AND v.date = d.date""",
    ("veglog", "zscores"),
)
def _(spark, sf):
    return A.anomaly_split(D.stored_log(spark, sf))


_ALERT = "aoi_id:bigint alert_no:int type:varchar severity:varchar message:varchar recommendation:varchar"


@query("alerts", _ALERT, "SELECT * FROM alerts", "alerts")
def _(spark, sf):
    return A.alert_rows(A.advanced_analytics(D.stored_log(spark, sf)))


@query("alerts_rolling", _ALERT, "SELECT * FROM alerts", "alerts", ROLLING_AS_LOG)
def _(spark, sf):
    """Alerts from the last twenty entries of each area."""
    log = D.rolling_log(spark, sf)
    return A.alert_rows(A.advanced_analytics(log))


@query("alerts_shown", _ALERT, "SELECT * FROM alerts WHERE alert_no <= 3", "alerts", ROLLING_AS_LOG)
def _(spark, sf):
    """Up to three alerts of an area, which are all that there are."""
    log = D.rolling_log(spark, sf)
    return A.alert_rows(A.advanced_analytics(log), shown=3)


_ANALYTICS = (
    "aoi_id:bigint data_points_analyzed:bigint trend_slope:r6 trend_direction:varchar r_squared:r6 january:r6 "
    "total_anomalies:bigint current_ndvi:r6 health_status:varchar confidence:varchar alert_count:int"
)


@query(
    "advanced_analytics",
    _ANALYTICS,
    f"""SELECT f.aoi_id, n_obs AS data_points_analyzed, slope AS trend_slope, direction AS trend_direction, r_squared,
               CASE WHEN n_obs >= 6 THEN january END AS january,
               CASE WHEN n_obs >= 4 THEN total_anomalies END AS total_anomalies, recent_ndvi AS current_ndvi,
               {_STATUS_CASE} AS health_status,
               CASE WHEN n_obs >= 5 THEN 'high' WHEN n_obs >= 3 THEN 'medium' ELSE 'low' END AS confidence,
               coalesce(alert_count, 0) AS alert_count
        FROM alert_flags f
        LEFT JOIN (SELECT aoi_id, avg(ndvi_mean) AS january FROM veglog WHERE month(date) = 1 GROUP BY aoi_id) m
          ON f.aoi_id = m.aoi_id
        LEFT JOIN (SELECT aoi_id, count(*) AS alert_count FROM alerts GROUP BY aoi_id) a ON f.aoi_id = a.aoi_id""",
    ("alert_flags", "alerts", "veglog"),
)
def _(spark, sf):
    january = F.try_element_at("seasonal_pattern", F.lit(1))
    return A.advanced_analytics(D.stored_log(spark, sf)).withColumns(
        {"january": january, "alert_count": F.size("alerts")}
    )


@query(
    "analytics_document",
    "aoi_id:bigint data_points_analyzed:bigint slope:r6 current_ndvi:r6 anomalies:bigint",
    """SELECT aoi_id, n_obs AS data_points_analyzed, slope, recent_ndvi AS current_ndvi,
              CASE WHEN n_obs >= 4 THEN total_anomalies ELSE 0 END AS anomalies FROM alert_flags""",
    "alert_flags",
)
def _(spark, sf):
    """The envelope through JSON text and back, read with defaults."""
    document = A.analytics_document(A.advanced_analytics(D.stored_log(spark, sf)))
    text = F.to_json(F.struct("*"))
    back = document.select(from_document(text, document.schema).alias("d"))
    root = F.col("d")
    return back.select(
        "d.aoi_id",
        "d.data_points_analyzed",
        get_path(root, "trend_analysis.trend_slope").alias("slope"),
        get_path(root, "health_classification.current_ndvi").alias("current_ndvi"),
        get_path(root, "anomaly_detection.total_anomalies", 0).alias("anomalies"),
    )


# --- dashboard -------------------------------------------------------------------


@query(
    "dashboard_status",
    "aoi_id:bigint n_obs:bigint first_date:date last_date:date current_health:varchar trend:varchar active_alerts:int",
    f"""SELECT aoi_id, n_obs, first_date, last_date,
               upper(health[1]) || health[2:] AS current_health,
               coalesce(upper(direction[1]) || direction[2:], 'Unknown') AS trend, active_alerts
        FROM (SELECT f.*, {_STATUS_CASE} AS health, coalesce(alert_count, 0) AS active_alerts
              FROM alert_flags f LEFT JOIN (SELECT aoi_id, count(*) AS alert_count FROM alerts GROUP BY aoi_id) a
                ON f.aoi_id = a.aoi_id)""",
    ("alert_flags", "alerts"),
)
def _(spark, sf):
    log = D.stored_log(spark, sf)
    return DB.status_row(A.advanced_analytics(log), log)


@query(
    "report_labels",
    "aoi_id:bigint mean:r6 interpretation:varchar trend:varchar trend_text:varchar",
    """SELECT aoi_id, mean, CASE WHEN mean > 0.3 THEN 'Good vegetation health' WHEN mean > 0.2 THEN 'Moderate vegetation'
                                 ELSE 'Sparse vegetation' END AS interpretation,
              upper(direction[1]) || direction[2:] AS trend,
              CASE direction WHEN 'improving' THEN 'Vegetation health is showing positive development'
                             WHEN 'declining' THEN 'Vegetation health shows concerning decline'
                             WHEN 'stable' THEN 'Vegetation health remains stable over time' END AS trend_text
       FROM trends""",
    "trends",
)
def _(spark, sf):
    return DB.report_labels(D.stored_log(spark, sf))


@query(
    "processing_timeline",
    "aoi_id:bigint scene_id:varchar date:date success:int",
    "SELECT *, 1 AS success FROM veglog",
    "veglog",
)
def _(spark, sf):
    return DB.processing_timeline(D.veglog(spark, sf))


# --- catalogue and batch ---------------------------------------------------------

_SCENE_ROW = "scene_id:bigint aoi_id:bigint datetime:timestamp cloud_cover:double"


@query(
    "scene_search",
    "scene_id:bigint aoi_id:bigint day:date cloud_cover:double",
    """SELECT *, cast(datetime AS date) AS day FROM suitable
       WHERE cast(datetime AS date) BETWEEN date '1998-07-01' AND date '1998-07-31'""",
    "suitable",
)
def _(spark, sf):
    found = SC.search_scenes(D.scenes(spark, sf), "1998-07-01", "1998-07-31")
    return found.withColumn("day", F.to_date("datetime"))


@query(
    "scene_lookup",
    "scene_id:bigint aoi_id:bigint day:date cloud_cover:double",
    "SELECT *, cast(datetime AS date) AS day FROM scenes WHERE scene_id = 1001",
    "scenes",
)
def _(spark, sf):
    return SC.scene_by_id(D.scenes(spark, sf), 1001).withColumn("day", F.to_date("datetime"))


@query(
    "recent_scenes",
    "scene_id:bigint aoi_id:bigint day:date stamp:varchar",
    """SELECT *, cast(datetime AS date) AS day, strftime(datetime, '%Y%m%d_%H%M%S') AS stamp FROM scenes
       WHERE cast(datetime AS date) BETWEEN date '2001-07-02' AND date '2001-08-01'""",
    "scenes",
)
def _(spark, sf):
    """The scheduled run's look-back of thirty days, with output stamps."""
    recent = PE.last_days(D.scenes(spark, sf), BATCH_AS_OF, 30)
    return recent.withColumns({"day": F.to_date("datetime"), "stamp": run_stamp(F.col("datetime"))})


@query(
    "scenes_over_areas",
    "area:bigint scenes:bigint best_cloud:double",
    """SELECT s_suppkey AS area, count(*) AS scenes, min(cloud_cover) AS best_cloud
       FROM suitable JOIN supplier
         ON (scene_id * 37) % 6000 <= (s_suppkey * 607) % 6000 + 2
        AND (s_suppkey * 607) % 6000 <= (scene_id * 37) % 6000 + 100
        AND (scene_id * 53) % 4000 <= (s_suppkey * 911) % 4000 + 2
        AND (s_suppkey * 911) % 4000 <= (scene_id * 53) % 4000 + 100
       GROUP BY s_suppkey""",
    "suitable",
)
def _(spark, sf):
    """Suitable scenes whose footprint meets an area, per area."""
    found = SC.search_scenes(D.scene_footprints(spark, sf))
    # Scenes of one footprint meet the same areas, so they are reduced before they meet any.
    reduced = found.groupBy("footprint").agg(F.count("*").alias("n"), F.min("cloud_cover").alias("cloud_cover"))
    over = SC.scenes_over_aoi(materialise(reduced, "footprints"), D.supplier_areas(spark, sf))
    return over.groupBy("area").agg(
        F.sum("n").alias("scenes"), F.min("cloud_cover").alias("best_cloud")
    )


_BEST = """
    SELECT *, cast(datetime AS date) AS day
    FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id, {key} ORDER BY cloud_cover, datetime, scene_id) AS place
          FROM {found}) WHERE place = 1"""


@query(
    "best_scene_per_period",
    "aoi_id:bigint period_idx:int scene_id:bigint day:date cloud_cover:double",
    _BEST.format(
        key="period_idx",
        found=f"""(SELECT s.*, p.i AS period_idx FROM suitable s
                   JOIN (SELECT i, date '{RANGE[0]}' + cast(31 * i AS integer) AS first_day
                         FROM range(0, 200) r(i)) p
                     ON cast(s.datetime AS date) BETWEEN p.first_day
                        AND least(p.first_day + 30, date '{RANGE[1]}')
                    AND p.first_day < date '{RANGE[1]}')""",
    ),
    "suitable",
)
def _(spark, sf):
    best = PE.best_scene_per_period(D.scenes(spark, sf), *RANGE)
    return best.withColumn("day", F.to_date("datetime"))


@query(
    "best_scene_per_month",
    "aoi_id:bigint month:date scene_id:bigint cloud_cover:double",
    _BEST.format(
        key="month",
        found="(SELECT *, cast(date_trunc('month', datetime) AS date) AS month FROM suitable)",
    ),
    "suitable",
)
def _(spark, sf):
    found = SC.search_scenes(D.scenes(spark, sf)).withColumn(
        "month", F.trunc(F.to_date("datetime"), "month")
    )
    return SC.best_scenes(found, ["aoi_id", "month"])


@query(
    "best_scene_per_season",
    "aoi_id:bigint season:varchar scene_id:bigint day:date cloud_cover:double",
    _BEST.format(
        key="season",
        found="(SELECT s.*, p.season FROM suitable s JOIN (VALUES "
        + ", ".join(f"('{n}', date '{a}', date '{b}')" for n, a, b in SEASONS)
        + ") p(season, a, b) ON cast(s.datetime AS date) BETWEEN p.a AND p.b)",
    ),
    "suitable",
)
def _(spark, sf):
    best = PE.best_scene_per_season(D.scenes(spark, sf), SEASONS)
    return best.withColumn("day", F.to_date("datetime"))


# 72 * 30 days before the date; 70 windows, of which every eighth is kept, eight at most
_BATCH_SQL = f"""
    SELECT a.aoi_id, p.period_no, p.first_day AS start_date, p.last_day AS end_date,
           cast(p.first_day AS varchar) || '_to_' || cast(p.last_day AS varchar) AS period, b.scene_id,
           'batch_' || cast(p.period_no AS varchar) AS batch_id,
           CASE WHEN b.scene_id IS NULL THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN b.scene_id IS NULL THEN 'No suitable scenes found' END AS error
    FROM (SELECT DISTINCT aoi_id FROM scenes) a
    CROSS JOIN periods p
    LEFT JOIN (SELECT * FROM (SELECT s.*, p.i, row_number() OVER (PARTITION BY s.aoi_id, p.i
                                        ORDER BY cloud_cover, datetime, scene_id) AS place
                              FROM suitable s JOIN periods p
                                ON cast(s.datetime AS date) BETWEEN p.first_day AND p.last_day) WHERE place = 1) b
      ON a.aoi_id = b.aoi_id AND p.i = b.i"""
_BATCH_VIEWS: Views = {
    **VIEWS,
    "periods": (
        (),
        f"""SELECT i, cast(i // 8 + 1 AS integer) AS period_no, first_day,
                   least(first_day + 30, date '{BATCH_AS_OF}') AS last_day
            FROM (SELECT i, date '{BATCH_AS_OF}' - {BATCH_MONTHS * 30} + cast(31 * i AS integer) AS first_day
                  FROM range(0, 70) r(i)) WHERE i % 8 = 0 AND i // 8 < {BATCH_SCENES}""",
    ),
}
_BATCH_VIEWS["batch"] = (("scenes", "suitable", "periods"), _BATCH_SQL)


def _batch(spark: SparkSession, sf: str) -> DataFrame:
    scenes = D.scenes(spark, sf)
    return PE.multi_temporal_batch(scenes, scenes, BATCH_AS_OF, BATCH_MONTHS, BATCH_SCENES)


@query(
    "multi_temporal_batch",
    "aoi_id:bigint period_no:int start_date:date end_date:date period:varchar batch_id:varchar "
    "scene_id:bigint status:varchar error:varchar",
    "SELECT * FROM batch",
    "batch",
    _BATCH_VIEWS,
)
def _(spark, sf):
    return _batch(spark, sf)


@query(
    "batch_summary",
    "aoi_id:bigint total_periods:bigint successful:bigint failed:bigint",
    """SELECT aoi_id, count(*) AS total_periods, count(scene_id) AS successful,
              count(*) - count(scene_id) AS failed FROM batch GROUP BY aoi_id""",
    "batch",
    _BATCH_VIEWS,
)
def _(spark, sf):
    return PE.batch_summary(_batch(spark, sf))


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("datetime")
    return D.scenes(spark, sf).groupBy("aoi_id").agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date")
    )


def _tiles_sql(most: str) -> str:
    return f"""
    SELECT aoi_id, i // step + 1 AS period_no, first_day + cast(31 * i AS integer) AS start_date,
           least(first_day + cast(31 * i AS integer) + 30, last_day) AS end_date
    FROM (SELECT *, greatest(1, n // {most}) AS step
          FROM (SELECT *, (last_day - first_day + 30) // 31 AS n
                FROM (SELECT aoi_id, min(cast(datetime AS date)) AS first_day, max(cast(datetime AS date)) AS last_day
                      FROM scenes GROUP BY aoi_id))) r, range(0, 200) t(i)
    WHERE i < n AND i % step = 0 AND i // step < {most}"""


_TILE = "aoi_id:bigint period_no:int start_date:date end_date:date"


@query("period_tiles", _TILE, _tiles_sql("1000000"), "scenes")
def _(spark, sf):
    """Windows over each area's range of scene dates."""
    return PE.tile_periods(_ranges(spark, sf))


@query("period_tiles_sampled", _TILE, _tiles_sql("8"), "scenes")
def _(spark, sf):
    return PE.tile_periods(_ranges(spark, sf), max_periods=8)


# --- climate ---------------------------------------------------------------------


@query(
    "climate_indices",
    "date:date temperature_max:r6 temperature_min:r6 temperature_avg:r6 precipitation:r6 humidity:r6 "
    "heat_stress_index:r6 cumulative_precip:r6 growing_degree_days:r6 water_stress_risk:int",
    "SELECT * FROM climate",
    "climate",
)
def _(spark, sf):
    return D.climate(spark, sf)


@query(
    "climate_summary",
    "first_date:date last_date:date total_days:bigint avg_temperature:double total_precipitation:double "
    "heat_stress_days:bigint growing_degree_days:double",
    """SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS total_days,
              round_even(cast(sum(cast(temperature_avg AS decimal(18,4))) AS double) / count(temperature_avg) * cast(10 AS double), 0) / 10 AS avg_temperature, round_even(cast(sum(cast(precipitation AS decimal(18,4))) AS double) * cast(10 AS double), 0) / 10 AS total_precipitation,
              sum(water_stress_risk) AS heat_stress_days, round_even(cast(sum(cast(growing_degree_days AS decimal(18,4))) AS double) * cast(10 AS double), 0) / 10 AS growing_degree_days
       FROM climate""",
    "climate",
)
def _(spark, sf):
    return CL.climate_summary(D.climate(spark, sf))


@query(
    "climate_by_year",
    "year:int total_days:bigint avg_temperature:double total_precipitation:double heat_stress_days:bigint",
    """SELECT year(date) AS year, count(*) AS total_days, round_even(cast(sum(cast(temperature_avg AS decimal(18,4))) AS double) / count(temperature_avg) * cast(10 AS double), 0) / 10 AS avg_temperature,
              round_even(cast(sum(cast(precipitation AS decimal(18,4))) AS double) * cast(10 AS double), 0) / 10 AS total_precipitation, sum(water_stress_risk) AS heat_stress_days
       FROM climate GROUP BY 1""",
    "climate",
)
def _(spark, sf):
    return CL.climate_summary(D.climate(spark, sf).withColumn("year", F.year("date")), ["year"])


_EXPECTED_T = "32 + 13 * sin(2 * pi() * (dayofyear(date) - 100) / 365)"
_EXPECTED_H = "greatest(30, least(90, 60 + 20 * sin(2 * pi() * (dayofyear(date) - 180) / 365)))"


@query(
    "seasonal_baseline",
    "date:date expected_temperature:r6 expected_humidity:r6 temperature_departure:r6 humidity_departure:r6 "
    "rainy_season:boolean",
    f"""SELECT date, {_EXPECTED_T} AS expected_temperature, {_EXPECTED_H} AS expected_humidity,
               temperature_avg - ({_EXPECTED_T}) AS temperature_departure,
               humidity - {_EXPECTED_H} AS humidity_departure, month(date) IN (12, 1, 2, 3) AS rainy_season
        FROM climate_days""",
    "climate_days",
)
def _(spark, sf):
    return CL.seasonal_baseline(D.climate_observed(spark, sf))


@query(
    "daily_climate",
    "date:date temperature_max:r6 temperature_min:r6 temperature_avg:r6 precipitation:r6 humidity:r6 "
    "heat_stress_index:r6",
    """SELECT date, round_even((temperature_avg + 3) * ten, 0) / 10 AS temperature_max,
              round_even((temperature_avg - 8) * ten, 0) / 10 AS temperature_min,
              round_even(temperature_avg * ten, 0) / 10 AS temperature_avg,
              round_even(precipitation * ten * 10, 0) / 100 AS precipitation,
              round_even(greatest(30, least(90, humidity)) * ten, 0) / 10 AS humidity, heat_stress_index
       FROM (SELECT *, cast(10 AS double) AS ten FROM climate_days)""",
    "climate_days",
)
def _(spark, sf):
    observed = D.climate_observed(spark, sf)
    return CL.daily_climate(observed.withColumnRenamed("temperature_avg", "temperature"))


@query(
    "calendar_gaps",
    "date:date",
    """SELECT cast(d AS date) AS date
       FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM climate_days)
       WHERE cast(d AS date) NOT IN (SELECT date FROM climate_days)""",
    "climate_days",
)
def _(spark, sf):
    return CL.calendar_gaps(D.climate_observed(spark, sf))


# --- vegetation and climate ------------------------------------------------------


def _insights(spark: SparkSession, sf: str) -> DataFrame:
    # one climate row per order date, so the calendar bounds the broadcast
    joined = CO.climate_join(D.veglog(spark, sf), D.climate(spark, sf), bounded=True)
    return CO.climate_insights(joined)


_SIGNED = "SELECT *, CASE WHEN r > 0 THEN 'positive' WHEN r IS NOT NULL THEN 'negative' END AS sign"


@query(
    "climate_correlation",
    "aoi_id:bigint variable:varchar r:r6 sign:varchar strong:boolean",
    f"{_SIGNED}, coalesce(abs(r) > 0.5, false) AS strong FROM correlations",
    "correlations",
)
def _(spark, sf):
    return CO.correlations(_insights(spark, sf))


@query(
    "climate_correlation_overall",
    "variable:varchar r:r6 sign:varchar",
    """SELECT *, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS sign
       FROM (SELECT 'temperature_avg' AS variable, corr(ndvi_mean, temperature_avg) AS r FROM joined
             UNION ALL SELECT 'precipitation', corr(ndvi_mean, precipitation) FROM joined
             UNION ALL SELECT 'humidity', corr(ndvi_mean, humidity) FROM joined
             UNION ALL SELECT 'heat_stress_index', corr(ndvi_mean, heat_stress_index) FROM joined)""",
    "joined",
)
def _(spark, sf):
    joined = CO.climate_join(D.veglog(spark, sf), D.climate(spark, sf), bounded=True)
    return CO.correlations(CO.climate_insights(joined, keys=()), keys=())


_YEARLY = " UNION ALL ".join(
    f"SELECT aoi_id, year(date) AS year, '{v}' AS variable, corr(ndvi_mean, {v}) AS r "
    "FROM joined GROUP BY aoi_id, year(date)"
    for v in CO.VARIABLES
)


@query(
    "strong_correlations",
    "aoi_id:bigint year:int variable:varchar r:r6 sign:varchar",
    f"{_SIGNED} FROM ({_YEARLY}) WHERE NOT isnan(r) AND abs(r) > 0.5",
    "joined",
)
def _(spark, sf):
    """Strong relationships within the years, as few hold over all of them."""
    keys = ("aoi_id", "year")
    joined = CO.climate_join(D.veglog(spark, sf), D.climate(spark, sf), bounded=True)
    yearly = CO.climate_insights(joined.withColumn("year", F.year("date")), keys=keys)
    return CO.strong_correlations(yearly, keys)


@query(
    "stress_impact",
    "aoi_id:bigint water_stress_periods:bigint ndvi_during_stress:r6 ndvi_normal:r6 impact_magnitude:r6",
    """SELECT aoi_id, water_stress_periods, ndvi_during_stress,
              CASE WHEN water_stress_periods > 0 THEN ndvi_normal END AS ndvi_normal,
              ndvi_normal - ndvi_during_stress AS impact_magnitude FROM insights""",
    "insights",
)
def _(spark, sf):
    return CO.stress_impact(_insights(spark, sf))


@query(
    "join_overview",
    "aoi_id:bigint data_points:bigint first_date:date last_date:date",
    "SELECT * FROM insights",
    "insights",
)
def _(spark, sf):
    return CO.join_overview(_insights(spark, sf))


@query(
    "quality_row",
    "aoi_id:bigint data_points:bigint strong_correlations:int",
    """SELECT i.aoi_id, i.data_points, s.n AS strong_correlations
       FROM insights i JOIN (SELECT aoi_id, count(CASE WHEN abs(r) > 0.5 THEN 1 END) AS n
                             FROM correlations GROUP BY aoi_id) s ON i.aoi_id = s.aoi_id""",
    ("insights", "correlations"),
)
def _(spark, sf):
    return CO.quality_row(_insights(spark, sf))


@query(
    "ndvi_training_rows",
    "aoi_id:bigint date:date temperature_avg:r6 precipitation:r6 humidity:r6 label:r6",
    f"""SELECT v.aoi_id, v.date, c.temperature_avg, c.precipitation, c.humidity, l.label
        FROM veglog v JOIN climate c ON v.date = c.date
        JOIN (SELECT aoi_id, date, avg(ndvi_mean) AS label FROM veglog GROUP BY aoi_id, date) l
          ON l.aoi_id = v.aoi_id AND l.date = v.date + 30
        WHERE v.date BETWEEN date '{MODEL_AS_OF}' - 2400 AND date '{MODEL_AS_OF}'""",
    ("veglog", "climate"),
)
def _(spark, sf):
    return FC.training_rows(
        D.stored_log(spark, sf), D.climate(spark, sf), MODEL_AS_OF, training_days=2400, bounded=True, tolerance_days=0
    )


_OLS_SQL = """
    SELECT unnest(['temperature_avg', 'precipitation', 'humidity', 'intercept']) AS term,
           unnest([b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3]) AS coefficient
    FROM (SELECT *, (y1 * (s22 * s33 - s23 * s23) - s12 * (y2 * s33 - s23 * y3) + s13 * (y2 * s23 - s22 * y3)) / det AS b1,
                 (s11 * (y2 * s33 - y3 * s23) - y1 * (s12 * s33 - s23 * s13) + s13 * (s12 * y3 - y2 * s13)) / det AS b2,
                 (s11 * (s22 * y3 - s23 * y2) - s12 * (s12 * y3 - y2 * s13) + y1 * (s12 * s23 - s22 * s13)) / det AS b3
          FROM (SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13)
                          + s13 * (s12 * s23 - s22 * s13) AS det
                FROM (SELECT avg(t) AS m1, avg(p) AS m2, avg(h) AS m3, avg(y) AS my,
                             covar_pop(t, t) AS s11, covar_pop(p, p) AS s22, covar_pop(h, h) AS s33,
                             covar_pop(t, p) AS s12, covar_pop(t, h) AS s13, covar_pop(p, h) AS s23,
                             covar_pop(t, y) AS y1, covar_pop(p, y) AS y2, covar_pop(h, y) AS y3
                      FROM (SELECT c.temperature_avg AS t, c.precipitation AS p, c.humidity AS h, l.label AS y
                            FROM veglog v JOIN climate c ON v.date = c.date
                            JOIN (SELECT aoi_id, date, avg(ndvi_mean) AS label FROM veglog GROUP BY aoi_id, date) l
                              ON l.aoi_id = v.aoi_id AND l.date = v.date + 30
                            WHERE v.date BETWEEN date '{as_of}' - 2400 AND date '{as_of}'))))"""


@query(
    "ndvi_regression",
    "term:varchar coefficient:r6",
    _OLS_SQL.format(as_of=MODEL_AS_OF),
    ("veglog", "climate"),
)
def _(spark, sf):
    """Least-squares coefficients over the whole history (the default is 120 days)."""
    rows = FC.training_rows(
        D.stored_log(spark, sf), D.climate(spark, sf), MODEL_AS_OF, training_days=2400, bounded=True, tolerance_days=0
    )
    return FC.coefficients(spark, FC.fit(materialise(rows, "training-rows")))


# --- rolling log and streams -----------------------------------------------------

_ROLLING = "aoi_id:bigint scene_id:varchar date:date ndvi_mean:double seq:bigint"


@query("rolling_last20", _ROLLING, "SELECT * FROM rolling", "rolling")
def _(spark, sf):
    return VL.rolling_last(D.log_stream(D.table(spark, sf, "events")))


@query(
    "log_append",
    "aoi_id:bigint entries:bigint ndvi_sum:r6",
    """SELECT aoi_id, count(*) AS entries, sum(ndvi_mean) AS ndvi_sum
       FROM (SELECT aoi_id, ndvi_mean FROM veglog UNION ALL SELECT aoi_id, ndvi_mean FROM log_stream)
       GROUP BY aoi_id""",
    ("veglog", "log_stream"),
)
def _(spark, sf):
    both = VL.append(
        D.veglog(spark, sf), D.log_stream(D.table(spark, sf, "events")).drop("arrived_at")
    )
    return both.groupBy("aoi_id").agg(
        F.count("*").alias("entries"), F.sum("ndvi_mean").alias("ndvi_sum")
    )


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return SR.read_stream(spark, f"{sf}/{name}.parq*", D.table(spark, sf, name).schema)


@query("rolling_last20_stream", _ROLLING, "SELECT * FROM rolling", "rolling")
def _(spark, sf):
    base = shared_dir(spark, "rolling-log")
    entries = D.log_stream(_stream(spark, sf, "events"))
    run_available(RL.snapshot_writer(entries, f"{base}/log", f"{base}/progress"))
    return latest_version(spark, f"{base}/log")


@query("rolling_last20_state", _ROLLING, "SELECT * FROM rolling", "rolling")
def _(spark, sf):
    base = shared_dir(spark, "rolling-state")
    entries = D.log_stream(_stream(spark, sf, "events"))
    run_available(RL.state_writer(entries, f"{base}/log", f"{base}/progress"))
    return VL.rolling_last(spark.read.parquet(f"{base}/log"))


@query("alerts_stream", _ALERT, "SELECT * FROM alerts", "alerts", ROLLING_AS_LOG)
def _(spark, sf):
    base = shared_dir(spark, "alerts")
    entries = D.log_stream(_stream(spark, sf, "events"))
    run_available(RL.alert_writer(entries, base, f"{base}/progress"))
    return latest_version(spark, f"{base}/alerts")


@query(
    "scene_stats_stream",
    f"{_SCENE} ndvi_mean:r6 ndvi_count:bigint vegetation_pixels:bigint vegetation_health:varchar",
    "SELECT * FROM stats",
    "stats",
)
def _(spark, sf):
    base = shared_dir(spark, "scene-results")
    pixels = D.pixels_of(_stream(spark, sf, "lineitem"))
    run_available(SR.scene_stats_writer(pixels, f"{base}/stats", f"{base}/progress", D.SCENE))
    return latest_rows(spark, f"{base}/stats", D.SCENE)


@query(
    "period_stats_stream",
    "period_start:varchar aoi_id:bigint scenes:bigint ndvi_mean:r10 ndvi_min:double ndvi_max:double",
    """SELECT cast(date '1970-01-01' + cast(31 * (datediff('day', date '1970-01-01', cast(arrived_at AS date)) // 31)
                                            AS integer) AS varchar) AS period_start,
              aoi_id, count(*) AS scenes, avg(ndvi_mean) AS ndvi_mean, min(ndvi_mean) AS ndvi_min,
              max(ndvi_mean) AS ndvi_max
       FROM log_stream GROUP BY 1, 2""",
    "log_stream",
)
def _(spark, sf):
    base = shared_dir(spark, "period-stats")
    entries = D.log_stream(_stream(spark, sf, "events"))
    run_available(SR.period_stats_writer(entries, f"{base}/stats", f"{base}/progress"))
    rows = latest_rows(spark, f"{base}/stats", ["period_start", "aoi_id"])
    return rows.withColumn("period_start", F.to_date("period_start").cast("string"))


# --- files -----------------------------------------------------------------------


@query(
    "event_properties",
    "event_id:bigint k:bigint",
    "SELECT event_id, coalesce(cast(json_extract(props, '$.k') AS bigint), 0) AS k FROM events",
)
def _(spark, sf):
    props = from_document(F.col("props"), "struct<k: bigint>")
    return D.table(spark, sf, "events").select("event_id", get_path(props, "k", 0).alias("k"))


@query(
    "labelled_scenes",
    "aoi_id:bigint scene_id:varchar label:varchar risk:int",
    """SELECT v.aoi_id, v.scene_id, upper(v.vegetation_health[1]) || v.vegetation_health[2:] AS label,
              c.water_stress_risk AS risk
       FROM veglog v JOIN climate c ON v.date = c.date""",
    ("veglog", "climate"),
)
def _(spark, sf):
    joined = CO.climate_join(D.veglog(spark, sf), D.climate_observed(spark, sf), bounded=True)
    return joined.select(
        "aoi_id",
        "scene_id",
        L.title(F.col("vegetation_health")).alias("label"),
        CF.water_stress_risk(F.col("temperature_max"), F.col("precipitation")).alias("risk"),
    )


from verdance import registry_files  # noqa: E402, F401  adds its queries
