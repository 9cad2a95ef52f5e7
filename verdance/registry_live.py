"""Queries of what is kept up by batches, and of rasters that are cropped before they become pixels.

They belong to ``registry``; ``registry_files`` imports this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators import crop as CR
from verdance.operators import forecast as FC
from verdance.operators import intervals as IV
from verdance.operators import pixels as PX
from verdance.operators import scenes as SC
from verdance.operators import utm as UT
from verdance.oracle_views import VIEWS, Views
from verdance.registry import _OLS_SQL, _TILE_VIEWS, MODEL_AS_OF, QUERIES, query
from verdance.registry_files import _LATE_DAYS, _PERIOD_DAYS, _in_batches
from verdance.session import materialise, shared_dir
from verdance.sinks import log_store as LS
from verdance.sources import driver_tables as D
from verdance.sources import files as S
from verdance.streaming import assembly as AS
from verdance.streaming import corrections as CO
from verdance.streaming import scene_results as SR
from verdance.streaming import series_blocks as SB
from verdance.streaming.versions import latest_rows, run_available

# --- rasters ---------------------------------------------------------------------


def _tile_areas(spark: SparkSession, sf: str) -> DataFrame:
    """A diamond with a smaller diamond as a hole per supplier, among the tiles."""
    key = F.col("s_suppkey")
    x, y = 550000 + (key * 3700) % 20000, 236000 + (key * 5300) % 9000

    def diamond(radius: int):
        steps = [(radius, 0), (0, radius), (-radius, 0), (0, -radius), (radius, 0)]
        return F.array(
            *[F.struct(((x + a) / F.lit(10000.0)).alias("lon"), ((y + b) / F.lit(10000.0)).alias("lat")) for a, b in steps]
        )

    return D.table(spark, sf, "supplier").where("s_suppkey % 3 = 0").select(
        key.alias("area"), F.array(diamond(2503), diamond(1003)).alias("rings")
    )


_TILE_CLIP_VIEWS: Views = {
    **_TILE_VIEWS,
    "placed": (
        ("cells",),
        """SELECT *, 550000 + (scene_id % 100) * 100 + col * 1250 + 625 AS x, 245000 - row * 1250 - 625 AS y FROM cells""",
    ),
    "inside": (
        ("placed",),
        """SELECT s_suppkey AS area, p.* FROM placed p JOIN supplier
             ON s_suppkey % 3 = 0
            AND abs(x - (550000 + (s_suppkey * 3700) % 20000)) + abs(y - (236000 + (s_suppkey * 5300) % 9000)) BETWEEN 1003 AND 2503""",
    ),
    "pixels": (("inside",), "SELECT area * 1000000 + scene_id AS aoi_id, scene_date, 0 AS lon_e4, 0 AS lat_e4, red_dn, nir_dn, green_dn, blue_dn FROM inside"),
}


@query(
    "tile_clip_stats",
    "area:bigint scene_id:bigint ndvi_mean:r6 ndvi_count:bigint evi_count:bigint ndwi_mean:r6 vegetation_pixels:bigint",
    "SELECT aoi_id // 1000000 AS area, aoi_id % 1000000 AS scene_id, * EXCLUDE (aoi_id) FROM stats",
    "stats",
    _TILE_CLIP_VIEWS,
)
def _(spark, sf):
    """Statistics of tiles inside areas with holes, of which only pixels inside are made."""
    cropped = CR.cropped_pixels(PX.wide_tiles(D.band_tiles(spark, sf)), _tile_areas(spark, sf), cell=0.5, in_place=True)
    return PX.scene_stats(cropped, ("area", "scene_id", "scene_date", *CR.PLACE))


@query(
    "clip_utm",
    "clip_id:varchar aoi_id:bigint scene_date:date lon_e4:bigint lat_e4:bigint",
    """SELECT 'clip' AS clip_id, aoi_id, scene_date, lon_e4, lat_e4 FROM pixels
       WHERE lon_e4 BETWEEN 557421 AND 557470 AND lat_e4 BETWEEN 242051 AND 242100
         AND NOT (lon_e4 BETWEEN 557436 AND 557455 AND lat_e4 BETWEEN 242061 AND 242080)""",
    "pixels",
)
def _(spark, sf):
    """Pixels of a grid in whole metres, clipped to an area with a hole between their positions, and taken back to degrees."""
    u, lon, lat = F.col("u"), F.col("lon"), F.col("lat")
    grid = D.pixels(spark, sf).select(*D.SCENE, G.to_utm(lon, lat).alias("u")).select(
        *D.SCENE, u["zone"].alias("zone"), F.lit(False).alias("south"),
        F.round(u["easting"]).alias("easting"), F.round(u["northing"]).alias("northing"),
    )

    def ring(x: float, y: float, size: float):
        return G.ring_literal([(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)])

    rings = F.array(ring(55.74205, 24.20505, 0.005), ring(55.74355, 24.20605, 0.002))
    area = spark.range(1).select(F.lit("clip").alias("clip_id"), rings.alias("rings"))
    back = G.from_utm(F.col("easting"), F.col("northing"), F.col("zone"), F.col("south"))
    return UT.clip_utm(grid, area, cell=100.0).select(
        "clip_id", *D.SCENE, F.round(back["lon"] * 10000).alias("lon_e4"), F.round(back["lat"] * 10000).alias("lat_e4")
    )


def _holed_areas(spark: SparkSession, sf: str) -> DataFrame:
    """A square of six degrees with a hole of three per supplier."""
    key = F.col("s_suppkey")
    x, y = (key * 607) % 6000 + 0.5, (key * 911) % 4000 + 0.5

    def square(offset: int, size: int):
        corners = [(0, 0), (size, 0), (size, size), (0, size), (0, 0)]
        return F.array(
            *[F.struct(((x + offset + a) / 100).alias("lon"), ((y + offset + b) / 100).alias("lat")) for a, b in corners]
        )

    return D.table(spark, sf, "supplier").select(key.alias("area"), F.array(square(0, 600), square(150, 300)).alias("rings"))


@query(
    "scenes_over_holed_areas",
    "scene_id:varchar area:bigint",
    """SELECT cast(scene_id AS varchar) AS scene_id, s_suppkey AS area
       FROM (SELECT scene_id, part, (scene_id * 37 + part * 450) % 6000 AS x, (scene_id * 53) % 4000 AS y
             FROM scenes, range(0, 2) r(part) WHERE part = 0 OR scene_id % 3 = 0) s
       JOIN (SELECT s_suppkey, (s_suppkey * 607) % 6000 AS ax, (s_suppkey * 911) % 4000 AS ay FROM supplier)
         ON x <= ax + 600 AND x + 100 > ax AND y <= ay + 600 AND y + 100 > ay
        AND NOT (x > ax + 150 AND x + 100 <= ax + 450 AND y > ay + 150 AND y + 100 <= ay + 450)
       GROUP BY ALL""",
    "scenes",
)
def _(spark, sf):
    """Catalogue items, every third a MultiPolygon, with the areas that they do not lie in a hole of."""
    key = F.col("scene_id")

    def corners(part: int):
        x, y = (key * 37 + part * 450) % 6000, (key * 53) % 4000
        points = [(0, 0), (100, 0), (100, 100), (0, 100), (0, 0)]
        return F.array(F.array(*[F.array((x + a) / F.lit(100.0), (y + b) / F.lit(100.0)) for a, b in points]))

    many = key % 3 == 0
    coordinates = F.when(many, F.to_json(F.array(corners(0), corners(1)))).otherwise(F.to_json(corners(0)))
    kind = F.when(many, "MultiPolygon").otherwise("Polygon")
    item = F.format_string(
        '{"id": "%s", "collection": "c", "properties": {}, "assets": {}, "geometry": {"type": "%s", "coordinates": %s}}',
        key.cast("string"), kind, coordinates,
    )
    path = shared_dir(spark, "items")
    # Text of items is large: compressed, and in files that tasks can share.
    D.scenes(spark, sf).select(item).write.options(compression="gzip", maxRecordsPerFile=1 << 18).text(path)
    found = SC.scenes_over_aoi(S.read_stac_items(spark, path), _holed_areas(spark, sf), cell=4.0)
    return found.select("scene_id", "area")


# --- streams ---------------------------------------------------------------------


@query(
    "trend_incremental",
    QUERIES["trend_events"].columns,
    QUERIES["trend_events"].sql,
    "log_stream",
)
def _(spark, sf):
    """The trend of the whole log, kept up over four batches of any dates."""
    base = shared_dir(spark, "trend")
    run_available(SB.trend_writer(_in_batches(spark, sf), f"{base}/log", f"{base}/progress"))
    return SB.stored_trend(spark, f"{base}/log")


_PERIOD = f"""SELECT *, cast(date '1970-01-01' + cast({_PERIOD_DAYS} * (datediff('day', date '1970-01-01', cast(arrived_at AS date)) // {_PERIOD_DAYS})
                                                    AS integer) AS date) AS period,
                     (SELECT max(arrived_at) FROM log_stream WHERE seq % 50 <> 0) AS newest FROM log_stream"""


@query(
    "period_stats_corrected",
    "period_start:varchar aoi_id:bigint scenes:bigint ndvi_mean:r10 ndvi_min:double ndvi_max:double late_rows:bigint corrected:boolean",
    f"""SELECT cast(period AS varchar) AS period_start, aoi_id, count(*) AS scenes, avg(ndvi_mean) AS ndvi_mean,
               min(ndvi_mean) AS ndvi_min, max(ndvi_mean) AS ndvi_max, count(CASE WHEN late THEN 1 END) AS late_rows,
               count(CASE WHEN late THEN 1 END) > 0 AS corrected
        FROM (SELECT *, seq % 50 = 0 AND cast(period + {_PERIOD_DAYS} AS timestamp) <= newest - INTERVAL {_LATE_DAYS} DAY AS late
              FROM ({_PERIOD}))
        GROUP BY period, aoi_id""",
    "log_stream",
)
def _(spark, sf):
    """All entries count: every fiftieth comes after all others, and corrects periods that had closed."""
    base, path = shared_dir(spark, "period-corrected"), shared_dir(spark, "late-events")
    events = D.table(spark, sf, "events")
    late = F.col("event_id") % 50 == 0
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(path)
        stream = D.log_stream(SR.read_stream(spark, path, events.schema))
        run_available(CO.corrected_periods_writer(stream, base, f"{base}/progress", _PERIOD_DAYS, _LATE_DAYS))
    sent = CO.stored_corrections(spark, base).select(*CO.KEYS, F.lit(True).alias("corrected"))
    rows = CO.stored_periods(spark, base).join(sent, CO.KEYS, "left")
    return rows.withColumns(
        {"period_start": F.to_date("period_start").cast("string"), "corrected": F.coalesce("corrected", F.lit(False))}
    )


@query(
    "tile_assembly",
    "scene_id:bigint tile_id:int status:varchar missing:varchar ndvi_count:bigint ndvi_mean:r6",
    """SELECT c.scene_id, c.tile_id, CASE WHEN c.scene_id % 5 = 0 THEN 'failed' ELSE 'complete' END AS status,
              CASE WHEN c.scene_id % 5 = 0 THEN 'blue' ELSE '' END AS missing,
              CASE WHEN c.scene_id % 5 <> 0 THEN ndvi_count END AS ndvi_count,
              CASE WHEN c.scene_id % 5 <> 0 THEN ndvi_mean END AS ndvi_mean
       FROM (SELECT DISTINCT scene_id, tile_id FROM cells) c JOIN stats s ON s.aoi_id = c.scene_id""",
    ("cells", "stats"),
    _TILE_VIEWS,
)
def _(spark, sf):
    """Bands of tiles in four batches, a band each; tiles whose blue band never comes are failed."""
    session = spark.newSession()
    for key, value in AS.ROCKSDB.items():
        session.conf.set(key, value)
    base, path = shared_dir(spark, "assembly"), shared_dir(spark, "bands")
    bands = D.band_tiles(spark, sf)
    # The last row is of no band and much later: it ends the wait for all tiles before it.
    later = bands.where("band = 'red'").orderBy("scene_id").limit(1).withColumn("band", F.lit("none"))
    start = F.timestamp_seconds(F.lit(1_720_000_000))
    for number, band in enumerate(("red", "nir", "green", "blue", "none")):
        some = later if band == "none" else bands.where(F.col("band") == band)
        hours = 100 if band == "none" else number
        some.withColumn("arrived_at", start + F.expr(f"INTERVAL {hours} HOURS")).write.mode("append").parquet(path)
        stream = SR.read_stream(session, path, spark.read.parquet(path).schema)
        run_available(AS.assembly_writer(stream, f"{base}/tiles", f"{base}/progress", wait_ms=86_400_000))
    done = latest_rows(spark, f"{base}/tiles", ["scene_id", "tile_id"])
    complete = PX.tile_pixels(done.where("status = 'complete'"))
    stats = PX.scene_stats(complete, ("scene_id", "scene_date", "tile_id")).select("scene_id", "tile_id", "ndvi_count", "ndvi_mean")
    return done.select("scene_id", "tile_id", "status", F.array_join("missing", ",").alias("missing")).join(
        stats, ["scene_id", "tile_id"], "left"
    )


_REVISED: Views = {
    **VIEWS,
    "revised": (
        ("climate_days",),
        """SELECT date, CASE WHEN dayofyear(date) % 6 = 0 THEN precipitation + 1 ELSE precipitation END AS precipitation
           FROM climate_days""",
    ),
}


@query(
    "cumulative_precip_revised",
    "date:date precipitation:r6 cumulative_precip:r6",
    "SELECT *, sum(precipitation) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS cumulative_precip FROM revised",
    "revised",
    _REVISED,
)
def _(spark, sf):
    """Running sums over three batches: most days, the days that came late, and revised days."""
    base = shared_dir(spark, "sums")
    days = D.climate_observed(spark, sf).select("date", "precipitation")
    late, revised = F.dayofyear("date") % 4 == 0, F.dayofyear("date") % 6 == 0
    rain = F.col("precipitation") + F.when(revised, 1.0).otherwise(0.0)
    batches = (days.where(~late), days.where(late), days.where(revised).withColumn("precipitation", rain))
    for number, batch in enumerate(batches):
        SB.advance_sums(batch.withColumn("revision", F.lit(number)), number, base, [], "precipitation")
    return SB.running_sums(spark, base, [], "precipitation", "cumulative_precip")


@query(
    "log_upsert",
    "aoi_id:bigint scene_id:varchar date:date ndvi_mean:double vegetation_health:varchar seq:bigint",
    """SELECT aoi_id, scene_id, date, CASE WHEN seq % 7 = 0 THEN cast(0.25 AS double) ELSE ndvi_mean END AS ndvi_mean,
              CASE WHEN seq % 7 <> 0 AND ndvi_mean > 0.3 THEN 'Good' ELSE 'Poor' END AS vegetation_health,
              CASE WHEN seq % 7 = 0 THEN seq + 1000000000 ELSE seq END AS seq FROM log_stream""",
    "log_stream",
)
def _(spark, sf):
    """The log in documents, written in two batches, and every seventh scene processed again."""
    base = shared_dir(spark, "log-documents")
    log = D.log_stream(D.table(spark, sf, "events"))
    again = log.where("seq % 7 = 0").withColumns(
        {"ndvi_mean": F.lit(0.25), "vegetation_health": F.lit("Poor"), "seq": F.col("seq") + 1_000_000_000}
    )
    for number, batch in enumerate((log.where("seq % 2 = 0"), log.where("seq % 2 = 1"), again)):
        LS.upsert_log(batch, number, base, buckets=16)
    return LS.read_log_store(spark, base)


# --- intervals and models ----------------------------------------------------------


@query(
    "best_scene_per_interval",
    "aoi_id:bigint period:int start_date:date end_date:date scene_id:bigint cloud_cover:double",
    """SELECT p.*, s.scene_id, s.cloud_cover
       FROM (SELECT aoi_id, i AS period, date '1992-01-01' + cast((aoi_id * 37 + i * 211) % 2300 AS integer) AS start_date,
                    date '1992-01-01' + cast((aoi_id * 37 + i * 211) % 2300 + (aoi_id * 53 + i * 97) % 900 AS integer) AS end_date
             FROM (SELECT DISTINCT aoi_id FROM scenes), range(0, 40) r(i)) p
       LEFT JOIN suitable s ON s.aoi_id = p.aoi_id AND cast(s.datetime AS date) BETWEEN p.start_date AND p.end_date
       QUALIFY row_number() OVER (PARTITION BY p.aoi_id, p.period ORDER BY s.cloud_cover, s.datetime, s.scene_id) = 1""",
    ("scenes", "suitable"),
)
def _(spark, sf):
    """Forty overlapping periods of 1 to 900 days per area, as a table."""
    scenes = D.scenes(spark, sf)
    periods = scenes.select("aoi_id").distinct().withColumn("period", F.explode(F.sequence(F.lit(0), F.lit(39))))
    offset = ((F.col("aoi_id") * 37 + F.col("period") * 211) % 2300).cast("int")
    length = ((F.col("aoi_id") * 53 + F.col("period") * 97) % 900).cast("int")
    first = F.lit("1992-01-01").cast("date")
    periods = periods.withColumns({"start_date": F.date_add(first, offset), "end_date": F.date_add(first, offset + length)})
    return IV.best_scene_per_interval(scenes, periods)


_TRAINING_DAYS = 2400
_LABELLED: Views = {
    **VIEWS,
    "labelled": (
        ("veglog", "climate"),
        f"""SELECT v.aoi_id, v.date, c.temperature_avg AS t, c.precipitation AS p, c.humidity AS h, l.label AS y,
                   datediff('day', date '1970-01-01', v.date) % {FC.HELD_OUT_EVERY} = 0 AS held
            FROM veglog v JOIN climate c ON v.date = c.date
            JOIN (SELECT d.aoi_id, d.date, n.label
                  FROM (SELECT DISTINCT aoi_id, date FROM veglog) d
                  JOIN (SELECT aoi_id, date, avg(ndvi_mean) AS label FROM veglog GROUP BY aoi_id, date) n
                    ON n.aoi_id = d.aoi_id AND abs(datediff('day', d.date + 30, n.date)) <= {FC.TOLERANCE_DAYS}
                  QUALIFY row_number() OVER (PARTITION BY d.aoi_id, d.date
                                             ORDER BY abs(datediff('day', d.date + 30, n.date)), n.date) = 1) l
              ON l.aoi_id = v.aoi_id AND l.date = v.date
            WHERE v.date BETWEEN date '{MODEL_AS_OF}' - {_TRAINING_DAYS} AND date '{MODEL_AS_OF}'""",
    ),
    "moments": (
        ("labelled",),
        """SELECT aoi_id, count(*) AS n, avg(t) AS m1, avg(p) AS m2, avg(h) AS m3, avg(y) AS my,
                  covar_pop(t, t) AS s11, covar_pop(p, p) AS s22, covar_pop(h, h) AS s33, covar_pop(t, p) AS s12,
                  covar_pop(t, h) AS s13, covar_pop(p, h) AS s23, covar_pop(t, y) AS y1, covar_pop(p, y) AS y2, covar_pop(h, y) AS y3
           FROM labelled WHERE NOT held GROUP BY aoi_id""",
    ),
    "fitted": (
        ("moments",),
        """SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0
           FROM (SELECT *, (y1 * (s22 * s33 - s23 * s23) - s12 * (y2 * s33 - s23 * y3) + s13 * (y2 * s23 - s22 * y3)) / det AS b1,
                        (s11 * (y2 * s33 - y3 * s23) - y1 * (s12 * s33 - s23 * s13) + s13 * (s12 * y3 - y2 * s13)) / det AS b2,
                        (s11 * (s22 * y3 - s23 * y2) - s12 * (s12 * y3 - y2 * s13) + y1 * (s12 * s23 - s22 * s13)) / det AS b3
                 FROM (SELECT *, CASE WHEN n > 3 AND s11 * s22 * s33 > 0 THEN nullif(s11 * (s22 * s33 - s23 * s23)
                                 - s12 * (s12 * s33 - s23 * s13) + s13 * (s12 * s23 - s22 * s13), 0) END AS det FROM moments))""",
    ),
}


@query(
    "ndvi_regression_by_area",
    "aoi_id:bigint n:bigint temperature_avg:r6 precipitation:r6 humidity:r6 intercept:r6 held_out:bigint held_out_rmse:r6",
    """SELECT f.aoi_id, f.n, b1 AS temperature_avg, b2 AS precipitation, b3 AS humidity, b0 AS intercept,
              coalesce(held_out, 0) AS held_out, held_out_rmse
       FROM fitted f LEFT JOIN (
         SELECT l.aoi_id, count(*) AS held_out, sqrt(avg(power(y - b0 - b1 * t - b2 * p - b3 * h, 2))) AS held_out_rmse
         FROM labelled l JOIN fitted g ON g.aoi_id = l.aoi_id WHERE held GROUP BY l.aoi_id) e ON e.aoi_id = f.aoi_id""",
    ("labelled", "fitted"),
    _LABELLED,
)
def _(spark, sf):
    """A model per area over its history, with the NDVI nearest to thirty days later, and its error on every fifth day."""
    rows = FC.training_rows(D.stored_log(spark, sf), D.climate(spark, sf), MODEL_AS_OF, training_days=_TRAINING_DAYS, bounded=True)
    return FC.fit_by_area(rows)


@query(
    "ndvi_regression_nearest",
    "term:varchar coefficient:r6",
    _OLS_SQL[: _OLS_SQL.index("FROM (SELECT c.temperature_avg")] + "FROM labelled)))",
    "labelled",
    _LABELLED,
)
def _(spark, sf):
    """One model of all areas with the default horizon and tolerance; a default period of these tables,
    whose entries are monthly, holds too few climate days for a solution."""
    rows = FC.training_rows(D.stored_log(spark, sf), D.climate(spark, sf), MODEL_AS_OF, training_days=_TRAINING_DAYS, bounded=True)
    return FC.coefficients(spark, FC.fit(materialise(rows, "training-rows")))
