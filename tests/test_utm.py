"""Projection there and back, and clips in metres."""

import random

import pytest
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators import utm as U

RING = "array<struct<lon: double, lat: double>>"


def square(x, y, a, b):
    return [(x, y), (x + a, y), (x + a, y + b), (x, y + b), (x, y)]


def test_round_trip_is_below_a_millimetre(spark):
    draw = random.Random(3)
    points = [(draw.uniform(-180, 179.999), draw.uniform(-80, 84)) for _ in range(500)]
    frame = spark.createDataFrame(points, "lon double, lat double").withColumn("u", G.to_utm(F.col("lon"), F.col("lat")))
    back = G.from_utm(F.col("u.easting"), F.col("u.northing"), F.col("u.zone"), F.col("lat") < 0)
    off = frame.select("lat", (back["lon"] - F.col("lon")).alias("x"), (back["lat"] - F.col("lat")).alias("y")).collect()
    assert max(abs(r.x) * 111_320 for r in off) < 1e-3 and max(abs(r.y) * 111_320 for r in off) < 1e-3


def test_known_point(spark):
    """The central meridian has easting 500,000; the equator northing 0 or 10,000,000."""
    frame = spark.createDataFrame([(57.0, 0.0, False), (57.0, 0.0, True)], "lon double, lat double, south boolean")
    rows = frame.select(G.to_utm(F.col("lon"), F.col("lat"), F.lit(40), F.col("south")).alias("u")).collect()
    assert [(r.u.easting, r.u.northing) for r in rows] == [(500000.0, 0.0), (500000.0, 10000000.0)]


def pixels_of(spark, points):
    frame = spark.createDataFrame(points, "lon double, lat double")
    u = G.to_utm(F.col("lon"), F.col("lat"))
    return frame.select("lon", "lat", u.alias("u")).select(
        F.col("lon").alias("x"), F.col("lat").alias("y"), "u.zone", (F.col("lat") < 0).alias("south"), "u.easting", "u.northing"
    )


def test_an_area_over_a_zone_border_is_whole(spark):
    draw = random.Random(8)
    points = [(draw.uniform(53.5, 54.5), draw.uniform(-0.4, 0.4)) for _ in range(3000)]
    areas = spark.createDataFrame([("wide", [square(53.8, -0.3, 0.5, 0.6), square(53.95, -0.1, 0.1, 0.2)])], f"aoi_id string, rings array<{RING}>")
    got = {(r.x, r.y) for r in U.clip_utm(pixels_of(spark, points), areas, cell=5000.0).collect()}

    def inside(x, y, margin):
        outer = 53.8 - margin <= x <= 54.3 + margin and -0.3 - margin <= y <= 0.3 + margin
        return outer and not (53.95 + margin < x < 54.05 - margin and -0.1 + margin < y < 0.1 - margin)

    near = 2e-6
    assert {p for p in points if inside(*p, -near)} <= got <= {p for p in points if inside(*p, near)}
    assert {x < 54 for x, _ in got} == {True, False} and {y < 0 for _, y in got} == {True, False}


@pytest.mark.parametrize("lat", [10.0, 60.0])
def test_long_sides_are_cut_within_the_error(spark, lat):
    """A point on a long side, moved by more than the error to either side, is decided right."""
    area = spark.createDataFrame([("a", square(55.0, lat, 2.0, 1.0))], f"aoi_id string, ring {RING}")
    step = 2 * U.MAX_ERROR / 111_000
    points = [(55.0 + 2.0 * i / 97, lat + d) for i in range(3, 94) for d in (step, -step)]
    got = {(r.x, r.y) for r in U.clip_utm(pixels_of(spark, points), area, cell=20_000.0).collect()}
    assert got == {p for p in points if p[1] > lat}


def test_empty_tables(spark):
    area = spark.createDataFrame([("a", square(55.0, 10.0, 1.0, 1.0))], f"aoi_id string, ring {RING}")
    pixels = pixels_of(spark, [(55.5, 10.5)])
    assert U.clip_utm(pixels, area).count() == 1
    assert U.clip_utm(pixels.limit(0), area).count() == 0 and U.clip_utm(pixels, area.limit(0)).count() == 0
