"""Polygon tests, spatial joins and projection."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.functions import geometry as G
from verdance.operators import pixels as P
from verdance.operators import scenes as SC
from verdance.plans.joins import fits, lookup_join

L_SHAPE = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0), (0.0, 0.0)]
TRIANGLE = [(0.0, 0.0), (3.0, 1.0), (1.0, 4.0), (0.0, 0.0)]


def brute(x, y, ring):
    """Winding by angles; the fixtures keep points off slanted sides."""
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (x1 == x2 == x and min(y1, y2) <= y <= max(y1, y2)) or (y1 == y2 == y and min(x1, x2) <= x <= max(x1, x2)):
            return True
    total = 0.0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        a, b = math.atan2(y1 - y, x1 - x), math.atan2(y2 - y, x2 - x)
        total += (b - a + math.pi) % (2 * math.pi) - math.pi
    return abs(total) > 3


def grid(step=0.25):
    n = int(5 / step)
    return [(i * step - 0.5, j * step - 0.5) for i in range(n) for j in range(n)]


@pytest.mark.parametrize("ring,points", [(L_SHAPE, grid()), (TRIANGLE, [(x + 0.013, y + 0.0071) for x, y in grid()])])
def test_point_in_polygon(spark, ring, points):
    df = spark.createDataFrame(points, "lon double, lat double").withColumn("ring", G.ring_literal(ring))
    lon, lat = F.col("lon"), F.col("lat")
    got = df.select("lon", "lat", G.in_polygon(lon, lat, ring).alias("fixed"), G.point_in_ring(lon, lat, F.col("ring")).alias("column")).collect()
    for r in got:
        assert r.fixed == r.column == brute(r.lon, r.lat, ring), (r.lon, r.lat)


def test_vertices_and_corners_are_inside(spark):
    df = spark.createDataFrame(TRIANGLE[:-1], "lon double, lat double")
    assert df.where(G.in_polygon(F.col("lon"), F.col("lat"), TRIANGLE)).count() == 3


def _areas(spark):
    rng = random.Random(8)
    rows = []
    for i in range(12):
        cx, cy, n = rng.uniform(0, 3), rng.uniform(0, 3), rng.randint(3, 9)
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(cx + rng.uniform(0.2, 1) * math.cos(a), cy + rng.uniform(0.2, 1) * math.sin(a)) for a in angles]
        rows.append((f"a{i}", 0, ring + ring[:1]))
    rows.append(("all", 0, [(-1.0, -1.0), (5.0, -1.0), (5.0, 5.0), (-1.0, 5.0), (-1.0, -1.0)]))
    rows.append(("l", 0, L_SHAPE))
    return rows, spark.createDataFrame(rows, schemas.AOI)


@pytest.mark.parametrize("max_rows", [10**6, 0])
@pytest.mark.parametrize("cell", [0.3, 1.0])
def test_assign_aoi_equals_brute_force(spark, max_rows, cell):
    """Both ways, broadcast and shuffled; the latter with a hot cell."""
    rows, aoi = _areas(spark)
    rng = random.Random(1)
    points = [(rng.uniform(-1, 4), rng.uniform(-1, 4)) for _ in range(300)] + [(0.5, 0.5 + i * 1e-5) for i in range(200)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    got = {(r.id, r.aoi_id) for r in P.assign_aoi(df, aoi, cell=cell, max_rows=max_rows).collect()}
    want = {(i, a) for i, (x, y) in enumerate(points) for a, _, ring in rows if brute(x, y, ring)}
    assert got == want


def test_cells_on_polygon_sides_decide_exactly(spark):
    """Polygon sides on cell borders, pixels on the sides."""
    ring = [(55.742, 24.205), (55.747, 24.205), (55.747, 24.21), (55.742, 24.21), (55.742, 24.205)]
    aoi = spark.createDataFrame([("a", 0, ring)], schemas.AOI)
    points = [(557400 + i, 242030 + j) for i in range(0, 90) for j in range(0, 90)]
    df = spark.createDataFrame(points, "x int, y int").withColumns({"lon": F.col("x") / 10000.0, "lat": F.col("y") / 10000.0})
    want = {p for p in points if 557420 <= p[0] <= 557470 and 242050 <= p[1] <= 242100}
    for cell in (0.001, 0.0005, 0.01):
        got = {(r.x, r.y) for r in P.assign_aoi(df, aoi, cell=cell).collect()}
        assert got == want, cell


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_footprints_over_areas(spark, max_rows):
    def square(x, y, size):
        return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]

    aoi = spark.createDataFrame([("small", 0, square(1.2, 1.2, 0.3)), ("wide", 0, square(-5.0, -5.0, 20.0)), ("far", 0, square(50.0, 50.0, 1.0))], schemas.AOI)
    # covers small; shares an edge strip; crosses like a plus; apart
    prints = {"cover": square(1.0, 1.0, 1.0), "corner": square(1.4, 1.4, 3.0), "apart": square(1.6, 1.0, 0.1),
              "band": [(0.0, 1.3), (5.0, 1.3), (5.0, 1.35), (0.0, 1.35), (0.0, 1.3)], "touch": square(1.5, 1.2, 1.0)}
    scenes = spark.createDataFrame([(k, "c", dt.datetime(2024, 1, 1), 1.0, v, {}) for k, v in prints.items()], schemas.SCENES)
    got = sorted((r.scene_id, r.aoi_id) for r in SC.scenes_over_aoi(scenes, aoi, max_rows=max_rows).collect())
    want = [(k, "wide") for k in prints] + [(k, "small") for k in ("cover", "corner", "band", "touch")]
    assert got == sorted(want)


def test_utm(spark):
    # published positions: CN Tower in zone 17, and a point on a central meridian
    df = spark.createDataFrame([(-79.387139, 43.642567), (57.0, 0.0), (57.0, -10.0)], "lon double, lat double")
    got = [r.u for r in df.select(G.to_utm(F.col("lon"), F.col("lat")).alias("u")).collect()]
    assert (got[0].zone, round(got[0].easting), round(got[0].northing)) == (17, 630084, 4833439)
    assert (got[1].zone, got[1].easting, got[1].northing) == (40, pytest.approx(500000), pytest.approx(0))
    assert 8_000_000 < got[2].northing < 10_000_000


def test_lookup_joins_agree_on_a_hot_key(spark):
    fact = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 40)] + [(7, 71)], "k bigint, v bigint")
    want = sorted(map(tuple, fact.join(dim, "k").collect()))
    order = ["k", "id", "v"]
    assert sorted(map(tuple, lookup_join(fact, dim, ["k"]).select(order).collect())) == want
    assert sorted(map(tuple, lookup_join(fact, dim, ["k"], max_rows=5).select(order).collect())) == want
    assert lookup_join(fact, dim, ["k"], "left", max_rows=5).count() == fact.join(dim, "k", "left").count()
    assert fits(dim, 41) and not fits(dim, 40) and not fits(dim, 41, max_bytes=100)


def test_missing_keys_meet(spark):
    fact = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    dim = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    for most in (5, 0):
        got = lookup_join(fact, dim, ["k"], max_rows=most)
        assert got.columns == ["k", "x", "y"]
        assert sorted((r.x, r.y) for r in got.collect()) == [(1, 10), (2, 20)]


def test_cells_of_a_large_polygon(spark):
    """A circle of a degree with 2,000 corners: each border cell has only the sides of its row."""
    ring = [(math.cos(2 * math.pi * i / 2000), math.sin(2 * math.pi * i / 2000)) for i in range(2000)]
    aoi = spark.createDataFrame([("disc", 0, ring + ring[:1])], schemas.AOI)
    cells = P.aoi_cells(aoi, 0.01).cache()
    border = cells.where("not _core")
    assert cells.where("_core").count() > 30_000 and 700 < border.count() < 1300
    assert border.select(F.max(F.size(F.get("_sides", F.lit(0))))).first()[0] < 400
    rng = random.Random(3)
    points = [(rng.uniform(-1.1, 1.1), rng.uniform(-1.1, 1.1)) for _ in range(3000)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lon double, lat double")
    got = {r.id for r in P.assign_aoi(df, aoi, cell=0.01).collect()}
    assert got == {i for i, (x, y) in enumerate(points) if brute(x, y, ring + ring[:1])}


def test_items_in_scratch_are_compressed(spark):
    import glob

    from tests.conftest import SMALL
    from verdance import session
    from verdance.registry_live import QUERIES

    mark = session.scratch_mark()
    QUERIES["scenes_over_holed_areas"](spark, SMALL)
    path = next(p for p in session._made[mark:] if "/items-" in p)
    assert glob.glob(f"{path}/part-*") and all(p.endswith(".gz") for p in glob.glob(f"{path}/part-*"))


@pytest.mark.parametrize("repeats", [1, 5])
def test_footprints_that_hardly_repeat_are_not_shuffled(spark, repeats):
    def square(x, y, size):
        return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]

    def where(i):
        return (i * 7 % 40 / 10.0, i * 3 % 30 / 10.0)

    point = "array<struct<lon: double, lat: double>>"
    rows = [(f"s{n}-{i}", i, square(*where(i), 0.5)) for i in range(40) for n in range(repeats)]
    rows += [("without", -1, None), rows[0]]
    scenes = spark.createDataFrame(rows, f"scene_id string, n int, footprint {point}")
    holed = [(f"a{k}", [square(k / 2, k / 3, 2.0), square(k / 2 + 0.3, k / 3 + 0.3, 1.4)]) for k in range(6)]
    aoi = spark.createDataFrame([*holed, holed[0]], f"aoi_id string, rings array<{point}>")
    got = SC.scenes_over_aoi(scenes, aoi)
    assert got.columns == ["scene_id", "n", "footprint", "aoi_id"]
    assert ("Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()) == (repeats == 1)

    def meets(i, k):
        (x, y), (ax, ay) = where(i), (k / 2, k / 3)
        apart = x > ax + 2 or x + 0.5 < ax or y > ay + 2 or y + 0.5 < ay
        return not apart and not (ax + 0.3 < x and x + 0.5 < ax + 1.7 and ay + 0.3 < y and y + 0.5 < ay + 1.7)

    want = sorted((s, f"a{k}") for s, i, ring in rows if ring for k in (0, *range(6)) if meets(i, k))
    assert sorted((r.scene_id, r.aoi_id) for r in got.collect()) == want
