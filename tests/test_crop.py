"""Crop windows against the test of every pixel's centre."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.operators import crop as C
from verdance.operators import pixels as PX

DAY = dt.date(2024, 7, 1)
AREA = "aoi_id string, rings array<array<struct<lon: double, lat: double>>>"


def ring(points):
    return [*points, points[0]]


def square(x, y, size):
    return ring([(x, y), (x + size, y), (x + size, y + size), (x, y + size)])


def tile(number, x0, y0, width, height, dx=0.125, dy=-0.125, bands=4):
    values = [list(range(b * 1000, b * 1000 + width * height)) for b in range(4)]
    values = [v if b < bands else None for b, v in enumerate(values)]
    return (f"scene{number}", DAY, number % 3, width, height, x0, y0, dx, dy, *values)


def wide(spark, tiles):
    names = ["scene_id", "scene_date", "tile_id", "width", "height", "x0", "y0", "dx", "dy"]
    frame = spark.createDataFrame(
        tiles, "scene_id string, scene_date date, tile_id int, width int, height int, x0 double, y0 double, dx double, "
        "dy double, red_dn array<int>, nir_dn array<int>, green_dn array<int>, blue_dn array<int>"
    )
    assert set(names) <= set(schemas.WIDE_TILES.names)
    return frame


def rows(df):
    return sorted(tuple(r[c] for c in ("aoi_id", "scene_id", "row", "col", "red_dn", "nir_dn", "blue_dn")) for r in df.collect())


def both_ways(spark, tiles, areas, **more):
    frame, area = wide(spark, tiles), spark.createDataFrame(areas, AREA)
    got = rows(C.cropped_pixels(frame, area, **more))
    want = rows(PX.assign_aoi(PX.tile_pixels(frame), area, cell=0.5))
    assert got == want
    return got


@pytest.mark.parametrize("dy", [-0.125, 0.125])
def test_shapes_equal_the_pixel_wise_clip(spark, dy):
    draw = random.Random(5)
    tiles = [tile(i, 10 + draw.randint(-8, 8) / 8, 20 + draw.randint(-8, 8) / 8, draw.randint(1, 20), draw.randint(1, 20), dy=dy) for i in range(12)]
    star = ring([(10 + draw.uniform(-2, 3), 20 + draw.uniform(-3, 2)) for _ in range(9)])
    areas = [
        ("on centres", [square(9.9375, 19.0625, 1.0)]),
        ("hole on centres", [square(9.0, 18.0, 3.0), square(9.5625, 18.5625, 1.0)]),
        ("diamond", [ring([(10.0625, 18.4375), (11.0625, 19.4375), (10.0625, 20.4375), (9.0625, 19.4375)])]),
        ("star", [star]),
        ("parts", [square(9.5, 19.0, 0.7)]),
        ("parts", [square(9.9, 19.2, 0.9)]),
        ("nearly level", [ring([(9.0, 19.0), (12.0, 19.00001), (12.0, 20.0), (9.0, 20.00001)])]),
        ("far away", [square(100.0, 50.0, 1.0)]),
    ]
    got = both_ways(spark, tiles, areas)
    assert {r[0] for r in got} == {name for name, _ in areas} - {"far away"}


def test_random_polygons(spark):
    draw = random.Random(9)
    tiles = [tile(i, draw.uniform(9, 11), draw.uniform(19, 22), 15, 11, 0.1, -0.07, bands=draw.choice([1, 4])) for i in range(8)]
    areas = []
    for i in range(25):
        x, y = draw.uniform(9, 12), draw.uniform(18, 22)
        points = [(x + draw.uniform(-1, 1), y + draw.uniform(-1, 1)) for _ in range(draw.randint(3, 12))]
        areas.append((f"a{i}", [ring(points)] + ([square(x - 0.2, y - 0.2, 0.37)] if i % 3 == 0 else [])))
    assert len(both_ways(spark, tiles, areas)) > 500
    assert both_ways(spark, tiles[:3], areas[:4], max_rows=0) is not None


def test_a_tile_outside_makes_no_pixel(spark):
    """Windows of tiles that meet an area only; the rest of the rasters is dropped by the join."""
    tiles = [tile(0, 10.0, 20.0, 16, 16), tile(1, 40.0, 20.0, 500, 500)]
    area = spark.createDataFrame([("a", [square(10.25, 18.5, 0.5)])], AREA)
    frame = wide(spark, tiles)
    windows = C.crop_windows(frame, area).collect()
    assert [(w.width, w.height) for w in windows] == [(16, 16)]
    runs = [(line.row, r.first, r.last) for line in windows[0].lines for r in line.runs]
    assert sum(b - a + 1 for _, a, b in runs) == C.cropped_pixels(frame, area).count() == 16


def test_a_polygon_of_many_sides(spark):
    import math

    points = [(10 + 0.9 * math.cos(2 * math.pi * i / 5000), 19 + 0.9 * math.sin(2 * math.pi * i / 5000)) for i in range(5000)]
    area = spark.createDataFrame([("circle", [ring(points)])], AREA)
    frame = wide(spark, [tile(0, 9.0, 20.0, 200, 200, 0.01, -0.01)])
    got = C.cropped_pixels(frame, area).agg(F.count("*").alias("n")).first().n
    inside = sum(
        (9 + (c + 0.5) * 0.01 - 10) ** 2 + (20 - (r + 0.5) * 0.01 - 19) ** 2 <= 0.81 for c in range(200) for r in range(200)
    )
    assert abs(got - inside) <= 4


def test_empty_tables(spark):
    area = spark.createDataFrame([("a", [square(10.0, 19.0, 1.0)])], AREA)
    frame = wide(spark, [tile(0, 10.0, 20.0, 4, 4)])
    assert C.cropped_pixels(frame.limit(0), area).count() == 0
    assert C.cropped_pixels(frame, area.limit(0)).count() == 0


@pytest.mark.parametrize("many", [False, True])
def test_groups_of_areas_and_scenes_are_not_shuffled(spark, monkeypatch, many):
    """Scenes of several lattices, missing ids, parts of areas: in place or shuffled, the statistics are the same."""
    draw = random.Random(3)
    tiles = [tile(number, 10.0 + number % 4, 20.0, 8, 8) for number in range(24)]
    tiles = [(f"scene{i % 7}" if i % 5 else None, DAY if i % 3 else None, *t[2:]) for i, t in enumerate(tiles)]
    areas = [(f"a{i}", [square(draw.uniform(9.5, 13.5), draw.uniform(18.8, 19.8), draw.uniform(0.2, 2.0))]) for i in range(20)]
    areas += [("a0", [square(10.1, 19.1, 0.9)]), (None, [square(11.6, 19.1, 0.9)])]
    frame, area = wide(spark, tiles), spark.createDataFrame(areas, AREA)
    keys = ("aoi_id", "scene_id", "scene_date")
    want = PX.scene_stats(PX.assign_aoi(PX.tile_pixels(frame), area, cell=0.5), keys)
    if many:
        monkeypatch.setattr(C, "FREE_BYTES", 0)
        monkeypatch.setattr(C, "GROUP_BYTES", 1 << 40)
        monkeypatch.setattr(C, "BLOCK_AREAS", 3)
        monkeypatch.setattr(C, "TASK_GROUPS", 8)
    pixels = C.cropped_pixels(frame, area, in_place=True)
    got = PX.scene_stats(pixels, (*keys, *C.PLACE))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" not in plan.split("SortMergeJoin")[0].split("Generate")[0]) == many

    def values(df):
        found = df.select(*keys, F.round("ndvi_mean", 9), "ndvi_count", F.round("ndwi_mean", 9), "vegetation_pixels").collect()
        return sorted((tuple(map(str, r)) for r in found))

    assert values(got) == values(want)
    assert len(values(got)) > 100


@pytest.mark.parametrize("few", [0, 64])
def test_sides_are_cut_in_place_or_dealt(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_SIDES", few)
    diamond = ring([(10.5, 18.4), (11.6, 19.4), (10.5, 20.4), (9.4, 19.4)])
    got = both_ways(spark, [tile(i, 10 + i / 4, 20.0, 9, 7) for i in range(4)], [("a", [diamond, square(10.3, 19.2, 0.4)]), ("b", [square(10.2, 19.0, 0.6)])])
    assert len(got) > 50


def test_few_sides_are_not_shuffled(spark):
    """One row per line of a raster is shuffled, not one per side of an area that touches it."""
    area = spark.createDataFrame([("a", [square(10.0, 19.0, 0.8)])], AREA)
    plan = C._lattice_windows(wide(spark, [tile(0, 10.0, 20.0, 8, 8)]), area, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "row" not in "".join(re.findall(r"hashpartitioning\(.*?\)", plan)) and "explode(sides" not in plan
