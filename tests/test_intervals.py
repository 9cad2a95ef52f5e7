"""Intervals by dyadic blocks, models per area, footprints in parts: against their definitions."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance.operators import forecast as FC
from verdance.operators import intervals as IV
from verdance.operators import scenes as SC

DAY = dt.date(2024, 1, 1)


def test_blocks_cover_the_days_once(spark):
    draw = random.Random(2)
    spans = [(a, a + draw.choice([0, 1, 2, 30, 31, 900, 70_000])) for a in (draw.randrange(-3000, 60_000) for _ in range(60))]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", IV.day_blocks(F.col("a"), F.col("b")).alias("blocks")).collect()
    for r in rows:
        days = sorted(d for k, n in r.blocks for d in range(n << k, (n + 1) << k))
        assert days == list(range(r.a, r.b + 1))
        assert len(r.blocks) <= 2 * IV.LEVELS + (r.b - r.a) // 2**IV.LEVELS


def test_best_scenes_equal_a_search_of_every_interval(spark):
    draw = random.Random(4)
    scenes = [
        (f"s{i}", draw.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randrange(24 * 400)),
         draw.choice([None, *map(float, range(0, 30, 3))]), draw.choice(["sentinel-2-l2a", "other"]))
        for i in range(300)
    ]
    spans = [(draw.choice("abc"), k, DAY + dt.timedelta(k * 7), DAY + dt.timedelta(k * 7 + draw.choice([-1, 0, 5, 200]))) for k in range(40)]
    spans += [("a", 99, None, DAY), spans[0]]
    frame = spark.createDataFrame(scenes, "scene_id string, aoi_id string, datetime timestamp, cloud_cover double, collection string")
    periods = spark.createDataFrame(spans, "aoi_id string, k int, start_date date, end_date date")
    got = sorted((r.aoi_id, r.k, r.scene_id) for r in IV.best_scene_per_interval(frame, periods).collect())
    want = []
    for area, k, a, b in spans:
        near = [(c, t, s) for s, o, t, c, kind in scenes if kind != "other" and c is not None and c < 20 and o == area and a and a <= t.date() <= b]
        want.append((area, k, min(near)[2] if near else None))
    assert got == sorted(want, key=lambda r: r[:2]) and len({r[2] for r in got}) > 5
    plan = IV.best_scene_per_interval(frame, periods)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_models_equal_least_squares(spark):
    draw = np.random.default_rng(3)
    rows = []
    for area, n in (("a", 60), ("b", 12), ("few", 3), ("flat", 30), ("none held", 4)):
        for i in range(n):
            t, p, h = draw.normal(20, 5), draw.exponential(2), draw.normal(50, 9)
            if area == "flat":
                h = 2 * t - p + 1
            day = DAY + dt.timedelta(int(i) if area != "none held" else 3 + 5 * int(i))
            rows.append((area, day, float(t), float(p), float(h), float(0.01 * t - 0.02 * p + 0.003 * h + draw.normal(0, 0.01))))
    rows.append(("a", DAY, None, 1.0, 2.0, 3.0))
    frame = spark.createDataFrame(rows, "aoi_id string, date date, temperature_avg double, precipitation double, humidity double, label double")
    got = {r.aoi_id: r for r in FC.fit_by_area(frame).collect()}
    epoch = dt.date(1970, 1, 1)
    for area in ("a", "b"):
        own = [r for r in rows if r[0] == area and r[2] is not None]
        held = [(r[1] - epoch).days % 5 == 0 for r in own]
        x = np.array([[*r[2:5], 1.0] for r in own])
        y = np.array([r[5] for r in own])
        fit = ~np.array(held)
        want = np.linalg.lstsq(x[fit], y[fit], rcond=None)[0]
        r = got[area]
        assert [r.temperature_avg, r.precipitation, r.humidity, r.intercept] == pytest.approx(want.tolist(), rel=1e-6, abs=1e-8)
        assert (r.n, r.held_out) == (int(fit.sum()), sum(held))
        assert r.held_out_rmse == pytest.approx(float(np.sqrt(np.mean((y[~fit] - x[~fit] @ want) ** 2))), rel=1e-6)
    assert got["few"].intercept is None and got["flat"].humidity is None
    assert FC.fit_by_area(frame.limit(0)).count() == 0


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def test_footprints_in_parts_and_holes(spark):
    ring = "array<struct<lon: double, lat: double>>"
    parts = {
        "in the hole": [[square(2.0, 2.0, 1.0)]],
        "over the hole's border": [[square(0.5, 2.0, 1.0)]],
        "second part": [[square(50.0, 50.0, 1.0)], [square(4.5, 4.5, 0.2)]],
        "around with a hole of its own": [[square(-5.0, -5.0, 20.0), square(-1.0, -1.0, 9.0)]],
        "around": [[square(-5.0, -5.0, 20.0)]],
        "apart": [[square(6.5, 6.5, 1.0)]],
    }
    scenes = spark.createDataFrame(list(parts.items()), f"scene_id string, footprint_parts array<array<{ring}>>")
    area = spark.createDataFrame([("a", [square(0.0, 0.0, 5.0), square(1.0, 1.0, 3.0)])], f"aoi_id string, rings array<{ring}>")
    got = {r.scene_id for r in SC.scenes_over_aoi(scenes, area, cell=4.0).collect()}
    assert got == {"over the hole's border", "second part", "around"}
    whole = spark.createDataFrame([("a", square(0.0, 0.0, 5.0))], f"aoi_id string, ring {ring}")
    assert SC.scenes_over_aoi(scenes, whole).count() == 4
