"""Period tiling, scene choice and batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.operators import periods as PE
from verdance.operators import scenes as SC

START = dt.date(2024, 1, 1)


def tiles(spark, days, most):
    ranges = spark.createDataFrame([(START, START + dt.timedelta(days))], "start_date date, end_date date")
    rows = PE.tile_periods(ranges, max_periods=most).orderBy("period_no").collect()
    assert [r.period_no for r in rows] == list(range(1, len(rows) + 1))
    return [((r.start_date - START).days, (r.end_date - START).days) for r in rows]


@pytest.mark.parametrize(
    "days,want",
    [
        (180, [(0, 30), (31, 61), (62, 92), (93, 123), (124, 154), (155, 180)]),
        (360, [(31 * i, 31 * i + 30) for i in range(8)]),
        (720, [(93 * i, 93 * i + 30) for i in range(8)]),
        (31, [(0, 30)]),
        (0, []),
    ],
)
def test_hand_cases(spark, days, want):
    assert tiles(spark, days, 8) == want


def day_walk(days, most):
    """The windows by walking the calendar."""
    found, current = [], 0
    while current < days:
        found.append((current, min(current + 30, days)))
        current = found[-1][1] + 1
    step = len(found) // most if len(found) > most else 1
    return found[::step][:most] if len(found) > most else found


@pytest.mark.parametrize("most", [1, 3, 8])
def test_tiling_equals_walk(spark, most):
    for days in (1, 30, 31, 32, 61, 62, 63, 92, 93, 250, 310, 311, 1000):
        assert tiles(spark, days, most) == day_walk(days, most), days


@pytest.mark.parametrize("days,most", [(62, None), (62, 1), (93, 2), (400, 3), (400, None), (31, 8)])
def test_bucket_of_date_equals_windows(spark, days, most):
    end = START + dt.timedelta(days)
    dates = [START + dt.timedelta(i) for i in range(-2, days + 3)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = {r.d: r.i for r in df.select("d", PE.in_period(F.col("d"), START, end, most).alias("i")).collect()}
    windows = day_walk(days, most or 10**6)
    for d in dates:
        at = (d - START).days
        inside = [w for w in windows if w[0] <= at <= w[1]]
        assert (got[d] is not None) == bool(inside), d
        if inside:
            assert got[d] == inside[0][0] // 31


def catalog(spark, rows):
    full = [(i, c, dt.datetime.fromisoformat(t), cloud, None, {}) for i, c, t, cloud in rows]
    return spark.createDataFrame(full, schemas.SCENES).withColumn("aoi_id", F.lit("a"))


def test_search_limits(spark):
    c = "sentinel-2-l2a"
    scenes = catalog(
        spark,
        [
            ("cloudy", c, "2024-07-10T10:00:00", 20.0),
            ("unknown", c, "2024-07-10T10:00:00", None),
            ("other", "sentinel-2-l1c", "2024-07-10T10:00:00", 1.0),
            ("first", c, "2024-07-01T00:00:00", 19.99),
            ("last", c, "2024-07-31T23:59:59", 3.0),
            ("late", c, "2024-08-01T00:00:00", 0.0),
            ("early", c, "2024-06-30T23:59:59", 0.0),
        ],
    )
    found = SC.search_scenes(scenes, "2024-07-01", "2024-07-31")
    assert {r.scene_id for r in found.collect()} == {"first", "last"}
    assert SC.select_scenes(scenes, "2024-07-01", "2024-07-31").first().scene_id == "last"
    assert SC.scene_by_id(scenes, "other").count() == 1


def test_ties_go_to_earlier_then_smaller_id(spark):
    c = "sentinel-2-l2a"
    scenes = catalog(
        spark,
        [("z", c, "2024-07-02T00:00:00", 5.0), ("b", c, "2024-07-02T00:00:00", 5.0), ("a", c, "2024-07-03T00:00:00", 5.0)],
    )
    assert SC.best_scenes(scenes).first().scene_id == "b"


def test_batch_reports_failed_periods(spark):
    end = dt.date(2024, 7, 1)
    scenes = catalog(spark, [("s1", "sentinel-2-l2a", "2024-06-20T10:00:00", 5.0)])
    aoi = spark.createDataFrame([("a",), ("b",)], "aoi_id string")
    batch = PE.multi_temporal_batch(scenes, aoi, end)
    summary = {r.aoi_id: r for r in PE.batch_summary(batch).collect()}
    assert (summary["a"].total_periods, summary["a"].successful, summary["a"].failed) == (6, 1, 5)
    assert (summary["b"].successful, summary["b"].failed) == (0, 6)
    failed = batch.where("status = 'failed'").select("error").distinct().collect()
    assert [r.error for r in failed] == [PE.NO_SCENE]


def test_batch_equals_brute_force(spark):
    rng = random.Random(3)
    end = dt.date(2024, 6, 30)
    rows = []
    for i in range(400):
        day = end - dt.timedelta(rng.randrange(-5, 760))
        rows.append((f"s{i:03}", "sentinel-2-l2a", f"{day}T10:00:00", rng.choice([5.0, 5.0, 12.5, 30.0])))
    batch = PE.multi_temporal_batch(catalog(spark, rows), spark.createDataFrame([("a",)], "aoi_id string"), end, 24, 8)
    start = end - dt.timedelta(720)
    windows = day_walk(720, 8)
    want = []
    for a, b in windows:
        inside = [
            (cloud, t, i) for i, _, t, cloud in rows
            if cloud < 20 and a <= (dt.date.fromisoformat(t[:10]) - start).days <= b
        ]
        want.append(min(inside)[2] if inside else None)
    got = batch.orderBy("period_no").collect()
    assert [r.scene_id for r in got] == want
    assert got[0].period == f"{start}_to_{start + dt.timedelta(30)}" and got[0].batch_id == "batch_1"


def test_assets(spark):
    rows = [("s1", "c", None, 1.0, None, {"red": "r", "nir": "n", "swir": "x"}),
            ("s2", "c", None, 1.0, None, {b: b for b in ("red", "green", "blue", "nir")})]
    scenes = spark.createDataFrame(rows, schemas.SCENES)
    kept = {(r.scene_id, r.band) for r in SC.required_assets(scenes).collect()}
    assert ("s1", "red") in kept and ("s1", "swir") not in kept and len(kept) == 6
    assert [r.scene_id for r in SC.with_all_bands(scenes).collect()] == ["s2"]


def test_seasons_may_overlap(spark):
    scenes = catalog(spark, [("s1", "sentinel-2-l2a", "2024-07-10T00:00:00", 5.0)])
    seasons = (("July", "2024-07-01", "2024-07-31"), ("Summer", "2024-06-01", "2024-08-31"), ("May", "2024-05-01", "2024-05-31"))
    assert {r.season for r in PE.best_scene_per_season(scenes, seasons).collect()} == {"July", "Summer"}
