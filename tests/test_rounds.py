"""Queries over rows of which many share a place, a footprint or a window, and alerts that are shown whole."""

import datetime as dt

import pytest

from verdance.operators import pixels as PX
from verdance.operators import scenes as SC
from verdance.registry import QUERIES

AT = dt.datetime(2024, 1, 1)


def saved(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def pairs(monkeypatch):
    """Row counts of the tables that an operator is given, or that are written."""
    seen = []

    def spy(module, name, at=0):
        whole = getattr(module, name)

        def counted(*args, **more):
            seen.append(args[at].count())
            return whole(*args, **more)

        monkeypatch.setattr(module, name, counted)
        return seen

    return spy


def test_pixels_of_one_place_are_joined_once(spark, tmp_path, pairs):
    seen = pairs(PX, "assign_aoi")
    lines = [(order, 7 + 100 * (order % 3), 5, 1, 10.0, AT) for order in range(0, 30_000, 100)]
    saved(spark, tmp_path, "lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp")
    # pixels lie at 557407, 242050
    suppliers = [(k,) for k in (0, 1, 40, 51, 91, 140)]
    sf = saved(spark, tmp_path, "supplier", suppliers, "s_suppkey long")
    want = {k: 300 for (k,) in suppliers if abs(7 - k * 37 % 100) + abs(50 - (30 + k * 53 % 100)) < 5.5}
    assert {r.area: r.pixels for r in QUERIES["polygon_join_counts"](spark, sf).collect()} == want
    assert seen == [1]


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def test_equal_footprints_are_tested_once(spark, pairs):
    ring = "array<struct<lon double, lat double>>"
    scenes = spark.createDataFrame(
        [(i, square(float(i % 3), 0.0, 1.0)) for i in range(300)] + [(300, None)], f"scene_id long, footprint {ring}"
    )
    areas = spark.createDataFrame(
        [(i, [square(0.2 + i % 2, 0.2, 0.1)]) for i in range(20)] + [(20, [square(-1.0, -1.0, 9.0), square(-0.5, -0.5, 2.7)])],
        f"area long, rings array<{ring}>",
    )
    seen = pairs(SC, "materialise") if hasattr(SC, "materialise") else []
    got = SC.scenes_over_aoi(scenes, areas)
    assert got.columns == ["scene_id", "footprint", "area"]
    want = {(s, a) for s in range(300) for a in range(20) if s % 3 == a % 2} | {(s, 20) for s in range(300) if s % 3 == 2}
    found = [(r.scene_id, r.area) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    assert seen == [4, 3]  # a missing footprint is one of them


def test_scenes_of_one_footprint_are_reduced_first(spark, tmp_path, pairs):
    seen = pairs(SC, "scenes_over_aoi")
    orders = [(12_000 * i, i, AT, i + 0.05, "1-URGENT") for i in range(15)] + [(3, 1, AT, 0.01, "5-LOW")]
    saved(spark, tmp_path, "orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string")
    sf = saved(spark, tmp_path, "supplier", [(0,), (1,), (12_000,)], "s_suppkey long")
    # a key that 97 divides has no cloud cover
    rows = {r.area: (r.scenes, r.best_cloud) for r in QUERIES["scenes_over_areas"](spark, sf).collect()}
    assert rows == {0: (14, 1.05), 12_000: (14, 1.05)}
    assert seen == [1]


def test_all_three_alerts_are_shown(spark, tmp_path):
    values = [60.0 - i for i in range(15)] + [44.0, 43.0, 1.0, 1.0, 1.0]
    rows = [(i, AT + dt.timedelta(days=30 * i), 1, v) for i, v in enumerate(values)]
    rows += [(100 + i, AT + dt.timedelta(days=30 * i), 2, 50.0) for i in range(20)]
    sf = saved(spark, tmp_path, "events", rows, "event_id long, ts timestamp, user_id long, value double")
    shown = sorted(QUERIES["alerts_shown"](spark, sf).collect())
    assert [(r.aoi_id, r.alert_no) for r in shown] == [(1, 1), (1, 2), (1, 3)]
    assert shown == sorted(QUERIES["alerts_rolling"](spark, sf).collect())


def test_areas_of_a_slot_share_states(spark, tmp_path, monkeypatch):
    from verdance import schemas
    from verdance.operators import veglog as VL
    from verdance.streaming import rolling_log as RL
    from verdance.streaming import scene_results as SR
    from verdance.streaming.versions import run_available

    monkeypatch.setattr(RL, "BUCKETS", 8, raising=False)
    monkeypatch.setattr(RL, "SLOT_BITS", 9)
    day = dt.date(2024, 1, 1)
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in range(2):
        areas = [None if i % 50 == 0 else "busy" if i % 3 == 0 else f"a{i % 300}" for i in range(600)]
        rows = [(a, f"s{part}_{i}", day, 0.5, "Good", 600 * part + i) for i, a in enumerate(areas)]
        spark.createDataFrame(rows, schemas.VEGLOG).coalesce(1).write.mode("append").parquet(source)
        run_available(RL.state_writer(SR.read_stream(spark, source, schemas.VEGLOG), out, progress))
    want = VL.rolling_last(spark.read.schema(schemas.VEGLOG).parquet(source)).select(*VL.COLUMNS)
    got = VL.rolling_last(spark.read.parquet(out)).select(*VL.COLUMNS)
    assert got.count() == want.count() > 400 and got.exceptAll(want).count() == 0
    states = spark.read.format("statestore").load(progress).count()
    assert states <= 3 * 9  # slots times buckets, and a bucket for missing areas


def test_pixels_are_projected_once(spark):
    from tests.conftest import SMALL
    from tests.test_plans import plan_of

    plan = plan_of(QUERIES["clip_utm"](spark, SMALL))
    assert not any("SINH" in line for line in plan.splitlines() if "Filter" in line)


def test_a_band_of_a_tile_takes_few_calls_for_state():
    import pandas as pd

    from verdance.streaming import assembly as AS

    calls = []

    class State:
        value = None

        def __getattr__(self, name):
            def call(*args):
                calls.append(name)
                if name in ("update", "clear"):
                    self.value = args[0] if args else None
                return self.value

            return call

    class Handle(State):
        def getValueState(self, *_):
            return State()

        def getMapState(self, *_):
            return State()

    tile = AS.Assembly(1000)
    tile.init(Handle())
    key, done = (1, AT.date(), 0, 2, 1, 10.0, 20.0, 0.5, -0.5), []
    for band in ("red", "nir", "green", "blue"):
        calls.clear()
        frame = pd.DataFrame({"band": [band], "dn": [[1, 2]], "arrived_at": [pd.Timestamp(AT)]})
        done += list(tile.handleInputRows(key, iter([frame]), None))
        assert len(calls) <= 5, calls
    assert [(f.status[0], f.missing[0], f.blue_dn[0]) for f in done] == [("complete", [], [1, 2])]


def test_tiles_of_one_lattice_share_windows(spark, pairs):
    from verdance.operators import crop as CR

    names = ["scene_id", "scene_date", "tile_id", "width", "height", "x0", "y0", "dx", "dy"]
    rows = [(i, AT.date(), i % 5, 4, 4, 10.0, 20.0, 0.5, -0.5) for i in range(10)]
    tiles = spark.createDataFrame(rows, "scene_id long, scene_date date, tile_id int, width int, height int, x0 double, y0 double, dx double, dy double")
    wide = tiles.selectExpr(*names, *[f"array_repeat(1, 16) AS {b}_dn" for b in ("red", "green", "blue", "nir")])
    areas = spark.createDataFrame([(1, square(10.6, 18.6, 0.8))], "area long, ring array<struct<lon double, lat double>>")
    seen = pairs(CR, "materialise")
    got = CR.cropped_pixels(wide, areas)
    assert sorted((r.scene_id, r.tile_id, r.row, r.col) for r in got.collect()) == [(i, i % 5, r, c) for i in range(10) for r in (1, 2) for c in (1, 2)]
    assert seen == [1]
