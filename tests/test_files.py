"""Sources and sinks, round trips, and the jobs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.functions import geometry as G
from verdance.functions.dates import iso_date, look_back, run_stamp
from verdance.jobs import analysis, batch, climate as climate_job, dashboard, scenes as scenes_job
from verdance.operators import anomalies as A
from verdance.operators import periods as PE
from verdance.operators import pixels as P
from verdance.operators.veglog import rolling_last
from verdance.plans import workflows as WF
from verdance.session import remove_scratch
from verdance.sinks import files as K
from verdance.sources import files as S

NOW = dt.datetime(2024, 7, 31, 9, 30, 5)


def geojson(path, rings, names=None):
    features = [
        {"type": "Feature", "properties": {"aoi_id": names[i]} if names else {},
         "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in ring]]}}
        for i, ring in enumerate(rings)
    ]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def test_read_aoi(spark, tmp_path):
    path = geojson(tmp_path / "field.geojson", [square(1, 2, 1), square(5, 5, 1)])
    rows = S.read_aoi(spark, path).orderBy("feature_id").collect()
    assert [(r.aoi_id, r.feature_id) for r in rows] == [("field#0", 0), ("field#1", 1)]
    assert (rows[0].ring[2].lon, rows[0].ring[2].lat) == (2.0, 3.0)
    assert S.read_aoi(spark, path, first_only=True).count() == 1
    named = geojson(tmp_path / "n.geojson", [square(1, 2, 1)], ["north"])
    assert S.read_aoi(spark, named).first().aoi_id == "north"


@pytest.mark.parametrize("content", [None, "not json", '{"type": "FeatureCollection", "features": []}'])
def test_a_path_without_a_polygon_is_an_error(spark, tmp_path, content):
    path = tmp_path / "aoi.geojson"
    if content is not None:
        path.write_text(content)
    with pytest.raises(Exception):
        S.read_aoi(spark, str(path)).collect()


def test_holes_and_parts(spark, tmp_path):
    outer, hole = square(0, 0, 3), square(1, 1, 1)
    parts = {"type": "MultiPolygon", "coordinates": [[square(5, 0, 1)], [square(6, 0, 1)]]}
    features = [
        {"type": "Feature", "properties": {"aoi_id": "ringed"}, "geometry": {"type": "Polygon", "coordinates": [outer, hole]}},
        {"type": "Feature", "properties": {"aoi_id": "parts"}, "geometry": parts},
        {"type": "Feature", "properties": {"aoi_id": "spot"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    ]
    path = tmp_path / "aoi.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    aoi = S.read_aoi(spark, str(path))
    assert sorted((r.aoi_id, len(r.rings)) for r in aoi.collect()) == [("parts", 1), ("parts", 1), ("ringed", 2)]
    points = [(0.5, 0.5), (1.5, 1.5), (1.0, 1.5), (2.5, 1.5), (6.0, 0.5), (5.5, 0.5), (6.5, 0.5), (8.0, 0.5)]
    df = spark.createDataFrame(points, "lon double, lat double")
    for cell in (0.3, 1.0, 10.0):
        got = sorted((r.aoi_id, r.lon, r.lat) for r in P.assign_aoi(df, aoi, cell=cell).collect())
        # a point on the hole's side is in; one on the side that two parts share counts once
        assert got == sorted([("ringed", *p) for p in (points[0], points[2], points[3])] + [("parts", *p) for p in points[4:7]])


def test_default_aoi(spark):
    row = S.read_aoi(spark).first()
    assert [(p.lon, p.lat) for p in row.ring] == G.DEFAULT_AOI
    assert S.clip_aoi(spark).first().ring[0].lon == 55.742


def test_stac_items(spark, tmp_path):
    item = {"id": "x1", "collection": "sentinel-2-l2a", "properties": {"eo:cloud_cover": 7.5, "datetime": "2023-05-02T08:15:00Z"},
            "geometry": {"type": "Polygon", "coordinates": [[list(p) for p in square(1, 2, 1)]]},
            "assets": {"red": {"href": "http://r"}, "nir": {"href": "http://n"}}}
    bare = {"id": "x2", "collection": "c", "properties": {"datetime": "2024-07-16T10:30:00Z"}, "assets": {}}
    (tmp_path / "items.json").write_text(json.dumps(item) + "\n" + json.dumps(bare))
    a, b = S.read_stac_items(spark, str(tmp_path)).orderBy("scene_id").collect()
    assert (a.scene_id, a.cloud_cover, a.datetime) == ("x1", 7.5, dt.datetime(2023, 5, 2, 8, 15))
    assert a.assets == {"red": "http://r", "nir": "http://n"} and a.footprint[1].lon == 2.0
    assert b.cloud_cover is None


def test_read_log(spark, tmp_path):
    scenes = [{"scene_id": f"s{i}", "date": f"2024-07-{10 - i:02}", "ndvi_mean": 0.1 * i, "vegetation_health": "Poor"} for i in range(3)]
    path = tmp_path / "log.json"
    path.write_text(json.dumps({"scenes": scenes, "last_updated": "x"}, indent=2))
    rows = S.read_log(spark, str(path), "a").orderBy("seq").collect()
    assert [(r.aoi_id, r.scene_id, r.date, r.seq) for r in rows] == [("a", f"s{i}", dt.date(2024, 7, 10 - i), i) for i in range(3)]
    path.write_text('{"scenes": []}')
    assert S.read_log(spark, str(path), "a").count() == 0
    assert S.read_log(spark, str(tmp_path / "none.json")).count() == 0
    path.write_text("{broken")
    with pytest.raises(Exception):
        S.read_log(spark, str(path), "a").count()


def test_area_of_a_log_is_never_missing(spark, tmp_path):
    """A log as the format has it, without an area: the file's name serves, and results follow."""
    entries = [{"scene_id": f"s{i}", "date": f"2024-0{i + 1}-01", "ndvi_mean": 0.1 * i, "vegetation_health": "Poor"} for i in range(8)]
    path = tmp_path / "north.json"
    path.write_text(json.dumps({"scenes": entries, "last_updated": "x"}))
    assert {r.aoi_id for r in S.read_log(spark, str(path)).collect()} == {"north"}
    paths = analysis.main(["--log", str(path), "--out", str(tmp_path / "out")])
    assert [spark.read.json(p).count() for p in paths] == [1, 1]


def test_log_round_trip(spark, tmp_path, log_of):
    log = log_of({"a": [0.01 * i for i in range(30)], "b": [0.5]})
    path = K.write_log(log, str(tmp_path), NOW)
    back = S.read_log(spark, path)
    assert {r.aoi_id: r["count"] for r in back.groupBy("aoi_id").count().collect()} == {"a": 30, "b": 1}
    short = S.read_log(spark, K.write_log(rolling_last(log), f"{tmp_path}/short", NOW))
    assert {r.aoi_id: r["count"] for r in short.groupBy("aoi_id").count().collect()} == {"a": 20, "b": 1}
    first = short.where("aoi_id = 'a' AND seq = 0").first()
    assert (first.scene_id, first.ndvi_mean) == ("a_10", pytest.approx(0.1))


def test_newest_climate(spark, tmp_path):
    base = str(tmp_path)
    assert_none = tmp_path / "empty"
    assert_none.mkdir()
    assert S.read_newest_climate(spark, str(assert_none)) is None
    for i, t in enumerate((20.0, 30.0)):
        df = spark.createDataFrame([(dt.date(2024, 1, 1), t)], "date date, temperature_avg double")
        path = K.write_climate(df, base, "2024-01-01", f"2024-01-0{i + 1}")
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000 - i * 1000,) * 2)
    got = S.read_newest_climate(spark, f"{base}/climate_data").collect()
    assert [r.temperature_avg for r in got] == [20.0]
    (tmp_path / "climate_data" / "plain.csv").write_text("date,temperature_avg,humidity\n2024-02-01,7.5,NaN\n")
    row = S.read_newest_climate(spark, f"{base}/climate_data").first()
    assert (row.date, row.temperature_avg, row.humidity) == (dt.date(2024, 2, 1), 7.5, None)


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_bytes(b"x" * 1024)
    (tmp_path / "sub" / "b.json").write_bytes(b"x" * 512)
    files = S.list_files(spark, str(tmp_path))
    total = S.size_totals(files).first()
    assert (total.files, total.total_kb) == (2, 1.5)


def test_scene_documents(spark, tmp_path):
    rows = [("a", "s1", dt.date(2024, 7, 15), 1.0, 1.0, 1000, 5000, 1500, 500), ("a", "s2", dt.date(2024, 7, 16), 1.0, 1.0, 0, 0, 0, 0)]
    stats = P.scene_stats(spark.createDataFrame(rows, schemas.PIXELS))
    path = K.write_scene_statistics(stats, str(tmp_path), NOW)
    assert sorted(n for n in os.listdir(path) if n.startswith("scene_date")) == ["scene_date=2024-07-15", "scene_date=2024-07-16"]
    got = {r["scene_id"]: r for r in map(json.loads, spark.read.text(path).toPandas()["value"])}
    assert got["s1"]["summary"]["vegetation_coverage"] == "100.0%"
    assert got["s1"]["statistics"]["NDVI"]["vegetation_pixels"] == 1
    assert "vegetation_pixels" not in got["s1"]["statistics"]["EVI"]
    assert got["s2"]["statistics"] == {} and got["s2"]["summary"]["vegetation_coverage"] == "0.0%"
    assert got["s2"]["processed_indices"] == ["NDVI", "EVI", "NDWI"]


def test_analytics_document(spark, tmp_path, log_of):
    document = A.analytics_document(A.advanced_analytics(log_of({"a": [0.5, 0.4, 0.3, 0.2, 0.1, 0.05]})), NOW)
    path = K.write_document(document, str(tmp_path), "advanced_analytics", NOW)
    assert path.endswith("advanced_analytics_20240731_093005.json")
    got = json.loads(spark.read.text(path).first().value)
    assert got["trend_analysis"]["trend_direction"] == "declining"
    assert set(got["trend_analysis"]["seasonal_pattern"]) == {"1", "2", "3", "4", "5", "6"}
    assert [a["type"] for a in got["alerts"]] == ["trend_alert", "health_alert"]
    assert got["data_points_analyzed"] == 6


def test_failed_write_fails_the_job(spark, tmp_path, log_of):
    trends = log_of({"a": [0.5]})
    K.write_document(trends, str(tmp_path), "x", NOW)
    with pytest.raises(Exception):
        K.write_document(trends, str(tmp_path), "x", NOW)


def test_dates(spark):
    df = spark.createDataFrame([("2024-07-15T10:30:00Z",)], "t string")
    row = df.select(iso_date(F.col("t")).alias("d"), run_stamp(F.lit(NOW)).alias("s")).first()
    assert (row.d, row.s) == (dt.date(2024, 7, 15), "20240731_093005")
    assert look_back("2024-07-31", 30) == (dt.date(2024, 7, 1), dt.date(2024, 7, 31))


# --- whole jobs -------------------------------------------------------------------


@pytest.fixture
def field(spark, tmp_path):
    """Two areas, a catalogue and a pixel table with one pixel row per scene and cell."""
    aoi = geojson(tmp_path / "aoi.geojson", [square(1.0, 1.0, 0.01), square(1.02, 1.0, 0.01)], ["west", "east"])
    wide = square(0.0, 0.0, 3.0)
    catalog = [
        ("best", "sentinel-2-l2a", dt.datetime(2024, 7, 10, 10), 2.0, wide, {}),
        ("cloudier", "sentinel-2-l2a", dt.datetime(2024, 7, 12, 10), 9.0, wide, {}),
        ("apart", "sentinel-2-l2a", dt.datetime(2024, 7, 12, 10), 0.0, square(9.0, 9.0, 1.0), {}),
    ]
    spark.createDataFrame(catalog, schemas.SCENES).write.parquet(str(tmp_path / "catalog"))
    rows = []
    for scene, day, nir in (("best", 10, 6000), ("cloudier", 12, 3000)):
        for i in range(40):
            for j in range(12):
                rows.append((None, scene, dt.date(2024, 7, day), 0.9985 + i * 0.001, 0.9985 + j * 0.001, 2000, nir, 1500, 900))
    spark.createDataFrame(rows, schemas.PIXELS).write.partitionBy("scene_date").parquet(str(tmp_path / "pixels"))
    return tmp_path, aoi


def test_process_scenes(spark, field):
    base, aoi = field
    stats = WF.process_scenes(S.read_scenes(spark, f"{base}/catalog"), spark.read.parquet(f"{base}/pixels"), S.read_aoi(spark, aoi))
    got = {r.aoi_id: r for r in stats.collect()}
    assert set(got) == {"west", "east"}
    for r in got.values():
        assert (r.scene_id, r.ndvi_count, round(r.ndvi_mean, 6)) == ("best", 100, 0.5)
    one = WF.process_scenes(
        S.read_scenes(spark, f"{base}/catalog"), spark.read.parquet(f"{base}/pixels"), S.read_aoi(spark, aoi), scene_id="cloudier"
    )
    assert {r.scene_id for r in one.collect()} == {"cloudier"}
    log = WF.update_log(spark.createDataFrame([], schemas.VEGLOG), stats)
    assert {(r.aoi_id, r.vegetation_health, r.seq) for r in log.collect()} == {("west", "Good", 0), ("east", "Good", 0)}
    again = WF.update_log(log, stats)
    assert sorted((r.aoi_id, r.seq) for r in again.collect()) == [("east", 0), ("east", 1), ("west", 0), ("west", 1)]


def test_no_scene_is_an_error(spark, field):
    base, aoi = field
    with pytest.raises(WF.NoSuitableScene, match="No suitable scenes found"):
        WF.process_scenes(S.read_scenes(spark, f"{base}/catalog"), spark.read.parquet(f"{base}/pixels"), S.read_aoi(spark, aoi), "2023-01-01", "2023-01-31")


def test_jobs(spark, field, log_of):
    base, aoi = field
    out = str(base / "out")
    run = ["--catalog", f"{base}/catalog", "--pixels", f"{base}/pixels", "--aoi", aoi]
    assert spark.read.json(scenes_job.main([*run, "--out", out])[0]).count() == 2
    # scenes, log, analysis: the analysis sees what the scene job appended
    started = K.write_log(log_of({"west": [0.1, 0.2, 0.3]}), f"{out}/before", NOW)
    _, whole, recent = scenes_job.main([*run, "--out", f"{out}/chain", "--log", started])
    seen = {r.aoi_id: r.total_scenes for r in spark.read.json(analysis.main(["--log", whole, "--out", f"{out}/chain"])[0]).collect()}
    assert seen == {"west": 4, "east": 1}
    assert S.read_log(spark, recent).count() == 5
    panels = dashboard.main(["--log", whole, "--out", f"{out}/chain"])
    assert {p.rsplit("/", 1)[1]: spark.read.parquet(p).count() for p in panels}["status"] == 2
    summary = batch.main(["--catalog", f"{base}/catalog", "--aoi", aoi, "--out", out, "--as-of", "2024-07-31"])
    got = {r.aoi_id: r for r in spark.read.json(summary).collect()}
    assert (got["west"].total_periods, got["west"].successful) == (6, 1) and len(got["east"].results) == 6
    log = K.write_log(log_of({"west": [0.5, 0.4, 0.3, 0.2, 0.1, 0.05]}), out, NOW)
    paths = analysis.main(["--log", log, "--out", out])
    assert all(spark.read.json(p).count() == 1 for p in paths)
    days = [(dt.date(2020, 1, 1) + dt.timedelta(i), 20.0 + i % 9, 20.0, 0.0, 50.0 + i % 7, 0.0) for i in range(200)]
    spark.createDataFrame(
        days, "date date, temperature_avg double, temperature_max double, precipitation double, humidity double, heat_stress_index double"
    ).write.parquet(f"{base}/observed")
    first, second = climate_job.main(["--observed", f"{base}/observed", "--log", log, "--out", out, "--as-of", "2020-07-01", "--days", "182"])
    assert spark.read.option("header", True).csv(first).count() == 183
    assert spark.read.json(second).first().data_points == 6


def test_a_job_leaves_no_scratch_folder(spark, tmp_path, log_of):
    from verdance.session import shared_dir

    shared = os.path.dirname(shared_dir(spark, "probe")).removeprefix("file:")
    remove_scratch(spark)
    before = set(os.listdir(shared))
    log = K.write_log(log_of({"a": [0.5, 0.4, 0.3, 0.2]}), str(tmp_path), NOW)
    analysis.main(["--log", log, "--out", str(tmp_path / "out")])
    assert set(os.listdir(shared)) == before


def test_season_periods_of_jobs_are_fixed():
    assert PE.SEASONS[0][1:] == ("2024-07-01", "2024-07-31")
