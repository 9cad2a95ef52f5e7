"""Indices, masks, statistics, tiles: hand-computed values."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdance import schemas
from verdance.functions import indices as I
from verdance.functions import labels as L
from verdance.operators import pixels as P
from verdance.operators.veglog import log_entries
from verdance.sources.files import read_wide_tiles

DAY = dt.date(2024, 7, 15)
RED, NIR = (900, 1800, 3100, 4200), (4100, 5200, 6900, 8800)
GREEN, BLUE = (1200, 2100, 3600, 4400), (400, 1300, 2300, 3600)


def pixels(spark, bands):
    rows = [("a", "s", DAY, 55.0, 24.0, *[None if v is None else int(v) for v in b]) for b in bands]
    return spark.createDataFrame(rows, schemas.PIXELS)


@pytest.fixture
def two_by_two(spark):
    return pixels(spark, zip(RED, NIR, GREEN, BLUE))


def test_index_values(two_by_two):
    got = I.with_indices(two_by_two).orderBy(F.desc("ndvi")).collect()
    assert [round(r.ndvi, 6) for r in got] == [0.64, 0.485714, 0.38, 0.353846]
    assert [round(r.evi, 6) for r in got] == [0.484848, 0.523077, 0.520548, 0.676471]
    assert [round(r.ndwi, 6) for r in got] == [-0.54717, -0.424658, -0.314286, -0.333333]


def test_index_from_reflectance_equals_index_from_numbers(two_by_two):
    bands = {b: I.reflectance(F.col(f"{b}_dn")) for b in I.BANDS}
    named = two_by_two.select(*[I.vegetation_index(n, bands).alias(n) for n in I.INDEX_NAMES])
    exact = I.with_indices(two_by_two).collect()
    for a, b in zip(named.collect(), exact):
        assert np.allclose([a.NDVI, a.EVI, a.NDWI], [b.ndvi, b.evi, b.ndwi], atol=1e-12)


def test_statistics(two_by_two):
    s = P.scene_stats(two_by_two).first()
    assert (round(s.ndvi_mean, 6), round(s.ndvi_std, 6)) == (0.46489, 0.11251)
    assert (round(s.evi_mean, 6), round(s.evi_std, 6)) == (0.551236, 0.073868)
    assert (round(s.ndwi_mean, 6), round(s.ndwi_std, 6)) == (-0.404862, 0.092146)
    assert (s.vegetation_pixels, s.vegetation_health, s.vegetation_coverage) == (4, "Good", 100.0)


@pytest.mark.parametrize("dn,valid", [(0, False), (1, True), (10000, True), (10001, False), (None, False), (-3, False)])
def test_mask_limits(spark, dn, valid):
    row = pixels(spark, [(dn, 5000, 5000, 5000)]).select(I.reflectance(F.col("red_dn")).alias("r")).first()
    assert (row.r is not None) is valid


def test_zero_evi_denominator_is_missing(spark):
    # nir + 6 red - 7.5 blue + 1 = 0 exactly
    got = I.with_indices(pixels(spark, [(1000, 3500, 2000, 2600)])).first()
    assert got.evi is None and got.ndvi is not None


def test_scene_without_valid_pixel(spark):
    stats = P.scene_stats(pixels(spark, [(0, 0, 0, 0), (20000, 0, 1, 1)]))
    s = stats.first()
    assert s.ndvi_mean is None and s.ndvi_count == 0
    assert (s.vegetation_health, s.vegetation_coverage) == ("Poor", 0.0)
    assert P.scene_stats_long(stats).count() == 0
    assert P.statistics_map(stats).first().statistics == {}
    entry = log_entries(stats, F.lit(1)).first()
    assert (entry.ndvi_mean, entry.vegetation_health) == (0.0, "Poor")


def test_missing_band_keeps_other_indices(spark):
    got = I.with_indices(pixels(spark, [(1000, 5000, 1500, None)])).first()
    assert got.evi is None and got.ndvi is not None and got.ndwi is not None


def test_float32_arrays_agree(spark):
    rng = np.random.default_rng(5)
    dn = rng.integers(0, 10500, size=(500, 4))
    got = P.scene_stats(pixels(spark, dn.tolist())).first()
    scaled = (dn.astype("float32") / 10000.0).astype("float32")
    red, nir, green, blue = np.where((scaled <= 0) | (scaled > 1), np.nan, scaled).T
    with np.errstate(invalid="ignore"):
        ndvi = np.where(nir + red > 0, (nir - red) / (nir + red), np.nan)
        ndwi = np.where(green + nir > 0, (green - nir) / (green + nir), np.nan)
    for name, values in (("ndvi", ndvi), ("ndwi", ndwi)):
        valid = values[~np.isnan(values)]
        assert got[f"{name}_count"] == len(valid)
        assert got[f"{name}_mean"] == pytest.approx(valid.mean(dtype="float64"), abs=1e-6)
        assert got[f"{name}_std"] == pytest.approx(valid.std(dtype="float64"), abs=1e-6)
    assert got.vegetation_pixels == (ndvi[~np.isnan(ndvi)] > 0.3).sum()


def test_percent_text_is_correctly_rounded(spark):
    values = [k / n * 100 for n in (1, 3, 7, 8, 16, 80, 400, 1000, 2000, 3091) for k in range(n + 1)]
    values += [12.25, 12.35, 0.05, 0.15, 99.95, 2.675, 0.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", L.percent_text(F.col("v")).alias("t")).collect()
    wrong = [(r.v, r.t, f"{r.v:.1f}%") for r in got if r.t != f"{r.v:.1f}%"]
    assert wrong == []


def test_tiles_to_pixels(spark):
    rows = []
    arrays = {"red": RED, "nir": NIR, "green": GREEN}
    for band, dn in arrays.items():
        rows.append(("s", DAY, band, 0, 2, 2, 55.0, 24.0, 0.1, -0.1, list(dn)))
    cells = P.tile_pixels(P.wide_tiles(spark.createDataFrame(rows, schemas.TILES))).orderBy("row", "col").collect()
    assert [(c.row, c["col"]) for c in cells] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert [c.red_dn for c in cells] == list(RED) and all(c.blue_dn is None for c in cells)
    assert cells[1].lon == pytest.approx(55.15) and cells[2].lat == pytest.approx(23.85)


def test_a_band_twice_is_an_error(spark):
    rows = [("s", DAY, "red", 0, 2, 2, 55.0, 24.0, 0.1, -0.1, list(dn)) for dn in (RED, NIR)]
    with pytest.raises(Exception, match="band red occurs twice"):
        P.wide_tiles(spark.createDataFrame(rows, schemas.TILES)).collect()


def test_stored_wide_tiles_need_no_shuffle_of_arrays(spark, tmp_path):
    rows = [("s", DAY, b, 0, 2, 2, 55.0, 24.0, 0.1, -0.1, list(dn)) for b, dn in zip(I.BANDS, (RED, GREEN, BLUE, NIR))]
    tiles = P.wide_tiles(spark.createDataFrame(rows, schemas.TILES))
    tiles.write.parquet(str(tmp_path / "wide"))
    stats = P.scene_stats(P.tile_pixels(read_wide_tiles(spark, str(tmp_path / "wide"))), ("scene_id", "scene_date"))
    assert stats.first().ndvi_count == P.scene_stats(P.tile_pixels(tiles), ("scene_id", "scene_date")).first().ndvi_count == 4
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_band_reduction_counts_stored_values(spark):
    rows = [("a", "s", DAY, 55.743, 24.206, 1, 1, 1, None), ("a", "s", DAY, 10.0, 10.0, 1, 1, 1, 1)]
    got = {r.band: r for r in P.band_reduction(spark.createDataFrame(rows, schemas.PIXELS)).collect()}
    assert (got["red"].pixels, got["red"].clipped_pixels, got["red"].reduction_percent) == (2, 1, 50.0)
    assert (got["blue"].pixels, got["blue"].clipped_pixels) == (1, 0)
