"""Clipping, index computation and reduction of the pixel table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.functions import labels as L
from verdance.functions.indices import BANDS, INDEX_NAMES, VEGETATION_NDVI, with_indices
from verdance.plans.joins import MAX_BROADCAST_ROWS, fits
from verdance.session import materialise

SCENE_KEYS = ("aoi_id", "scene_id", "scene_date")
CELL_DEGREES = 0.01


def clip(pixels: DataFrame, ring: G.Ring = G.CLIP_AOI) -> DataFrame:
    """Pixels whose centre lies in or on one polygon."""
    return pixels.where(G.in_polygon(F.col("lon"), F.col("lat"), ring))


def clip_reduction(
    pixels: DataFrame, ring: G.Ring = G.CLIP_AOI, keys: Sequence[str] = SCENE_KEYS
) -> DataFrame:
    """Pixels before and after the clip, and the reduction in percent, per scene."""
    inside = G.in_polygon(F.col("lon"), F.col("lat"), ring)
    counted = pixels.groupBy(*keys).agg(
        F.count("*").alias("pixels"), F.count_if(inside).alias("clipped_pixels")
    )
    return counted.withColumn(
        "reduction_percent", (1 - F.col("clipped_pixels") / F.col("pixels")) * 100.0
    )


def band_reduction(
    pixels: DataFrame, ring: G.Ring = G.CLIP_AOI, keys: Sequence[str] = SCENE_KEYS
) -> DataFrame:
    """``clip_reduction`` for each band on its own, over the band's stored values."""
    inside = G.in_polygon(F.col("lon"), F.col("lat"), ring)
    aggregates = []
    for b in BANDS:
        present = F.col(f"{b}_dn").isNotNull()
        aggregates += [
            F.count_if(present).alias(f"{b}_n"),
            F.count_if(present & inside).alias(f"{b}_clipped"),
        ]
    per_band = F.array(
        *[
            F.struct(
                F.lit(b).alias("band"),
                F.col(f"{b}_n").alias("pixels"),
                F.col(f"{b}_clipped").alias("clipped_pixels"),
            )
            for b in BANDS
        ]
    )
    return (
        pixels.groupBy(*keys)
        .agg(*aggregates)
        .select(*keys, F.inline(per_band))
        .where("pixels > 0")
        .withColumn("reduction_percent", (1 - F.col("clipped_pixels") / F.col("pixels")) * 100.0)
    )


def aoi_cells(aoi: DataFrame, cell: float = CELL_DEGREES) -> DataFrame:
    """One row per area and grid cell they share.

    An area is all rows of ``aoi`` with the same columns beside ``feature_id``;
    a row has a ``ring``, or ``rings`` of which inner ones are holes.  ``_core``
    marks cells that lie inside a polygon; the others carry, per polygon, the
    sides that touch the cell's row of cells.  These decide alone, as a ray to
    the east crosses no others.  Polygons are cut into sides, sides are dealt
    to rows of cells, and each row is filled apart, so a large polygon is
    shared by tasks.  Rows and cells are widened a little, so a pixel that
    rounding puts beside its cell is still decided by the sides.
    """
    pad = cell * 1e-6
    given = [c for c in aoi.columns if c not in ("ring", "rings", "feature_id")]
    rings = F.col("rings") if "rings" in aoi.columns else F.array("ring")

    def span(low, high):
        return F.sequence(F.floor((low - pad) / cell), F.floor((high + pad) / cell))

    sides = aoi.withColumn("_polygon", F.monotonically_increasing_id()).select(
        F.struct(*given).alias("_area"), "_polygon", F.explode(F.flatten(F.transform(rings, G.ring_sides))).alias("_side")
    )
    rows = (
        sides.withColumn("_cy", F.explode(span(F.col("_side.low"), F.col("_side.high"))))
        .groupBy("_area", "_polygon", "_cy")
        .agg(
            F.collect_list("_side").alias("_sides"),
            F.min("_side.left").alias("_left"),
            F.max("_side.right").alias("_right"),
        )
    )
    bottom, top = F.col("_cy") * cell - pad, (F.col("_cy") + 1) * cell + pad
    west, east = F.col("_cx") * cell - pad, (F.col("_cx") + 1) * cell + pad

    def touches(s):
        low, high = F.greatest(s["low"], bottom), F.least(s["high"], top)
        # a side that is nearly level is taken whole, as its slope is not exact
        level = s["high"] - s["low"] < cell * 1e-3
        at = [
            F.when(level, x).otherwise(F.least(F.greatest(s["slope"] * y + s["start"], s["left"]), s["right"]))
            for x, y in ((s["left"], low), (s["right"], high))
        ]
        return (F.least(*at) - pad <= east) & (F.greatest(*at) + pad >= west)

    cells = rows.withColumn("_cx", F.explode(span(F.col("_left"), F.col("_right")))).withColumn(
        "_border", F.exists("_sides", touches)
    )
    centre = G.in_sides((F.col("_cx") + 0.5) * cell, (F.col("_cy") + 0.5) * cell, F.col("_sides"))
    return (
        cells.where(F.col("_border") | centre)
        .groupBy("_area", "_cx", "_cy")
        .agg(
            F.bool_or(~F.col("_border")).alias("_core"),
            F.collect_list(F.when(F.col("_border"), F.col("_sides"))).alias("_sides"),
        )
        .select("_area.*", "_cx", "_cy", "_core", F.when(~F.col("_core"), F.col("_sides")).alias("_sides"))
    )


def assign_aoi(
    pixels: DataFrame,
    aoi: DataFrame,
    keys: Sequence[str] = (),
    cell: float = CELL_DEGREES,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Spatial join: every pixel with every area it lies in or on, once per area.

    Equi-join on the grid cell (and ``keys``, such as the scene chosen for the
    area); only pixels in cells on a polygon's border need the exact test.
    The areas' cells are written once, as they are counted and then joined.
    They are broadcast while their rows and bytes are within the bounds; beyond
    them the join is shuffled, and Spark splits cells that hold many pixels.
    """
    cells = materialise(aoi_cells(aoi, cell), "aoi-cells")
    lon, lat = F.col("lon"), F.col("lat")
    placed = pixels.withColumns(
        {"_cx": F.floor(lon / cell), "_cy": F.floor(lat / cell)}
    )
    inside = F.exists("_sides", lambda sides: G.in_sides(lon, lat, sides))
    small = F.broadcast(cells) if fits(cells, max_rows) else cells
    # No cell is missing, so the null-safe test finds the same; a plain one would have Spark filter the scan by
    # "is not null" of the whole expressions behind lon and lat, which a filter computes anew for each use.
    named = small.withColumnsRenamed({k: f"_of_{k}" for k in (*keys, "_cx", "_cy")})
    same = [F.col(k) == F.col(f"_of_{k}") for k in keys] + [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in ("_cx", "_cy")]
    joined = placed.join(named, reduce(lambda a, b: a & b, same)).where(F.col("_core") | inside)
    return joined.drop("_cx", "_cy", "_core", "_sides", *[f"_of_{k}" for k in (*keys, "_cx", "_cy")])


def wide_tiles(tiles: DataFrame) -> DataFrame:
    """One row per tile with an array column per band.

    This shuffles the arrays once on (scene, tile); a table stored in the wide
    form does not need it.  A band that a tile has twice is an error, as
    either copy could be meant.
    """
    place = ["scene_id", "scene_date", "tile_id", "width", "height", "x0", "y0", "dx", "dy"]

    def band(b: str):
        one = F.col("band") == b
        twice = F.concat(F.lit(f"band {b} occurs twice in a tile of scene "), F.col("scene_id").cast("string"))
        kept = F.first(F.when(one, F.col("dn")), ignorenulls=True)
        return F.when(F.count_if(one) > 1, F.raise_error(twice).cast("array<int>")).otherwise(kept).alias(f"{b}_dn")

    return tiles.groupBy(*place).agg(*[band(b) for b in BANDS])


def tile_pixels(wide: DataFrame) -> DataFrame:
    """Pixel rows of wide tiles, with the coordinates of the pixel centres.

    A band that the tile lacks is missing in its pixels.
    """
    names = [f"{b}_dn" for b in BANDS]
    empty = F.array().cast("array<int>")
    cells = F.arrays_zip(*[F.coalesce(F.col(n), empty).alias(n) for n in names])
    row = F.floor(F.col("_pos") / F.col("width")).cast("int")
    col = (F.col("_pos") % F.col("width")).cast("int")
    return (
        wide.withColumn("_cells", cells)
        .select(
            "scene_id", "scene_date", "tile_id", "width", "x0", "y0", "dx", "dy",
            F.posexplode("_cells").alias("_pos", "_cell"),
        )
        .select(
            "scene_id", "scene_date", "tile_id",
            row.alias("row"),
            col.alias("col"),
            (F.col("x0") + (col + 0.5) * F.col("dx")).alias("lon"),
            (F.col("y0") + (row + 0.5) * F.col("dy")).alias("lat"),
            *[F.col(f"_cell.{n}").alias(n) for n in names],
        )
    )


def scene_stats(pixels: DataFrame, keys: Sequence[str] = SCENE_KEYS) -> DataFrame:
    """Statistics of the three indices per scene, vegetation pixels, health and coverage.

    One hash aggregate: map tasks send one row per scene they saw, however
    many pixels the scene has.
    """
    ndvi = F.col("ndvi")
    aggregates = []
    for name in INDEX_NAMES:
        value, p = F.col(name.lower()), name.lower()
        aggregates += [
            F.avg(value).alias(f"{p}_mean"),
            F.stddev_pop(value).alias(f"{p}_std"),
            F.min(value).alias(f"{p}_min"),
            F.max(value).alias(f"{p}_max"),
            F.count(value).alias(f"{p}_count"),
        ]
    aggregates.append(F.count_if(ndvi > VEGETATION_NDVI).alias("vegetation_pixels"))
    stats = with_indices(pixels).groupBy(*keys).agg(*aggregates)
    return stats.withColumns(
        {
            "vegetation_health": L.scene_health(F.col("ndvi_mean")),
            "vegetation_coverage": L.coverage_percent(
                F.col("vegetation_pixels"), F.col("ndvi_count")
            ),
        }
    )


def _index_struct(name: str):
    p = name.lower()
    vegetation = F.col("vegetation_pixels") if name == "NDVI" else F.lit(None)
    return F.struct(
        F.col(f"{p}_mean").alias("mean"),
        F.col(f"{p}_std").alias("std"),
        F.col(f"{p}_min").alias("min"),
        F.col(f"{p}_max").alias("max"),
        F.col(f"{p}_count").alias("count"),
        vegetation.cast("bigint").alias("vegetation_pixels"),
    )


def statistics_map(stats: DataFrame) -> DataFrame:
    """Add ``statistics``: index name to its struct; an index without valid pixel is absent."""
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("key"), _index_struct(n).alias("value"))
            for n in INDEX_NAMES
        ]
    )
    present = F.filter(entries, lambda e: e["value"]["count"] > 0)
    return stats.withColumn("statistics", F.map_from_entries(present))


def scene_stats_long(stats: DataFrame, keys: Sequence[str] = SCENE_KEYS) -> DataFrame:
    """One row per scene and index that has a valid pixel."""
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("index_name"), _index_struct(n).alias("s"))
            for n in INDEX_NAMES
        ]
    )
    return (
        stats.select(*keys, F.inline(entries)).select(*keys, "index_name", "s.*").where("count > 0")
    )
