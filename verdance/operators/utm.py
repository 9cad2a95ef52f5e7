"""Clipping rasters whose grid is in metres: areas are brought into the raster's system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.operators.pixels import assign_aoi
from verdance.plans.joins import MAX_BROADCAST_ROWS

#: A projected side is at most this far, in metres, from the straight line that stands for it.
MAX_ERROR = 0.05
CELL_METRES = 1000.0
EARTH_RADIUS = 6.37e6
#: Latitudes beyond this have no zones.
MAX_LATITUDE = 84.0


def _parts_of_side(x1: Column, y1: Column, x2: Column, y2: Column, max_error: float) -> Column:
    """In how many equal parts a side is cut.

    A straight line in degrees of length ``s`` bends in the plane by at most
    ``s^2 (1 + tan(lat)) / (8 R)``, a quarter of that if it is halved.
    """
    lat = F.radians(F.least(F.greatest(F.abs(y1), F.abs(y2)), F.lit(MAX_LATITUDE)))
    metres = F.radians(F.sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)) * EARTH_RADIUS
    bend = metres * metres * (1 + F.tan(lat)) / (8 * EARTH_RADIUS)
    return F.greatest(F.lit(1), F.ceil(F.sqrt(bend / max_error)).cast("int"))


def densified(ring: Column, max_error: float = MAX_ERROR) -> Column:
    """A closed ring with points put into long sides."""

    def points(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        parts = _parts_of_side(a["lon"], a["lat"], b["lon"], b["lat"], max_error)
        return F.transform(
            F.sequence(F.lit(0), parts - 1),
            lambda k: F.struct(
                (a["lon"] + (b["lon"] - a["lon"]) * k / parts).alias("lon"),
                (a["lat"] + (b["lat"] - a["lat"]) * k / parts).alias("lat"),
            ),
        )

    inner = F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), points))
    return F.concat(inner, F.array(F.get(ring, F.size(ring) - 1)))


def projected_areas(areas: DataFrame, max_error: float = MAX_ERROR) -> DataFrame:
    """Areas in metres, a row per zone and half that an area touches, whole in each.

    Has the areas' columns, ``zone``, ``south`` and ``rings``, whose points are
    named ``lon`` and ``lat`` but hold easting and northing.
    """
    rings = F.col("rings") if "rings" in areas.columns else F.array("ring")
    box = G.ring_box(F.flatten(rings))
    zones = F.sequence(G.utm_zone(box["min_lon"]), G.utm_zone(box["max_lon"]))
    halves = F.array_distinct(F.array(box["min_lat"] < 0, box["max_lat"] < 0))
    given = [c for c in areas.columns if c not in ("ring", "rings", "feature_id")]
    placed = areas.select(*given, rings.alias("_rings"), F.explode(zones).alias("zone"), halves.alias("_halves")).select(
        *given, "_rings", "zone", F.explode("_halves").alias("south")
    )

    def point(p: Column) -> Column:
        u = G.to_utm(p["lon"], p["lat"], F.col("zone"), F.col("south"))
        return F.struct(u["easting"].alias("lon"), u["northing"].alias("lat"))

    metres = F.transform("_rings", lambda r: F.transform(densified(r, max_error), point))
    return placed.select(*given, "zone", "south", metres.alias("rings"))


def clip_utm(
    pixels: DataFrame,
    areas: DataFrame,
    cell: float = CELL_METRES,
    max_error: float = MAX_ERROR,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Every pixel with every area it lies in; pixels have ``zone``, ``south``, ``easting`` and ``northing``.

    Areas and pixels meet by zone, half and cell of the grid in metres, so an
    area over the border of two zones takes pixels of both.
    """
    named = pixels.withColumnsRenamed({"easting": "lon", "northing": "lat"})
    found = assign_aoi(named, projected_areas(areas, max_error), ("zone", "south"), cell, max_rows)
    return found.withColumnsRenamed({"lon": "easting", "lat": "northing"})
