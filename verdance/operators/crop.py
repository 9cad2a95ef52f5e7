"""Crop windows: only pixels inside an area ever leave a raster.

The inverse geotransform turns a polygon into column runs of a raster's rows,
its scan lines.  They depend on the raster's grid alone, which all scenes of a
tile share, so they are found once per grid without reading a band.  The bands'
arrays are then sliced to the runs, and a tile that no area meets is dropped
before any pixel is made of it.

Pixels of many scenes in many areas can be made where a later grouping by area
and scene needs no shuffle: ``PLACE`` then names the columns they are dealt by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import geometry as G
from verdance.functions.indices import BANDS
from verdance.plans.joins import MAX_BROADCAST_ROWS, fits, lookup_join
from verdance.session import materialise

LATTICE = ["width", "height", "x0", "y0", "dx", "dy"]
GRID = ["tile_id", *LATTICE]
WINDOW_CELL = 1.0
#: Columns this near to a side, in pixels, are decided by the exact test.
NEAR = 0.02
#: A side lower than this share of a pixel is too level for its line to be exact.
LEVEL = 1e-3
#: Polygons of more sides have them dealt to the raster rows they touch.
FEW_SIDES = 64
#: What pixels are dealt by: the set of lattices of their scene, a share of its scenes, a block of areas.
PLACE = ["_set", "_share", "_block"]
SCENE = ["scene_id", "scene_date"]
BLOCK_AREAS = 4096
#: Areas times scenes that a task is to group.
TASK_GROUPS = 1 << 18
#: Bytes of a group while it is shuffled, and of all that may be shuffled in any case.
GROUP_BYTES, FREE_BYTES = 64, 64 << 20


def area_sides(areas: DataFrame) -> DataFrame:
    """``area, polygon, box, sides``: a row per polygon; ``area`` holds the columns beside rings and features."""
    given = [c for c in areas.columns if c not in ("ring", "rings", "feature_id")]
    rings = F.col("rings") if "rings" in areas.columns else F.array("ring")
    sides = F.flatten(F.transform(rings, G.ring_sides))
    return areas.select(
        F.struct(*given).alias("area"), F.xxhash64(rings).alias("polygon"), G.ring_box(F.flatten(rings)).alias("box"), sides.alias("sides")
    )


def _cells(box: Column, cell: float) -> tuple[Column, Column]:
    def span(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(box[low] / cell), F.floor(box[high] / cell)))

    return span("min_lon", "max_lon"), span("min_lat", "max_lat")


def grids_and_polygons(grids: DataFrame, polygons: DataFrame, cell: float = WINDOW_CELL) -> DataFrame:
    """Every grid with every polygon whose box it overlaps: equal cells, kept in their boxes' common corner."""
    x, y = F.col("x0") + F.col("width") * F.col("dx"), F.col("y0") + F.col("height") * F.col("dy")
    frame = F.struct(
        F.least("x0", x).alias("min_lon"), F.least("y0", y).alias("min_lat"),
        F.greatest("x0", x).alias("max_lon"), F.greatest("y0", y).alias("max_lat"),
    )

    def placed(df: DataFrame, box: str) -> DataFrame:
        cx, cy = _cells(F.col(box), cell)
        return df.withColumn("_cx", cx).withColumn("_cy", cy)

    left, right = placed(grids.withColumn("frame", frame), "frame"), placed(polygons, "box")
    corner = [
        F.floor(F.greatest(F.col(f"frame.{low}"), F.col(f"box.{low}")) / cell) for low in ("min_lon", "min_lat")
    ]
    met = G.boxes_overlap(F.col("frame"), F.col("box")) & (F.col("_cx") == corner[0]) & (F.col("_cy") == corner[1])
    return left.join(right, ["_cx", "_cy"]).where(met).drop("_cx", "_cy", "frame")


def _line_runs(lat: Column, sides: Column) -> Column:
    """Column runs of a scan line at ``lat``, of the sides that touch it; inner ones first, then single columns."""

    def column_at(lon: Column) -> Column:
        return (lon - F.col("x0")) / F.col("dx") - 0.5

    def span(a: Column, b: Column, margin: float) -> tuple[Column, Column]:
        first, last = F.ceil(F.least(a, b) + margin), F.floor(F.greatest(a, b) - margin)
        return F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.col("width") - 1).cast("int")

    def run(first: Column, last: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"))

    def at(s: Column) -> Column:
        return s["slope"] * lat + s["start"]

    exact = F.abs(F.col("dy")) * LEVEL
    uncertain = F.exists(sides, lambda s: (s["high"] > s["low"]) & (s["high"] - s["low"] < exact))
    crossed = F.filter(sides, lambda s: (lat >= s["low"]) & (lat < s["high"]))
    order = F.array_sort(F.transform(crossed, lambda s: column_at(at(s))))
    spans = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(order)), lambda i: (i % 2 == 0) & (i + 1 < F.size(order))),
        lambda i: run(*span(F.get(order, i), F.get(order, i + 1), NEAR / 2)),
    )
    # Where a line is not exact, every column is decided by the test.
    inner = F.when(uncertain, F.filter(spans, lambda r: F.lit(False))).otherwise(F.filter(spans, lambda r: r["first"] <= r["last"]))

    def near(s: Column) -> Column:
        whole = s["low"] == s["high"]
        a = column_at(F.when(whole, s["left"]).otherwise(at(s)))
        b = column_at(F.when(whole, s["right"]).otherwise(at(s)))
        first, last = span(a, b, -NEAR)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    everywhere = F.sequence(F.lit(0), F.col("width") - 1)
    beside = F.when(uncertain, everywhere).otherwise(F.array_distinct(F.flatten(F.transform(sides, near))))

    def decided(c: Column) -> Column:
        taken = F.exists(inner, lambda r: (c >= r["first"]) & (c <= r["last"]))
        return ~taken & G.in_sides(F.col("x0") + (c + 0.5) * F.col("dx"), lat, sides)

    return F.concat(inner, F.transform(F.filter(beside, decided), lambda c: run(c, c)))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed where it stands, however often it is read; a filter would compute it anew."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


def _lattice_windows(tiles: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """Scan lines of each lattice of pixels; tiles with other ids but the same lattice share them."""
    # Few bytes can be many lines: they are shared by as many tasks as a shuffle has.
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    polygons = area_sides(areas)
    # A text of its numbers stands for a lattice: rows dealt by floating numbers are dealt again to be grouped by them.
    grids = tiles.select(*LATTICE).distinct().withColumn("_grid", F.concat_ws(" ", *LATTICE))
    pairs = grids_and_polygons(grids, polygons.repartition(tasks), cell)
    place = ["_grid", *LATTICE, "area", "polygon"]

    def ends(s: Column) -> tuple[Column, Column]:
        rows = [(lat - F.col("y0")) / F.col("dy") - 0.5 for lat in (s["low"], s["high"])]
        first = F.greatest(F.ceil(F.least(*rows) - NEAR), F.lit(0)).cast("int")
        return first, F.least(F.floor(F.greatest(*rows) + NEAR), F.col("height") - 1).cast("int")

    def rows(first: Column, last: Column) -> Column:
        return F.explode(F.when(first <= last, F.sequence(first, last))).alias("row")

    def touches(s: Column) -> Column:
        first, last = ends(s)
        return (first <= F.col("row")) & (F.col("row") <= last)

    few, many = F.size("sides") <= FEW_SIDES, F.size("sides") > FEW_SIDES
    first = F.array_min(F.transform("sides", lambda s: ends(s)[0]))
    last = F.array_max(F.transform("sides", lambda s: ends(s)[1]))
    kept = _once(pairs.where(few).select(*place, "sides", rows(first, last)), "sides", F.filter("sides", touches))
    dealt = (
        pairs.where(many).select(*place, F.explode("sides").alias("side"))
        .select(*place, "side", rows(*ends(F.col("side"))))
        .groupBy(*place, "row")
        .agg(F.collect_list("side").alias("sides"))
    )
    touched = kept if polygons.where(many).isEmpty() else kept.unionByName(dealt)
    lat = F.col("y0") + (F.col("row") + 0.5) * F.col("dy")
    lines = _once(touched, "runs", _line_runs(lat, F.col("sides"))).where(F.size("runs") > 0)
    # Parts of an area may overlap: their columns are counted once.
    columns = F.flatten(F.transform(F.flatten("parts"), lambda r: F.sequence(r["first"], r["last"])))
    once = F.transform(F.array_distinct(columns), lambda c: F.struct(c.alias("first"), c.alias("last")))
    window, lattice = ["_grid", "area"], [F.first(c).alias(c) for c in LATTICE]
    together = lines.select(*window, *LATTICE, "row", "runs").repartition(*window)
    by_row = together.groupBy(*window, "row").agg(*lattice, F.collect_list("runs").alias("parts"))
    merged = by_row.withColumn("runs", F.when(F.size("parts") == 1, F.col("parts")[0]).otherwise(once))
    found = merged.groupBy(*window).agg(*lattice, F.collect_list(F.struct("row", "runs")).alias("lines"))
    return found.select(*LATTICE, "area", "lines")


def crop_windows(tiles: DataFrame, areas: DataFrame, cell: float = WINDOW_CELL) -> DataFrame:
    """Scan lines: the grid's columns, ``area``, and ``lines``, an array of ``(row, runs)``.

    ``runs`` are closed ranges of columns whose centres lie in or on the area,
    each column once.  The sides of a large polygon are dealt to the raster
    rows they touch, and each row is decided apart, so it is shared by tasks.
    """
    windows = _lattice_windows(tiles, areas, cell)
    return tiles.select(*GRID).distinct().where("tile_id IS NOT NULL").join(windows, LATTICE).select(*GRID, "area", "lines")


def _met_by_lattice(tiles: DataFrame, windows: DataFrame, max_rows: int) -> DataFrame:
    small = F.broadcast(windows) if fits(windows, max_rows) else windows
    return tiles.join(small, LATTICE).withColumns({c: F.lit(None).cast("bigint") for c in PLACE})


def _met_in_place(tiles: DataFrame, windows: DataFrame, max_rows: int) -> DataFrame:
    """Tiles with their windows, all of an area and scene in one task.

    Scenes with the same set of lattices meet the same windows.  Their shares
    are dealt with blocks of areas, tiles going to each block and windows to
    each share, unless that moves more than the groups of areas and scenes
    themselves, or these are few.
    """
    spark = tiles.sparkSession
    of_windows = windows.groupBy(*LATTICE).agg(
        F.count("*").alias("_windows"), F.sum(64 + 48 * F.size("lines")).alias("_bytes")
    )
    of_windows = materialise(of_windows.withColumn("_lattice", F.monotonically_increasing_id()), "lattices")
    lattices = of_windows.select(*LATTICE, "_lattice")
    lattices = F.broadcast(lattices) if fits(lattices, max_rows) else lattices
    pixels = F.sum(F.col("width").cast("bigint") * F.col("height") * 4 * len(BANDS)).alias("_pixels")
    of_tiles = tiles.groupBy(*LATTICE).agg(F.count("*").alias("_tiles"))
    groups = of_tiles.join(of_windows, LATTICE).agg(F.sum(F.col("_tiles") * F.col("_windows"))).first()[0] or 0
    if groups * GROUP_BYTES <= FREE_BYTES:
        return _met_by_lattice(tiles, windows, max_rows)
    numbered = tiles.join(lattices, LATTICE)
    scenes = materialise(
        numbered.groupBy(*SCENE).agg(F.sort_array(F.collect_set("_lattice")).alias("_lattices"), pixels), "scene-lattices"
    )
    sets = scenes.groupBy("_lattices").agg(F.count("*").alias("_scenes"), F.sum("_pixels").alias("_pixels"))
    sets = materialise(sets.withColumn("_set", F.monotonically_increasing_id()), "lattice-sets")
    members = sets.select("_set", F.explode("_lattices").alias("_lattice"))
    total = members.join(of_windows, "_lattice").groupBy("_set").agg(F.sum("_windows").alias("_windows"), F.sum("_bytes").alias("_bytes"))
    blocks = F.ceil(F.col("_windows") / BLOCK_AREAS)
    shares = F.ceil(F.col("_scenes") * F.ceil(F.col("_windows") / F.col("_blocks")) / TASK_GROUPS)
    dealt = sets.join(total, "_set").withColumn("_blocks", blocks).withColumn("_shares", shares)
    dealt = materialise(dealt, "lattice-sets-dealt")
    moved = dealt.agg(F.sum(F.col("_pixels") * F.col("_blocks") + F.col("_bytes") * F.col("_shares"))).first()[0]
    if groups * GROUP_BYTES <= moved:
        return _met_by_lattice(tiles, windows, max_rows)
    share = F.pmod(F.xxhash64(*SCENE), F.col("_shares")).alias("_share")
    every = scenes.select(*SCENE, "_lattices").join(dealt, "_lattices").select(*SCENE, "_set", share, "_blocks")
    every = lookup_join(numbered, materialise(every, "scene-sets"), SCENE, max_rows=max_rows)
    left = every.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)))
    # A number as a difference is no key of the join, which is dealt by what the groups are dealt by.
    of_set = members.join(dealt.select("_set", "_blocks", "_shares"), "_set")
    right = windows.join(lattices, LATTICE).join(of_set, "_lattice").select(
        F.col("_lattice").alias("_of"), "area", "lines", "_set",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shares") - 1)).alias("_share"),
        F.pmod(F.xxhash64("area"), F.col("_blocks")).alias("_block"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * groups // TASK_GROUPS))
    met = left.repartition(parts, *PLACE).join(right.repartition(parts, *PLACE).hint("merge"), PLACE)
    return met.where(F.col("_lattice") - F.col("_of") == 0)


def cropped_pixels(
    wide: DataFrame,
    areas: DataFrame,
    cell: float = WINDOW_CELL,
    max_rows: int = MAX_BROADCAST_ROWS,
    in_place: bool = False,
) -> DataFrame:
    """Pixels of wide tiles inside areas, with the areas' columns; the others are never made.

    The windows are written once, as they are counted and then joined: within
    the bounds for a broadcast the rasters do not move, beyond them they are
    shuffled by lattice.  A band that a tile lacks is missing in its pixels.

    ``in_place`` adds the columns ``PLACE``, which an area and scene have one
    value of.  Pixels are dealt by them if their groups are many, so a grouping
    by area, scene and ``PLACE`` is the one by area and scene, unshuffled.
    """
    windows = materialise(_lattice_windows(wide, areas, cell), "crop-windows")
    met = (_met_in_place if in_place else _met_by_lattice)(wide.where("tile_id IS NOT NULL"), windows, max_rows)
    names = [f"{b}_dn" for b in BANDS]
    empty = F.array().cast("array<int>")
    start = F.col("line.row") * F.col("width") + F.col("run.first") + 1
    many = F.col("run.last") - F.col("run.first") + 1
    pieces = F.arrays_zip(*[F.slice(F.coalesce(F.col(n), empty), start, many).alias(n) for n in names])
    place = ["scene_id", "scene_date", "tile_id", "x0", "y0", "dx", "dy", "area", *PLACE]
    col = F.col("run.first") + F.col("_pos")
    return (
        met.withColumn("line", F.explode("lines"))
        .withColumn("run", F.explode("line.runs"))
        .select(*place, "line", "run", F.posexplode(pieces).alias("_pos", "_cell"))
        .select(
            "area.*", "scene_id", "scene_date", "tile_id", F.col("line.row").alias("row"), col.alias("col"),
            (F.col("x0") + (col + 0.5) * F.col("dx")).alias("lon"),
            (F.col("y0") + (F.col("line.row") + 0.5) * F.col("dy")).alias("lat"),
            *[F.col(f"_cell.{n}").alias(n) for n in names],
            *(PLACE if in_place else []),
        )
    )
