"""Entry points that combine the operators: scene, batch, analytics and climate jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.functions.dates import CLIMATE_DAYS, look_back
from verdance.operators import anomalies, climate, correlation, pixels, scenes, series, veglog
from verdance.operators.periods import NO_SCENE
from verdance.session import materialise

# fixed values: default search interval
START_DATE, END_DATE = "2024-07-01", "2024-07-31"


class NoSuitableScene(LookupError):
    pass


def choose_scenes(
    catalog: DataFrame,
    aoi: DataFrame,
    start_date: dt.date | str = START_DATE,
    end_date: dt.date | str = END_DATE,
    scene_id: str | None = None,
) -> DataFrame:
    """Per area the scene to process, with the area's polygon.

    Scenes are filtered first, then matched by footprint, then ranked.
    """
    if scene_id is None:
        candidates = scenes.search_scenes(catalog, start_date, end_date)
    else:
        candidates = scenes.scene_by_id(catalog, scene_id)
    over = scenes.scenes_over_aoi(candidates, aoi)
    best = scenes.best_scenes(over, ["aoi_id"]).select(
        "aoi_id", "scene_id", F.to_date("datetime").alias("scene_date")
    )
    return best.join(aoi.select("aoi_id", *[c for c in ("ring", "rings") if c in aoi.columns]), "aoi_id")


def process_scenes(
    catalog: DataFrame,
    pixel_table: DataFrame,
    aoi: DataFrame,
    start_date: dt.date | str = START_DATE,
    end_date: dt.date | str = END_DATE,
    scene_id: str | None = None,
) -> DataFrame:
    """Scene statistics of every area that has a suitable scene.

    The chosen scenes and polygons meet the pixel table by scene and grid
    cell; a pixel table partitioned by ``scene_date`` is read only for the
    chosen dates.
    """
    chosen = materialise(
        choose_scenes(catalog, aoi, start_date, end_date, scene_id), "chosen-scenes"
    )
    if chosen.isEmpty():
        raise NoSuitableScene(NO_SCENE)
    bare = pixel_table.drop("aoi_id")
    inside = pixels.assign_aoi(bare, chosen, keys=["scene_id", "scene_date"])
    return pixels.scene_stats(inside)


def analyze_log(log: DataFrame) -> dict[str, DataFrame]:
    """Trend report and analytics of one log, which is read once and stored."""
    log = materialise(log, "log")
    return {
        "trends": series.vegetation_trends(log),
        "analytics": anomalies.advanced_analytics(log),
    }


def integrate_climate(observed: DataFrame, as_of: dt.date | str, days: int = CLIMATE_DAYS):
    """Indices and summary of the look-back window that ends on ``as_of``."""
    start, end = look_back(as_of, days)
    window = observed.where(F.col("date").between(F.lit(start), F.lit(end)))
    indices = climate.climate_indices(window)
    return indices, climate.climate_summary(indices)


def climate_correlation(log: DataFrame, daily: DataFrame, bounded: bool | None = None) -> DataFrame:
    """One row per area: overlap, correlations and stress impact."""
    return correlation.climate_insights(correlation.climate_join(log, daily, bounded))


def update_log(log: DataFrame, stats: DataFrame) -> DataFrame:
    """The whole log after scene results, which follow each area's last entry by date and id."""
    last = log.groupBy("aoi_id").agg(F.max("seq").alias("_last"))
    order = W.partitionBy("aoi_id").orderBy("scene_date", "scene_id")
    placed = stats.withColumn("_place", F.row_number().over(order)).join(last, "aoi_id", "left")
    seq = F.coalesce(F.col("_last"), F.lit(-1)) + F.col("_place")
    return veglog.append(log, veglog.log_entries(placed, seq))
