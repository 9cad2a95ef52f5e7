"""Period tiling and the multi-temporal batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.functions.dates import as_date, in_days
from verdance.operators.scenes import COLLECTION, MAX_CLOUD, best_scenes, search_scenes

# fixed values
STRIDE_DAYS = 31
WINDOW_DAYS = 30
MONTH_DAYS = 30
BATCH_MONTHS = 6
BATCH_SCENES = 8  # the usual limit, if one is asked for
NO_SCENE = "No suitable scenes found"
SEASONS = (
    ("Recent Scene", "2024-07-01", "2024-07-31"),
    ("Winter Scene", "2024-01-01", "2024-01-31"),
    ("Spring Scene", "2024-04-01", "2024-04-30"),
)


def _sampling(periods: Column, max_periods: int | None) -> tuple[Column, Column]:
    """Step between the kept periods, and how many may be kept."""
    if max_periods is None:
        return F.lit(1), periods
    step = F.greatest(F.lit(1), F.floor(periods / F.lit(max_periods)).cast("int"))
    return step, F.lit(max_periods)


def tile_periods(
    ranges: DataFrame,
    start: str = "start_date",
    end: str = "end_date",
    max_periods: int | None = None,
) -> DataFrame:
    """Windows of 30 days at a stride of 31, both ends inclusive, per row.

    With more windows than ``max_periods`` every k-th is kept (k = windows div
    maximum), then the first ``max_periods`` of them.  The windows come from
    the row itself, so no join is needed.
    """
    keys = [c for c in ranges.columns if c not in (start, end)]
    starts = F.when(
        F.col(start) < F.col(end),
        F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr(f"interval {STRIDE_DAYS} days")),
    )
    tiles = ranges.select(
        *keys,
        F.col(end).alias("_last"),
        F.size(starts).alias("periods_total"),
        F.posexplode(starts).alias("period_idx", "_start"),
    )
    step, most = _sampling(F.col("periods_total"), max_periods)
    idx = F.col("period_idx")
    kept = tiles.where((idx % step == 0) & (F.floor(idx / step) < most))
    last = F.least(F.date_add("_start", WINDOW_DAYS), F.col("_last"))
    return kept.select(
        *keys,
        "period_idx",
        "periods_total",
        (F.floor(idx / step) + 1).cast("int").alias("period_no"),
        F.col("_start").alias("start_date"),
        last.alias("end_date"),
    ).withColumn("period", L.period_label(F.col("start_date"), F.col("end_date")))


def in_period(date: Column, start: dt.date, end: dt.date, max_periods: int | None = None) -> Column:
    """Index of the tiled period that a date falls in, NULL if in none.

    Bucket arithmetic in place of a range join.  The last day is uncovered if
    a period would start on it, and periods dropped by sampling are uncovered.
    """
    days = (end - start).days
    periods = max(0, -(-days // STRIDE_DAYS))
    offset = F.datediff(date, F.lit(start))
    idx = F.floor(offset / STRIDE_DAYS).cast("int")
    covered = (offset >= 0) & (date <= F.lit(end)) & (idx * STRIDE_DAYS < days)
    if max_periods is not None and periods > max_periods:
        step = periods // max_periods
        covered = covered & (idx % step == 0) & (idx < step * max_periods)
    return F.when(covered, idx)


def best_scene_per_period(
    scenes: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    max_periods: int | None = None,
    collections: Sequence[str] = (COLLECTION,),
    max_cloud: float = MAX_CLOUD,
) -> DataFrame:
    """The least cloudy scene of each area in each period that has one."""
    start, end = as_date(start), as_date(end)
    found = search_scenes(scenes, start, end, collections, max_cloud).withColumn(
        "period_idx", in_period(F.to_date("datetime"), start, end, max_periods)
    )
    return best_scenes(found.where(F.col("period_idx").isNotNull()), ["aoi_id", "period_idx"])


def multi_temporal_batch(
    scenes: DataFrame,
    aoi: DataFrame,
    as_of: dt.date | str,
    date_range_months: int = BATCH_MONTHS,
    max_scenes: int | None = None,
) -> DataFrame:
    """One row per area and period with the chosen scene, or the reason of failure.

    All periods count unless ``max_scenes`` asks for fewer; ``periods_total``
    says how many there were.  All periods of all areas are one job.  The periods are generated on the
    area rows; scenes meet them by an equality join on (area, period).
    """
    end = as_date(as_of)
    start = end - dt.timedelta(days=date_range_months * MONTH_DAYS)
    ranges = aoi.select("aoi_id").distinct().select(
        "aoi_id", F.lit(start).alias("start_date"), F.lit(end).alias("end_date")
    )
    periods = tile_periods(ranges, max_periods=max_scenes)
    best = best_scene_per_period(scenes, start, end, max_scenes).select(
        "aoi_id", "period_idx", "scene_id", "datetime", "cloud_cover"
    )
    matched = F.col("scene_id").isNotNull()
    return (
        periods.join(best, ["aoi_id", "period_idx"], "left")
        .withColumns(
            {
                "batch_id": L.batch_label(F.col("period_no")),
                "status": F.when(matched, "success").otherwise("failed"),
                "error": F.when(~matched, NO_SCENE),
            }
        )
        .drop("period_idx")
    )


def batch_summary(batch: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    return batch.groupBy(*keys).agg(
        F.count("*").alias("total_periods"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def best_scene_per_season(
    scenes: DataFrame, seasons: Sequence[tuple[str, str, str]] = SEASONS
) -> DataFrame:
    """The least cloudy scene of each area in a few named date ranges.

    The ranges may overlap; they are an array constant that a scene is matched
    to in place.
    """
    date = F.to_date("datetime")
    ranges = F.array(
        *[
            F.struct(
                F.lit(name).alias("season"),
                F.lit(as_date(a)).alias("start_date"),
                F.lit(as_date(b)).alias("end_date"),
            )
            for name, a, b in seasons
        ]
    )
    first, last = min(s[1] for s in seasons), max(s[2] for s in seasons)
    found = search_scenes(scenes, first, last).withColumn(
        "_season",
        F.explode(F.filter(ranges, lambda s: date.between(s["start_date"], s["end_date"]))),
    )
    return best_scenes(found.select("*", "_season.*").drop("_season"), ["aoi_id", "season"])


def last_days(scenes: DataFrame, as_of: dt.date | str, days: int) -> DataFrame:
    """Scenes of the look-back window that ends on ``as_of``."""
    end = as_date(as_of)
    return scenes.where(in_days(F.col("datetime"), end - dt.timedelta(days=days), end))
