"""The vegetation log: entries, appends and the rolling window by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.plans.ordering import first_rows

ROLLING_ENTRIES = 20
COLUMNS = ("aoi_id", "scene_id", "date", "ndvi_mean", "vegetation_health", "seq")


def log_entries(stats: DataFrame, seq: Column | str = "seq") -> DataFrame:
    """Log rows of scene statistics; a scene without a valid pixel enters with 0."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    return stats.select(
        "aoi_id",
        "scene_id",
        F.col("scene_date").alias("date"),
        F.coalesce(F.col("ndvi_mean"), F.lit(0.0)).alias("ndvi_mean"),
        "vegetation_health",
        seq.cast("bigint").alias("seq"),
    )


def append(log: DataFrame, entries: DataFrame, dedupe: bool = False) -> DataFrame:
    """Bag append; a re-processed scene appears twice unless ``dedupe`` is set,
    which keeps its latest entry."""
    both = log.unionByName(entries)
    if not dedupe:
        return both
    return first_rows(both, ["aoi_id", "scene_id"], [F.col("seq").desc()], 1)


def rolling_last(log: DataFrame, k: int = ROLLING_ENTRIES) -> DataFrame:
    """The last ``k`` entries of each area by arrival, not by date."""
    return first_rows(log, ["aoi_id"], [F.col("seq").desc()], k)
