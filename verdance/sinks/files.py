"""Writers.  A failed write fails the job; nothing is swallowed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.functions.indices import processed_indices
from verdance.operators.pixels import statistics_map
from verdance.schemas import CLIMATE

# fixed values: texts and folders of the stored results
DATA_SIZE = "Small AOI (1km²)"


def _stamp(ts: dt.datetime) -> str:
    return ts.strftime("%Y%m%d_%H%M%S")


def scene_documents(stats: DataFrame, processed_at: dt.datetime) -> DataFrame:
    """One nested document per scene: statistics by index, and the summary."""
    return statistics_map(stats).select(
        "aoi_id",
        "scene_id",
        "scene_date",
        processed_indices().alias("processed_indices"),
        "statistics",
        F.struct(
            "vegetation_health",
            L.percent_text(F.col("vegetation_coverage")).alias("vegetation_coverage"),
            F.lit(processed_at.isoformat()).alias("processing_timestamp"),
            F.lit(DATA_SIZE).alias("data_size"),
        ).alias("summary"),
    )


def write_scene_statistics(stats: DataFrame, base: str, processed_at: dt.datetime) -> str:
    """JSON documents below ``results/statistics``, one folder per scene date.

    Rows are rebalanced by date first: few files per date, and a date with many
    scenes is split.
    """
    path = f"{base}/results/statistics"
    scene_documents(stats, processed_at).hint("rebalance", "scene_date").write.mode("append").partitionBy("scene_date").json(path)
    return path


def write_log(log: DataFrame, base: str, updated_at: dt.datetime) -> str:
    """One document per area with all its entries in arrival order, at a new versioned path.

    An area's entries are one document, as readers of the format expect; pass
    ``rolling_last(log)`` for the short form.
    """
    path = f"{base}/time_series/vegetation_log_{_stamp(updated_at)}"
    entry = F.struct(
        "seq",
        "scene_id",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "ndvi_mean",
        "vegetation_health",
    )
    documents = log.groupBy("aoi_id").agg(F.sort_array(F.collect_list(entry)).alias("scenes"))
    documents.select(
        "aoi_id",
        F.transform("scenes", lambda s: s.dropFields("seq")).alias("scenes"),
        F.lit(updated_at.isoformat()).alias("last_updated"),
    ).write.json(path)
    return path


def write_climate(climate: DataFrame, base: str, start: dt.date | str, end: dt.date | str) -> str:
    path = f"{base}/climate_data/climate_{start}_to_{end}.csv"
    names = ["aoi_id", *CLIMATE.names]
    climate.select(*[n for n in names if n in climate.columns]).write.mode("overwrite").option("header", True).csv(path)
    return path


def batch_documents(batch: DataFrame, created_at: dt.datetime) -> DataFrame:
    """Counts and the list of period results per area (as many as the batch has periods)."""
    result = F.struct(
        "period_no", "period", "start_date", "end_date", "status", "scene_id", "error"
    )
    return batch.groupBy("aoi_id").agg(
        F.lit(f"multi_temporal_{_stamp(created_at)}").alias("batch_id"),
        F.count("*").alias("total_periods"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sort_array(F.collect_list(result)).alias("results"),
        F.lit(created_at.isoformat()).alias("created_at"),
    )


def write_batch_summary(batch: DataFrame, base: str, created_at: dt.datetime) -> str:
    path = f"{base}/batch_processing/batch_summary_multi_temporal_{_stamp(created_at)}.json"
    batch_documents(batch, created_at).write.json(path)
    return path


def write_document(documents: DataFrame, base: str, name: str, created_at: dt.datetime) -> str:
    """Analytics documents at ``analytics/{name}_{timestamp}.json``."""
    path = f"{base}/analytics/{name}_{_stamp(created_at)}.json"
    documents.write.json(path)
    return path


def write_trends(trends: DataFrame, base: str) -> str:
    path = f"{base}/analysis_results.json"
    trends.write.mode("overwrite").json(path)
    return path
