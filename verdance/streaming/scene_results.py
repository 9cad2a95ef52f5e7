"""Scene statistics and period statistics of arriving data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from verdance.operators.periods import STRIDE_DAYS
from verdance.operators.pixels import SCENE_KEYS, scene_stats
from verdance.streaming.versions import write_version


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they arrive below a path or glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _changed_rows_writer(changes: DataFrame, base: str, checkpoint: str, keys: Sequence[str]) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, base, batch_id, keys)

    return (
        changes.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def scene_stats_writer(
    pixels: DataFrame,
    base: str,
    checkpoint: str,
    keys: Sequence[str] = SCENE_KEYS,
    late: str | None = None,
) -> DataStreamWriter:
    """Statistics of every scene that has new pixels.

    A scene's pixels may be spread over batches.  State is one aggregate per
    scene; ``late`` drops scenes that old from it (their dates must then
    arrive roughly in order), without it none is dropped.
    """
    if late is not None:
        day = F.col("scene_date").cast("timestamp")
        pixels = pixels.withColumn("scene_date", day).withWatermark("scene_date", late)
    return _changed_rows_writer(scene_stats(pixels, keys), base, checkpoint, keys)


def period_stats(entries: DataFrame, days: int = STRIDE_DAYS, late: str | None = None) -> DataFrame:
    """Entries and NDVI per area and period of arrival."""
    if late is not None:
        entries = entries.withWatermark("arrived_at", late)
    period = F.window("arrived_at", f"{days} days")
    return entries.groupBy(period.alias("period"), "aoi_id").agg(
        F.count("*").alias("scenes"),
        F.avg("ndvi_mean").alias("ndvi_mean"),
        F.min("ndvi_mean").alias("ndvi_min"),
        F.max("ndvi_mean").alias("ndvi_max"),
    )


def period_stats_writer(
    entries: DataFrame, base: str, checkpoint: str, days: int = STRIDE_DAYS, late: str | None = None
) -> DataStreamWriter:
    stats = period_stats(entries, days, late).select(
        F.col("period.start").alias("period_start"),
        F.col("period.end").alias("period_end"),
        "aoi_id", "scenes", "ndvi_mean", "ndvi_min", "ndvi_max",
    )
    return _changed_rows_writer(stats, base, checkpoint, ["period_start", "aoi_id"])
