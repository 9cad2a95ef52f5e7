"""Domain tables as deterministic views over the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.functions.climate import heat_stress_index
from verdance.operators.climate import climate_indices
from verdance.operators.pixels import scene_stats
from verdance.operators.veglog import log_entries, rolling_last
from verdance.session import materialise

SCENE = ("aoi_id", "scene_date")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels_of(table(spark, sf_dir, "lineitem"))


def pixels_of(lineitem: DataFrame) -> DataFrame:
    """Pixels of the line items, batch or stream."""
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    price = cents(F.col("l_extendedprice"))
    return lineitem.select(
        F.col("l_suppkey").alias("aoi_id"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("scene_date"),
        (price % 4000).alias("red_dn"),
        (1500 + (part * 37 + line * 911 + order * 13) % 9500).alias("nir_dn"),
        ((price * 7 + order) % 4200).alias("green_dn"),
        ((price * 13 + part) % 2600).alias("blue_dn"),
        ((557400 + (order * 31 + line * 7) % 100) / F.lit(10000.0)).alias("lon"),
        ((242030 + (part * 17 + line) % 100) / F.lit(10000.0)).alias("lat"),
    )


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scene_stats(pixels(spark, sf_dir), SCENE)


def veglog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene per area and month, numbered by date (the calendar bounds an area)."""
    named = stats(spark, sf_dir).withColumn(
        "scene_id", F.concat_ws("_", "aoi_id", F.col("scene_date").cast("string"))
    )
    by_date = W.partitionBy("aoi_id").orderBy("scene_date")
    return log_entries(named.withColumn("seq", F.row_number().over(by_date)))


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``veglog`` as a written table, for analyses that read the log several times:
    the pixels are then scanned once."""
    return materialise(veglog(spark, sf_dir), "veglog")


def rolling_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entries of each area of the event log, as a written table."""
    return materialise(rolling_last(log_stream(table(spark, sf_dir, "events"))), "rolling-log")


def log_stream(events: DataFrame) -> DataFrame:
    """Log entries of the event table, batch or stream."""
    ndvi = (cents(F.col("value")) % 10000) / F.lit(10000.0)
    return events.select(
        F.col("user_id").alias("aoi_id"),
        F.concat_ws("_", "user_id", "event_id").alias("scene_id"),
        F.col("ts").cast("date").alias("date"),
        ndvi.alias("ndvi_mean"),
        F.when(ndvi > 0.3, "Good").otherwise("Poor").alias("vegetation_health"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("arrived_at"),
    )


def climate_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order date, as a written table (at most a row per calendar day)."""
    days = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.sum(cents(F.col("o_totalprice"))).alias("_price"),
            F.sum("o_custkey").alias("_cust"),
            F.sum("o_orderkey").alias("_order"),
        )
    )
    temperature = 20 + (F.col("_price") % 2600) / F.lit(100.0)
    rain = F.when(F.col("_cust") % 100 < 30, (F.col("_cust") % 500) / F.lit(100.0)).otherwise(0.0)
    observed = days.select(
        "date",
        temperature.alias("temperature_avg"),
        (temperature + 3.0).alias("temperature_max"),
        (temperature - 8.0).alias("temperature_min"),
        rain.alias("precipitation"),
        (30 + (F.col("_order") % 6000) / F.lit(100.0)).alias("humidity"),
        heat_stress_index(temperature).alias("heat_stress_index"),
    )
    return materialise(observed, "climate")


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return climate_indices(climate_observed(spark, sf_dir))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cloud = F.when(
        F.col("o_orderkey") % 97 != 0, (cents(F.col("o_totalprice")) % 10000) / F.lit(100.0)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scene_id"),
        (F.col("o_custkey") % 25).alias("aoi_id"),
        F.col("o_orderdate").alias("datetime"),
        cloud.alias("cloud_cover"),
        F.when(F.col("o_orderpriority") == "5-LOW", "sentinel-2-l1c")
        .otherwise("sentinel-2-l2a")
        .alias("collection"),
    )


def band_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band tiles, eight pixels wide, from the embedding vectors; some lack the blue band."""
    vector = F.col("embedding")

    def band(name: str, factor: int, base: int):
        dn = F.transform(
            vector, lambda x: (F.floor(F.abs(x.cast("double")) * factor) + base).cast("int")
        )
        return F.struct(F.lit(name).alias("band"), dn.alias("dn"))

    bands = F.array(
        band("red", 10000, 0), band("nir", 17000, 300), band("green", 7000, 50), band("blue", 3000, 20)
    )
    return (
        table(spark, sf_dir, "embeddings")
        .select(
            F.col("vec_id").alias("scene_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 28).cast("int")).alias("scene_date"),
            F.col("label").alias("tile_id"),
            F.lit(8).alias("width"),
            F.floor(F.size(vector) / 8).cast("int").alias("height"),
            (55 + (F.col("vec_id") % 100) / F.lit(100.0)).alias("x0"),
            F.lit(24.5).alias("y0"),
            F.lit(0.125).alias("dx"),
            F.lit(-0.125).alias("dy"),
            F.inline(bands),
        )
        .where((F.col("band") != "blue") | (F.col("scene_id") % 5 != 0))
    )


def _square(x: Column, y: Column, size: int) -> Column:
    corners = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return F.array(
        *[
            F.struct((a / F.lit(100.0)).alias("lon"), (b / F.lit(100.0)).alias("lat"))
            for a, b in corners
        ]
    )


def scene_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes with a footprint of one degree."""
    key = F.col("scene_id")
    footprint = _square((key * 37) % 6000, (key * 53) % 4000, 100)
    return scenes(spark, sf_dir).withColumn("footprint", footprint)


def supplier_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small square area per supplier."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("area"), _square((key * 607) % 6000, (key * 911) % 4000, 2).alias("ring")
    )
