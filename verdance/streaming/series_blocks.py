"""Whole-log analytics and running sums kept up by batches, late and revised entries included.

Series are cut into calendar months.  A batch rewrites the months it touches
and their partial sums; what depends on earlier months, the position of an entry
or the sum before a day, is an offset per month, formed when results are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from verdance.operators.series import block_partials, merged_summary
from verdance.operators.veglog import COLUMNS
from verdance.plans.ordering import block_offsets, first_rows
from verdance.streaming.blocks import BLOCK, Blocks, month_block


def trend_store(spark: SparkSession, base: str) -> Blocks:
    return Blocks(spark, base, ("entries", "partials"))


def advance_trend(batch: DataFrame, batch_id: int, base: str) -> Blocks:
    """Adds log entries of any dates; reads and rewrites only the months they fall in."""
    store = trend_store(batch.sparkSession, base)

    def make(before: DataFrame | None, new: DataFrame) -> dict[str, DataFrame]:
        entries = new.select(*COLUMNS, BLOCK)
        entries = entries if before is None else before.unionByName(entries)
        return {"entries": entries, "partials": block_partials(entries, BLOCK)}

    store.advance(batch, batch_id, month_block(F.col("date")), make)
    return store


def trend_writer(entries: DataFrame, base: str, checkpoint: str) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        advance_trend(batch, batch_id, base)
        batch.unpersist()

    return entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def stored_trend(spark: SparkSession, base: str) -> DataFrame:
    """Summary and trend of every area's whole log, from a row per area and month."""
    partials = trend_store(spark, base).read("partials")
    if partials is None:
        raise LookupError(f"no log in {base}")
    return merged_summary(partials, BLOCK)


def sums_store(spark: SparkSession, base: str) -> Blocks:
    return Blocks(spark, base, ("days", "totals"))


def advance_sums(batch: DataFrame, batch_id: int, base: str, keys: list[str], value: str) -> Blocks:
    """Adds days, or replaces days that are there: ``batch`` has the keys, ``date``, the value and ``revision``.

    Of the values of a day the one with the largest revision counts.
    """
    store = sums_store(batch.sparkSession, base)

    def make(before: DataFrame | None, new: DataFrame) -> dict[str, DataFrame]:
        days = new.select(*keys, "date", value, "revision", BLOCK)
        days = days if before is None else before.unionByName(days)
        days = first_rows(days, [*keys, "date"], [F.col("revision").desc(), F.col(value).asc_nulls_last()], 1)
        totals = days.groupBy(*keys, BLOCK).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("total"))
        return {"days": days, "totals": totals}

    store.advance(batch, batch_id, month_block(F.col("date")), make)
    return store


def running_sums(spark: SparkSession, base: str, keys: list[str], value: str, out: str) -> DataFrame:
    """Days with the sum of all days up to each; a missing value adds nothing and has no sum."""
    store = sums_store(spark, base)
    days, totals = store.read("days"), store.read("totals")
    if days is None:
        raise LookupError(f"no days in {base}")
    if not keys:
        # One row per month of the calendar.
        days, totals = (t.withColumn("_all", F.lit(0)) for t in (days, totals))
    by = keys or ["_all"]
    offsets = block_offsets(totals, by, [BLOCK], "total", "_before").drop("total")
    inside = W.partitionBy(*by, BLOCK).orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        days.withColumn("_local", F.sum(value).over(inside))
        .join(offsets, [*by, BLOCK])
        .withColumn(out, F.when(F.col(value).isNotNull(), F.col("_before") + F.col("_local")))
        .drop("_local", "_before", BLOCK, "_all")
    )
