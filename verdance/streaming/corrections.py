"""Period statistics that late entries correct instead of being dropped.

Statistics are stored as mergeable partials (counts, sum, least, largest) in
blocks of one period.  Entries whose period had closed when they came, by the
clock of the batches before, go to a side table as well, and the rows that they
change are sent out as corrections with their new version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from verdance.operators.periods import STRIDE_DAYS
from verdance.streaming.blocks import BLOCK, Blocks
from verdance.streaming.versions import latest_rows, latest_version, write_next, write_version

KEYS = ["period_start", "aoi_id"]


def periods_store(spark: SparkSession, base: str) -> Blocks:
    return Blocks(spark, f"{base}/periods", ("partials",))


def _partials(entries: DataFrame, days: int) -> DataFrame:
    start = F.timestamp_seconds(F.col(BLOCK) * (days * 86400))
    y = F.col("ndvi_mean")
    return entries.groupBy(BLOCK, start.alias("period_start"), "aoi_id").agg(
        F.count("*").alias("scenes"), F.count(y).alias("n_obs"), F.sum(y).alias("ndvi_sum"),
        F.min(y).alias("ndvi_min"), F.max(y).alias("ndvi_max"), F.count_if("late").alias("late_rows"),
        F.lit(1).cast("long").alias("version"),
    )


def _merged(both: DataFrame) -> DataFrame:
    return both.groupBy(BLOCK, *KEYS).agg(
        F.sum("scenes").alias("scenes"), F.sum("n_obs").alias("n_obs"), F.sum("ndvi_sum").alias("ndvi_sum"),
        F.min("ndvi_min").alias("ndvi_min"), F.max("ndvi_max").alias("ndvi_max"), F.sum("late_rows").alias("late_rows"),
        F.sum("version").alias("version"),
    )


def advance_periods(batch: DataFrame, batch_id: int, base: str, days: int = STRIDE_DAYS, late_days: float = 0) -> Blocks:
    """Folds entries of any age into their periods.

    ``late_days`` is how long a period stays open after the newest entry of the
    earlier batches; entries that come later are folded in all the same.
    """
    spark = batch.sparkSession
    store = periods_store(spark, base)
    seconds = days * 86400
    number = F.floor(F.unix_seconds(F.col("arrived_at").cast("timestamp")) / seconds).cast("long")

    def clock(before: DataFrame | None) -> DataFrame:
        now = batch.agg(F.max("arrived_at").cast("timestamp").alias("newest"))
        if before is not None:
            now = before.select("newest").unionByName(now)
        passed = F.lit(None).cast("timestamp") if before is None else F.lit(before.first().newest)
        return now.agg(F.max("newest").alias("newest")).withColumn("before", passed)

    reached = write_next(spark, f"{base}/clock", batch_id, clock).first().before
    closes = F.timestamp_seconds((number + 1) * seconds) + F.expr(f"make_dt_interval(0, 0, 0, {late_days * 86400})")
    late = F.lit(False) if reached is None else closes <= F.lit(reached)
    marked = batch.withColumn("late", F.coalesce(late, F.lit(False)))
    write_version(marked.where("late").drop("late"), f"{base}/late", batch_id)

    def make(before: DataFrame | None, new: DataFrame) -> dict[str, DataFrame]:
        part = _partials(new, days)
        return {"partials": part if before is None else _merged(before.unionByName(part))}

    # The keys that late entries change, with what they become.
    store.advance(marked, batch_id, number, make)
    changed = marked.where("late").select(number.alias(BLOCK), "aoi_id").distinct()
    touched = [r[0] for r in changed.select(BLOCK).distinct().collect()]  # bounded by the calendar
    manifest = store.manifest()
    partials = store.read("partials", {b: manifest[b] for b in touched})
    if partials is not None:
        corrected = partials.join(changed, [BLOCK, "aoi_id"], "left_semi").drop(BLOCK)
        write_version(corrected, f"{base}/corrections", batch_id, KEYS)
    return store


def corrected_periods_writer(
    entries: DataFrame, base: str, checkpoint: str, days: int = STRIDE_DAYS, late_days: float = 0
) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        if not batch.isEmpty():
            advance_periods(batch, batch_id, base, days, late_days)
        batch.unpersist()

    return entries.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def stored_periods(spark: SparkSession, base: str) -> DataFrame:
    """Statistics over all entries that ever came, with the number of batches and of late entries in them."""
    partials = periods_store(spark, base).read("partials")
    if partials is None:
        raise LookupError(f"no periods in {base}")
    return partials.withColumn("ndvi_mean", F.try_divide("ndvi_sum", "n_obs")).drop(BLOCK)


def stored_corrections(spark: SparkSession, base: str) -> DataFrame:
    """The newest correction of each period and area."""
    return latest_rows(spark, f"{base}/corrections", KEYS)


def newest_arrival(spark: SparkSession, base: str):
    return latest_version(spark, f"{base}/clock").first().newest
