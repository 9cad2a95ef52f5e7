"""The best scene of any, also overlapping, intervals of days per area, without a range join.

An interval is cut into dyadic blocks of days, at most two of each length, and a
scene's day lies in one block of each length.  The best scene of a block is found
once, however many intervals hold it, and intervals meet blocks by equality.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.operators.scenes import BEST_FIRST, COLLECTION, MAX_CLOUD, search_scenes

#: Blocks of up to 2**LEVELS days; a longer interval has more blocks of the longest kind.
LEVELS = 15


def day_blocks(first: Column, last: Column) -> Column:
    """The dyadic blocks ``(level, number)`` that make up the days from ``first`` to ``last``."""

    def at(level: Column) -> Column:
        length = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        # Blocks of this length from the first whole one to before the last whole one's end.
        begin, end = F.ceil(first / length).cast("long"), F.floor((last + 1) / length).cast("long")
        odd = F.array(F.when(begin % 2 != 0, begin), F.when((end % 2 != 0) & ((end - 1 > begin) | (begin % 2 == 0)), end - 1))
        numbers = F.when(level < LEVELS, F.filter(odd, lambda n: n.isNotNull())).otherwise(F.sequence(begin, end - 1))
        blocks = F.transform(numbers, lambda n: F.struct(level.alias("level"), n.alias("number")))
        return F.when(begin < end, blocks).otherwise(F.filter(blocks, lambda b: F.lit(False)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), at))


def _days(date: Column) -> Column:
    return F.unix_date(date).cast("long")


def best_scene_per_interval(
    scenes: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = ("aoi_id",),
    collections: Sequence[str] = (COLLECTION,),
    max_cloud: float = MAX_CLOUD,
) -> DataFrame:
    """Every interval with the least cloudy scene of its area and days, or none.

    ``intervals`` has the keys, ``start_date`` and ``end_date``, both included,
    and columns of its own; rows that repeat are answered each.  An interval
    without a date, or that ends before it starts, has no scene.
    """
    found = search_scenes(scenes, collections=collections, max_cloud=max_cloud).where(F.col("datetime").isNotNull())
    row = F.struct(*BEST_FIRST)
    levels = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS)),
        lambda n: F.struct(n.alias("level"), F.call_function("shiftright", F.col("_day"), n).alias("number")),
    )
    # One row per day first, so that levels multiply days and not scenes.
    daily = found.groupBy(*keys, _days(F.to_date("datetime")).alias("_day")).agg(F.min(row).alias("_best"))
    blocks = daily.select(*keys, "_best", F.inline(levels)).groupBy(*keys, "level", "number").agg(F.min("_best").alias("_best"))
    wanted = intervals.withColumn("_interval", F.struct(*intervals.columns))
    start, end = F.col("_interval.start_date"), F.col("_interval.end_date")
    parts = F.when(start <= end, day_blocks(_days(start), _days(end)))
    cut = wanted.select(*keys, "_interval").distinct().select(*keys, "_interval", F.inline(parts))
    best = cut.join(blocks, [*keys, "level", "number"]).groupBy("_interval").agg(F.min("_best").alias("_best"))
    return wanted.join(best, "_interval", "left").select(*intervals.columns, "_best.*")
