"""Running totals and positions that do not put a whole key into one task.

A plain window over ``keys`` sorts all rows of a key in one task.  Here rows
are split into ordered blocks: the block totals are formed by a hash
aggregate, their prefix sums by a window over one row per block, and only the
order inside a block by a window over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def block_offsets(totals: DataFrame, keys: Sequence[str], block: Sequence[str], total: str, out: str) -> DataFrame:
    """Sum of ``total`` over all earlier blocks of the key."""
    earlier = (
        W.partitionBy(*keys).orderBy(*block).rowsBetween(W.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast(totals.schema[total].dataType)
    return totals.withColumn(out, F.coalesce(F.sum(total).over(earlier), zero))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    block: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """Running sum of ``value`` in the order of ``block`` then ``order``.

    A missing value adds nothing, and its own running sum is missing.
    """
    cells = [*keys, *block]
    zero = F.lit(0).cast(df.schema[value].dataType)
    totals = df.groupBy(*cells).agg(F.coalesce(F.sum(value), zero).alias("_total"))
    offsets = block_offsets(totals, keys, block, "_total", "_offset").drop("_total")
    local = W.partitionBy(*cells).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        df.withColumn("_local", F.sum(value).over(local))
        .join(offsets, cells)
        .withColumn(out, F.when(F.col(value).isNotNull(), F.col("_offset") + F.col("_local")))
        .drop("_offset", "_local")
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of each key.

    The rank filter is applied before the shuffle as well (window group
    limit), so a map task sends at most ``k`` rows of a key.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
