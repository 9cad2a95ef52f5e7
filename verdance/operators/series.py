"""Per-area statistics of the log: descriptive, trend, recent, seasonal.

The trend is fitted on the position of an entry in date order, which needs the
position among all entries of the area.  An area may own a large share of the
log, so positions are formed block-wise (see ``plans.ordering``): a block holds
the entries of one area and day with the same upper bits of ``seq``, at most
2**20 as ``seq`` is unique in an area.  The number of blocks of an area is
bounded by the days of the calendar plus entries / 2**20.

What entries need of their area (mean, deviation, range) is one small row per
area.  It is written once and joined by ``lookup_join``: broadcast while it is
small, else shuffled with hot areas split.

An entry without NDVI keeps its place in date order, and counts in ``entries``,
but is no observation: ``n_obs``, the statistics, the trend and the limits on
the number of observations leave it out.  An entry without a date comes before
all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.functions import labels as L
from verdance.plans.joins import lookup_join, null_safe_join
from verdance.plans.ordering import block_offsets, first_rows
from verdance.session import materialise

BLOCK = ["aoi_id", "date", "_block"]
BLOCK_BITS = 20
EDGE_ROWS = 3

# fixed values: entries needed
MIN_TREND = 3
MIN_COMPARISON = 6
MIN_SEASONAL_CHART = 4
MIN_SEASONAL = 6
MIN_ANOMALY = 4


def _blocked(log: DataFrame) -> DataFrame:
    return log.withColumn("_block", F.shiftright("seq", BLOCK_BITS))


def _in_block(block: Sequence[str] = BLOCK) -> Column:
    """Position of an entry in its block, from 0."""
    return F.row_number().over(W.partitionBy(*block).orderBy("seq")) - 1


def log_overview(log: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """Count, dates and descriptive statistics per area: one hash aggregate."""
    y = F.col("ndvi_mean")
    return log.groupBy(*keys).agg(
        F.count("*").alias("entries"),
        F.count(y).alias("n_obs"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.avg(y).alias("mean"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
        F.stddev_samp(y).alias("std"),
    )


def _position_products(log: DataFrame, keys: Sequence[str] = ("aoi_id",)) -> DataFrame:
    """Sums over an area's observations of position, its square, NDVI and their product.

    Inside a block the position counts from the block's start; the entries in
    earlier blocks are added for the block as a whole.
    """
    block = [*keys, "date", "_block"]
    y, i = F.col("ndvi_mean"), F.when(F.col("ndvi_mean").isNotNull(), F.col("_i")).cast("double")
    blocks = (
        _blocked(log)
        .select(*block, "ndvi_mean", _in_block(block).alias("_i"))
        .groupBy(*block)
        .agg(
            F.count("*").alias("_n"),
            F.count(y).alias("_m"),
            F.coalesce(F.sum(y), F.lit(0.0)).alias("_sum"),
            F.coalesce(F.sum(i * y), F.lit(0.0)).alias("_iy"),
            F.coalesce(F.sum(i), F.lit(0.0)).alias("_ix"),
            F.coalesce(F.sum(i * i), F.lit(0.0)).alias("_ixx"),
        )
    )
    return _shifted_products(blocks, keys, ["date", "_block"])


def _shifted_products(blocks: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Products of whole series from those of its blocks, whose positions count from the block's start."""
    located = block_offsets(blocks, keys, order, "_n", "_before")
    before = F.col("_before").cast("double")
    return located.groupBy(*keys).agg(
        F.sum(before * F.col("_sum") + F.col("_iy")).alias("_xy"),
        F.sum(before * F.col("_m") + F.col("_ix")).alias("_x"),
        F.sum(before * before * F.col("_m") + 2 * before * F.col("_ix") + F.col("_ixx")).alias("_xx"),
        F.sum("_sum").alias("_y"),
    )


def block_partials(log: DataFrame, block: str) -> DataFrame:
    """One row per area and block of its series, from which ``merged_summary`` forms the whole."""
    keys = ["aoi_id", block]
    products = _position_products(log, keys).select(
        *keys, F.col("_y").alias("_sum"), F.col("_xy").alias("_iy"), F.col("_x").alias("_ix"), F.col("_xx").alias("_ixx")
    )
    squares = (F.var_pop("ndvi_mean") * F.count("ndvi_mean")).alias("_squares")
    spread = log.groupBy(*keys).agg(F.coalesce(squares, F.lit(0.0)).alias("_squares"))
    return null_safe_join(null_safe_join(log_overview(log, keys), products, keys), spread, keys)


def merged_summary(partials: DataFrame, block: str) -> DataFrame:
    """``series_summary`` of series whose blocks are summarised: only offsets of blocks are formed anew."""
    keys = ["aoi_id"]
    blocks = partials.withColumns({"_n": F.col("entries"), "_m": F.col("n_obs")})
    total = partials.groupBy(*keys).agg((F.sum("_sum") / F.sum("n_obs")).alias("_mean"))
    off = F.coalesce(F.col("n_obs") * (F.col("mean") - F.col("_mean")) ** 2, F.lit(0.0))
    overview = null_safe_join(partials, total, keys).groupBy(*keys).agg(
        F.sum("entries").alias("entries"),
        F.sum("n_obs").alias("n_obs"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.first("_mean").alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sqrt(F.try_divide(F.sum(F.col("_squares") + off), F.sum("n_obs") - 1)).alias("std"),
    )
    return _summary(overview, _shifted_products(blocks, keys, [block]))


def series_summary(log: DataFrame) -> DataFrame:
    """One row per area: n, dates, mean, min, max, sample std, trend.

    The trend columns are NULL below three observations, ``r_squared`` also for a
    constant series.
    """
    return _summary(log_overview(log), _position_products(log))


def _summary(overview: DataFrame, products: DataFrame) -> DataFrame:
    n = F.col("n_obs").cast("double")
    middle = F.try_divide(F.col("_x"), n)
    sxx = F.col("_xx") - middle * F.col("_x")
    sxy = F.col("_xy") - middle * F.col("_y")
    syy = F.col("std") ** 2 * (n - 1)
    varies = F.col("min") < F.col("max")
    enough = F.col("n_obs") >= MIN_TREND
    return (
        null_safe_join(overview, products, ["aoi_id"])
        .withColumns(
            {
                "slope": F.when(enough, F.when(varies, sxy / sxx).otherwise(0.0)),
                "r_squared": F.when(enough & varies, sxy**2 / (sxx * syy)),
            }
        )
        .withColumns(
            {
                "intercept": F.col("mean") - F.col("slope") * middle,
                "direction": L.trend_direction(F.col("slope")),
            }
        )
        .drop("_xy", "_y", "_x", "_xx")
    )


def with_positions(log: DataFrame) -> DataFrame:
    """Log rows with their position ``idx`` in the area's date order."""
    counts = _blocked(log).groupBy(*BLOCK).agg(F.count("*").alias("_n"))
    located = block_offsets(counts, ["aoi_id"], ["date", "_block"], "_n", "_before")
    ranked = _blocked(log).withColumn("_i", _in_block())
    return (
        null_safe_join(ranked, located.drop("_n"), BLOCK)
        .withColumn("idx", F.col("_before") + F.col("_i"))
        .drop("_before", "_i", "_block")
    )


def with_area(rows: DataFrame, per_area: DataFrame) -> DataFrame:
    """Log rows with a table of one row per area."""
    return lookup_join(rows, materialise(per_area, "areas"), ["aoi_id"])


def trend_line(log: DataFrame) -> DataFrame:
    """Series with the fitted value of each entry (NULL below three observations)."""
    fits = series_summary(log).select("aoi_id", "slope", "intercept")
    return with_area(with_positions(log), fits).select(
        "aoi_id", "scene_id", "date", "idx", "ndvi_mean",
        (F.col("intercept") + F.col("slope") * F.col("idx")).alias("fitted"),
    )


def health_distribution(log: DataFrame) -> DataFrame:
    """Entries per class and their share of the area's entries in percent."""
    counts = log.groupBy("aoi_id", "vegetation_health").agg(F.count("*").alias("scenes"))
    total = F.sum("scenes").over(W.partitionBy("aoi_id"))
    return counts.withColumn("percent", L.share_percent(F.col("scenes"), total))


def _edge_mean(log: DataFrame, newest: bool, name: str) -> DataFrame:
    order = [F.col(c).desc() if newest else F.col(c).asc() for c in ("date", "seq")]
    observed = log.where("ndvi_mean is not null").select("aoi_id", "date", "seq", "ndvi_mean")
    rows = first_rows(observed, ["aoi_id"], order, EDGE_ROWS)
    return rows.groupBy("aoi_id").agg(F.avg("ndvi_mean").alias(name))


def recent_mean(log: DataFrame) -> DataFrame:
    """Mean of the last three observations of each area, fewer if it has fewer."""
    return _edge_mean(log, True, "recent_ndvi")


def recent_vs_historical(log: DataFrame) -> DataFrame:
    """Last three against first three observations; areas with at least six."""
    counts = log.groupBy("aoi_id").agg(F.count("ndvi_mean").alias("n_obs"))
    enough = null_safe_join(counts.where(F.col("n_obs") >= MIN_COMPARISON), recent_mean(log), ["aoi_id"])
    return (
        null_safe_join(enough, _edge_mean(log, False, "historical_ndvi"), ["aoi_id"])
        .withColumn("change", F.col("recent_ndvi") - F.col("historical_ndvi"))
    )


def seasonal_pattern(log: DataFrame, min_rows: int = MIN_SEASONAL) -> DataFrame:
    """Mean NDVI by calendar month over all years, for areas with enough dated observations."""
    dated = log.where("date is not null and ndvi_mean is not null")
    monthly = dated.groupBy("aoi_id", F.month("date").alias("month")).agg(
        F.avg("ndvi_mean").alias("ndvi_mean"), F.count("*").alias("scenes")
    )
    total = F.sum("scenes").over(W.partitionBy("aoi_id"))
    return monthly.withColumn("_total", total).where(F.col("_total") >= min_rows).drop("_total")


def seasonal_map(log: DataFrame, min_rows: int = MIN_SEASONAL) -> DataFrame:
    """``seasonal_pattern`` as one map of at most twelve months per area."""
    return seasonal_pattern(log, min_rows).groupBy("aoi_id").agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("month", "ndvi_mean")))
        ).alias("seasonal_pattern")
    )


def current_health(log: DataFrame) -> DataFrame:
    """Health of the last three observations and the confidence by their number."""
    counts = log.groupBy("aoi_id").agg(F.count("ndvi_mean").alias("n_obs"))
    return null_safe_join(counts, recent_mean(log), ["aoi_id"], "left").select(
        "aoi_id",
        "n_obs",
        F.col("recent_ndvi").alias("current_ndvi"),
        L.current_health(F.col("recent_ndvi")).alias("health_status"),
        L.confidence(F.col("n_obs")).alias("confidence"),
    )


def histogram(log: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins over each area's range; the last bin is closed.

    A constant series is counted in the range of half a unit around it.  Bins
    without an entry have no row.
    """
    y = F.col("ndvi_mean")
    flat = F.col("min") == F.col("max")
    low = F.when(flat, F.col("min") - 0.5).otherwise(F.col("min"))
    high = F.when(flat, F.col("max") + 0.5).otherwise(F.col("max"))
    step = (F.col("_high") - F.col("_low")) / float(bins)
    raw = F.least(F.floor((y - F.col("_low")) / step), F.lit(bins - 1)).cast("int")
    # an edge that rounding put on the wrong side decides by comparison
    left, right = F.col("_low") + F.col("_raw") * step, F.col("_low") + (F.col("_raw") + 1) * step
    settled = (
        F.when(y < left, F.col("_raw") - 1)
        .when((y >= right) & (F.col("_raw") < bins - 1), F.col("_raw") + 1)
        .otherwise(F.col("_raw"))
    )
    binned = (
        with_area(log.where(y.isNotNull()), log_overview(log).select("aoi_id", "min", "max", "mean"))
        .withColumns({"_low": low, "_high": high})
        .withColumn("_raw", raw)
        .withColumn("bin", settled)
    )
    return binned.groupBy("aoi_id", "bin").agg(
        F.count("*").alias("scenes"),
        F.min(F.col("_low") + F.col("bin") * step).alias("low"),
        F.min(F.col("_low") + (F.col("bin") + 1) * step).alias("high"),
        F.min("mean").alias("mean"),
    )


def vegetation_trends(log: DataFrame) -> DataFrame:
    """The trend report: one row per area, optional sections NULL when too short."""
    summary = series_summary(log)
    classes = health_distribution(log.where("vegetation_health is not null")).groupBy("aoi_id").agg(
        F.map_from_entries(
            F.collect_list(F.struct("vegetation_health", "scenes"))
        ).alias("health_distribution")
    )
    comparison = recent_vs_historical(log).select(
        "aoi_id", F.struct("recent_ndvi", "historical_ndvi", "change").alias("comparison")
    )
    with_classes = null_safe_join(summary, classes, ["aoi_id"], "left")
    return (
        null_safe_join(with_classes, comparison, ["aoi_id"], "left")
        .select(
            "aoi_id",
            F.col("entries").alias("total_scenes"),
            F.struct(
                F.date_format("first_date", "yyyy-MM-dd").alias("start"),
                F.date_format("last_date", "yyyy-MM-dd").alias("end"),
            ).alias("date_range"),
            F.struct("mean", "min", "max", "std").alias("ndvi_stats"),
            "health_distribution",
            F.when(F.col("slope").isNotNull(), F.struct("slope", "direction")).alias("trend"),
            "comparison",
        )
    )
