"""Linear model of future NDVI on climate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.functions.dates import as_date
from verdance.operators.correlation import climate_join

# fixed values
MODEL_CONFIG = {
    "model_type": "linear_regression",
    "features": ["temperature_avg", "precipitation", "humidity"],
    "target": "ndvi_mean",
    "training_days": 120,
    "horizon_days": 30,
}
#: Days that the later NDVI may be off the horizon.
TOLERANCE_DAYS = 15


def training_rows(
    log: DataFrame,
    climate: DataFrame,
    as_of: dt.date | str,
    training_days: int = MODEL_CONFIG["training_days"],
    horizon_days: int = MODEL_CONFIG["horizon_days"],
    bounded: bool | None = None,
    tolerance_days: int = TOLERANCE_DAYS,
) -> DataFrame:
    """Climate of a logged day with the NDVI seen about ``horizon_days`` later.

    The later NDVI is the mean over the area's entries of the day nearest to
    the horizon, the earlier of two, within the tolerance; an entry is one
    training row.  Days meet by equality on buckets as long as the tolerance
    is wide, of which a day has two at most.  Only the days of the training
    period are joined.
    """
    end = as_date(as_of)
    start = end - dt.timedelta(days=training_days)
    features = log.where(F.col("date").between(F.lit(start), F.lit(end)))
    last = end + dt.timedelta(days=horizon_days + tolerance_days)
    width = 2 * tolerance_days + 1
    day = F.unix_date("date")
    later = (
        log.where(F.col("date").between(F.lit(start), F.lit(last)) & F.col("ndvi_mean").isNotNull())
        .groupBy("aoi_id", day.alias("_day"))
        .agg(F.avg("ndvi_mean").alias("_ndvi"))
        .withColumn("_bucket", F.floor(F.col("_day") / width))
    )
    target = day + horizon_days
    buckets = F.array_distinct(
        F.array(F.floor((target - tolerance_days) / width), F.floor((target + tolerance_days) / width))
    )
    wanted = features.select("aoi_id", "date").distinct().select(
        "aoi_id", "date", target.alias("_target"), F.explode(buckets).alias("_bucket")
    )
    off = F.abs(F.col("_day") - F.col("_target"))
    labels = (
        wanted.join(later, ["aoi_id", "_bucket"])
        .where(off <= tolerance_days)
        .groupBy("aoi_id", "date")
        .agg(F.min_by("_ndvi", F.struct(off, "_day")).alias("label"))
    )
    seen = climate_join(features, climate, bounded)
    return seen.join(labels, ["aoi_id", "date"]).select("aoi_id", "date", *MODEL_CONFIG["features"], "label")


def fit(rows: DataFrame) -> LinearRegressionModel:
    """Least squares by normal equations: one pass, partial sums merged in a tree."""
    assembler = VectorAssembler(
        inputCols=MODEL_CONFIG["features"], outputCol="features", handleInvalid="skip"
    )
    return LinearRegression(solver="normal", labelCol="label").fit(
        assembler.transform(rows.dropna(subset=[*MODEL_CONFIG["features"], "label"]))
    )


#: A feature whose variance is explained by the others up to this share leaves the system without a solution.
RANK_SHARE = 1e-10
#: Every so many days are held out.
HELD_OUT_EVERY = 5


def fit_by_area(rows: DataFrame, keys: Sequence[str] = ("aoi_id",), held_out_every: int = HELD_OUT_EVERY) -> DataFrame:
    """Least squares per area: ``n``, a coefficient per feature, ``intercept``, and the error on days held out.

    One aggregate with partial moments, so an area with most of the rows costs a
    task no more than others.  The normal equations of the centred features are
    solved by Cholesky factors written out as Columns.  Areas whose features do
    not span the space have no coefficients.  ``held_out_rmse`` is that of every
    fifth day, from the moments of these days; they are not fitted.
    """
    names = MODEL_CONFIG["features"]
    complete = rows.dropna(subset=[*names, "label"])
    held = F.pmod(F.unix_date("date"), F.lit(held_out_every)) == 0
    variables = [*names, "label"]
    aggregates = []
    for prefix, part in (("f", ~held), ("h", held)):
        value = {v: F.when(part, F.col(v)) for v in variables}
        aggregates.append(F.count_if(part).alias(f"{prefix}_n"))
        aggregates += [F.avg(value[v]).alias(f"{prefix}_{v}") for v in variables]
        aggregates += [
            F.covar_pop(value[a], value[b]).alias(f"{prefix}_{a}_{b}") for i, a in enumerate(variables) for b in variables[i:]
        ]
    moments = complete.groupBy(*keys).agg(*aggregates)

    def cov(prefix: str, a: str, b: str) -> Column:
        first, second = sorted((a, b), key=variables.index)
        return F.col(f"{prefix}_{first}_{second}")

    # Factor columns l_i_j with the pivots' squares p_i, one step after the other.
    solved = moments
    full = F.lit(True)
    for i, a in enumerate(names):
        for j, b in enumerate(names[:i]):
            rest = cov("f", a, b)
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            solved = solved.withColumn(f"l_{i}_{j}", F.try_divide(rest, F.col(f"l_{j}_{j}")))
        pivot = cov("f", a, a)
        for k in range(i):
            pivot = pivot - F.col(f"l_{i}_{k}") * F.col(f"l_{i}_{k}")
        solved = solved.withColumn(f"p_{i}", pivot)
        full = full & (F.col(f"p_{i}") > RANK_SHARE * cov("f", a, a)) & (cov("f", a, a) > 0)
        solved = solved.withColumn(f"l_{i}_{i}", F.sqrt(F.greatest(F.col(f"p_{i}"), F.lit(0.0))))
    for i, a in enumerate(names):
        rest = cov("f", a, "label")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        solved = solved.withColumn(f"z_{i}", F.try_divide(rest, F.col(f"l_{i}_{i}")))
    solvable = F.coalesce(full, F.lit(False)) & (F.col("f_n") > len(names))
    for i in reversed(range(len(names))):
        rest = F.col(f"z_{i}")
        for k in range(i + 1, len(names)):
            rest = rest - F.col(f"l_{k}_{i}") * F.col(f"b_{k}")
        solved = solved.withColumn(f"b_{i}", F.when(solvable, F.try_divide(rest, F.col(f"l_{i}_{i}"))))
    slope = [F.col(f"b_{i}") for i in range(len(names))]

    def expected(prefix: str) -> Column:
        return reduce(lambda x, y: x + y, [b * F.col(f"{prefix}_{v}") for b, v in zip(slope, names)])

    solved = solved.withColumn("intercept", F.col("f_label") - expected("f"))
    bias = F.col("h_label") - F.col("intercept") - expected("h")
    spread = cov("h", "label", "label")
    for b, v in zip(slope, names):
        spread = spread - 2 * b * cov("h", v, "label")
        for c, w in zip(slope, names):
            spread = spread + b * c * cov("h", v, w)
    error = F.when(F.col("h_n") > 0, F.sqrt(F.greatest(spread + bias * bias, F.lit(0.0))))
    return solved.select(
        *keys, F.col("f_n").alias("n"), *[F.col(f"b_{i}").alias(v) for i, v in enumerate(names)], "intercept",
        F.col("h_n").alias("held_out"), error.alias("held_out_rmse"),
    )


def predict(model: LinearRegressionModel, climate: DataFrame) -> DataFrame:
    """Expected NDVI ``horizon_days`` after each climate day."""
    assembler = VectorAssembler(
        inputCols=MODEL_CONFIG["features"], outputCol="features", handleInvalid="skip"
    )
    scored = model.transform(assembler.transform(climate))
    target = F.date_add("date", MODEL_CONFIG["horizon_days"])
    return scored.withColumns({"target_date": target}).drop("features")


def coefficients(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    names = [*MODEL_CONFIG["features"], "intercept"]
    values = [*map(float, model.coefficients), float(model.intercept)]
    return spark.createDataFrame(list(zip(names, values)), "term string, coefficient double")
