"""Forecast error measures: offline (percent, floored) and live (fraction, zeros skipped)."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S


def evaluate(frame, actual, predicted, *keys):
    """MAPE in percent, RMSE, MAE and R2 per key, in one aggregation.

    Actual values about zero are floored in the MAPE divisor. R2 is 0 for a single
    row; for a constant target it is 1 when every row is exact, else 0.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    floor = F.greatest(F.abs(y), F.lit(K.MAPE_FLOOR))
    sums = [
        F.count("*").alias("samples"),
        (F.avg(F.abs(error) / floor) * 100.0).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop(y) * F.count("*")).alias("_sst"),
    ]
    grouped = frame.groupBy(*keys).agg(*sums) if keys else frame.agg(*sums)
    constant = F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    r2 = (
        F.when(F.col("samples") <= 1, 0.0).when(F.col("_sst") == 0, constant)
        .otherwise(1 - F.try_divide(F.col("_sse"), F.col("_sst")))
    )
    return grouped.withColumn("r2", r2).drop("_sse", "_sst")


def live_metrics(joined):
    """Samples, MAPE as a fraction over non-zero actuals, RMSE and MAE per model and category."""
    y, p = F.col("actual_units"), F.col("predicted_units")
    error = y - p
    relative = F.when(y != 0, F.abs(F.try_divide(error, y)))
    return joined.groupBy("model_version", "category").agg(
        F.count("*").cast("int").alias("samples"),
        F.coalesce(F.avg(relative), F.lit(0.0)).alias("live_mape"),
        F.sqrt(F.avg(error * error)).alias("live_rmse"),
        F.avg(F.abs(error)).alias("live_mae"),
    )


def feature_baselines(frame, columns=None, *keys):
    """Mean and sample deviation of every numeric feature, in long form."""
    from shelfcast.operators.analytics import numeric_columns

    names = [c for c in (columns or numeric_columns(frame)) if c not in keys]
    wide = frame.groupBy(*keys).agg(*[
        F.struct(F.avg(c).alias("mean"),
                 F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias("std")).alias(c) for c in names
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}.mean").alias("mean"),
                 F.col(f"{c}.std").alias("std")) for c in names
    ])
    return wide.select(*keys, F.inline(rows))


def detect_drift(current, baselines, *keys):
    """Features whose mean moved by more than two baseline deviations.

    Both sides are long (feature, mean[, std]) frames with one row per feature.
    """
    on = [*keys, "feature"]
    now = current.select(*on, F.col("mean").alias("_now"))
    shift = F.abs(F.col("_now") - F.col("mean"))
    return (
        baselines.join(now, on)
        .filter((F.col("std") >= K.DRIFT_STD_FLOOR) & (shift > K.DRIFT_SIGMA * F.col("std")))
        .select(
            *on, F.round("_now", 4).alias("current_mean"), F.round("mean", 4).alias("baseline_mean"),
            F.round("std", 4).alias("baseline_std"),
            F.round(F.try_divide(shift, F.col("std")), 2).alias("sigma_shift"),
            F.lit("warn").alias("severity"),
        )
    )


def drift_json(warnings, *keys):
    """Warnings per key as one JSON array (at most one entry per feature)."""
    fields = [c for c in warnings.columns if c not in keys]
    listed = F.array_sort(F.collect_list(F.struct(*fields)))
    return warnings.groupBy(*keys).agg(
        F.to_json(listed).alias("drift_warnings"), F.count("*").alias("drift_count")
    )


def clamped_metrics():
    """Lineage metric columns limited to what their decimal columns hold."""
    return {f"train_{m}": S.clamped_metric(m) for m in ("mape", "rmse", "mae", "r2")}
