"""Model features on the weekly panel."""

from functools import reduce

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators.cleaning import require_columns
from shelfcast.operators.windows import fill_series, last_rows, previous_promotion


def price_reference(frame, groups):
    """Mean price per category, or of the whole frame when it has no category.

    Computed as a narrow aggregation joined back, not as a window: a category may hold
    a third of all rows, and a window would put it into one task.
    """
    keys = [*groups, *(["category"] if "category" in frame.columns else [])]
    if not keys:
        return frame.withColumn(
            "_price_mean", frame.agg(F.avg("price_unit")).scalar()
        )
    means = frame.groupBy(*keys).agg(F.avg("price_unit").alias("_price_mean"))
    renamed = means.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return frame.join(renamed, same, "left").drop(*[f"_k_{k}" for k in keys])


def encoded_features():
    return {
        "lifecycle_encoded": S.encode("lifecycle_stage", K.LIFECYCLE_CODE),
        "channel_encoded": S.encode("channel", K.CHANNEL_CODE),
        "region_encoded": S.encode("region", K.REGION_CODE),
    }


def price_ratio(price, mean):
    """Price over the mean price; 1 when either is missing or the mean is zero."""
    return F.coalesce(F.try_divide(price, mean), F.lit(1.0))


def stock_ratio(stock="stock_available", mean="rolling_mean_4"):
    return S.safe_divide(stock, mean, 0.0)


def add_derived_features(weekly, groups=()):
    """Encodings, price against its category, stock cover and the previous promotion.

    `groups` names extra keys (a fold) inside which everything is computed.
    """
    with_mean = price_reference(weekly, groups)
    return with_mean.withColumns({
        **encoded_features(),
        "price_vs_category_avg": price_ratio(F.col("price_unit"), F.col("_price_mean")),
        "stock_to_demand_ratio": stock_ratio(),
        "promo_lag_1": previous_promotion((*groups, *K.SERIES)),
    }).drop("_price_mean")


def feature_columns(frame):
    """Features present in the frame, in canonical order."""
    return [c for c in K.FEATURES if c in frame.columns]


def as_features(frame, names=K.FEATURES):
    """Feature columns as doubles in the given order; absent or missing ones are 0."""
    present = set(frame.columns)
    return [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)).alias(c)
        for c in names
    ]


def build_training_features(weekly, groups=(), carry=(), fill="both"):
    """Feature rows with a known target (`target`), plus the `carry` columns."""
    require_columns(weekly, ["target_next_week"], "weekly frame")
    derived = add_derived_features(weekly, groups)
    gaps = [c for c in K.PANEL_FEATURES if c in derived.columns]
    filled = fill_series(derived, gaps, keys=(*groups, *K.SERIES), mode=fill)
    names = feature_columns(filled)
    return filled.filter(F.col("target_next_week").isNotNull()).select(
        *groups, *carry, *as_features(filled, names),
        F.col("target_next_week").cast("double").alias("target"),
    )


def build_inference_features(recent):
    """Feature row of the last week of every series, without any filling.

    Without a category column each series is compared with its own mean price.
    """
    if "category" in recent.columns:
        derived = add_derived_features(recent)
    else:
        from shelfcast.operators.windows import whole_series

        mean = F.avg("price_unit").over(whole_series())
        derived = recent.withColumns({
            **encoded_features(),
            "price_vs_category_avg": price_ratio(F.col("price_unit"), mean),
            "stock_to_demand_ratio": stock_ratio(),
            "promo_lag_1": previous_promotion(),
        })
    last = last_rows(derived)
    return last.select(*K.SERIES, "week", *as_features(last, feature_columns(last)))
