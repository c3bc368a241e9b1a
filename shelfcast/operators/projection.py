"""Seasonal projection of every series into the coming weeks."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators import analytics
from shelfcast.operators.windows import latest_sku_metadata


def seasonal_projection(weekly, weeks=1):
    """Expected units per series and week: mean times month factor, kept within bounds.

    Rows grow with series x weeks; all three lookups join on full keys.
    """
    stats = analytics.series_statistics(weekly)
    start = weekly.agg(F.max("week")).scalar()
    step = F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("step")
    ahead = (
        stats.select("*", step).withColumn("week", F.date_add(start, F.col("step") * 7))
        .withColumns(S.calendar_columns())
    )
    factors = analytics.seasonality_factors(weekly)
    stages = latest_sku_metadata(weekly).select("sku", "lifecycle_stage")
    low, high = K.PROJECTION_CLIP
    expected = F.col("mean_us") * F.coalesce(F.col("seasonality_factor"), F.lit(1.0))
    units = F.greatest(F.col("min_us") * low, F.least(F.col("max_us") * high, expected))
    return (
        ahead.join(factors, [*K.SERIES, "month"], "left").join(stages, "sku", "left")
        .select(
            *K.SERIES, "week", units.alias("units_sold"),
            F.col("mean_stock").alias("stock_available"), F.col("mean_price").alias("price_unit"),
            F.col("mean_dd").alias("delivery_days"),
            (F.col("max_sku_age") + F.col("step")).alias("sku_age"),
            F.coalesce(F.col("lifecycle_stage"), F.lit("Mature")).alias("lifecycle_stage"),
            "week_number", "month", "year", "is_holiday_week", "is_holiday_peak", "is_summer",
            "is_winter",
        )
    )
