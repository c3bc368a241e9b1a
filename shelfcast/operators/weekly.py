"""From daily rows to the weekly panel, and its enrichment."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators.windows import whole_series


def aggregate_to_weekly(daily):
    """Weekly sums per (sku, week, channel, region).

    One shuffle on the full key after map-side partial sums, so a product that
    holds a third of all rows still spreads over its weeks, channels and regions.
    """
    keyed = daily.withColumn("week", S.week_start("date")).dropna(subset=list(K.WEEKLY_KEY))
    return keyed.groupBy(*K.WEEKLY_KEY).agg(
        F.coalesce(F.sum("units_sold"), F.lit(0.0)).alias("units_sold"),
        F.coalesce(F.sum("delivered_qty"), F.lit(0.0)).alias("delivered_qty"),
        F.max("stock_available").alias("stock_available"),
        F.max("promotion_flag").alias("promotion_flag"),
        F.avg("price_unit").alias("price_unit"),
        F.avg("delivery_days").alias("delivery_days"),
    )


def resample_weekly(daily):
    """Weekly sums of a batch file with its product attributes and calendar parts."""
    extra = [c for c in ("category", "brand", "segment", "pack_type") if c in daily.columns]
    keys = ["sku", "channel", "region", "week", *extra]
    keyed = daily.withColumn("week", S.week_start("date")).dropna(subset=keys)
    sums = keyed.groupBy(*keys).agg(
        F.coalesce(F.sum("units_sold"), F.lit(0.0)).alias("units_sold"),
        F.max("stock_available").alias("stock_available"),
        F.max("promotion_flag").alias("promotion_flag"),
        F.avg("price_unit").alias("price_unit"),
        F.avg("delivery_days").alias("delivery_days"),
    )
    calendar = S.calendar_columns()
    return sums.withColumns({c: calendar[c] for c in ("week_number", "month", "year")})


def template_weekly(template):
    """Template rows brought to one row per week."""
    return template.groupBy("week").agg(
        F.avg("avg_temp").alias("avg_temp"),
        F.avg("inflation_index").alias("inflation_index"),
        F.max("school_in_session").alias("school_in_session"),
        F.avg("category_trend").alias("category_trend"),
        F.avg("event_score").alias("event_score"),
    )


def template_defaults(template):
    """One row of fill values: means of the template rows, the mode of the school flag."""
    return template.agg(
        F.avg("avg_temp").alias("avg_temp"),
        F.avg("inflation_index").alias("inflation_index"),
        F.mode("school_in_session", True).cast("int").alias("school_in_session"),
        F.avg("category_trend").alias("category_trend"),
        F.avg("event_score").alias("event_score"),
    )


def enrich_features(weekly, template):
    """Nine enrichment columns for every weekly row.

    Weeks the template lacks take the template-wide defaults, which enter the plan
    as scalar subqueries. The template holds one row per calendar week.
    """
    defaults = template_defaults(template)
    joined = (
        weekly.withColumns({
            "price_avg": F.avg("price_unit").over(whole_series()),
            "promo_rate": S.promo_rate(),
            "stock_avg": F.avg("stock_available").over(whole_series()),
            "deliveries": S.delivery_indicator(weekly.columns),
        })
        .join(template_weekly(template), "week", "left")
    )
    return joined.withColumns({
        c: F.coalesce(F.col(c), defaults.select(c).scalar()) for c in defaults.columns
    })
