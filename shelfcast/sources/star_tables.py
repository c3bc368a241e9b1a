"""Domain tables read off a retail star schema (orders, lineitem, part, customer, nation).

Each frame is a lazy plan over the Parquet files, so column pruning and filters
reach the scans. The price is cut to multiples of 2^-20: such numbers add without
rounding, so totals do not depend on how rows were split over tasks.
"""

from functools import cached_property

from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.operators.weekly import aggregate_to_weekly
from shelfcast.operators.windows import compute_lag_features, next_week_target, whole_series

PRICE_STEPS = 1048576
TEMPLATE_SKU = "BR-006"
LOG_START, LOG_AS_OF = "2001-07-02", "2001-10-01"


def _brand_number():
    return F.substring("p_brand", 7, 10).cast("int")


def brand_columns():
    """Product attributes, all functions of the brand."""
    number = _brand_number()
    category = (
        F.when(number % 5 == 0, "Milk").when(number % 5 == 1, "Yogurt")
        .when(number % 5 == 2, "ReadyMeal").when(number % 5 == 3, "Juice").otherwise("SnackBar")
    )
    pack = F.when(number % 3 == 0, "Multipack").when(number % 3 == 1, "Single").otherwise("Carton")
    return [
        F.concat(F.lit("BR-"), F.lpad(F.substring("p_brand", 7, 10), 3, "0")).alias("sku"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("SEG-"), (number % 13).cast("string")).alias("segment"),
        category.alias("category"),
        pack.alias("pack_type"),
    ]


def with_dimensions(coded):
    """The 14 columns of the daily frame from brand, channel and region codes."""
    channel, region = F.col("channel_code"), F.col("region_code")
    sku, brand, segment, category, pack = brand_columns()
    return coded.select(
        "date", sku, brand, segment, category,
        F.when(channel == 0, "Retail").when(channel == 1, "Discount")
        .otherwise("E-commerce").alias("channel"),
        F.when(region == 0, "PL-Central").when(region == 1, "PL-North")
        .otherwise("PL-South").alias("region"),
        pack, "price_unit", "promotion_flag", "delivery_days", "stock_available",
        "delivered_qty", "units_sold",
    )


class StarTables:
    """Frames of one data folder; every property is a plan, nothing is computed here."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder

    def read(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def coded_lines(self):
        """One row per order line, its dimensions still as short codes."""
        days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
        raw_price = F.col("p_retailprice") * (1 - F.col("l_discount")) / 200
        joined = (
            self.read("lineitem")
            .join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        )
        return joined.select(
            F.col("l_shipdate").cast("date").alias("date"),
            "p_brand",
            (F.col("c_custkey") % 3).cast("int").alias("channel_code"),
            (F.col("n_regionkey") % 3).alias("region_code"),
            (F.floor(raw_price * PRICE_STEPS) / PRICE_STEPS).alias("price_unit"),
            (F.col("l_discount") >= 0.075).cast("int").alias("promotion_flag"),
            (F.abs(days) % 5 + 1).cast("int").alias("delivery_days"),
            (F.col("p_size").cast("double") * 4).alias("stock_available"),
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
            .alias("delivered_qty"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7),
                   -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("units_sold"),
        )

    @cached_property
    def sales_lines(self):
        """One row per order line with its dimensions spelled out."""
        return with_dimensions(self.coded_lines)

    @cached_property
    def daily(self):
        """Daily frame, unique by (sku, date, channel, region).

        Lines are summed on the short codes; names are attached to the few sums.
        """
        return with_dimensions(
            self.coded_lines.groupBy("date", "p_brand", "channel_code", "region_code").agg(
                F.avg("price_unit").alias("price_unit"),
                F.max("promotion_flag").alias("promotion_flag"),
                F.min("delivery_days").alias("delivery_days"),
                F.max("stock_available").alias("stock_available"),
                F.sum("delivered_qty").alias("delivered_qty"),
                F.sum("units_sold").alias("units_sold"),
            )
        )

    @cached_property
    def daily_sales(self):
        """Stored fact table: the daily frame without product attributes."""
        return self.sales_of(self.daily)

    @staticmethod
    def sales_of(daily, *more):
        return daily.select(
            "sku", F.col("date").alias("sale_date"), "channel", "region", "price_unit",
            "promotion_flag", "delivery_days", "stock_available", "delivered_qty", "units_sold", *more,
        )

    @cached_property
    def products(self):
        """Product master: one row per brand of the part table."""
        return self.read("part").select(*brand_columns()).distinct()

    @cached_property
    def weekly_base(self):
        """Daily frame summed up to weeks."""
        return aggregate_to_weekly(self.daily)

    @cached_property
    def weekly_aged(self):
        """Weekly sums with calendar, age and lifecycle stage, before any lag.

        The first week is a window over the product: at most channels x regions x weeks
        rows, and its shuffle by product also serves all series windows that follow.
        """
        first_week = F.min("week").over(whole_series("sku"))
        age = F.floor(F.datediff(F.col("week"), first_week) / 7).cast("int")
        stage = (
            F.when(F.col("sku_age") < 119, "Growth").when(F.col("sku_age") < 238, "Mature")
            .otherwise("Decline")
        )
        return (
            self.weekly_base.withColumns({**S.calendar_columns(), "sku_age": age})
            .withColumn("lifecycle_stage", stage)
        )

    @cached_property
    def weekly(self):
        """Modelling panel: calendar, age, filled lags and the next week's units."""
        return next_week_target(compute_lag_features(self.weekly_aged)).select(
            "sku", "week", "channel", "region", "units_sold", "stock_available",
            "promotion_flag", "price_unit", "delivery_days", "is_holiday_peak", "week_number",
            "month", "year", "is_holiday_week", "is_summer", "is_winter", "sku_age",
            "lifecycle_stage", "lag_1", "lag_2", "rolling_mean_4", "rolling_std_4", "momentum",
            "target_next_week",
        )

    @cached_property
    def weekly_categorised(self):
        """Panel with the category of its product."""
        return self.weekly.join(self.products.select("sku", "category"), "sku")

    @cached_property
    def template(self):
        """Enrichment rows of one product; every fifth ISO week is missing."""
        return (
            self.weekly.filter((F.col("sku") == TEMPLATE_SKU) & (F.col("week_number") % 5 != 0))
            .select(
                "sku", "week", "channel", "region",
                F.col("price_unit").alias("price_avg"),
                F.col("promotion_flag").cast("double").alias("promo_rate"),
                F.col("stock_available").alias("stock_avg"),
                F.lit(1).alias("deliveries"),
                (2.0 * F.col("month")).alias("avg_temp"),
                (1 + 0.01 * (F.col("year") - 1995)).alias("inflation_index"),
                F.when(F.col("month").isin(7, 8), 0).otherwise(1).alias("school_in_session"),
                (1 + 0.1 * (F.col("week_number") % 5)).alias("category_trend"),
                (0.25 * (F.col("week_number") % 4)).alias("event_score"),
            )
        )

    @cached_property
    def prediction_log(self):
        """Served forecasts still waiting for their actual units."""
        point = F.col("rolling_mean_4")
        return (
            self.weekly_categorised.filter(F.col("week") >= F.lit(LOG_START).cast("date"))
            .select(
                F.lit("r1").alias("request_id"), "sku", "channel", "region",
                F.col("week").alias("forecast_week"),
                point.alias("predicted_units"),
                (point - 10).alias("confidence_lower"),
                (point + 10).alias("confidence_upper"),
                F.concat(S.model_name(), F.lit("_v1")).alias("model_version"),
                F.lit(None).cast("double").alias("actual_units"),
                F.lit(None).cast("timestamp").alias("scored_at"),
            )
        )
