"""Sales analytics: summaries, rankings, promotion, season, lifecycle and stock reports.

Every report is one aggregation with map-side partial sums; the keys are products,
categories, channels, regions, months or weeks. Lookups on the product master carry
no hint: Spark broadcasts the side by its measured size or splits skewed keys.
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators.windows import change_to_previous


def check_range(value, low, high, name):
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, got {value}")


def promo_means(frame, *keys):
    """Mean units with and without promotion per key; a missing side is NULL."""
    units, flag = F.col("units_sold"), F.col("promotion_flag")
    return frame.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.avg(F.when(flag == 0, units)).alias("non_promo_avg"),
        F.avg(F.when(flag == 1, units)).alias("promo_avg"),
    )


def period_start(frame, period):
    """First day of the week or month of each row."""
    source = next((c for c in ("week", "date") if c in frame.columns), None)
    if source is None:
        raise ValueError("frame has neither a 'week' nor a 'date' column")
    return S.month_start(source) if period == "monthly" else S.week_start(source)


def units_by(frame, dimension, period="weekly"):
    """Units per category, channel or region and per week or month, in order."""
    return (
        frame.withColumn("period", period_start(frame, period)).dropna(subset=[dimension])
        .groupBy(dimension, "period").agg(F.sum("units_sold").alias("units_sold"))
        .orderBy(dimension, "period")
    )


def in_period(daily_sales, products, start, end, category=None):
    """Sales between two dates, both included, with their category."""
    if str(start) > str(end):
        raise ValueError("start date after end date")
    days = daily_sales.filter(F.col("sale_date").between(F.lit(start).cast("date"),
                                                         F.lit(end).cast("date")))
    kept = products if category is None else products.filter(F.col("category") == category)
    return days.join(kept.select("sku", "category"), "sku")


def sales_summary(daily_sales, products, start, end, category=None):
    """Total units, revenue and rows of a period; zeros when it is empty."""
    return in_period(daily_sales, products, start, end, category).agg(
        F.coalesce(F.sum("units_sold"), F.lit(0.0)).alias("total_units"),
        F.coalesce(F.sum(S.revenue()), F.lit(0.0)).alias("total_revenue"),
        F.count("*").alias("record_count"),
    )


def sales_breakdown(daily_sales, products, start, end, category=None):
    return (
        in_period(daily_sales, products, start, end, category).groupBy("category")
        .agg(F.coalesce(F.sum("units_sold"), F.lit(0.0)).alias("units_sold")).orderBy("category")
    )


def top_products(sales, n=10, metric="units_sold"):
    """The n best products of a frame with sku and category; ties go to the smaller SKU."""
    check_range(n, 1, K.TOP_PRODUCTS_MAX, "n")
    value = F.col("units_sold") if metric == "units_sold" else S.revenue()
    return (
        sales.groupBy("sku", "category").agg(F.sum(value).alias("metric_value"))
        .orderBy(F.col("metric_value").desc(), "sku").limit(n)
    )


def inventory_risk(weekly, threshold_days=7):
    """Series whose stock lasts fewer days than the threshold, shortest first."""
    check_range(threshold_days, 1, K.INVENTORY_DAYS_MAX, "threshold_days")
    demand = F.col("avg_weekly_demand")
    return (
        weekly.filter(F.col("rolling_mean_4") > 0).groupBy(*K.SERIES)
        .agg(F.avg("stock_available").alias("stock_available"),
             F.avg("rolling_mean_4").alias("avg_weekly_demand"))
        .withColumn("days_of_supply", 7.0 * S.safe_divide("stock_available", demand))
        .filter(F.col("days_of_supply") < threshold_days)
        .withColumn("threshold_days", F.lit(threshold_days))
        .orderBy("days_of_supply", *K.SERIES)
    )


def category_trends(daily_sales, products, months=6):
    """Monthly units per category with the change to the month before.

    Keeps the newest months*5 groups, a row limit over all categories. The windows
    run over those few groups.
    """
    check_range(months, 1, K.TREND_MONTHS_MAX, "months")
    newest = (
        daily_sales.join(products.select("sku", "category"), "sku")
        .groupBy("category", S.month_start("sale_date").alias("month"))
        .agg(F.sum("units_sold").alias("total_units_sold"))
        .orderBy(F.col("month").desc(), "category").limit(months * 5)
    )
    change = change_to_previous(newest, "total_units_sold", "category", "month")
    return newest.withColumn("delta_pct", change).orderBy("category", "month")


def stage_counts(stages, count):
    """Wide row of counts per stage, 0 for an absent one."""
    return stages.agg(*[
        F.coalesce(F.max(F.when(F.col("lifecycle_stage") == s, F.col(count))), F.lit(0))
        .cast("long").alias(s.lower()) for s in K.LIFECYCLE_STAGES
    ])


def modal_stage(weekly):
    """Most frequent stage per SKU; ties go to the alphabetically first."""
    return weekly.groupBy("sku").agg(
        F.mode("lifecycle_stage", True).alias("lifecycle_stage")
    )


def lifecycle_distribution(weekly):
    """SKUs per modal stage."""
    counts = modal_stage(weekly).groupBy("lifecycle_stage").agg(F.count("*").alias("n"))
    return stage_counts(counts, "n")


def lifecycle_membership(weekly):
    """SKUs ever seen in each stage; one SKU may count in several."""
    pairs = weekly.select("lifecycle_stage", "sku").distinct()
    return stage_counts(pairs.groupBy("lifecycle_stage").agg(F.count("*").alias("n")), "n")


def stage_week_counts(weekly):
    return weekly.groupBy("lifecycle_stage").agg(F.count("*").alias("sku_weeks"))


def dominant_stage_counts(weekly):
    return modal_stage(weekly).groupBy("lifecycle_stage").agg(F.count("*").alias("skus"))


def promo_impact(frame):
    """Mean units per SKU with and without promotion, a missing side as 0, and the lift."""
    means = promo_means(frame, "sku").fillna(0.0)
    return means.withColumn("promo_lift_pct", S.lift_percent("promo_avg", "non_promo_avg"))


def promo_lift_by(frame, key):
    """Mean-based promotion lift per key, highest first; NULL when a side is missing."""
    lift = S.percent_change("promo_avg", "non_promo_avg").alias("lift_pct")
    return (
        promo_means(frame, key).select(key, "non_promo_avg", "promo_avg", lift)
        .orderBy(F.col("lift_pct").desc(), key)
    )


def units_by_promotion(frame, key="channel"):
    return (
        frame.groupBy(key, "promotion_flag").agg(F.sum("units_sold").alias("units_sold"))
        .orderBy(key, "promotion_flag")
    )


def channel_comparison_means(frame):
    """Channel report over rows: total units, mean price, lift from mean units."""
    units, flag = F.col("units_sold"), F.col("promotion_flag")
    sides = {
        "promo": F.coalesce(F.avg(F.when(flag == 1, units)), F.lit(0.0)),
        "base": F.coalesce(F.avg(F.when(flag == 0, units)), F.lit(0.0)),
    }
    return frame.groupBy("channel").agg(
        F.sum("units_sold").alias("total_units_sold"),
        F.avg("price_unit").alias("avg_price_unit"),
        *[e.alias(n) for n, e in sides.items()],
    ).select("channel", "total_units_sold", "avg_price_unit",
             S.lift_percent("promo", "base").alias("promo_lift_pct"))


def channel_comparison_sums(daily_sales):
    """Channel report over promotion groups: unweighted mean price, lift from sums."""
    flag, total = F.col("promotion_flag"), F.col("total_units_sold")
    groups = daily_sales.groupBy("channel", "promotion_flag").agg(
        F.sum("units_sold").alias("total_units_sold"), F.avg("price_unit").alias("avg_price_unit")
    )
    return groups.groupBy("channel").agg(
        F.sum("total_units_sold").alias("total_units_sold"),
        F.avg("avg_price_unit").alias("avg_price_unit"),
        F.coalesce(F.sum(F.when(flag == 1, total)), F.lit(0.0)).alias("promo"),
        F.coalesce(F.sum(F.when(flag == 0, total)), F.lit(0.0)).alias("base"),
    ).select("channel", "total_units_sold", "avg_price_unit",
             S.lift_percent("promo", "base").alias("promo_lift_pct"))


def seasonality(weekly, sku):
    """Highest and lowest monthly mean of one SKU and their ratio; 0, 0, 1 when unknown."""
    monthly = (
        weekly.filter(F.col("sku") == sku).groupBy("month")
        .agg(F.avg("units_sold").alias("mean_units"))
    )
    span = monthly.agg(
        F.coalesce(F.max("mean_units"), F.lit(0.0)).alias("max_monthly"),
        F.coalesce(F.min("mean_units"), F.lit(0.0)).alias("min_monthly"),
    )
    return span.withColumn(
        "seasonality_strength", S.safe_divide("max_monthly", "min_monthly", 1.0)
    )


def numeric_columns(frame):
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [n for n, t in frame.dtypes if t in kinds or t.startswith("decimal")]


def _pair_sums(centred, names):
    """Per column pair: rows with both values and the sums a correlation needs.

    Each task multiplies its batches' matrices with numpy and emits one row per pair;
    the rows then add up in Spark. The values come centred, which keeps the sums small.
    """
    schema = "left int, right int, n double, sx double, sy double, sxx double, syy double, sxy double"
    size = len(names)

    def per_task(batches):
        total = np.zeros((6, size, size))
        for batch in batches:
            values = batch.to_numpy(dtype=float)
            known = (~np.isnan(values)).astype(float)
            x = np.nan_to_num(values)
            total += (known.T @ known, x.T @ known, known.T @ x, (x * x).T @ known,
                      known.T @ (x * x), x.T @ x)
        left, right = np.indices((size, size)).reshape(2, -1)
        sums = total.reshape(6, -1)
        yield pd.DataFrame(dict(zip(
            ("left", "right", "n", "sx", "sy", "sxx", "syy", "sxy"), (left, right, *sums)
        )))

    return centred.mapInPandas(per_task, schema).groupBy("left", "right").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )


def correlations(frame, columns=None):
    """Pearson correlation of every column pair in long form, 0 where undefined.

    Only rows with both values count for a pair. The means that centre the values are a
    subquery of the plan, so nothing runs before the result is asked for.
    """
    names = list(columns or numeric_columns(frame))
    narrow = frame.select(*[S.nan_to_null(F.col(c).cast("double")).alias(c) for c in names])
    means = narrow.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in names])
    centred = narrow.select(*[(F.col(c) - means.select(c).scalar()).alias(c) for c in names])
    spread = (
        (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
        * (F.col("n") * F.col("syy") - F.col("sy") * F.col("sy"))
    )
    shared = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    corr = F.when(spread > 0, F.try_divide(shared, F.sqrt(spread)))
    label = F.array(*[F.lit(c) for c in names])
    return _pair_sums(centred, names).select(
        F.get(label, F.col("left")).alias("left"), F.get(label, F.col("right")).alias("right"),
        F.coalesce(corr, F.lit(0.0)).alias("corr"),
    )


def ranked_correlations(frame, columns, target):
    """Correlations with the target limited to [-1, 1], strongest first."""
    limited = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("corr")))
    return (
        correlations(frame, columns).filter((F.col("left") == target) & (F.col("right") != target))
        .select(F.col("right").alias("feature"), limited.alias("corr"))
        .orderBy(F.abs("corr").desc(), "feature")
    )


def category_summary(frame):
    """Total, mean and deviation of units per category with its share of all units."""
    sums = frame.dropna(subset=["category"]).groupBy("category").agg(
        F.sum("units_sold").alias("total_units"),
        F.avg("units_sold").alias("avg_weekly"),
        F.stddev_samp("units_sold").alias("std_weekly"),
    )
    total = sums.agg(F.sum("total_units")).scalar()
    share = F.round(F.try_divide(F.col("total_units"), total) * 100, 1)
    return sums.withColumn("pct_of_total", share).orderBy(F.col("total_units").desc(), "category")


def share_of_total(frame, key, value):
    """Each key's share of the grand total."""
    sums = frame.groupBy(key).agg(F.sum(value).alias(value))
    total = sums.agg(F.sum(value)).scalar()
    return sums.withColumn("share", F.try_divide(F.col(value), total))


def cardinalities(frame, columns):
    """Distinct values per column.

    Rows first shrink to their distinct combinations, then each (column, value) pair
    is counted once, so no column's values gather in a single task.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])).alias("cell")
    return (
        frame.select(*columns).distinct().select(cells).select("cell.*").distinct()
        .groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    )


def distinct_values(frame, column):
    return frame.select(column).distinct().orderBy(column)


def skus_per_category(frame):
    return (
        frame.select("category", "sku").distinct().groupBy("category")
        .agg(F.count("sku").alias("sku_count")).orderBy(F.col("sku_count").desc(), "category")
    )


def extent(frames):
    """Rows and first and last date of each (name, frame, date column)."""
    parts = [
        frame.agg(F.count("*").alias("row_count"), F.min(date).alias("first_date"),
                  F.max(date).alias("last_date")).select(F.lit(name).alias("input"), "*")
        for name, frame, date in frames
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_counts(tables):
    """Rows per table, as one small frame."""
    parts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def region_category_matrix(frame):
    """Units by region and category, raw and scaled to 0..1 within each category."""
    sums = (
        frame.groupBy("region").pivot("category", list(K.CATEGORIES)).agg(F.sum("units_sold"))
    )
    ends = sums.agg(*[f(c).alias(f"{c}_{n}") for c in K.CATEGORIES
                      for n, f in (("min", F.min), ("max", F.max))])
    scaled = {
        f"{c}_scaled": F.try_divide(
            F.col(c) - ends.select(f"{c}_min").scalar(),
            ends.select(f"{c}_max").scalar() - ends.select(f"{c}_min").scalar(),
        ) for c in K.CATEGORIES
    }
    return sums.withColumns(scaled).orderBy("region")


def monthly_mean(weekly):
    return (
        weekly.groupBy(S.month_start("week").alias("month_start"))
        .agg(F.avg("units_sold").alias("mean_units")).orderBy("month_start")
    )


def yearly_profile(weekly, sku):
    """Units of one SKU by year and ISO week, one row per series week."""
    return (
        weekly.filter(F.col("sku") == sku)
        .select("year", "week_number", "channel", "region", "week", "units_sold")
        .orderBy("week", "channel", "region")
    )


def season_means(weekly):
    return (
        weekly.groupBy(S.season_label().alias("season"))
        .agg(F.avg("units_sold").alias("mean_units"))
        .orderBy(F.col("mean_units").desc(), "season")
    )


def steady_mean(column):
    """Mean that does not move with the order of rows, also where values are fractions.

    Multiples of 2^-20 add without rounding up to 2^33 (every double beyond is one); what is left of
    each value is so small that its own rounding does not reach the last digit of the sum.
    """
    value, steps, most = F.col(column).cast("double"), F.lit(2.0**20), F.lit(2.0**33)
    rest = F.when(F.abs(value) < most, value - F.rint(value * steps) / steps).otherwise(0.0)
    return F.try_divide(F.sum(value - rest) + F.sum(rest), F.count(value))


def series_statistics(weekly):
    """Distribution of units and means of the other inputs per series."""
    return weekly.groupBy(*K.SERIES).agg(
        steady_mean("units_sold").alias("mean_us"), F.stddev_samp("units_sold").alias("std_us"),
        F.min("units_sold").alias("min_us"), F.max("units_sold").alias("max_us"),
        steady_mean("price_unit").alias("mean_price"), steady_mean("stock_available").alias("mean_stock"),
        steady_mean("delivery_days").alias("mean_dd"), F.max("sku_age").alias("max_sku_age"),
        F.max("week").alias("latest_week"),
    )


def seasonality_factors(weekly):
    """Month mean over the mean of month means per series (at most 12 rows a series)."""
    from shelfcast.operators.windows import whole_series

    monthly = weekly.groupBy(*K.SERIES, "month").agg(F.avg("units_sold").alias("month_mean"))
    overall = F.avg("month_mean").over(whole_series())
    factor = F.coalesce(F.try_divide(F.col("month_mean"), overall), F.lit(1.0))
    return monthly.select(*K.SERIES, "month", factor.alias("seasonality_factor"))
