"""Filters, predicates and scalar functions."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models.folds import make_folds
from shelfcast.models.horizon import as_arrays, flatten_arrays
from shelfcast.operators import alerts, analytics, cleaning, features
from shelfcast.operators.windows import recent_history
from shelfcast.plans import jobs
from shelfcast.queries.registry import query
from shelfcast.sources.star_tables import LOG_AS_OF

DAILY_DOUBLES = "price_unit stock_available delivered_qty units_sold"
PANEL_DOUBLES = (
    "units_sold stock_available price_unit delivery_days lag_1 lag_2 rolling_mean_4 "
    "rolling_std_4 momentum target_next_week"
)


# --- filters and predicates -----------------------------------------------
@query("b1_clean_daily", "SELECT *, units_sold < 0 AS is_return FROM daily", DAILY_DOUBLES)
def b1(t):
    return cleaning.clean_daily_data(t.daily)


@query("b1_unreadable_dates", """
    SELECT COUNT(*) AS row_count, COUNT(*) FILTER (promotion_flag = 1) AS unreadable,
      COUNT(*) FILTER (units_sold < 0) AS returns FROM daily
""")
def b1_dates(t):
    text = F.when(F.col("promotion_flag") == 1, "2024-13-45").otherwise(F.col("date").cast("string"))
    return cleaning.clean_daily_data(t.daily.withColumn("date", text)).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("date").isNull()).alias("unreadable"),
        F.count_if("is_return").alias("returns"),
    )


@query("b2_violation_counts", """
    SELECT COUNT(*) FILTER (category = 'Juice' OR channel NOT IN ('Retail', 'Discount', 'E-commerce')
        OR region NOT IN ('PL-Central', 'PL-North', 'PL-South')) AS unknown_enums,
      COUNT(*) FILTER (CASE WHEN promotion_flag = 1 THEN 0 ELSE price_unit END <= 1e-6)
        AS non_positive_price,
      COUNT(*) FILTER (delivery_days + 1 NOT BETWEEN 1 AND 5) AS delivery_out_of_range
    FROM daily
""")
def b2(t):
    spoiled = t.daily.withColumns({
        "category": F.when(F.col("category") == "Juice", "Soup").otherwise(F.col("category")),
        "price_unit": F.when(F.col("promotion_flag") == 1, 0.0).otherwise(F.col("price_unit")),
        "delivery_days": F.col("delivery_days") + 1,
    })
    return cleaning.count_violations(spoiled)


@query("b3_date_range_and_category", """
    SELECT sku, sale_date, channel, region, units_sold, category
    FROM daily_sales JOIN products USING (sku)
    WHERE sale_date BETWEEN DATE '1997-02-01' AND DATE '1997-04-30' AND category = 'Milk'
""", "units_sold")
def b3(t):
    period = analytics.in_period(t.daily_sales, t.products, "1997-02-01", "1997-04-30", "Milk")
    return period.select("sku", "sale_date", "channel", "region", "units_sold", "category")


@query("b4_one_series", """
    SELECT * FROM weekly WHERE sku = 'BR-011' AND channel = 'Retail' AND region = 'PL-North'
""", PANEL_DOUBLES)
def b4(t):
    return alerts.filter_alerts(t.weekly, "BR-011", "Retail", "PL-North")


@query("b6_eligible_predictions", """
    SELECT sku, channel, region, forecast_week, predicted_units, category
    FROM prediction_log JOIN products USING (sku)
    WHERE forecast_week <= DATE '2001-10-01' - 7
""", "predicted_units")
def b6(t):
    return jobs.eligible_predictions(t.prediction_log, t.products, LOG_AS_OF).select(
        *K.SERIES, "forecast_week", "predicted_units", "category"
    )


@query("b7_member_filter", """
    SELECT COUNT(*) AS fact_rows FROM daily_sales WHERE sku IN (SELECT sku FROM template)
      AND date_trunc('week', sale_date) IN (SELECT week FROM template)
""")
def b7(t):
    keys = t.template.select(F.col("week").alias("forecast_week"), "sku")
    facts = jobs.facts_of_weeks(t.daily_sales_by_month, keys.select("forecast_week").distinct())
    return (
        facts.join(keys.select("sku").distinct(), "sku", "left_semi")
        .agg(F.count("*").alias("fact_rows"))
    )


@query("b8_positive_demand", """
    SELECT COUNT(*) AS row_count, SUM(units_sold) AS units FROM weekly
    WHERE rolling_mean_4 IS NOT NULL AND rolling_mean_4 > 0
""", "units")
def b8(t):
    return t.weekly.filter(F.col("rolling_mean_4") > 0).agg(
        F.count("*").alias("row_count"), F.sum("units_sold").alias("units")
    )


@query("b9_rows_with_target", """
    SELECT sku, COUNT(*) AS row_count, SUM(target_next_week) AS target FROM weekly
    WHERE target_next_week IS NOT NULL GROUP BY sku
""", "target")
def b9(t):
    return features.build_training_features(t.weekly, carry=("sku",)).groupBy("sku").agg(
        F.count("*").alias("row_count"), F.sum("target").alias("target")
    )


@query("b10_temporal_slices", """
    SELECT 'train' AS role, COUNT(*) AS row_count, MIN(week) AS first_week, MAX(week) AS last_week
    FROM weekly WHERE week <= DATE '1998-06-01' UNION ALL
    SELECT 'test', COUNT(*), MIN(week), MAX(week) FROM weekly
    WHERE week BETWEEN DATE '1998-06-08' AND DATE '1998-06-29'
""")
def b10(t):
    role = F.when(F.col("week") <= "1998-06-01", "train").when(
        F.col("week").between("1998-06-08", "1998-06-29"), "test"
    )
    return t.weekly.withColumn("role", role).dropna(subset=["role"]).groupBy("role").agg(
        F.count("*").alias("row_count"), F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    )


@query("b11_feature_projection", """
    SELECT sku, week, channel, region, COALESCE(target_next_week, 0) * 0 AS lifecycle_encoded,
      lag_1, price_unit, CAST(year AS DOUBLE) AS year
    FROM weekly
""", "lifecycle_encoded lag_1 price_unit year")
def b11(t):
    picked = features.as_features(t.weekly, ("lag_1", "price_unit", "year", "lifecycle_encoded"))
    return t.weekly.select(*K.WEEKLY_KEY, *picked)


# --- scalar functions -----------------------------------------------------
@query("d1_safe_divide", """
    SELECT sku, week, channel, region,
      CASE WHEN momentum IS NULL OR abs(momentum) < 1e-12 THEN -1
        ELSE stock_available / momentum END AS ratio
    FROM weekly
""", "ratio")
def d1(t):
    return t.weekly.select(
        *K.WEEKLY_KEY, S.safe_divide("stock_available", "momentum", -1.0).alias("ratio")
    )


@query("d2_week_start", """
    SELECT date, CAST(date_trunc('week', date) AS DATE) AS week_start, COUNT(*) AS row_count
    FROM daily GROUP BY 1, 2
""")
def d2(t):
    return t.daily.groupBy("date", S.week_start("date").alias("week_start")).agg(
        F.count("*").alias("row_count")
    )


@query("d3_month_start", """
    SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, COUNT(*) AS row_count
    FROM daily GROUP BY 1
""")
def d3(t):
    return t.daily.groupBy(S.month_start("date").alias("month_start")).agg(
        F.count("*").alias("row_count")
    )


@query("d4_calendar_parts", """
    SELECT DISTINCT week, week_number, month, year FROM weekly_aged
""")
def d4(t):
    parts = S.calendar_columns()
    return t.weekly_base.select("week").distinct().withColumns(
        {c: parts[c] for c in ("week_number", "month", "year")}
    )


@query("d5_calendar_flags", """
    SELECT DISTINCT week, is_holiday_week, is_holiday_peak, is_summer, is_winter FROM weekly_aged
""")
def d5(t):
    parts = S.calendar_columns()
    return t.weekly_base.select("week").distinct().withColumns(
        {c: parts[c] for c in ("is_holiday_week", "is_holiday_peak", "is_summer", "is_winter")}
    )


ENCODED_SQL = """
      CASE lifecycle_stage WHEN 'Decline' THEN 0 WHEN 'Mature' THEN 1 WHEN 'Growth' THEN 2 ELSE 1
        END AS lifecycle_encoded,
      CASE channel WHEN 'Discount' THEN 0 WHEN 'Retail' THEN 1 WHEN 'E-commerce' THEN 2 ELSE 1
        END AS channel_encoded,
      CASE region WHEN 'PL-South' THEN 0 WHEN 'PL-Central' THEN 1 WHEN 'PL-North' THEN 2 ELSE 1
        END AS region_encoded"""


@query("d6_encodings", f"""
    SELECT lifecycle_stage, channel, region, {ENCODED_SQL}, COUNT(*) AS row_count
    FROM weekly GROUP BY 1, 2, 3
""")
def d6(t):
    counts = t.weekly.groupBy("lifecycle_stage", "channel", "region").agg(
        F.count("*").alias("row_count")
    )
    return counts.withColumns(features.encoded_features())


@query("d7_category_from_prefix", """
    SELECT concat(CASE WHEN pack_type = 'Carton' THEN 'ZZ' ELSE upper(substr(category, 1, 2)) END,
        substr(sku, 3)) AS sku, CASE WHEN pack_type <> 'Carton' THEN category END AS category
    FROM products
""")
def d7(t):
    prefix = F.when(F.col("pack_type") == "Carton", "ZZ").otherwise(
        F.upper(F.substring("category", 1, 2))
    )
    return cleaning.add_category(
        t.products.select(F.concat(prefix, F.substring("sku", 3, 10)).alias("sku"))
    )


@query("d8_promo_rate_and_deliveries", """
    SELECT promotion_flag, least(1.0, greatest(0.0, promotion_flag)) AS promo_rate,
      CASE WHEN delivered_qty > 0 THEN 1 ELSE 0 END AS deliveries, COUNT(*) AS row_count
    FROM weekly_base GROUP BY ALL
""", "promo_rate")
def d8(t):
    marked = t.weekly_base.withColumns({
        "promo_rate": S.promo_rate(), "deliveries": S.delivery_indicator(t.weekly_base.columns)
    })
    return marked.groupBy("promotion_flag", "promo_rate", "deliveries").agg(
        F.count("*").alias("row_count")
    )


@query("d9_revenue", "SELECT sku, SUM(units_sold * price_unit) AS revenue FROM daily GROUP BY sku",
       "revenue", digits=2)
def d9(t):
    return t.daily.groupBy("sku").agg(F.sum(S.revenue()).alias("revenue"))


@query("d10_stock_to_demand", """
    SELECT sku, week, channel, region, CASE WHEN abs(rolling_mean_4) < 1e-12 THEN 0
      ELSE stock_available / rolling_mean_4 END AS stock_to_demand_ratio
    FROM weekly
""", "stock_to_demand_ratio")
def d10(t):
    return t.weekly.select(*K.WEEKLY_KEY, features.stock_ratio().alias("stock_to_demand_ratio"))


@query("d11_price_against_category", """
    SELECT sku, week, channel, region, price_unit / AVG(price_unit) OVER (PARTITION BY category)
      AS price_vs_category_avg
    FROM weekly_cat
""", "price_vs_category_avg")
def d11(t):
    return features.add_derived_features(t.weekly_categorised).select(
        *K.WEEKLY_KEY, "price_vs_category_avg"
    )


@query("d11_price_against_whole_frame", """
    SELECT sku, week, channel, region, price_unit / AVG(price_unit) OVER () AS price_vs_category_avg
    FROM weekly
""", "price_vs_category_avg")
def d11_whole(t):
    return features.add_derived_features(t.weekly).select(*K.WEEKLY_KEY, "price_vs_category_avg")


@query("d12_bracketed_interval", """
    SELECT sku, week, channel, region, least(lag_1 - 5, rolling_mean_4) AS lower,
      greatest(lag_2 + 5, rolling_mean_4) AS upper
    FROM weekly
""", "lower upper")
def d12(t):
    lower, upper = S.bracket("rolling_mean_4", F.col("lag_1") - 5, F.col("lag_2") + 5)
    return t.weekly.select(*K.WEEKLY_KEY, lower.alias("lower"), upper.alias("upper"))


@query("d13_season_label", """
    SELECT DISTINCT week, CASE
      WHEN is_holiday_week = 1 AND is_summer = 0 AND is_winter = 0 THEN 'holiday'
      WHEN is_holiday_week = 0 AND is_summer = 1 AND is_winter = 0 THEN 'summer'
      WHEN is_holiday_week = 0 AND is_summer = 0 AND is_winter = 1 THEN 'winter'
      ELSE 'shoulder' END AS season
    FROM weekly
""")
def d13(t):
    return t.weekly.select("week", S.season_label().alias("season")).distinct()


@query("d14_model_names", """
    SELECT DISTINCT category, concat('forecaster_', lower(replace(category, ' ', '_'))) AS model
    FROM products
""")
def d14(t):
    return t.products.select("category", S.model_name().alias("model")).distinct()


@query("d15_validators", """
    SELECT COUNT(*) FILTER (regexp_full_match(sku, '[A-Z]{2}-[0-9]{3}')) AS valid_skus,
      COUNT(*) FILTER (regexp_full_match(brand, '[A-Z]{2}-[0-9]{3}')) AS valid_brands,
      COUNT(*) FILTER (channel IN ('Retail', 'Discount', 'E-commerce')) AS valid_channels
    FROM daily
""")
def d15(t):
    return t.daily.agg(
        F.count_if(S.valid_sku()).alias("valid_skus"),
        F.count_if(S.valid_sku("brand")).alias("valid_brands"),
        F.count_if(~S.not_in("channel", K.CHANNELS)).alias("valid_channels"),
    )


@query("d16_forecast_arrays_flattened", """
    SELECT sku, channel, region, forecast_week AS week, predicted_units, confidence_lower,
      confidence_upper, CAST(row_number() OVER (
        PARTITION BY sku, channel, region ORDER BY forecast_week) - 1 AS INT) AS position
    FROM prediction_log
""", "predicted_units confidence_lower confidence_upper")
def d16(t):
    forecast = t.prediction_log.select(
        *K.SERIES, F.col("forecast_week").alias("week"), F.col("predicted_units").alias("point"),
        F.col("confidence_lower").alias("lower"), F.col("confidence_upper").alias("upper"),
    )
    return flatten_arrays(as_arrays(forecast))


@query("d17_array_lengths", """
    SELECT sku, channel, region, COUNT(*) = COUNT(target_next_week) AS same_length
    FROM weekly GROUP BY 1, 2, 3
""")
def d17(t):
    recent = t.weekly.groupBy(*K.SERIES).agg(
        F.collect_list("week").alias("weeks"), F.collect_list("target_next_week").alias("targets")
    )
    return recent.select(*K.SERIES, S.same_length("weeks", "targets").alias("same_length"))


@query("d18_json_round_trip", """
    SELECT sku, channel, region, AVG(price_unit) AS mean, stddev_samp(price_unit) AS std
    FROM weekly GROUP BY 1, 2, 3
""", "mean std")
def d18(t):
    measured = t.weekly.groupBy(*K.SERIES).agg(
        F.to_json(F.struct(F.avg("price_unit").alias("mean"),
                           F.stddev_samp("price_unit").alias("std"))).alias("document")
    )
    parsed = F.from_json("document", "mean double, std double")
    return measured.select(*K.SERIES, parsed.alias("p")).select(*K.SERIES, "p.mean", "p.std")


@query("d19_formatted_numbers", """
    SELECT sku, week, channel, region, printf('%.1f', rolling_mean_4) AS one,
      printf('%.2f', rolling_std_4) AS two
    FROM weekly
""")
def d19(t):
    return t.weekly.select(
        *K.WEEKLY_KEY, S.fixed_text("rolling_mean_4", 1).alias("one"),
        S.fixed_text("rolling_std_4", 2).alias("two"),
    )


@query("d20_text_to_number", """
    SELECT sku, SUM(TRY_CAST(CASE WHEN promotion_flag = 1 THEN 'n/a'
      ELSE CAST(units_sold AS VARCHAR) END AS DOUBLE)) AS units, COUNT(*) AS row_count
    FROM daily GROUP BY sku
""", "units")
def d20(t):
    text = F.when(F.col("promotion_flag") == 1, "n/a").otherwise(F.col("units_sold").cast("string"))
    return t.daily.withColumn("text", text).groupBy("sku").agg(
        F.sum(S.to_number("text")).alias("units"), F.count("*").alias("row_count")
    )


@query("d21_date_arithmetic", """
    SELECT DISTINCT week, week + 7 AS next_week, week + 28 AS four_weeks_on, week - 14 AS two_weeks_ago
    FROM weekly
""")
def d21(t):
    return t.weekly.select("week").distinct().select(
        "week", F.date_add("week", 7).alias("next_week"),
        F.date_add("week", 28).alias("four_weeks_on"), F.date_sub("week", 14).alias("two_weeks_ago"),
    )


# --- series windows -------------------------------------------------------
LAG_DOUBLES = "units_sold lag_1 lag_2 rolling_mean_4 rolling_std_4 momentum"


@query("f1_lags", """
    SELECT sku, week, channel, region, lag_1, lag_2 FROM weekly_lagged
""", "lag_1 lag_2")
def f1(t):
    from shelfcast.operators.windows import add_lags

    return add_lags(t.weekly_base).select(*K.WEEKLY_KEY, "lag_1", "lag_2")


@query("f2_rolling", """
    SELECT sku, week, channel, region, rolling_mean_4, rolling_std_4 FROM weekly_lagged
""", "rolling_mean_4 rolling_std_4")
def f2(t):
    from shelfcast.operators.windows import add_lags

    return add_lags(t.weekly_base).select(*K.WEEKLY_KEY, "rolling_mean_4", "rolling_std_4")


@query("f3_momentum", "SELECT sku, week, channel, region, momentum FROM weekly_lagged", "momentum")
def f3(t):
    from shelfcast.operators.windows import add_lags

    return add_lags(t.weekly_base).select(*K.WEEKLY_KEY, "momentum")


@query("f4_filled_lags", """
    SELECT sku, week, channel, region, lag_1, lag_2, rolling_mean_4, rolling_std_4, momentum
    FROM weekly
""", "lag_1 lag_2 rolling_mean_4 rolling_std_4 momentum")
def f4(t):
    from shelfcast.operators.windows import add_lags, fill_series

    return fill_series(add_lags(t.weekly_base), K.LAG_COLUMNS).select(
        *K.WEEKLY_KEY, *K.LAG_COLUMNS
    )


@query("f5_weekly_lag_features", "SELECT * FROM weekly", PANEL_DOUBLES)
def f5(t):
    return t.weekly_computed


@query("f5_invalid_lifecycle", """
    SELECT COUNT(*) FILTER (lifecycle_stage = 'Mature') AS bad_row_count FROM weekly
""")
def f5_invalid(t):
    from shelfcast.operators.windows import invalid_lifecycle_rows

    renamed = F.when(F.col("lifecycle_stage") != "Mature", F.col("lifecycle_stage"))
    return invalid_lifecycle_rows(t.weekly.withColumn("lifecycle_stage", renamed))


@query("f6_previous_promotion", """
    SELECT sku, week, channel, region, COALESCE(lag(promotion_flag) OVER (
      PARTITION BY sku, channel, region ORDER BY week), 0) AS promo_lag_1
    FROM weekly
""")
def f6(t):
    from shelfcast.operators.windows import previous_promotion

    return t.weekly.select(*K.WEEKLY_KEY, previous_promotion().alias("promo_lag_1"))


GAPPY = "CASE WHEN is_holiday_week = 1 OR week < DATE '1995-03-01' THEN NULL ELSE price_unit END"


@query("f7_series_fill", f"""
    SELECT sku, week, channel, region, COALESCE(
      last_value(p IGNORE NULLS) OVER (PARTITION BY sku, channel, region ORDER BY week
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(p IGNORE NULLS) OVER (PARTITION BY sku, channel, region ORDER BY week
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS price_unit
    FROM (SELECT *, {GAPPY} AS p FROM weekly)
""", "price_unit")
def f7(t):
    from shelfcast.operators.windows import fill_series

    gappy = t.weekly.select(*K.WEEKLY_KEY, F.expr(GAPPY).alias("price_unit"))
    return fill_series(gappy, ["price_unit"])


@query("f8_series_means", """
    SELECT sku, week, channel, region,
      AVG(price_unit) OVER (PARTITION BY sku, channel, region) AS price_avg,
      AVG(stock_available) OVER (PARTITION BY sku, channel, region) AS stock_avg
    FROM weekly
""", "price_avg stock_avg")
def f8(t):
    from shelfcast.operators.windows import whole_series

    return t.weekly.select(
        *K.WEEKLY_KEY, F.avg("price_unit").over(whole_series()).alias("price_avg"),
        F.avg("stock_available").over(whole_series()).alias("stock_avg"),
    )


@query("f9_percent_change", """
    SELECT category, month, (u - lag(u) OVER w) / nullif(lag(u) OVER w, 0) * 100 AS delta_pct
    FROM (SELECT category, CAST(date_trunc('month', date) AS DATE) AS month, SUM(units_sold) AS u
          FROM daily GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY category ORDER BY month)
""", "delta_pct")
def f9(t):
    from shelfcast.operators.windows import change_to_previous

    monthly = t.daily.groupBy("category", S.month_start("date").alias("month")).agg(
        F.sum("units_sold").alias("u")
    )
    change = change_to_previous(monthly, "u", "category", "month")
    return monthly.select("category", "month", change.alias("delta_pct"))


@query("f10_latest_sku_metadata", """
    SELECT DISTINCT sku, lifecycle_stage, sku_age FROM weekly
    QUALIFY week = MAX(week) OVER (PARTITION BY sku)
""")
def f10(t):
    from shelfcast.operators.windows import latest_sku_metadata

    return latest_sku_metadata(t.weekly)


@query("f11_recent_history", """
    SELECT * FROM weekly QUALIFY row_number() OVER (
      PARTITION BY sku, channel, region ORDER BY week DESC) <= 26
""", PANEL_DOUBLES)
def f11(t):
    return recent_history(t.weekly)


@query("f12_last_rows", """
    SELECT * FROM weekly QUALIFY row_number() OVER (
      PARTITION BY sku, channel, region ORDER BY week DESC) = 1
""", PANEL_DOUBLES)
def f12(t):
    from shelfcast.operators.windows import last_rows

    return last_rows(t.weekly)


@query("f13_growth_deltas", """
    WITH m AS (SELECT category, date_trunc('month', week) AS p, SUM(units_sold) AS u
               FROM weekly_cat GROUP BY 1, 2),
    l AS (SELECT DISTINCT p FROM m ORDER BY p DESC LIMIT 2)
    SELECT category, COALESCE(SUM(u) FILTER (p = (SELECT MIN(p) FROM l)), 0) AS previous,
      COALESCE(SUM(u) FILTER (p = (SELECT MAX(p) FROM l)), 0) AS current,
      100.0 * (COALESCE(SUM(u) FILTER (p = (SELECT MAX(p) FROM l)), 0)
        - COALESCE(SUM(u) FILTER (p = (SELECT MIN(p) FROM l)), 0))
        / COALESCE(SUM(u) FILTER (p = (SELECT MIN(p) FROM l)), 0) AS delta_pct
    FROM m GROUP BY category
""", "previous current delta_pct")
def f13(t):
    from shelfcast.operators.insights import growth_deltas

    return growth_deltas(t.weekly_categorised)


@query("f14_share_of_total", """
    SELECT category, SUM(units_sold) AS units_sold,
      SUM(units_sold) / (SELECT SUM(units_sold) FROM weekly) AS share
    FROM weekly_cat GROUP BY category
""", "units_sold share")
def f14(t):
    return analytics.share_of_total(t.weekly_categorised, "category", "units_sold")


@query("f15_next_week_target", """
    SELECT sku, week, channel, region, target_next_week FROM weekly
""", "target_next_week")
def f15(t):
    from shelfcast.operators.windows import next_week_target

    return next_week_target(t.weekly_base).select(*K.WEEKLY_KEY, "target_next_week")


@query("f16_series_positions", """
    SELECT sku, week, channel, region, CAST(sku_age + row_number() OVER (
      PARTITION BY sku, channel, region ORDER BY week) - 1 AS INT) AS position
    FROM weekly
""")
def f16(t):
    from shelfcast.operators.windows import positions

    return t.weekly.select(*K.WEEKLY_KEY, positions("sku_age").alias("position"))


@query("k13_fold_boundaries", """
    WITH w AS (
      SELECT category, week, row_number() OVER (PARTITION BY category ORDER BY week) AS i,
        COUNT(*) OVER (PARTITION BY category) AS n
      FROM (SELECT DISTINCT category, week FROM weekly_cat))
    SELECT category, CAST(f AS INT) AS fold, MAX(week) FILTER (i = 100 + 4 * (f - 1)) AS train_cut,
      MAX(week) FILTER (i = 101 + 4 * (f - 1)) AS test_start,
      MAX(week) FILTER (i = 104 + 4 * (f - 1)) AS test_end
    FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS f)
    WHERE f <= greatest(1, least(5, (n - 100) // 4)) AND 100 + 4 * f <= n
    GROUP BY category, f
""")
def k13(t):
    return make_folds(t.weekly_categorised)
