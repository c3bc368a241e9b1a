"""Weekly aggregation, sales analytics, rankings and joins."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators import analytics as A
from shelfcast.operators import behaviour, quantiles
from shelfcast.operators import weekly as W
from shelfcast.operators.fingerprint import combined, fingerprint, fingerprint_parts
from shelfcast.plans import jobs
from shelfcast.queries.registry import query

START, END = "1996-01-01", "1998-12-31"


@query("e1_weekly_aggregate", "SELECT * FROM weekly_base",
       "units_sold delivered_qty stock_available price_unit delivery_days")
def e1(t):
    return W.aggregate_to_weekly(t.daily)


@query("e2_batch_weekly", """
    SELECT sku, channel, region, CAST(date_trunc('week', date) AS DATE) AS week, category, brand,
      segment, pack_type, SUM(units_sold) AS units_sold, MAX(stock_available) AS stock_available,
      MAX(promotion_flag) AS promotion_flag, AVG(price_unit) AS price_unit,
      AVG(delivery_days) AS delivery_days,
      CAST(weekofyear(date_trunc('week', date)) AS INT) AS week_number,
      CAST(month(date_trunc('week', date)) AS INT) AS month,
      CAST(year(date_trunc('week', date)) AS INT) AS year
    FROM daily GROUP BY ALL
""", "units_sold stock_available price_unit delivery_days")
def e2(t):
    return W.resample_weekly(t.daily)


@query("e3_template_weekly", """
    SELECT week, AVG(avg_temp) AS avg_temp, AVG(inflation_index) AS inflation_index,
      MAX(school_in_session) AS school_in_session, AVG(category_trend) AS category_trend,
      AVG(event_score) AS event_score
    FROM template GROUP BY week
""", "avg_temp inflation_index category_trend event_score")
def e3(t):
    return W.template_weekly(t.template)


ENRICHED_SQL = """
    SELECT b.*,
      AVG(price_unit) OVER (PARTITION BY sku, channel, region) AS price_avg,
      CAST(least(1.0, greatest(0.0, promotion_flag)) AS DOUBLE) AS promo_rate,
      AVG(stock_available) OVER (PARTITION BY sku, channel, region) AS stock_avg,
      CASE WHEN delivered_qty > 0 THEN 1 ELSE 0 END AS deliveries,
      COALESCE(tw.avg_temp, (SELECT AVG(avg_temp) FROM template)) AS avg_temp,
      COALESCE(tw.inflation_index, (SELECT AVG(inflation_index) FROM template)) AS inflation_index,
      CAST(COALESCE(tw.school, (SELECT school_in_session FROM template GROUP BY 1
        ORDER BY COUNT(*) DESC, school_in_session LIMIT 1)) AS INT) AS school_in_session,
      COALESCE(tw.category_trend, (SELECT AVG(category_trend) FROM template)) AS category_trend,
      COALESCE(tw.event_score, (SELECT AVG(event_score) FROM template)) AS event_score
    FROM weekly_base b LEFT JOIN (
      SELECT week, AVG(avg_temp) AS avg_temp, AVG(inflation_index) AS inflation_index,
        MAX(school_in_session) AS school, AVG(category_trend) AS category_trend,
        AVG(event_score) AS event_score
      FROM template GROUP BY week
    ) tw USING (week)
"""
ENRICHED_DOUBLES = (
    "units_sold delivered_qty stock_available price_unit delivery_days price_avg promo_rate "
    "stock_avg avg_temp inflation_index category_trend event_score"
)


@query("e4_enriched_weekly", ENRICHED_SQL, ENRICHED_DOUBLES)
def e4(t):
    return W.enrich_features(t.weekly_base, t.template)


def _register_units_by():
    for dimension in ("category", "channel", "region"):
        for period, grain in (("weekly", "week"), ("monthly", "month")):
            def build(t, dimension=dimension, period=period):
                return A.units_by(t.weekly_categorised, dimension, period)

            query(f"e5_{period}_units_by_{dimension}", f"""
                SELECT {dimension}, CAST(date_trunc('{grain}', week) AS DATE) AS period,
                  SUM(units_sold) AS units_sold
                FROM weekly_cat GROUP BY 1, 2
            """, "units_sold")(build)


_register_units_by()


@query("e6_promo_impact", """
    SELECT sku, non_promo_avg, promo_avg,
      CASE WHEN non_promo_avg = 0 THEN 0.0
        ELSE 100.0 * (promo_avg - non_promo_avg) / non_promo_avg END AS promo_lift_pct
    FROM (
      SELECT sku, COALESCE(AVG(units_sold) FILTER (promotion_flag = 0), 0) AS non_promo_avg,
        COALESCE(AVG(units_sold) FILTER (promotion_flag = 1), 0) AS promo_avg
      FROM weekly GROUP BY sku
    )
""", "non_promo_avg promo_avg promo_lift_pct")
def e6(t):
    return A.promo_impact(t.weekly)


MODAL_SQL = """
    SELECT sku, lifecycle_stage FROM (
      SELECT sku, lifecycle_stage,
        row_number() OVER (PARTITION BY sku ORDER BY COUNT(*) DESC, lifecycle_stage) AS rn
      FROM weekly GROUP BY sku, lifecycle_stage
    ) WHERE rn = 1
"""


@query("e7_lifecycle_modal", f"""
    SELECT COUNT(*) FILTER (lifecycle_stage = 'Growth') AS growth,
      COUNT(*) FILTER (lifecycle_stage = 'Mature') AS mature,
      COUNT(*) FILTER (lifecycle_stage = 'Decline') AS decline
    FROM ({MODAL_SQL})
""")
def e7(t):
    return A.lifecycle_distribution(t.weekly)


@query("e8_lifecycle_membership", """
    SELECT COUNT(DISTINCT sku) FILTER (lifecycle_stage = 'Growth') AS growth,
      COUNT(DISTINCT sku) FILTER (lifecycle_stage = 'Mature') AS mature,
      COUNT(DISTINCT sku) FILTER (lifecycle_stage = 'Decline') AS decline
    FROM weekly
""")
def e8(t):
    return A.lifecycle_membership(t.weekly)


@query("e9_seasonality", """
    SELECT MAX(m) AS max_monthly, MIN(m) AS min_monthly,
      CASE WHEN MIN(m) = 0 THEN 1.0 ELSE MAX(m) / MIN(m) END AS seasonality_strength
    FROM (SELECT AVG(units_sold) AS m FROM weekly WHERE sku = 'BR-011' GROUP BY month)
""", "max_monthly min_monthly seasonality_strength")
def e9(t):
    return A.seasonality(t.weekly, "BR-011")


@query("e9_seasonality_unknown_sku",
       "SELECT 0.0 AS max_monthly, 0.0 AS min_monthly, 1.0 AS seasonality_strength "
       "WHERE NOT EXISTS (SELECT 1 FROM weekly WHERE sku = 'ZZ-999')",
       "max_monthly min_monthly seasonality_strength")
def e9_unknown(t):
    return A.seasonality(t.weekly, "ZZ-999")


CORRELATED = ("units_sold", "lag_1", "lag_2", "rolling_mean_4", "rolling_std_4", "momentum",
              "price_unit", "stock_available", "promotion_flag", "target_next_week")


def _correlation_sql(columns):
    rows = [
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", corr({a}, {b}) AS corr FROM weekly"
        for a in columns for b in columns
    ]
    return f"""SELECT "left", "right",
      CASE WHEN corr IS NULL OR isnan(corr) THEN 0 ELSE corr END AS corr
      FROM ({' UNION ALL '.join(rows)})"""


@query("e10_correlations", _correlation_sql(CORRELATED), "corr")
def e10(t):
    return A.correlations(t.weekly.select(*CORRELATED))


@query("e10_ranked_correlations", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, target_next_week) AS corr FROM weekly"
    for c in CORRELATED if c != "target_next_week"), "corr")
def e10_ranked(t):
    return A.ranked_correlations(t.weekly, CORRELATED, "target_next_week")


@query("e11_channel_comparison_means", """
    SELECT channel, total_units_sold, avg_price_unit, 100.0 * (p - b) / b AS promo_lift_pct FROM (
      SELECT channel, SUM(units_sold) AS total_units_sold, AVG(price_unit) AS avg_price_unit,
        AVG(units_sold) FILTER (promotion_flag = 1) AS p,
        AVG(units_sold) FILTER (promotion_flag = 0) AS b
      FROM weekly GROUP BY channel)
""", "total_units_sold avg_price_unit promo_lift_pct")
def e11(t):
    return A.channel_comparison_means(t.weekly)


@query("e12_channel_comparison_sums", """
    SELECT channel, SUM(u) AS total_units_sold, AVG(p) AS avg_price_unit,
      100.0 * (SUM(u) FILTER (promotion_flag = 1) - SUM(u) FILTER (promotion_flag = 0))
        / SUM(u) FILTER (promotion_flag = 0) AS promo_lift_pct
    FROM (SELECT channel, promotion_flag, SUM(units_sold) AS u, AVG(price_unit) AS p
          FROM daily_sales GROUP BY 1, 2)
    GROUP BY channel
""", "total_units_sold avg_price_unit promo_lift_pct")
def e12(t):
    return A.channel_comparison_sums(t.daily_sales)


@query("e13_sales_summary", f"""
    SELECT SUM(units_sold) AS total_units, SUM(units_sold * price_unit) AS total_revenue,
      COUNT(*) AS record_count
    FROM daily_sales JOIN products USING (sku)
    WHERE sale_date BETWEEN DATE '{START}' AND DATE '{END}'
""", "total_units total_revenue", digits=2)
def e13(t):
    return A.sales_summary(t.daily_sales, t.products, START, END)


@query("e13_sales_summary_of_category", f"""
    SELECT SUM(units_sold) AS total_units, SUM(units_sold * price_unit) AS total_revenue,
      COUNT(*) AS record_count
    FROM daily_sales JOIN products USING (sku)
    WHERE sale_date BETWEEN DATE '{START}' AND DATE '{END}' AND category = 'Juice'
""", "total_units total_revenue", digits=2)
def e13_category(t):
    return A.sales_summary(t.daily_sales, t.products, START, END, "Juice")


@query("e13_sales_summary_empty_period", """
    SELECT COALESCE(SUM(units_sold), 0.0) AS total_units, 0.0 AS total_revenue,
      COUNT(*) AS record_count
    FROM daily_sales WHERE sale_date < DATE '1950-01-01'
""", "total_units total_revenue")
def e13_empty(t):
    return A.sales_summary(t.daily_sales, t.products, "1900-01-01", "1949-12-31")


@query("e14_sales_breakdown", f"""
    SELECT category, SUM(units_sold) AS units_sold FROM daily_sales JOIN products USING (sku)
    WHERE sale_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY category
""", "units_sold")
def e14(t):
    return A.sales_breakdown(t.daily_sales, t.products, START, END)


RISK_SQL = """
    SELECT sku, channel, region, s AS stock_available, d AS avg_weekly_demand,
      7.0 * s / d AS days_of_supply, {days} AS threshold_days
    FROM (SELECT sku, channel, region, AVG(stock_available) AS s, AVG(rolling_mean_4) AS d
          FROM weekly WHERE rolling_mean_4 IS NOT NULL AND rolling_mean_4 > 0 GROUP BY 1, 2, 3)
    WHERE 7.0 * s / d < {days}
"""


@query("e15_inventory_risk", RISK_SQL.format(days=24),
       "stock_available avg_weekly_demand days_of_supply")
def e15(t):
    return A.inventory_risk(t.weekly, 24)


@query("e16_category_trends", """
    SELECT category, month, total_units_sold,
      (total_units_sold - lag(total_units_sold) OVER w)
        / nullif(lag(total_units_sold) OVER w, 0) * 100 AS delta_pct
    FROM (
      SELECT category, CAST(date_trunc('month', sale_date) AS DATE) AS month,
        SUM(units_sold) AS total_units_sold
      FROM daily_sales JOIN products USING (sku) GROUP BY 1, 2
      ORDER BY month DESC, category LIMIT 30)
    WINDOW w AS (PARTITION BY category ORDER BY month)
""", "total_units_sold delta_pct")
def e16(t):
    return A.category_trends(t.daily_sales, t.products, 6)


@query("e17_category_summary", """
    SELECT category, SUM(units_sold) AS total_units, AVG(units_sold) AS avg_weekly,
      stddev_samp(units_sold) AS std_weekly,
      round(SUM(units_sold) / (SELECT SUM(units_sold) FROM weekly_cat) * 100, 1) AS pct_of_total
    FROM weekly_cat GROUP BY category
""", "total_units avg_weekly std_weekly pct_of_total")
def e17(t):
    return A.category_summary(t.weekly_categorised)


DIMENSIONS = ("sku", "brand", "segment", "category", "channel", "region", "pack_type")


@query("e18_cardinalities", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values FROM daily"
    for c in DIMENSIONS))
def e18(t):
    return A.cardinalities(t.daily, DIMENSIONS)


@query("e18_distinct_segments", "SELECT DISTINCT segment FROM daily")
def e18_values(t):
    return A.distinct_values(t.daily, "segment")


@query("e18_skus_per_category",
       "SELECT category, COUNT(DISTINCT sku) AS sku_count FROM daily GROUP BY category")
def e18_skus(t):
    return A.skus_per_category(t.daily)


@query("e18_input_extent", """
    SELECT 'daily' AS input, COUNT(*) AS row_count, MIN(date) AS first_date, MAX(date) AS last_date
    FROM daily UNION ALL
    SELECT 'weekly', COUNT(*), MIN(week), MAX(week) FROM weekly UNION ALL
    SELECT 'template', COUNT(*), MIN(week), MAX(week) FROM template
""")
def e18_extent(t):
    return A.extent([("daily", t.daily, "date"), ("weekly", t.weekly, "week"),
                     ("template", t.template, "week")])


DESCRIBED_DAILY = ("price_unit", "promotion_flag", "delivery_days", "stock_available", "units_sold")
DESCRIBED_WEEKLY = ("units_sold", "lag_1", "rolling_mean_4", "rolling_std_4", "momentum",
                    "target_next_week")
DESCRIBE_DOUBLES = "mean std min p25 p50 p75 max"


def _describe_sql(table, columns):
    return " UNION ALL ".join(f"""
        SELECT '{c}' AS metric, COUNT({c}) AS count, AVG({c}) AS mean, stddev_samp({c}) AS std,
          MIN({c}) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
          quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
          quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, MAX({c}) AS max
        FROM {table}""" for c in columns)


@query("e19_describe_daily", _describe_sql("daily", DESCRIBED_DAILY), DESCRIBE_DOUBLES)
def e19_daily(t):
    return quantiles.describe(t.daily, DESCRIBED_DAILY)


@query("e19_describe_weekly", _describe_sql("weekly", DESCRIBED_WEEKLY), DESCRIBE_DOUBLES)
def e19_weekly(t):
    return quantiles.describe(t.weekly, DESCRIBED_WEEKLY)


@query("e20_channel_promotion_units", """
    SELECT channel, promotion_flag, SUM(units_sold) AS units_sold FROM daily GROUP BY 1, 2
""", "units_sold")
def e20(t):
    return A.units_by_promotion(t.daily)


LIFT_SQL = """
    SELECT {key}, b AS non_promo_avg, p AS promo_avg, (p - b) / b * 100 AS lift_pct FROM (
      SELECT {key}, AVG(units_sold) FILTER (promotion_flag = 1) AS p,
        AVG(units_sold) FILTER (promotion_flag = 0) AS b FROM {table} GROUP BY 1)
"""


@query("e20_channel_promotion_lift", LIFT_SQL.format(key="channel", table="daily"),
       "non_promo_avg promo_avg lift_pct")
def e20_lift(t):
    return A.promo_lift_by(t.daily, "channel")


def _matrix_sql():
    cells = ", ".join(
        f"SUM(units_sold) FILTER (category = '{c}') AS \"{c}\"" for c in K.CATEGORIES)
    scaled = ", ".join(
        f'("{c}" - MIN("{c}") OVER ()) / nullif(MAX("{c}") OVER () - MIN("{c}") OVER (), 0) '
        f'AS "{c}_scaled"' for c in K.CATEGORIES)
    return f"SELECT *, {scaled} FROM (SELECT region, {cells} FROM daily GROUP BY region)"


@query("e21_region_category_matrix", _matrix_sql(),
       " ".join([*K.CATEGORIES, *[f"{c}_scaled" for c in K.CATEGORIES]]))
def e21(t):
    return A.region_category_matrix(t.daily)


@query("e22_category_promotion_lift", LIFT_SQL.format(key="category", table="weekly_cat"),
       "non_promo_avg promo_avg lift_pct")
def e22(t):
    return A.promo_lift_by(t.weekly_categorised, "category")


@query("e23_stage_week_counts",
       "SELECT lifecycle_stage, COUNT(*) AS sku_weeks FROM weekly GROUP BY 1")
def e23(t):
    return A.stage_week_counts(t.weekly)


@query("e23_dominant_stages",
       f"SELECT lifecycle_stage, COUNT(*) AS skus FROM ({MODAL_SQL}) GROUP BY 1")
def e23_dominant(t):
    return A.dominant_stage_counts(t.weekly)


@query("e24_monthly_mean", """
    SELECT CAST(date_trunc('month', week) AS DATE) AS month_start, AVG(units_sold) AS mean_units
    FROM weekly GROUP BY 1
""", "mean_units")
def e24(t):
    return A.monthly_mean(t.weekly)


@query("e25_yearly_profile", """
    SELECT year, week_number, channel, region, week, units_sold FROM weekly WHERE sku = 'BR-011'
""", "units_sold")
def e25(t):
    return A.yearly_profile(t.weekly, "BR-011")


SEASON_SQL = """CASE
    WHEN is_holiday_week = 1 AND is_summer = 0 AND is_winter = 0 THEN 'holiday'
    WHEN is_holiday_week = 0 AND is_summer = 1 AND is_winter = 0 THEN 'summer'
    WHEN is_holiday_week = 0 AND is_summer = 0 AND is_winter = 1 THEN 'winter'
    ELSE 'shoulder' END"""


@query("e26_season_means",
       f"SELECT {SEASON_SQL} AS season, AVG(units_sold) AS mean_units FROM weekly GROUP BY 1",
       "mean_units")
def e26(t):
    return A.season_means(t.weekly)


ACTUALS_SQL = """
    SELECT sku, channel, region, CAST(date_trunc('week', sale_date) AS DATE) AS forecast_week,
      SUM(units_sold) AS actual_units
    FROM daily_sales
    WHERE sku IN (SELECT sku FROM prediction_log)
      AND CAST(date_trunc('week', sale_date) AS DATE) IN (SELECT forecast_week FROM prediction_log)
    GROUP BY 1, 2, 3, 4
"""


@query("e27_weekly_actuals", ACTUALS_SQL, "actual_units")
def e27(t):
    return jobs.weekly_actuals(t.daily_sales_by_month, t.prediction_log)


@query("e31_sku_behaviour", """
    SELECT f.sku, avg_weekly_demand,
      CASE WHEN abs(avg_weekly_demand) < 1e-12 THEN 0 ELSE sd / avg_weekly_demand END
        AS demand_coefficient_of_variation,
      seasonality_strength, trend_slope, promo_sensitivity,
      CASE stage WHEN 'Decline' THEN 0 WHEN 'Mature' THEN 1 WHEN 'Growth' THEN 2 ELSE 1 END
        AS lifecycle_stage_encoded,
      price / MAX(price) OVER () AS price_point_normalized
    FROM (
      SELECT sku, AVG(units_sold) AS avg_weekly_demand, stddev_samp(units_sold) AS sd,
        AVG(price_unit) AS price,
        CASE WHEN AVG(units_sold) FILTER (promotion_flag = 1) IS NULL
               OR AVG(units_sold) FILTER (promotion_flag = 0) IS NULL
               OR AVG(units_sold) FILTER (promotion_flag = 0) = 0 THEN 1.0
          ELSE AVG(units_sold) FILTER (promotion_flag = 1)
             / AVG(units_sold) FILTER (promotion_flag = 0) END AS promo_sensitivity
      FROM weekly GROUP BY sku
    ) f JOIN (
      SELECT sku, COALESCE(MAX(m) / nullif(MIN(m), 0), 1) AS seasonality_strength
      FROM (SELECT sku, month, AVG(units_sold) AS m FROM weekly GROUP BY 1, 2) GROUP BY sku
    ) s USING (sku) JOIN (
      SELECT sku, regr_slope(units_sold, i) AS trend_slope FROM (
        SELECT sku, units_sold,
          row_number() OVER (PARTITION BY sku ORDER BY week, channel, region) - 1 AS i
        FROM weekly) GROUP BY sku
    ) r USING (sku) JOIN (
""" + MODAL_SQL.replace("lifecycle_stage FROM (", "lifecycle_stage AS stage FROM (", 1) + """
    ) m USING (sku)
""", " ".join(c for c in K.CLUSTER_FEATURES if c != "lifecycle_stage_encoded"), digits=5)
def e31(t):
    return behaviour.sku_features(t.weekly)


@query("e32_trend_slope", """
    SELECT sku, COALESCE(regr_slope(units_sold, i), 0) AS trend_slope FROM (
      SELECT sku, units_sold,
        row_number() OVER (PARTITION BY sku ORDER BY week, channel, region) - 1 AS i
      FROM weekly) GROUP BY sku
""", "trend_slope", digits=6)
def e32(t):
    return behaviour.trend_slope(t.weekly)


@query("e33_promo_sensitivity", """
    SELECT sku, CASE WHEN p IS NULL OR b IS NULL OR abs(b) < 1e-12 THEN 1.0 ELSE p / b END
      AS promo_sensitivity
    FROM (SELECT sku, AVG(units_sold) FILTER (promotion_flag = 1) AS p,
            AVG(units_sold) FILTER (promotion_flag = 0) AS b FROM weekly GROUP BY sku)
""", "promo_sensitivity")
def e33(t):
    return behaviour.promo_sensitivity(t.weekly)


@query("e34_series_statistics", """
    SELECT sku, channel, region, AVG(units_sold) AS mean_us, stddev_samp(units_sold) AS std_us,
      MIN(units_sold) AS min_us, MAX(units_sold) AS max_us, AVG(price_unit) AS mean_price,
      AVG(stock_available) AS mean_stock, AVG(delivery_days) AS mean_dd,
      MAX(sku_age) AS max_sku_age, MAX(week) AS latest_week
    FROM weekly GROUP BY 1, 2, 3
""", "mean_us std_us min_us max_us mean_price mean_stock mean_dd")
def e34(t):
    return A.series_statistics(t.weekly)


SEASON_FACTOR_SQL = """
    SELECT sku, channel, region, month,
      COALESCE(m / nullif(AVG(m) OVER (PARTITION BY sku, channel, region), 0), 1)
        AS seasonality_factor
    FROM (SELECT sku, channel, region, month, AVG(units_sold) AS m FROM weekly GROUP BY 1, 2, 3, 4)
"""


@query("e35_seasonality_factors", SEASON_FACTOR_SQL, "seasonality_factor")
def e35(t):
    return A.seasonality_factors(t.weekly)


@query("e38_fingerprint")
def e38(t):
    return fingerprint(t.weekly_categorised, "category")


@query("e38_fingerprint_by_months", """
    WITH text AS (SELECT category, sha256('{"channel":"' || channel || '","lifecycle_stage":"' || lifecycle_stage
        || '","promotion_flag":' || promotion_flag || ',"region":"' || region || '","sku":"' || sku || '","sku_age":'
        || sku_age || ',"units_sold":' || CAST(CAST(units_sold AS BIGINT) AS VARCHAR) || ',"week":"' || week || '"}') AS h
      FROM weekly_cat),
    sums AS (SELECT category, COUNT(*) AS n, SUM(CAST(('0x' || h[1:15]) AS BIGINT)) AS a,
        SUM(CAST(('0x' || h[16:30]) AS BIGINT)) AS b FROM text GROUP BY category)
    SELECT category, CAST(n AS BIGINT) AS rows, sha256(n || '|' || a || '|' || b)[1:32] AS data_hash FROM sums
""")
def e38_months(t):
    """Columns whose text is the same everywhere, hashed month by month and added up."""
    rows = t.weekly_categorised.select(
        "category", "sku", "week", "channel", "region", "lifecycle_stage", "promotion_flag", "sku_age",
        F.col("units_sold").cast("long").alias("units_sold"), F.trunc("week", "month").alias("month"),
    )
    return combined(fingerprint_parts(rows, "category", "month"), "category")


@query("g1_top_products_by_units", """
    SELECT sku, category, SUM(units_sold) AS metric_value FROM daily_sales JOIN products USING (sku)
    GROUP BY 1, 2 ORDER BY metric_value DESC, sku LIMIT 10
""", "metric_value")
def g1_units(t):
    return A.top_products(t.daily_sales.join(t.products, "sku"), 10)


@query("g1_top_products_by_revenue", """
    SELECT sku, category, SUM(units_sold * price_unit) AS metric_value
    FROM daily_sales JOIN products USING (sku)
    GROUP BY 1, 2 ORDER BY metric_value DESC, sku LIMIT 10
""", "metric_value", digits=2)
def g1_revenue(t):
    return A.top_products(t.daily_sales.join(t.products, "sku"), 10, "revenue")


@query("g2_top_weekly_products_by_units", """
    SELECT sku, category, SUM(units_sold) AS metric_value FROM weekly_cat
    GROUP BY 1, 2 ORDER BY metric_value DESC, sku LIMIT 5
""", "metric_value")
def g2_units(t):
    return A.top_products(t.weekly_categorised, 5)


@query("g2_top_weekly_products_by_revenue", """
    SELECT sku, category, SUM(units_sold * price_unit) AS metric_value FROM weekly_cat
    GROUP BY 1, 2 ORDER BY metric_value DESC, sku LIMIT 5
""", "metric_value", digits=2)
def g2_revenue(t):
    return A.top_products(t.weekly_categorised, 5, "revenue")


@query("g3_shortest_supply", RISK_SQL.format(days=30),
       "stock_available avg_weekly_demand days_of_supply")
def g3(t):
    return A.inventory_risk(t.weekly, 30)


@query("g4_newest_month_groups", """
    SELECT category, CAST(date_trunc('month', sale_date) AS DATE) AS month,
      SUM(units_sold) AS total_units_sold
    FROM daily_sales JOIN products USING (sku) GROUP BY 1, 2 ORDER BY month DESC, category LIMIT 15
""", "total_units_sold")
def g4(t):
    return A.category_trends(t.daily_sales, t.products, 3).drop("delta_pct")


@query("g6_correlation_rank", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, units_sold) AS corr FROM weekly"
    for c in ("lag_1", "lag_2", "rolling_mean_4", "price_unit", "promotion_flag")), "corr")
def g6(t):
    columns = ("units_sold", "lag_1", "lag_2", "rolling_mean_4", "price_unit", "promotion_flag")
    return A.ranked_correlations(t.weekly, columns, "units_sold")


@query("h3_first_row_per_sku", "SELECT sku, brand, segment, category, pack_type FROM products")
def h3(t):
    from shelfcast.sources.loads import product_master

    return product_master(t.daily, "date")


@query("h4_distinct_weeks", "SELECT DISTINCT week FROM weekly")
def h4(t):
    return A.distinct_values(t.weekly, "week")


@query("h5_promotion_pivot", """
    SELECT channel, SUM(units_sold) FILTER (promotion_flag = 0) AS no_promo,
      SUM(units_sold) FILTER (promotion_flag = 1) AS promo FROM daily GROUP BY channel
""", "no_promo promo")
def h5(t):
    wide = t.daily.groupBy("channel").pivot("promotion_flag", [0, 1]).agg(F.sum("units_sold"))
    return wide.select("channel", F.col("0").alias("no_promo"), F.col("1").alias("promo"))


@query("h6_members_per_category", """
    SELECT category, array_to_string(list_sort(list(sku)), ',') AS members FROM products GROUP BY 1
""")
def h6(t):
    members = F.array_join(F.array_sort(F.collect_list("sku")), ",")
    return t.products.groupBy("category").agg(members.alias("members"))


@query("c1_sales_with_products", """
    SELECT d.*, brand, segment, category, pack_type FROM daily_sales d JOIN products USING (sku)
""", "price_unit stock_available delivered_qty units_sold")
def c1(t):
    return t.daily_sales.join(t.products, "sku")


@query("c2_panel_with_category", "SELECT * FROM weekly_cat",
       "units_sold stock_available price_unit delivery_days lag_1 lag_2 rolling_mean_4 "
       "rolling_std_4 momentum target_next_week")
def c2(t):
    return t.weekly_categorised


@query("c3_template_join", """
    SELECT b.sku, b.week, b.channel, b.region, tw.avg_temp
    FROM weekly_base b LEFT JOIN (SELECT week, AVG(avg_temp) AS avg_temp FROM template GROUP BY 1) tw
      USING (week)
""", "avg_temp")
def c3(t):
    return t.weekly_base.join(W.template_weekly(t.template), "week", "left").select(
        *K.WEEKLY_KEY, "avg_temp"
    )


MATCHED_SQL = f"""
    SELECT p.sku, p.channel, p.region, p.forecast_week, p.predicted_units, a.actual_units,
      p.model_version, category
    FROM prediction_log p JOIN products USING (sku) JOIN ({ACTUALS_SQL}) a
      USING (sku, channel, region, forecast_week)
    WHERE p.forecast_week <= DATE '2001-10-01' - 7
"""


@query("c4_predictions_with_actuals", MATCHED_SQL, "predicted_units actual_units")
def c4(t):
    from shelfcast.sources.star_tables import LOG_AS_OF

    return jobs.match_actuals(t.prediction_log, t.products, t.daily_sales_by_month, LOG_AS_OF).select(
        *K.SERIES, "forecast_week", "predicted_units", "actual_units", "model_version", "category"
    )


@query("c5_log_with_products", """
    SELECT request_id, sku, channel, region, forecast_week, model_version, category
    FROM prediction_log JOIN products USING (sku)
""")
def c5(t):
    return t.prediction_log.join(t.products, "sku").select(
        "request_id", *K.SERIES, "forecast_week", "model_version", "category"
    )


@query("c6_sku_feature_merge", """
    SELECT sku, AVG(units_sold) AS avg_weekly_demand FROM weekly GROUP BY sku
""", "avg_weekly_demand")
def c6(t):
    return behaviour.sku_features(t.weekly).select("sku", "avg_weekly_demand")


@query("c7_channel_summary_with_promo_means", """
    SELECT channel, SUM(units_sold) AS total_units_sold,
      AVG(units_sold) FILTER (promotion_flag = 0) AS non_promo_avg,
      AVG(units_sold) FILTER (promotion_flag = 1) AS promo_avg
    FROM weekly GROUP BY channel
""", "total_units_sold non_promo_avg promo_avg")
def c7(t):
    totals = t.weekly.groupBy("channel").agg(F.sum("units_sold").alias("total_units_sold"))
    return totals.join(A.promo_means(t.weekly, "channel"), "channel", "left")


@query("c8_category_lookup", """
    SELECT sku, channel, region, COUNT(*) AS weeks, MIN(category) AS category
    FROM weekly_cat GROUP BY 1, 2, 3
""")
def c8(t):
    from shelfcast.operators.windows import first_rows

    lookup = first_rows(t.daily, "sku", "date", ["category"])
    counted = t.weekly.groupBy(*K.SERIES).agg(F.count("*").alias("weeks"))
    return counted.join(lookup, "sku", "left")


@query("c9_month_over_overall_mean", SEASON_FACTOR_SQL, "seasonality_factor")
def c9(t):
    return A.seasonality_factors(t.weekly)


@query("c11_facts_under_scoring", """
    SELECT COUNT(*) AS fact_rows, SUM(units_sold) AS units FROM daily_sales
    WHERE sku IN (SELECT sku FROM prediction_log)
      AND CAST(date_trunc('week', sale_date) AS DATE) IN (SELECT forecast_week FROM prediction_log)
""", "units")
def c11(t):
    weeks = t.prediction_log.select("forecast_week").distinct()
    skus = t.prediction_log.select("sku").distinct()
    return (
        jobs.facts_of_weeks(t.daily_sales_by_month, weeks).join(skus, "sku", "left_semi")
        .agg(F.count("*").alias("fact_rows"), F.sum("units_sold").alias("units"))
    )


@query("c12_orphan_skus", """
    SELECT sku, COUNT(*) AS rows FROM (
      SELECT CASE WHEN month(sale_date) = 7 THEN 'ZZ-' || substr(sku, 4) ELSE sku END AS sku FROM daily_sales)
    WHERE sku NOT IN (SELECT sku FROM products) GROUP BY sku
""")
def c12(t):
    from shelfcast.operators.quality import orphans

    strange = F.concat(F.lit("ZZ-"), F.substring("sku", 4, 99))
    renamed = F.when(F.month("sale_date") == 7, strange).otherwise(F.col("sku"))
    return orphans(t.daily_sales.withColumn("sku", renamed), t.products)
