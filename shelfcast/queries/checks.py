"""Data contracts, the gate, alerts, insights and health reports."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators import alerts, behaviour, insights, metrics, quality
from shelfcast.operators.weekly import enrich_features
from shelfcast.plans import jobs
from shelfcast.queries.registry import query
from shelfcast.queries.sales import ENRICHED_SQL, MATCHED_SQL
from shelfcast.sources.star_tables import LOG_AS_OF

GATE_DATE = "2001-11-20"
HEALTH_DATE = "2001-11-05"


# --- contracts ------------------------------------------------------------
@query("i1_product_rules", """
    SELECT 'sku_format' AS rule, COUNT(*) FILTER (NOT regexp_full_match(sku, '[A-Z]{2}-[0-9]{3}'))
      AS violations FROM products UNION ALL
    SELECT 'category_valid', COUNT(*) FILTER (category NOT IN
      ('Milk', 'Yogurt', 'ReadyMeal', 'Juice', 'SnackBar')) FROM products UNION ALL
    SELECT 'pack_type_valid', COUNT(*) FILTER (pack_type NOT IN ('Multipack', 'Single', 'Carton'))
    FROM products
""")
def i1_products(t):
    return quality.rule_violations(t.products, quality.table_rules()["products"])


@query("i1_daily_rules", """
    SELECT 'price_positive' AS rule, COUNT(*) FILTER (price_unit - 4 <= 0) AS violations
    FROM daily_sales UNION ALL
    SELECT 'delivery_range', COUNT(*) FILTER (delivery_days * 2 NOT BETWEEN 1 AND 5) FROM daily_sales
    UNION ALL
    SELECT 'promo_flag', COUNT(*) FILTER (promotion_flag NOT IN (0, 1)) FROM daily_sales UNION ALL
    SELECT 'channel_valid', COUNT(*) FILTER (channel NOT IN ('Retail', 'Discount', 'E-commerce'))
    FROM daily_sales UNION ALL
    SELECT 'region_valid', COUNT(*) FILTER (region NOT IN ('PL-Central', 'PL-North', 'PL-South'))
    FROM daily_sales
""")
def i1_daily(t):
    spoiled = t.daily_sales.withColumns({
        "price_unit": F.col("price_unit") - 4, "delivery_days": F.col("delivery_days") * 2
    })
    return quality.rule_violations(spoiled, quality.table_rules()["daily_sales"])


@query("i1_failing_rows", """
    SELECT sku, sale_date, channel, region, concat_ws(',',
      CASE WHEN price_unit - 4 <= 0 THEN 'price_positive' END,
      CASE WHEN delivery_days * 2 NOT BETWEEN 1 AND 5 THEN 'delivery_range' END) AS broken
    FROM daily_sales WHERE price_unit - 4 <= 0 OR delivery_days * 2 NOT BETWEEN 1 AND 5
""")
def i1_rows(t):
    spoiled = t.daily_sales.withColumns({
        "price_unit": F.col("price_unit") - 4, "delivery_days": F.col("delivery_days") * 2
    })
    failing = quality.failing_rows(spoiled, quality.table_rules()["daily_sales"])
    return failing.select("sku", "sale_date", "channel", "region",
                          F.concat_ws(",", "broken_rules").alias("broken"))


@query("i1_forecast_intervals", """
    SELECT 'interval_valid' AS rule, COUNT(*) FILTER (
      NOT (lag_1 - 5 <= rolling_mean_4 AND rolling_mean_4 <= lag_1 + 5)) AS violations FROM weekly
""")
def i1_intervals(t):
    forecasts = t.weekly.select(
        F.col("rolling_mean_4").alias("predicted_units"),
        (F.col("lag_1") - 5).alias("confidence_lower"),
        (F.col("lag_1") + 5).alias("confidence_upper"),
    )
    return quality.rule_violations(forecasts, quality.table_rules()["demand_forecasts"])


@query("i2_duplicate_keys", """
    SELECT sku, date, channel, region, COUNT(*) AS copies FROM sales_lines
    GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1
""")
def i2_duplicates(t):
    return quality.duplicate_keys(t.sales_lines, ["sku", "date", "channel", "region"])


@query("i2_orphan_rows", """
    SELECT sku, COUNT(*) AS rows FROM (
      SELECT CASE WHEN month = 7 THEN 'ZZ-' || substr(sku, 4) ELSE sku END AS sku FROM weekly)
    WHERE sku NOT IN (SELECT sku FROM products) GROUP BY sku
""")
def i2_orphans(t):
    renamed = F.when(F.col("month") == 7, F.concat(F.lit("ZZ-"), F.substring("sku", 4, 99))).otherwise(F.col("sku"))
    return quality.orphans(t.weekly.withColumn("sku", renamed), t.products)


@query("i3_weekly_contract", """
    SELECT 'sku_format' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL
    SELECT 'week_number_range', COUNT(*) FILTER (week_number NOT BETWEEN 1 AND 53) FROM weekly
    UNION ALL SELECT 'month_range', COUNT(*) FILTER (month NOT BETWEEN 1 AND 12) FROM weekly
    UNION ALL SELECT 'year_range', COUNT(*) FILTER (year NOT BETWEEN 2020 AND 2030) FROM weekly
    UNION ALL SELECT 'sku_age_not_negative', COUNT(*) FILTER (sku_age < 0) FROM weekly
    UNION ALL SELECT 'holiday_peak_flag', COUNT(*) FILTER (is_holiday_peak NOT IN (0, 1)) FROM weekly
    UNION ALL SELECT 'holiday_week_flag', COUNT(*) FILTER (is_holiday_week NOT IN (0, 1)) FROM weekly
    UNION ALL SELECT 'summer_flag', COUNT(*) FILTER (is_summer NOT IN (0, 1)) FROM weekly
    UNION ALL SELECT 'winter_flag', COUNT(*) FILTER (is_winter NOT IN (0, 1)) FROM weekly
""")
def i3_weekly(t):
    return quality.rule_violations(t.weekly, quality.row_contracts()["weekly_features"])


@query("i3_enrichment_contract", """
    SELECT 'sku_format' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL
    SELECT 'deliveries_not_negative', COUNT(*) FILTER (deliveries < 0) FROM template UNION ALL
    SELECT 'inflation_not_negative', COUNT(*) FILTER (inflation_index < 0) FROM template UNION ALL
    SELECT 'school_flag', COUNT(*) FILTER (school_in_session NOT IN (0, 1)) FROM template UNION ALL
    SELECT 'promo_rate', COUNT(*) FILTER (promo_rate NOT BETWEEN 0 AND 1) FROM template UNION ALL
    SELECT 'price_avg_positive', COUNT(*) FILTER (price_avg < 0) FROM template
""")
def i3_enrichment(t):
    rules = {**quality.row_contracts()["enrichment_features"],
             **quality.table_rules()["enrichment_features"]}
    return quality.rule_violations(t.template, rules)


# --- gate -----------------------------------------------------------------
def _missing_sql():
    parts = []
    for c in K.GATE_COLUMNS:
        if c in K.GATE_MISSING_EXEMPT:
            continue
        rate = f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)"
        parts.append(f"""SELECT 'missing_{c}' AS name, 'FAIL' AS level, {rate} <= 0.01 AS ok,
            printf('{c}: %.2f%% NaN (limit 1%%)', {rate} * 100) AS message FROM weekly""")
    return " UNION ALL ".join(parts)


CARDINALITY_SQL = " UNION ALL ".join(
    f"""SELECT 'cardinality_{k}s' AS name, 'WARN' AS level, COUNT(DISTINCT {k}) = {n} AS ok,
      concat('{label}: ', COUNT(DISTINCT {k}), ' (expected {n})') AS message FROM weekly"""
    for k, label, n in (("sku", "SKUs", 30), ("channel", "Channels", 3), ("region", "Regions", 3)))
DISTRIBUTION_SQL = """
    SELECT 'dist_units_sold' AS name, 'WARN' AS level, AVG(units_sold) BETWEEN 50 AND 200 AS ok,
      printf('units_sold mean=%.2f (expected [50.0,200.0])', AVG(units_sold)) AS message FROM weekly
    UNION ALL
    SELECT 'dist_price_unit', 'WARN', AVG(price_unit) BETWEEN 3 AND 8,
      printf('price_unit mean=%.4f (expected [3.0,8.0])', AVG(price_unit)) FROM weekly
"""
RECENCY_SQL = f"""
    SELECT 'recency' AS name, 'WARN' AS level,
      date_diff('day', MAX(week), DATE '{GATE_DATE}') <= 30 OR {{stale}} AS ok,
      concat('Latest week ', MAX(week), ' is ', date_diff('day', MAX(week), DATE '{GATE_DATE}'),
        ' days ago (--allow-stale={{word}})') AS message
    FROM weekly
"""
SCHEMA_SQL = """SELECT 'schema_columns' AS name, 'FAIL' AS level, TRUE AS ok,
    'All 24 required columns present' AS message"""


def _report(t, **options):
    return quality.validation_report(t.weekly, GATE_DATE, **options)


@query("i4_schema_check", SCHEMA_SQL)
def i4(t):
    return _report(t).filter(F.col("name").startswith("schema") | F.col("name").startswith("dtype"))


@query("i5_cardinality_check", CARDINALITY_SQL)
def i5(t):
    return _report(t).filter(F.col("name").startswith("cardinality"))


@query("i6_missing_check", _missing_sql())
def i6(t):
    return _report(t).filter(F.col("name").startswith("missing"))


@query("i7_distribution_check", DISTRIBUTION_SQL)
def i7(t):
    return _report(t).filter(F.col("name").startswith("dist"))


@query("i8_recency_check", RECENCY_SQL.format(stale="FALSE", word="not set"))
def i8(t):
    return _report(t).filter(F.col("name") == "recency")


@query("i9_validation_report", " UNION ALL ".join([
    SCHEMA_SQL, CARDINALITY_SQL, _missing_sql(), DISTRIBUTION_SQL.strip(),
    RECENCY_SQL.format(stale="TRUE", word="set"),
]))
def i9(t):
    return _report(t, allow_stale=True)


DRIFT_COLUMNS = ("lag_1", "rolling_mean_4", "price_unit", "stock_available", "sku_age", "year")
_DRIFT_NOW = "week >= DATE '2001-01-01'"
_DRIFT_BASE = "week < DATE '1996-01-01'"
DRIFT_SQL = " UNION ALL ".join(f"""
    SELECT '{c}' AS feature, round(n, 4) AS current_mean, round(m, 4) AS baseline_mean,
      round(s, 4) AS baseline_std, round(abs(n - m) / s, 2) AS sigma_shift, 'warn' AS severity
    FROM (SELECT AVG({c}) FILTER ({_DRIFT_NOW}) AS n, AVG({c}) FILTER ({_DRIFT_BASE}) AS m,
            stddev_samp({c}) FILTER ({_DRIFT_BASE}) AS s FROM weekly)
    WHERE s >= 1e-9 AND abs(n - m) > 2 * s""" for c in DRIFT_COLUMNS)


@query("i10_drift", DRIFT_SQL, "current_mean baseline_mean baseline_std sigma_shift")
def i10(t):
    now = metrics.feature_baselines(t.weekly.filter(_DRIFT_NOW), DRIFT_COLUMNS)
    base = metrics.feature_baselines(t.weekly.filter(_DRIFT_BASE), DRIFT_COLUMNS)
    return metrics.detect_drift(now, base)


# --- alerts ---------------------------------------------------------------
ENRICHED_PANEL = """
    SELECT w.* REPLACE (CASE WHEN is_holiday_week = 1 THEN price_unit * 1.25 ELSE price_unit END
      AS price_unit), AVG(price_unit) OVER (PARTITION BY sku, channel, region) AS price_avg
    FROM weekly w
"""
ALERT_SQL = {
    "demand_spike": """SELECT sku, channel, region, week, 0 AS rule, 'demand_spike' AS alert_type,
      'HIGH' AS severity, concat('Units sold ', printf('%.1f', units_sold),
        ' exceeded mean+2.5σ (', printf('%.1f', rolling_mean_4), '+2.5*',
        printf('%.1f', rolling_std_4), ').') AS message,
      'Review supply lines; may indicate viral demand or data issue.' AS recommended_action
    FROM panel WHERE rolling_mean_4 > 0 AND units_sold > rolling_mean_4 + 2.5 * rolling_std_4""",
    "demand_drop": """SELECT sku, channel, region, week, 1 AS rule, 'demand_drop' AS alert_type,
      'MEDIUM' AS severity, concat('Units sold ', printf('%.1f', units_sold),
        ' below mean-2σ (', printf('%.1f', rolling_mean_4), '-2.0*',
        printf('%.1f', rolling_std_4), ').') AS message,
      'Investigate channel listing or stockouts.' AS recommended_action
    FROM panel WHERE rolling_mean_4 > 0 AND units_sold >= 0
      AND units_sold < rolling_mean_4 - 2 * rolling_std_4""",
    "return_anomaly": """SELECT sku, channel, region, week, 2 AS rule,
      'return_anomaly' AS alert_type, 'LOW' AS severity, concat('Negative units_sold (',
        printf('%.1f', units_sold), ') — likely a return batch.') AS message,
      'Verify return reason in upstream POS.' AS recommended_action
    FROM panel WHERE units_sold < 0""",
    "stock_risk": """SELECT sku, channel, region, week, 3 AS rule, 'stock_risk' AS alert_type,
      'HIGH' AS severity, concat('Stock cover ', printf('%.1f', stock_available / rolling_mean_4),
        ' weeks below 2.0-week threshold.') AS message,
      'Trigger replenishment order.' AS recommended_action
    FROM panel WHERE rolling_mean_4 > 0 AND stock_available / rolling_mean_4 < 2""",
    "price_anomaly": """SELECT sku, channel, region, week, 4 AS rule,
      'price_anomaly' AS alert_type, 'LOW' AS severity, concat('Price ',
        printf('%.2f', price_unit), ' deviates >15% from 4-week avg ', printf('%.2f', price_avg),
        '.') AS message, 'Confirm pricing change is intentional.' AS recommended_action
    FROM panel WHERE price_avg > 0 AND abs(price_unit - price_avg) / price_avg > 0.15""",
}
CANNIBAL_SQL = """
    SELECT sku, channel, region, 'promo_cannibalization' AS alert_type, 'MEDIUM' AS severity,
      concat('Promo mean ', printf('%.1f', p), ' below non-promo mean ', printf('%.1f', b),
        '; consider lifting promo.') AS message,
      'Review promo ROI and channel mix.' AS recommended_action
    FROM (SELECT sku, channel, region, AVG(units_sold) FILTER (promotion_flag = 1) AS p,
            AVG(units_sold) FILTER (promotion_flag = 0) AS b FROM weekly GROUP BY 1, 2, 3)
    WHERE p < b
"""


def alert_panel(t):
    """Weekly panel with the price average of its series and a surcharge in holiday weeks.

    Without the surcharge no price of the test data strays far enough for an alert.
    """
    from shelfcast.operators.windows import whole_series

    surcharge = F.when(F.col("is_holiday_week") == 1, F.col("price_unit") * 1.25)
    averaged = t.weekly.withColumn("price_avg", F.avg("price_unit").over(whole_series()))
    return averaged.withColumn("price_unit", F.coalesce(surcharge, "price_unit"))


def _register_rules():
    names = {"demand_spike": "j1", "demand_drop": "j2", "return_anomaly": "j3",
             "stock_risk": "j4", "price_anomaly": "j5"}
    for kind, key in names.items():
        def build(t, kind=kind):
            return alerts.detect_alerts(alert_panel(t)).filter(F.col("alert_type") == kind)

        query(f"{key}_{kind}", f"WITH panel AS ({ENRICHED_PANEL}) {ALERT_SQL[kind]}")(build)


_register_rules()


@query("j6_promo_cannibalisation", CANNIBAL_SQL)
def j6(t):
    return alerts.detect_cannibalisation(t.weekly)


@query("j7_all_row_alerts",
       f"WITH panel AS ({ENRICHED_PANEL}) {' UNION ALL '.join(ALERT_SQL.values())}")
def j7(t):
    return alerts.detect_alerts(alert_panel(t))


SCOPED_SQL = f"""
    WITH panel AS ({ENRICHED_PANEL}),
    every AS (SELECT sku, channel, region, alert_type, severity, message, recommended_action
      FROM ({' UNION ALL '.join(ALERT_SQL.values())}) UNION ALL {CANNIBAL_SQL})
    SELECT * FROM every WHERE {{where}}
"""


@query("j8_scoped_alerts", SCOPED_SQL.format(where="channel = 'Retail' AND region = 'PL-South'"))
def j8(t):
    return alerts.check_alerts(alert_panel(t), channel="Retail", region="PL-South")


@query("b5_alerts_of_one_sku", SCOPED_SQL.format(where="sku = 'BR-011'"))
def b5(t):
    return alerts.check_alerts(alert_panel(t), sku="BR-011")


@query("h1_alert_union", f"""
    WITH panel AS ({ENRICHED_PANEL})
    SELECT alert_type, severity, COUNT(*) AS hits FROM (
      SELECT alert_type, severity FROM ({' UNION ALL '.join(ALERT_SQL.values())})
      UNION ALL SELECT alert_type, severity FROM ({CANNIBAL_SQL})) GROUP BY 1, 2
""")
def h1(t):
    return alerts.check_alerts(alert_panel(t)).groupBy("alert_type", "severity").agg(
        F.count("*").alias("hits")
    )


# --- insights -------------------------------------------------------------
INSIGHT_SQL = f"""
    WITH panel AS ({ENRICHED_PANEL}),
    m AS (SELECT category, date_trunc('month', week) AS p, SUM(units_sold) AS u
          FROM weekly_cat GROUP BY 1, 2),
    l AS (SELECT DISTINCT p FROM m ORDER BY p DESC LIMIT 2),
    g AS (SELECT category, COALESCE(SUM(u) FILTER (p = (SELECT MIN(p) FROM l)), 0) AS a,
            COALESCE(SUM(u) FILTER (p = (SELECT MAX(p) FROM l)), 0) AS b FROM m GROUP BY category),
    growth AS (SELECT 1 AS section, 0 AS weight, category AS rank, concat(category, ' category demand ',
        CASE WHEN b > a THEN 'up' ELSE 'down' END, ' ', printf('%.1f', abs(100.0 * (b - a) / a)),
        '% MoM (', printf('%.0f', a), ' -> ', printf('%.0f', b), ' units).') AS insight
      FROM g WHERE abs(100.0 * (b - a) / a) >= 5),
    lifts AS (SELECT category, AVG(100.0 * (p - b) / b) AS lift FROM (
        SELECT sku, MIN(category) AS category, AVG(units_sold) FILTER (promotion_flag = 1) AS p,
          AVG(units_sold) FILTER (promotion_flag = 0) AS b FROM weekly_cat GROUP BY sku)
      GROUP BY category),
    promo AS (SELECT 2 AS section, -lift AS weight, category AS rank, concat('Promotions in ',
        category, ' produce a strong ', printf('%.1f', lift), '% average lift.') AS insight
      FROM lifts WHERE lift >= 15),
    modal AS (SELECT sku, lifecycle_stage FROM (
      SELECT sku, lifecycle_stage,
        row_number() OVER (PARTITION BY sku ORDER BY COUNT(*) DESC, lifecycle_stage) AS rn
      FROM weekly GROUP BY 1, 2) WHERE rn = 1),
    stages AS (SELECT COUNT(*) FILTER (lifecycle_stage = 'Decline') AS d,
        COUNT(*) FILTER (lifecycle_stage = 'Growth') AS g FROM modal),
    life AS (SELECT 3 AS section, 0 AS weight, 'a' AS rank, concat(d,
        ' SKUs in Decline lifecycle — consider markdown or rationalization.') AS insight
      FROM stages WHERE d > 0 UNION ALL SELECT 3, 0, 'b', concat(g,
        ' SKUs in Growth lifecycle — prioritize stocking and channel coverage.')
      FROM stages WHERE g > 0),
    hits AS (SELECT * FROM ({' UNION ALL '.join(ALERT_SQL.values())}) WHERE severity = 'HIGH'),
    high AS (SELECT 4 AS section, 0 AS weight, '' AS rank, concat((SELECT COUNT(*) FROM hits),
        ' HIGH-severity alerts active (e.g. ', (SELECT string_agg(concat(sku, '/', alert_type), '; '
          ORDER BY sku, channel, region, week, rule)
          FROM (SELECT * FROM hits ORDER BY sku, channel, region, week, rule LIMIT 3)), ').')
        AS insight)
    SELECT CAST(row_number() OVER (ORDER BY section, weight, rank) AS INT) AS ordinal, insight
    FROM (SELECT * FROM growth UNION ALL SELECT * FROM promo UNION ALL SELECT * FROM life
      UNION ALL SELECT * FROM high)
    ORDER BY ordinal LIMIT {{limit}}
"""


@query("k24_insights", INSIGHT_SQL.format(limit=5))
def k24(t):
    return insights.generate_insights(
        t.weekly_categorised, alerts.detect_alerts(alert_panel(t))
    )


@query("k24_all_insights", INSIGHT_SQL.format(limit="ALL"))
def k24_all(t):
    return insights.generate_insights(
        t.weekly_categorised, alerts.detect_alerts(alert_panel(t)), limit=None
    )


@query("g5_top_alerts_and_forecast", """
    SELECT 5 AS section, concat('Highest forecasted demand: ', sku, ' (', channel, ' / ',
      region, ') at ', printf('%.0f', SUM(predicted_units)), ' units over ', COUNT(*), ' weeks.')
      AS insight
    FROM prediction_log GROUP BY sku, channel, region
    ORDER BY SUM(predicted_units) DESC, sku, channel, region LIMIT 1
""")
def g5(t):
    return insights.forecast_line(t.prediction_log).select("section", "insight")


# --- error metrics, baselines, health -------------------------------------
LIVE_SQL = f"""
    SELECT model_version, category, CAST(COUNT(*) AS INT) AS samples,
      COALESCE(AVG(CASE WHEN actual_units <> 0
        THEN abs((actual_units - predicted_units) / actual_units) END), 0) AS live_mape,
      sqrt(AVG((actual_units - predicted_units) ** 2)) AS live_rmse,
      AVG(abs(actual_units - predicted_units)) AS live_mae
    FROM ({MATCHED_SQL}) GROUP BY 1, 2
"""


@query("e28_live_metrics", LIVE_SQL, "live_mape live_rmse live_mae")
def e28(t):
    matched = jobs.match_actuals(t.prediction_log, t.products, t.daily_sales_by_month, LOG_AS_OF)
    return metrics.live_metrics(matched)


OFFLINE_SQL = """
    SELECT {key}, COUNT(*) AS samples,
      AVG(abs({y} - {p}) / greatest(abs({y}), 1e-9)) * 100 AS mape,
      sqrt(AVG(({y} - {p}) ** 2)) AS rmse, AVG(abs({y} - {p})) AS mae,
      1 - SUM(({y} - {p}) ** 2) / (var_pop({y}) * COUNT(*)) AS r2
    FROM {table} WHERE {y} IS NOT NULL GROUP BY {key}
"""


@query("e29_offline_metrics", OFFLINE_SQL.format(
    key="category", y="target_next_week", p="rolling_mean_4", table="weekly_cat"),
    "mape rmse mae r2", digits=3)
def e29(t):
    rows = t.weekly_categorised.filter(F.col("target_next_week").isNotNull())
    return metrics.evaluate(rows, "target_next_week", "rolling_mean_4", "category")


@query("e30_feature_baselines", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, AVG({c}) AS mean, stddev_samp({c}) AS std FROM weekly"
    for c in K.PANEL_FEATURES), "mean std")
def e30(t):
    return metrics.feature_baselines(t.weekly.select(*K.PANEL_FEATURES))


LINEAGE_SQL = """(
    SELECT category, CASE WHEN year(date) > 1995 THEN MAX(date) FILTER (units_sold < -40) END
      AS completed_at
    FROM daily GROUP BY category, year(date))"""


def lineage(t):
    """Retraining runs per category and year; the first year's runs never completed."""
    last = F.max(F.when(F.col("units_sold") < -40, F.col("date")))
    return t.daily.groupBy("category", F.year("date").alias("year")).agg(last.alias("d")).select(
        "category", F.when(F.col("year") > 1995, F.col("d")).cast("timestamp").alias("completed_at")
    )


@query("e36_live_mape_by_category", f"""
    SELECT category, AVG(live_mape) AS avg_mape FROM (
      SELECT date AS scored_date, category, AVG(promotion_flag) AS live_mape FROM daily GROUP BY 1, 2)
    WHERE scored_date >= DATE '{LOG_AS_OF}' - 7 GROUP BY category
""", "avg_mape")
def e36(t):
    performance = t.daily.groupBy(F.col("date").alias("scored_date"), "category").agg(
        F.avg("promotion_flag").alias("live_mape")
    )
    return jobs.live_mape_by_category(performance, LOG_AS_OF)


@query("e37_days_since_retrain", f"""
    SELECT CAST(greatest(0, date_diff('day', MAX(completed_at), DATE '{HEALTH_DATE}')) AS INT)
      AS days_since FROM {LINEAGE_SQL}
""")
def e37(t):
    return jobs.days_since_retrain(lineage(t), HEALTH_DATE)


@query("c10_stale_categories", f"""
    SELECT DISTINCT category FROM {LINEAGE_SQL} WHERE category NOT IN (
      SELECT category FROM {LINEAGE_SQL}
      WHERE completed_at IS NOT NULL AND completed_at >= DATE '{HEALTH_DATE}' - 14)
""")
def c10(t):
    return jobs.stale_categories(lineage(t), HEALTH_DATE)


# --- clusters given by rule -----------------------------------------------
LABEL_SQL = "SELECT sku, CAST(CAST(substr(sku, 4) AS INT) % 4 AS INT) AS cluster FROM products"


def rule_labels(t):
    """Cluster numbers by a fixed rule, so reports can be checked without K-Means."""
    return t.products.select("sku", (F.substring("sku", 4, 3).cast("int") % 4).alias("cluster"))


@query("e39_cluster_summaries", f"""
    SELECT concat('cluster_', cluster) AS cluster_label, 'Unlabeled' AS cluster_description,
      COUNT(DISTINCT sku) AS sku_count,
      array_to_string(list_sort(list(DISTINCT sku)), ',') AS members,
      AVG(units_sold) AS avg_weekly_demand
    FROM ({LABEL_SQL}) JOIN weekly USING (sku) GROUP BY cluster
""", "avg_weekly_demand")
def e39(t):
    labels = rule_labels(t).join(t.weekly.select("sku").distinct(), "sku", "left_semi")
    none = labels.select("cluster", F.lit("x").alias("cluster_description")).filter("cluster < 0")
    summaries = behaviour.cluster_summaries(t.weekly, labels, none)
    return summaries.withColumn("members", F.array_join("members", ","))


@query("e39_cluster_members", f"""
    SELECT concat('cluster_', cluster) AS cluster_label,
      CASE cluster WHEN 1 THEN 'second' ELSE 'Unlabeled' END AS cluster_description, sku FROM ({LABEL_SQL})
""")
def e39_members(t):
    labels = rule_labels(t)
    one = labels.filter("cluster = 1").select("cluster", F.lit("second").alias("cluster_description")).distinct()
    return behaviour.cluster_members(labels, one)


@query("k21_cluster_labels", f"""
    WITH f AS (SELECT sku, AVG(units_sold) AS d, stddev_samp(units_sold) / AVG(units_sold) AS cv,
        AVG(units_sold) FILTER (promotion_flag = 1) / AVG(units_sold) FILTER (promotion_flag = 0)
          AS promo FROM weekly GROUP BY sku),
    s AS (SELECT sku, MAX(m) / MIN(m) AS season FROM (
        SELECT sku, month, AVG(units_sold) AS m FROM weekly GROUP BY 1, 2) GROUP BY sku),
    g AS (SELECT sku, CASE lifecycle_stage WHEN 'Decline' THEN 0 WHEN 'Mature' THEN 1 ELSE 2 END AS l
        FROM (SELECT sku, lifecycle_stage, row_number() OVER (
          PARTITION BY sku ORDER BY COUNT(*) DESC, lifecycle_stage) AS rn
          FROM weekly GROUP BY 1, 2) WHERE rn = 1)
    SELECT cluster, CASE
        WHEN AVG(d) > (SELECT median(d) FROM f) AND AVG(cv) < 0.3 THEN 'High-Volume Steady'
        WHEN AVG(season) > 1.5 THEN 'Seasonal Responders'
        WHEN AVG(promo) > 1.3 THEN 'Promo-Dependent'
        WHEN AVG(l) < 0.7 THEN 'Declining Niche' ELSE 'Mid-Tier Consistent' END
      AS cluster_description
    FROM f JOIN s USING (sku) JOIN g USING (sku) JOIN ({LABEL_SQL}) USING (sku) GROUP BY cluster
""")
def k21(t):
    return behaviour.label_clusters(behaviour.sku_features(t.weekly), rule_labels(t))


@query("k22_similar_skus", f"""
    WITH labels AS ({LABEL_SQL})
    SELECT 'BR-011' AS sku, concat('cluster_', cluster) AS cluster_label,
      'Unlabeled' AS cluster_description, sku AS similar_sku
    FROM labels WHERE sku <> 'BR-011'
      AND cluster = (SELECT cluster FROM labels WHERE sku = 'BR-011')
""")
def k22(t):
    labels = rule_labels(t)
    none = labels.select("cluster", F.lit("x").alias("cluster_description")).filter("cluster < 0")
    return behaviour.similar_skus(labels, none, "BR-011")


@query("j5_price_alerts_on_enriched_rows", f"""
    SELECT COUNT(*) AS hits FROM ({ENRICHED_SQL})
    WHERE price_avg > 0 AND abs(price_unit - price_avg) / price_avg > 0.15
""")
def j5_enriched(t):
    enriched = enrich_features(t.weekly_base, t.template)
    lagless = enriched.withColumns({
        c: F.lit(None).cast("double") for c in ("rolling_mean_4", "rolling_std_4")
    })
    hits = alerts.detect_alerts(lagless).filter(F.col("alert_type") == "price_anomaly")
    return hits.agg(F.count("*").alias("hits"))


@query("i2_valid_series_rows", "SELECT COUNT(*) AS row_count, COUNT(*) AS valid_rows FROM weekly")
def i2_valid(t):
    checked = quality.enum_ok(t.weekly)
    return checked.agg(F.count("*").alias("row_count"), F.count_if("row_ok").alias("valid_rows"))


@query("d19_clamped_metrics", """
    SELECT sku, week, channel, region, round(greatest(-9999, least(9999, momentum * 1000)), 6)
      AS clamped FROM weekly
""", "clamped")
def d19_clamped(t):
    return t.weekly.select(*K.WEEKLY_KEY, S.clamped_metric(F.col("momentum") * 1000).alias("clamped"))
