"""The domain tables in SQL, written independently of the Spark plans."""

SERIES = "PARTITION BY sku, channel, region ORDER BY week"


def filled(column):
    return f"""COALESCE(
      last_value({column} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value({column} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      0) AS {column}"""


BRAND = "CAST(substr(p_brand, 7) AS INT)"
PRODUCT_COLUMNS = f"""
    concat('BR-', lpad(substr(p_brand, 7), 3, '0')) AS sku,
    p_brand AS brand,
    CASE {BRAND} % 5 WHEN 0 THEN 'Milk' WHEN 1 THEN 'Yogurt' WHEN 2 THEN 'ReadyMeal'
      WHEN 3 THEN 'Juice' ELSE 'SnackBar' END AS category,
    concat('SEG-', CAST({BRAND} % 13 AS VARCHAR)) AS segment,
    CASE {BRAND} % 3 WHEN 0 THEN 'Multipack' WHEN 1 THEN 'Single' ELSE 'Carton' END AS pack_type"""

SHARED = f"""WITH sales_lines AS (
  SELECT {PRODUCT_COLUMNS},
    CAST(l_shipdate AS DATE) AS date,
    CASE c_custkey % 3 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Discount' ELSE 'E-commerce' END AS channel,
    CASE n_regionkey % 3 WHEN 0 THEN 'PL-Central' WHEN 1 THEN 'PL-North'
      ELSE 'PL-South' END AS region,
    floor(p_retailprice * (1 - l_discount) / 200 * 1048576) / 1048576 AS price_unit,
    CASE WHEN l_discount >= 0.075 THEN 1 ELSE 0 END AS promotion_flag,
    CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 5 + 1 AS INT)
      AS delivery_days,
    CAST(p_size AS DOUBLE) * 4 AS stock_available,
    CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END AS delivered_qty,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -l_quantity ELSE l_quantity END
      AS units_sold
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
daily AS (
  SELECT date, sku, brand, segment, category, channel, region, pack_type,
    AVG(price_unit) AS price_unit, MAX(promotion_flag) AS promotion_flag,
    MIN(delivery_days) AS delivery_days, MAX(stock_available) AS stock_available,
    SUM(delivered_qty) AS delivered_qty, SUM(units_sold) AS units_sold
  FROM sales_lines GROUP BY date, sku, brand, segment, category, channel, region, pack_type
),
daily_sales AS (
  SELECT sku, date AS sale_date, channel, region, price_unit, promotion_flag, delivery_days,
    stock_available, delivered_qty, units_sold FROM daily
),
products AS (
  SELECT DISTINCT sku, brand, segment, category, pack_type
  FROM (SELECT {PRODUCT_COLUMNS} FROM part) p
),
weekly_base AS (
  SELECT sku, CAST(date_trunc('week', date) AS DATE) AS week, channel, region,
    SUM(units_sold) AS units_sold, SUM(delivered_qty) AS delivered_qty,
    MAX(stock_available) AS stock_available, MAX(promotion_flag) AS promotion_flag,
    AVG(price_unit) AS price_unit, AVG(delivery_days) AS delivery_days
  FROM daily GROUP BY 1, 2, 3, 4
),
weekly_aged AS (
  SELECT *, CASE WHEN sku_age < 119 THEN 'Growth' WHEN sku_age < 238 THEN 'Mature'
    ELSE 'Decline' END AS lifecycle_stage
  FROM (
    SELECT *,
      CASE WHEN week_number IN (14, 17, 18, 43, 44, 51, 52) THEN 1 ELSE 0 END AS is_holiday_week,
      CASE WHEN week_number IN (14, 17, 18, 43, 44, 51, 52) THEN 1 ELSE 0 END AS is_holiday_peak,
      CASE WHEN month IN (6, 7, 8) THEN 1 ELSE 0 END AS is_summer,
      CASE WHEN month IN (12, 1, 2) THEN 1 ELSE 0 END AS is_winter,
      CAST(floor(date_diff('day', MIN(week) OVER (PARTITION BY sku), week) / 7) AS INT) AS sku_age
    FROM (
      SELECT *, CAST(weekofyear(week) AS INT) AS week_number, CAST(month(week) AS INT) AS month,
        CAST(year(week) AS INT) AS year
      FROM weekly_base
    ) c
  ) a
),
weekly_lagged AS (
  SELECT *, lag_1 - lag_2 AS momentum FROM (
    SELECT *, lag(units_sold, 1) OVER ({SERIES}) AS lag_1,
      lag(units_sold, 2) OVER ({SERIES}) AS lag_2,
      AVG(units_sold) OVER ({SERIES} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS rolling_mean_4,
      stddev_samp(units_sold) OVER ({SERIES} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
        AS rolling_std_4,
      lead(units_sold, 1) OVER ({SERIES}) AS target_next_week
    FROM weekly_aged
  ) l
),
weekly AS (
  SELECT sku, week, channel, region, units_sold, stock_available, promotion_flag, price_unit,
    delivery_days, is_holiday_peak, week_number, month, year, is_holiday_week, is_summer,
    is_winter, sku_age, lifecycle_stage,
    {filled('lag_1')}, {filled('lag_2')}, {filled('rolling_mean_4')}, {filled('rolling_std_4')},
    {filled('momentum')}, target_next_week
  FROM weekly_lagged
),
weekly_cat AS (
  SELECT weekly.*, category FROM weekly JOIN products USING (sku)
),
template AS (
  SELECT sku, week, channel, region, price_unit AS price_avg,
    CAST(promotion_flag AS DOUBLE) AS promo_rate, stock_available AS stock_avg, 1 AS deliveries,
    CAST(2.0 * month AS DOUBLE) AS avg_temp,
    CAST(1 + CAST(0.01 AS DOUBLE) * (year - 1995) AS DOUBLE) AS inflation_index,
    CASE WHEN month IN (7, 8) THEN 0 ELSE 1 END AS school_in_session,
    1 + CAST(0.1 AS DOUBLE) * (week_number % 5) AS category_trend,
    CAST(0.25 AS DOUBLE) * (week_number % 4) AS event_score
  FROM weekly WHERE sku = 'BR-006' AND week_number % 5 <> 0
),
prediction_log AS (
  SELECT 'r1' AS request_id, sku, channel, region, week AS forecast_week,
    rolling_mean_4 AS predicted_units, rolling_mean_4 - 10 AS confidence_lower,
    rolling_mean_4 + 10 AS confidence_upper,
    concat('forecaster_', lower(category), '_v1') AS model_version
  FROM weekly_cat WHERE week >= DATE '2001-07-02'
)"""
