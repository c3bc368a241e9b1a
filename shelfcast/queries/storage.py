"""Files, stored tables, the model catalog and the stream.

Each query writes to a new folder below the shared root and reads back what it wrote.
"""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models.ridge import fit_ridge
from shelfcast.operators import analytics, metrics
from shelfcast.operators.weekly import enrich_features
from shelfcast.plans import jobs
from shelfcast.queries.registry import query
from shelfcast.queries.rows import DAILY_DOUBLES, PANEL_DOUBLES
from shelfcast.session import scratch_path
from shelfcast.sources import loads, readers
from shelfcast.sources.catalog import ModelCatalog, baselines_by_category
from shelfcast.streaming.weekly_stream import run_weekly_stream

TEMPLATE_DOUBLES = (
    "price_avg promo_rate stock_avg avg_temp inflation_index category_trend event_score"
)


def _csv(t, frame, name):
    path = scratch_path(t.spark, name)
    frame.write.option("header", True).csv(path)
    return path


@query("a1_daily_csv", "SELECT * FROM daily", DAILY_DOUBLES)
def a1(t):
    return readers.read_daily_csv(t.spark, _csv(t, t.daily, "daily-csv"))


@query("a2_weekly_csv", "SELECT * FROM weekly", PANEL_DOUBLES)
def a2(t):
    flag = F.when(F.col("is_holiday_peak") == 1, "True").otherwise("False")
    return readers.read_weekly_csv(
        t.spark, _csv(t, t.weekly.withColumn("is_holiday_peak", flag), "weekly-csv")
    )


@query("a3_enriched_csv", "SELECT * FROM template", TEMPLATE_DOUBLES)
def a3(t):
    return readers.read_enriched_csv(t.spark, _csv(t, t.template, "template-csv"))


@query("a4_batch_parquet", "SELECT * FROM daily", DAILY_DOUBLES)
def a4(t):
    path = scratch_path(t.spark, "batch-parquet")
    t.daily.withColumn("date", F.col("date").cast("string")).write.parquet(path)
    return readers.read_batch_parquet(t.spark, path)


@query("a5_parameterised_sql", """
    SELECT sku, SUM(units_sold) AS units FROM daily_sales
    WHERE channel = 'Retail' AND sale_date >= DATE '1998-01-01' GROUP BY sku
""", "units")
def a5(t):
    t.daily_sales.createOrReplaceTempView("stored_daily_sales")
    return readers.run_query(t.spark, """
        SELECT sku, SUM(units_sold) AS units FROM stored_daily_sales
        WHERE channel = :channel AND sale_date >= CAST(:start AS DATE) GROUP BY sku
    """, {"channel": "Retail", "start": "1998-01-01"})


@query("a6_year_partitioned_snapshots", """
    SELECT 'enriched' AS artifact, year(week) AS year, COUNT(*) AS row_count, SUM(units_sold) AS units
    FROM weekly_base GROUP BY 2 UNION ALL
    SELECT 'modeling', year(week), COUNT(*), SUM(units_sold) FROM weekly GROUP BY 2
""", "units")
def a6(t):
    folder = scratch_path(t.spark, "artifacts")
    readers.write_artifacts(enrich_features(t.weekly_base, t.template), t.weekly, folder)

    def per_year(name, path):
        return t.spark.read.parquet(f"{folder}/{path}").groupBy(
            F.col("_year").cast("long").alias("year")
        ).agg(F.count("*").alias("row_count"), F.sum("units_sold").alias("units")).select(
            F.lit(name).alias("artifact"), "*"
        )

    return per_year("enriched", "weekly_enriched").unionByName(
        per_year("modeling", "weekly_modeling")
    )


STORED_DAILY = """CAST(CAST(price_unit AS DECIMAL(10, 4)) AS DOUBLE) AS price_unit,
      CAST(promotion_flag AS SMALLINT) AS promotion_flag,
      CAST(delivery_days AS SMALLINT) AS delivery_days, stock_available, delivered_qty"""


@query("a7_upsert_last_copy_wins", f"""
    SELECT sku, sale_date, channel, region, {STORED_DAILY}, units_sold * 3 AS units_sold
    FROM daily_sales UNION ALL
    SELECT sku, sale_date + 3653, channel, region, NULL, NULL, NULL, NULL, NULL, units_sold * 2
    FROM daily_sales
    WHERE (sku, sale_date + 3653, channel, region) NOT IN
      (SELECT (sku, sale_date, channel, region) FROM daily_sales)
""", DAILY_DOUBLES)
def a7(t):
    """Load, then a batch without the other columns: two copies per key, and new keys."""
    stored = loads.open_table(t.spark, scratch_path(t.spark, "upsert"), "daily_sales")
    stored.upsert(t.daily_sales, stable=True)
    keys = [*stored.keys]
    units = F.col("units_sold")
    first = t.daily_sales.select(*keys, (units * 2).alias("units_sold"), F.lit(1).alias("copy"))
    later = first.withColumn("sale_date", F.date_add("sale_date", 3653))
    second = t.daily_sales.select(*keys, (units * 3).alias("units_sold"), F.lit(2).alias("copy"))
    batch = first.unionByName(second).unionByName(later)
    stored.upsert(batch.select(*keys, "units_sold", "copy"), order="copy", stable=True)
    return stored.read()


LOG_DOUBLES = "predicted_units confidence_lower confidence_upper"


@query("a8_insert_ignore_first_wins", """
    SELECT request_id, sku, channel, region, forecast_week, predicted_units, model_version
    FROM prediction_log UNION ALL
    SELECT 'r2', sku, channel, region, forecast_week, predicted_units + 1, model_version
    FROM prediction_log
""", "predicted_units", digits=3)
def a8(t):
    root = scratch_path(t.spark, "log")
    served = t.prediction_log.drop("actual_units", "scored_at")
    raised = served.withColumn("predicted_units", F.col("predicted_units") + 1)
    loads.write_prediction_log(t.spark, root, served)
    loads.write_prediction_log(
        t.spark, root, raised.unionByName(raised.withColumn("request_id", F.lit("r2")))
    )
    return loads.open_table(t.spark, root, "prediction_log").read().select(
        "request_id", *K.SERIES, "forecast_week", "predicted_units", "model_version"
    )


@query("a9_persisted_forecasts", """
    SELECT sku, channel, region, forecast_week, predicted_units + 1 AS predicted_units,
      confidence_lower, confidence_upper, model_version FROM prediction_log
""", LOG_DOUBLES, digits=3)
def a9(t):
    root = scratch_path(t.spark, "forecasts")
    rows = t.prediction_log.select(*K.SERIES, "forecast_week", *LOG_DOUBLES.split(), "model_version")
    loads.insert_forecasts(t.spark, root, rows)
    loads.insert_forecasts(
        t.spark, root, rows.withColumn("predicted_units", F.col("predicted_units") + 1)
    )
    return loads.open_table(t.spark, root, "demand_forecasts").read().drop("created_at")


@query("a10_persisted_weekly", """
    SELECT sku, week, channel, region, units_sold, lag_1, rolling_mean_4, target_next_week FROM weekly
""", "units_sold lag_1 rolling_mean_4 target_next_week", digits=3)
def a10(t):
    root = scratch_path(t.spark, "weekly")
    loads.load_weekly_features(t.spark, root, t.weekly)
    loads.load_weekly_features(t.spark, root, t.weekly)
    return loads.open_table(t.spark, root, "weekly_features").read().select(
        *K.WEEKLY_KEY, "units_sold", "lag_1", "rolling_mean_4", "target_next_week"
    )


@query("a11_product_master_load", "SELECT * FROM products")
def a11(t):
    root = scratch_path(t.spark, "products")
    loads.load_products(t.spark, root, t.daily, "date")
    return loads.open_table(t.spark, root, "products").read()


@query("a12_daily_load", f"""
    SELECT sku, sale_date, channel, region, {STORED_DAILY}, units_sold FROM daily_sales
""", DAILY_DOUBLES)
def a12(t):
    root = scratch_path(t.spark, "daily")
    loads.load_daily_sales(t.spark, root, t.daily, stable=True)
    return loads.open_table(t.spark, root, "daily_sales").read()


@query("a13_boolean_flag_load", """
    SELECT CAST(is_holiday_peak AS SMALLINT) AS is_holiday_peak,
      CAST(is_holiday_week AS SMALLINT) AS is_holiday_week, COUNT(*) AS row_count
    FROM weekly GROUP BY 1, 2
""")
def a13(t):
    root = scratch_path(t.spark, "flags")
    boolean = t.weekly.withColumn("is_holiday_peak", F.col("is_holiday_peak") == 1)
    loads.load_weekly_features(t.spark, root, boolean)
    stored = loads.open_table(t.spark, root, "weekly_features").read()
    return stored.groupBy("is_holiday_peak", "is_holiday_week").agg(F.count("*").alias("row_count"))


@query("a14_enrichment_load", """
    SELECT sku, week, channel, region, promo_rate, deliveries, avg_temp, inflation_index,
      CAST(school_in_session AS SMALLINT) AS school_in_session, event_score FROM template
""", "promo_rate avg_temp inflation_index event_score")
def a14(t):
    root = scratch_path(t.spark, "enrichment")
    loads.load_enrichment_features(t.spark, root, t.template)
    return loads.open_table(t.spark, root, "enrichment_features").read().drop(
        "price_avg", "stock_avg", "category_trend"
    )


def two_versions(t):
    """A catalog with two ridge versions per category; baselines of early and of all rows."""
    catalog = ModelCatalog(t.spark, scratch_path(t.spark, "catalog"))
    names = ("lag_1", "price_unit")
    rows = t.weekly_categorised.filter(F.col("target_next_week").isNotNull())
    for part in (rows.filter(F.col("year") < 1998), rows):
        model = fit_ridge(part, ("category",), names, target="target_next_week").persist()
        known = baselines_by_category(
            metrics.feature_baselines(part.select("category", *names), names, "category")
        )
        for row in model.collect():
            own = model.filter(F.col("category") == row["category"])
            catalog.save_ridge(
                own, S.model_name_text(row["category"]), metrics={}, features=names,
                training_rows=row["training_rows"], category=row["category"],
                baselines=known[row["category"]],
            )
        model.unpersist()
    return catalog


@query("a15_model_catalog", """
    SELECT concat('forecaster_', lower(category)) AS name, version, category, 'ridge' AS kind,
      COUNT(*) AS training_rows
    FROM weekly_cat, (SELECT unnest([1, 2]) AS version)
    WHERE target_next_week IS NOT NULL AND (version = 2 OR year < 1998) GROUP BY ALL
""")
def a15(t):
    return two_versions(t).list_models().select(
        "name", "version", "category", "kind", "training_rows"
    )


@query("a16_latest_baselines", """
    SELECT category, 'lag_1' AS feature, AVG(lag_1) AS mean, stddev_samp(lag_1) AS std
    FROM weekly_cat WHERE target_next_week IS NOT NULL GROUP BY category UNION ALL
    SELECT category, 'price_unit', AVG(price_unit), stddev_samp(price_unit)
    FROM weekly_cat WHERE target_next_week IS NOT NULL GROUP BY category
""", "mean std")
def a16(t):
    return two_versions(t).latest_baselines()


@query("a17_lineage_rows", """
    SELECT concat('run1_', substr(lower(category), 1, 4)) AS run_id, category,
      'v1' AS model_version, CAST(COUNT(*) AS INT) AS training_rows,
      round(greatest(-9999, least(9999, SUM(units_sold))), 6) AS train_mape,
      round(AVG(price_unit), 6) AS train_rmse, 'promoted' AS promotion_decision,
      '[]' AS drift_warnings
    FROM weekly_cat GROUP BY category
""", "train_mape train_rmse")
def a17(t):
    summary = t.weekly_categorised.groupBy("category").agg(
        F.count("*").alias("training_rows"), F.sum("units_sold").alias("mape"),
        F.avg("price_unit").alias("rmse"), F.avg("price_unit").alias("mae"),
        F.lit(None).cast("double").alias("r2"), F.lit("v1").alias("model_version"),
        F.lit("h").alias("data_hash"), F.lit(None).cast("string").alias("incumbent_version"),
        F.lit(None).cast("double").alias("incumbent_mape"), F.lit("promoted").alias("decision"),
        F.lit("[]").alias("drift_warnings"), F.lit("").alias("notes"),
    )
    lineage = loads.open_table(t.spark, scratch_path(t.spark, "lineage"), "model_lineage")
    jobs.record_lineage(lineage, summary, "run1")
    return lineage.read().select(
        "run_id", "category", "model_version", "training_rows", "train_mape", "train_rmse",
        "promotion_decision", "drift_warnings",
    )


@query("a18_row_counts", """
    SELECT 'products' AS table_name, COUNT(*) AS row_count FROM products UNION ALL
    SELECT 'daily_sales', COUNT(*) FROM daily_sales UNION ALL
    SELECT 'weekly_features', COUNT(*) FROM weekly UNION ALL
    SELECT 'prediction_log', COUNT(*) FROM prediction_log
""")
def a18(t):
    return analytics.row_counts({
        "products": t.products, "daily_sales": t.daily_sales, "weekly_features": t.weekly,
        "prediction_log": t.prediction_log,
    })


@query("l1_weekly_stream", "SELECT * FROM weekly_base",
       "units_sold delivered_qty stock_available price_unit delivery_days")
def l1(t):
    """Daily files arrive in three deliveries; each run upserts the weeks it touched."""
    root = scratch_path(t.spark, "stream")
    table = None
    early, late = F.col("date") < "1997-01-01", F.col("date") >= "1999-01-01"
    for n, rows in enumerate((early, ~early & ~late, F.coalesce(late, F.lit(True)))):
        t.daily.filter(rows).write.parquet(f"{root}/arrivals/{n}")
        table = run_weekly_stream(
            t.spark, f"{root}/arrivals", f"{root}/weekly", f"{root}/checkpoint"
        )
    return table.read()
