"""Loads of the stored tables: projection, types and key, then upsert."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas
from shelfcast.operators.windows import first_rows
from shelfcast.sources.snapshots import input_order, table


def _schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


_STR, _DATE, _TS, _INT = T.StringType(), T.DateType(), T.TimestampType(), T.IntegerType()


def _dec(p, s):
    return T.DecimalType(p, s)


DAILY_SALES = _schema(
    ("sku", _STR), ("sale_date", _DATE), ("channel", _STR), ("region", _STR),
    ("price_unit", _dec(10, 4)), ("promotion_flag", T.ShortType()),
    ("delivery_days", T.ShortType()), ("stock_available", _dec(14, 4)),
    ("delivered_qty", _dec(14, 4)), ("units_sold", _dec(14, 4)),
)
WEEKLY_DECIMALS = {
    "units_sold": (14, 4), "stock_available": (14, 4), "price_unit": (10, 4),
    "delivery_days": (6, 3), "lag_1": (14, 4), "lag_2": (14, 4), "rolling_mean_4": (14, 4),
    "rolling_std_4": (14, 4), "momentum": (14, 4), "target_next_week": (14, 4),
}
WEEKLY_FEATURES = T.StructType([
    T.StructField(f.name, _dec(*WEEKLY_DECIMALS[f.name]) if f.name in WEEKLY_DECIMALS
                  else T.ShortType() if f.dataType == _INT and f.name != "sku_age"
                  else f.dataType)
    for f in schemas.WEEKLY.fields
])
ENRICHMENT_FEATURES = _schema(
    ("sku", _STR), ("week", _DATE), ("channel", _STR), ("region", _STR),
    ("price_avg", _dec(10, 4)), ("promo_rate", _dec(6, 4)), ("stock_avg", _dec(14, 4)),
    ("deliveries", _INT), ("avg_temp", _dec(6, 2)), ("inflation_index", _dec(8, 4)),
    ("school_in_session", T.ShortType()), ("category_trend", _dec(10, 4)),
    ("event_score", _dec(8, 4)),
)
_POINT = [
    (n, _dec(14, 4)) for n in ("predicted_units", "confidence_lower", "confidence_upper")
]
DEMAND_FORECASTS = _schema(
    ("sku", _STR), ("channel", _STR), ("region", _STR), ("forecast_week", _DATE), *_POINT,
    ("model_version", _STR), ("created_at", _TS),
)
BATCH_PREDICTIONS = _schema(
    ("batch_id", _STR), ("sku", _STR), ("week", _DATE), ("channel", _STR), ("region", _STR),
    *_POINT, ("model_version", _STR), ("created_at", _TS),
)
PREDICTION_LOG = _schema(
    ("request_id", _STR), ("sku", _STR), ("channel", _STR), ("region", _STR),
    ("forecast_week", _DATE), *_POINT, ("model_version", _STR), ("served_at", _TS),
    ("actual_units", _dec(14, 4)), ("scored_at", _TS),
)
MODEL_LINEAGE = _schema(
    ("run_id", _STR), ("started_at", _TS), ("completed_at", _TS), ("category", _STR),
    ("model_version", _STR), ("data_hash", _STR), ("training_rows", _INT),
    ("train_mape", _dec(10, 6)), ("train_rmse", _dec(14, 6)), ("train_mae", _dec(14, 6)),
    ("train_r2", _dec(10, 6)), ("incumbent_version", _STR), ("incumbent_mape", _dec(10, 6)),
    ("promotion_decision", _STR), ("drift_warnings", _STR), ("notes", _STR),
)
MODEL_PERFORMANCE_LIVE = _schema(
    ("scored_date", _DATE), ("model_version", _STR), ("category", _STR), ("samples", _INT),
    ("live_mape", _dec(10, 6)), ("live_rmse", _dec(14, 6)), ("live_mae", _dec(14, 6)),
)


def open_table(spark, root, name):
    """One of the nine stored tables; the large ones are partitioned by month.

    A day's load then reads and rewrites one month, not the year.
    """
    def month(date):
        return F.date_format(date, "yyyy-MM")

    layout = {
        "products": (schemas.PRODUCTS, None),
        "daily_sales": (DAILY_SALES, month("sale_date")),
        "weekly_features": (WEEKLY_FEATURES, month("week")),
        "enrichment_features": (ENRICHMENT_FEATURES, month("week")),
        "demand_forecasts": (DEMAND_FORECASTS, month("forecast_week")),
        "batch_predictions": (BATCH_PREDICTIONS, month("week")),
        "prediction_log": (PREDICTION_LOG, month("forecast_week")),
        "model_lineage": (MODEL_LINEAGE, None),
        "model_performance_live": (MODEL_PERFORMANCE_LIVE, month("scored_date")),
    }
    return table(spark, root, name, *layout[name])


def product_master(daily, order):
    """Distinct products, the first row per SKU in the given order."""
    return first_rows(daily, "sku", order, ["brand", "segment", "category", "pack_type"])


def load_products(spark, root, daily, order=None):
    """Product master from daily rows; file order decides unless `order` names a column."""
    place = input_order(daily) if order is None else F.col(order)
    kept = daily.select("sku", "brand", "segment", "category", "pack_type", place.alias("_place"))
    order = "_place"
    return open_table(spark, root, "products").upsert(product_master(kept, order))


def daily_rows(daily):
    return daily.withColumnRenamed("date", "sale_date").select(*DAILY_SALES.names)


def load_daily_sales(spark, root, daily, order=None, stable=False):
    """`stable`: daily is a plain read of files, see SnapshotTable.upsert."""
    return open_table(spark, root, "daily_sales").upsert(daily_rows(daily), order, stable)


def weekly_rows(weekly):
    """Weekly rows with a boolean holiday flag brought to 0/1; other flags stay as they are."""
    if dict(weekly.dtypes).get("is_holiday_peak") == "boolean":
        weekly = weekly.withColumn("is_holiday_peak", F.col("is_holiday_peak").cast("short"))
    return weekly.select(*[c for c in WEEKLY_FEATURES.names if c in weekly.columns])


def load_weekly_features(spark, root, weekly):
    return open_table(spark, root, "weekly_features").upsert(weekly_rows(weekly))


def load_enrichment_features(spark, root, enriched):
    return open_table(spark, root, "enrichment_features").upsert(
        enriched.select(*ENRICHMENT_FEATURES.names)
    )


def insert_forecasts(spark, root, rows):
    return open_table(spark, root, "demand_forecasts").upsert(rows)


def insert_batch_predictions(spark, root, rows):
    return open_table(spark, root, "batch_predictions").upsert(rows)


def write_prediction_log(spark, root, rows):
    """Served forecasts; a request that was already logged stays as it is."""
    return open_table(spark, root, "prediction_log").insert_new(rows)
