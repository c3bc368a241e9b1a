"""Explicit schemas of every table and file; readers never infer."""

from pyspark.sql import types as T

_STR, _DBL, _INT, _DATE, _TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.DateType(), T.TimestampType()
)


def _struct(spec):
    return T.StructType([T.StructField(name, kind) for name, kind in spec])


DAILY = _struct([
    ("date", _DATE), ("sku", _STR), ("brand", _STR), ("segment", _STR), ("category", _STR),
    ("channel", _STR), ("region", _STR), ("pack_type", _STR), ("price_unit", _DBL),
    ("promotion_flag", _INT), ("delivery_days", _INT), ("stock_available", _DBL),
    ("delivered_qty", _DBL), ("units_sold", _DBL),
])
PRODUCTS = _struct([(c, _STR) for c in ("sku", "brand", "segment", "category", "pack_type")])
WEEKLY = _struct([
    ("sku", _STR), ("week", _DATE), ("channel", _STR), ("region", _STR), ("units_sold", _DBL),
    ("stock_available", _DBL), ("promotion_flag", _INT), ("price_unit", _DBL),
    ("delivery_days", _DBL), ("is_holiday_peak", _INT), ("week_number", _INT), ("month", _INT),
    ("year", _INT), ("is_holiday_week", _INT), ("is_summer", _INT), ("is_winter", _INT),
    ("sku_age", _INT), ("lifecycle_stage", _STR), ("lag_1", _DBL), ("lag_2", _DBL),
    ("rolling_mean_4", _DBL), ("rolling_std_4", _DBL), ("momentum", _DBL),
    ("target_next_week", _DBL),
])
ENRICHED = _struct([
    ("sku", _STR), ("week", _DATE), ("channel", _STR), ("region", _STR), ("price_avg", _DBL),
    ("promo_rate", _DBL), ("stock_avg", _DBL), ("deliveries", _INT), ("avg_temp", _DBL),
    ("inflation_index", _DBL), ("school_in_session", _INT), ("category_trend", _DBL),
    ("event_score", _DBL),
])
BASELINE = T.StructType([T.StructField("mean", _DBL), T.StructField("std", _DBL)])
MODEL_CARD = _struct([
    ("name", _STR), ("version", _INT), ("kind", _STR), ("path", _STR),
    ("metrics", T.MapType(_STR, _DBL)), ("metric_kind", _STR),
    ("features", T.ArrayType(_STR)), ("training_rows", T.LongType()), ("category", _STR),
    ("created_at", _STR), ("feature_baselines", T.MapType(_STR, BASELINE)),
])
