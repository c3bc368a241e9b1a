"""Fixed values of the domain: enumerations, thresholds, encodings and texts."""

# --- fixed values: enumerations -------------------------------------------
CATEGORIES = ("Milk", "Yogurt", "ReadyMeal", "Juice", "SnackBar")
CHANNELS = ("Retail", "Discount", "E-commerce")
REGIONS = ("PL-Central", "PL-North", "PL-South")
PACK_TYPES = ("Multipack", "Single", "Carton")
LIFECYCLE_STAGES = ("Growth", "Mature", "Decline")
PROMOTION_DECISIONS = ("promoted", "rejected", "no_incumbent")
SKU_PATTERN = "^[A-Z]{2}-[0-9]{3}$"
MODEL_NAME_PATTERN = "^[A-Za-z0-9_\\-]+$"
IDENTIFIER_PATTERN = "^[a-z_][a-z0-9_]*$"

# --- fixed values: lookups ------------------------------------------------
CATEGORY_BY_PREFIX = {"MI": "Milk", "YO": "Yogurt", "RE": "ReadyMeal", "JU": "Juice", "SN": "SnackBar"}
LIFECYCLE_CODE = {"Decline": 0, "Mature": 1, "Growth": 2}
CHANNEL_CODE = {"Discount": 0, "Retail": 1, "E-commerce": 2}
REGION_CODE = {"PL-South": 0, "PL-Central": 1, "PL-North": 2}
UNKNOWN_CODE = 1

# --- fixed values: calendar -----------------------------------------------
HOLIDAY_WEEKS = (14, 17, 18, 43, 44, 51, 52)
SUMMER_MONTHS = (6, 7, 8)
WINTER_MONTHS = (12, 1, 2)

# --- fixed values: keys and column orders ---------------------------------
SERIES = ("sku", "channel", "region")
WEEKLY_KEY = ("sku", "week", "channel", "region")
LAG_COLUMNS = ("lag_1", "lag_2", "rolling_mean_4", "rolling_std_4", "momentum")
PANEL_FEATURES = (
    "lag_1", "lag_2", "rolling_mean_4", "rolling_std_4", "momentum",
    "is_holiday_peak", "is_holiday_week", "is_summer", "is_winter",
    "week_number", "month", "year", "sku_age",
    "promotion_flag", "price_unit", "delivery_days", "stock_available",
)
DERIVED_FEATURES = (
    "lifecycle_encoded", "channel_encoded", "region_encoded",
    "price_vs_category_avg", "stock_to_demand_ratio", "promo_lag_1",
)
FEATURES = PANEL_FEATURES + DERIVED_FEATURES
CLUSTER_FEATURES = (
    "avg_weekly_demand", "demand_coefficient_of_variation", "seasonality_strength",
    "trend_slope", "promo_sensitivity", "lifecycle_stage_encoded", "price_point_normalized",
)
ENRICHMENT_COLUMNS = (
    "price_avg", "promo_rate", "stock_avg", "deliveries", "avg_temp", "inflation_index",
    "school_in_session", "category_trend", "event_score",
)
TABLE_KEYS = {
    "products": ("sku",),
    "daily_sales": ("sku", "sale_date", "channel", "region"),
    "weekly_features": WEEKLY_KEY,
    "enrichment_features": WEEKLY_KEY,
    "demand_forecasts": ("sku", "channel", "region", "forecast_week", "model_version"),
    "batch_predictions": ("batch_id", "sku", "week", "channel", "region"),
    "prediction_log": ("request_id", "sku", "channel", "region", "forecast_week"),
    "model_lineage": ("run_id",),
    "model_performance_live": ("scored_date", "model_version", "category"),
}

# --- fixed values: thresholds ---------------------------------------------
DIVISOR_FLOOR = 1e-12
MIN_PRICE = 1e-6
DELIVERY_RANGE = (1, 5)
SPIKE_SIGMA = 2.5
DROP_SIGMA = 2.0
STOCK_RISK_WEEKS = 2.0
PRICE_DEVIATION = 0.15
MAPE_FLOOR = 1e-9
QUANTILES = (0.1, 0.9)
RESIDUAL_Z = 1.2816
RIDGE_ALPHA = 1.0
BOOSTING = {"rounds": 200, "depth": 5, "rate": 0.05, "min_leaf": 20, "seed": 42}
HORIZON_DEFAULT, HORIZON_MAX = 4, 12
HISTORY_WEEKS = 26
FOLDS = {"splits": 5, "train_weeks": 100, "test_weeks": 4}
MODEL_CHOICE_TOLERANCE = 5.0
INCUMBENT_TOLERANCE = 1.05
DRIFT_SIGMA = 2.0
DRIFT_STD_FLOOR = 1e-9
METRIC_CLAMP = 9999.0
SETTLE_DAYS = 7
LIVE_WINDOW_DAYS = 7
STALE_MODEL_DAYS = 14
PROMO_LIFT_STRONG = 15.0
GROWTH_REPORTED = 5.0
INSIGHT_LIMIT = 5
TOP_PRODUCTS_MAX = 100
INVENTORY_DAYS_MAX = 30
TREND_MONTHS_MAX = 24
K_RANGE = (3, 6)
KMEANS_STARTS = 10
PROJECTION_CLIP = (0.5, 1.5)
FALLBACK_STAGE, FALLBACK_AGE, FALLBACK_CATEGORY = "Decline", 1, "Milk"
GATE = {
    "skus": 30, "channels": 3, "regions": 3, "missing_rate": 0.01,
    "units_mean": (50.0, 200.0), "price_mean": (3.0, 8.0), "recency_days": 30,
}
GATE_COLUMNS = (
    "sku", "week", "channel", "region", "units_sold", "stock_available", "promotion_flag",
    "price_unit", "delivery_days", "is_holiday_peak", "week_number", "month", "year",
    "is_holiday_week", "is_summer", "is_winter", "sku_age", "lifecycle_stage", "lag_1", "lag_2",
    "rolling_mean_4", "rolling_std_4", "momentum", "target_next_week",
)
GATE_TEXT_COLUMNS = ("sku", "week", "channel", "region", "promotion_flag", "lifecycle_stage")
GATE_MISSING_EXEMPT = ("lag_1", "lag_2")

# --- fixed values: texts --------------------------------------------------
ALERT_TEXT = {
    "demand_spike": "Review supply lines; may indicate viral demand or data issue.",
    "demand_drop": "Investigate channel listing or stockouts.",
    "return_anomaly": "Verify return reason in upstream POS.",
    "stock_risk": "Trigger replenishment order.",
    "price_anomaly": "Confirm pricing change is intentional.",
    "promo_cannibalization": "Review promo ROI and channel mix.",
}
CLUSTER_LABELS = (
    "High-Volume Steady", "Seasonal Responders", "Promo-Dependent",
    "Declining Niche", "Mid-Tier Consistent",
)
CLUSTER_LIMITS = {"cv": 0.3, "seasonality": 1.5, "promo": 1.3, "lifecycle": 0.7}
