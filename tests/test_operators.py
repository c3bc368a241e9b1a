import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models.selection import choose_model, compare_to_incumbent
from shelfcast.operators import alerts, analytics, cleaning, metrics, quality, quantiles, weekly, windows
from shelfcast.operators.features import add_derived_features, as_features, build_training_features
from shelfcast.operators.fingerprint import fingerprint
from tests.conftest import series

DAILY = ("date string, sku string, brand string, segment string, category string, channel string, "
         "region string, pack_type string, price_unit double, promotion_flag int, "
         "delivery_days int, stock_available double, delivered_qty double, units_sold double")


def daily(spark):
    rows = []
    for i in range(10):
        sku = "MI-006" if i % 2 == 0 else "YO-001"
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        units = -5.0 if i == 4 else 25.0 + i
        rows.append((str(day), sku, "b", "s", "Milk", "Retail", "PL-North", "Single", 2.0, 0, 2,
                     100.0, 30.0, units))
    return spark.createDataFrame(rows, DAILY)


def test_returns_survive_cleaning(spark):
    cleaned = cleaning.clean_daily_data(daily(spark))
    assert cleaned.count() == 10
    assert [r["units_sold"] for r in cleaned.filter("is_return").collect()] == [-5.0]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="brand.*channel"):
        cleaning.clean_daily_data(daily(spark).drop("channel", "brand"))


def test_violation_counts_treat_missing_as_unknown(spark):
    frame = daily(spark).withColumn("region", F.when(F.col("sku") == "MI-006", F.col("region")))
    row = cleaning.count_violations(frame).first()
    assert (row["unknown_enums"], row["non_positive_price"], row["delivery_out_of_range"]) == (5, 0, 0)


def test_weekly_sums_conserve_units(spark):
    cleaned = cleaning.clean_daily_data(daily(spark))
    total = weekly.aggregate_to_weekly(cleaned).agg(F.sum("units_sold")).first()[0]
    assert total == cleaned.agg(F.sum("units_sold")).first()[0]


def test_filled_lags_known_answer(spark):
    rows = windows.compute_lag_features(series(spark, range(10, 70, 10))).orderBy("week").collect()
    column = {c: [round(r[c], 4) for r in rows] for c in K.LAG_COLUMNS}
    assert column["lag_1"] == [10, 10, 20, 30, 40, 50]
    assert column["lag_2"] == [10, 10, 10, 20, 30, 40]
    assert column["rolling_mean_4"] == [10, 10, 15, 20, 25, 35]
    assert column["rolling_std_4"] == [7.0711, 7.0711, 7.0711, 10, 12.9099, 12.9099]
    assert column["momentum"] == [10] * 6


def test_forward_fill_only(spark):
    rows = windows.compute_lag_features(series(spark, [10, 20, 30]), mode="forward")
    assert [r["lag_1"] for r in rows.orderBy("week").collect()] == [0, 10, 20]


def test_single_row_series_fills_with_zero(spark):
    row = windows.compute_lag_features(series(spark, [10])).first()
    assert [row[c] for c in K.LAG_COLUMNS] == [0.0] * 5


def test_enrichment_defaults(spark):
    base = weekly.aggregate_to_weekly(cleaning.clean_daily_data(daily(spark)))
    template = spark.createDataFrame(
        [("2024-01-01", 2.0, 1.0, 1, 1.0, 0.5), ("2024-03-04", 4.0, 2.0, 0, 3.0, 1.5),
         ("2024-03-11", 6.0, 3.0, 0, 5.0, 2.5)],
        "week string, avg_temp double, inflation_index double, school_in_session int, "
        "category_trend double, event_score double",
    ).withColumn("week", F.col("week").cast("date"))
    rows = weekly.enrich_features(base, template).collect()
    by_week = {str(r["week"]): r for r in rows}
    assert by_week["2024-01-01"]["avg_temp"] == 2.0
    assert by_week["2024-01-08"]["avg_temp"] == 4.0
    assert by_week["2024-01-08"]["school_in_session"] == 0


def test_safe_divide_and_fixed_text(spark):
    frame = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (12.25, None)], "n double, d double")
    rows = frame.select(S.safe_divide("n", "d", -1.0).alias("q"),
                        S.fixed_text("n", 1).alias("t")).collect()
    assert [r["q"] for r in rows] == [-1.0, 0.25, -1.0]
    assert rows[2]["t"] == "12.2"


def test_iso_week_keeps_calendar_year(spark):
    row = spark.sql("SELECT DATE '2024-12-30' AS week").withColumns(S.calendar_columns()).first()
    assert (row["week_number"], row["month"], row["year"], row["is_winter"]) == (1, 12, 2024, 1)


def test_price_ratio_without_category(spark):
    extra = {"price_unit": F.lit(0.0), "stock_available": F.lit(5.0), "rolling_mean_4": F.lit(0.0),
             "promotion_flag": F.lit(1), "lifecycle_stage": F.lit("New")}
    rows = add_derived_features(series(spark, [1, 2], extra)).orderBy("week").collect()
    assert [r["price_vs_category_avg"] for r in rows] == [1.0, 1.0]
    assert [r["promo_lag_1"] for r in rows] == [0, 1]
    assert rows[0]["lifecycle_encoded"] == 1 and rows[0]["stock_to_demand_ratio"] == 0.0


def test_training_features_need_a_target(spark):
    with pytest.raises(ValueError, match="target_next_week"):
        build_training_features(series(spark, [1]))


def test_absent_features_are_zero(spark):
    row = series(spark, [1]).select(*as_features(series(spark, [1]), ("lag_1",))).first()
    assert row["lag_1"] == 0.0


def alert_rows(spark, units, mean, std, stock=1000.0, price=10.0, average=10.0):
    frame = series(spark, [units], {
        "rolling_mean_4": F.lit(mean), "rolling_std_4": F.lit(std),
        "stock_available": F.lit(stock), "price_unit": F.lit(price), "price_avg": F.lit(average),
        "promotion_flag": F.lit(0),
    })
    return [(r["alert_type"], r["severity"]) for r in alerts.check_alerts(frame).collect()]


def test_alert_rules(spark):
    assert alert_rows(spark, 10, 100.0, 20.0) == [("demand_drop", "MEDIUM")]
    assert alert_rows(spark, 200, 100.0, 20.0) == [("demand_spike", "HIGH")]
    assert alert_rows(spark, -3, 0.0, 0.0) == [("return_anomaly", "LOW")]
    assert alert_rows(spark, 100, 100.0, 20.0, stock=150.0) == [("stock_risk", "HIGH")]
    assert alert_rows(spark, 100, 100.0, 20.0, price=12.0) == [("price_anomaly", "LOW")]
    assert alert_rows(spark, 100, 100.0, None) == []


def test_live_metrics_known_answer(spark):
    rows = [("m", "Milk", 100.0, 100.0), ("m", "Milk", 50.0, 0.0), ("m", "Milk", 80.0, 100.0)]
    frame = spark.createDataFrame(
        rows, "model_version string, category string, predicted_units double, actual_units double")
    row = metrics.live_metrics(frame).first()
    assert row["samples"] == 3 and abs(row["live_mape"] - 0.10) < 1e-9
    assert abs(row["live_mae"] - 70 / 3) < 1e-9 and abs(row["live_rmse"] - 31.0913) < 1e-3
    zero = metrics.live_metrics(frame.withColumn("actual_units", F.lit(0.0))).first()
    assert zero["live_mape"] == 0.0


def test_r2_of_constant_targets(spark):
    frame = spark.createDataFrame([(5.0, 5.0, 4.0)] * 3, "y double, exact double, off double")
    assert metrics.evaluate(frame, "y", "exact").first()["r2"] == 1.0
    assert metrics.evaluate(frame, "y", "off").first()["r2"] == 0.0
    assert metrics.evaluate(frame.limit(1), "y", "off").first()["r2"] == 0.0


def test_drift_needs_two_deviations(spark):
    now = spark.createDataFrame([("a", 4.0), ("b", 4.0), ("c", 9.0)], "feature string, mean double")
    base = spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 1.0), ("c", 1.0, 0.0)],
                                 "feature string, mean double, std double")
    rows = metrics.detect_drift(now, base).collect()
    assert [(r["feature"], r["sigma_shift"]) for r in rows] == [("a", 3.0)]


def test_model_choice_and_incumbent_boundaries(spark):
    def mape(*rows):
        return spark.createDataFrame(rows, "category string, mape double")

    choice = choose_model(mape(("a", 9.8), ("b", 9.0)), mape(("a", 10.0), ("b", 10.0)), "category")
    assert {r["category"]: r["winner"] for r in choice.collect()} == {"a": "ridge", "b": "gbr"}
    old = mape(("a", 10.0), ("b", 0.21), ("c", 0.20)).withColumn("version", F.lit("v1"))
    new = mape(("a", 10.5), ("b", 0.221), ("c", 0.30), ("d", 1.0))
    decided = {r["category"]: r["decision"] for r in compare_to_incumbent(new, old).collect()}
    assert decided == {"a": "promoted", "b": "rejected", "c": "rejected", "d": "no_incumbent"}


def test_gate_fails_on_missing_column_only(small):
    report = quality.validation_report(small.weekly.drop("lifecycle_stage"), "2001-11-01")
    failed = {r["name"] for r in report.filter("level = 'FAIL' AND NOT ok").collect()}
    assert "schema_columns" in failed and not quality.gate_passed(report)
    levels = {r["name"]: r["level"] for r in report.collect()}
    assert levels["dist_units_sold"] == "WARN"


def test_strict_rules_raise(small):
    rules = quality.table_rules()["daily_sales"]
    quality.enforce(small.daily_sales, rules)
    with pytest.raises(ValueError, match="price_positive"):
        quality.enforce(small.daily_sales.withColumn("price_unit", F.lit(0.0)), rules)


def test_fingerprint_ignores_order_and_sees_duplicates(spark):
    frame = spark.range(100).withColumn("x", F.col("id") % 7)
    a = fingerprint(frame).first()["data_hash"]
    assert len(a) == 32
    assert a == fingerprint(frame.orderBy(F.col("id").desc()).repartition(3)).first()["data_hash"]
    assert a != fingerprint(frame.union(frame.limit(1)).union(frame.limit(1))).first()["data_hash"]


def test_exact_quantiles_match_numpy_with_a_hot_value(spark):
    import numpy as np

    values = [7.0] * 400 + [float(i * i % 997) for i in range(701)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    got = {r["probability"]: r["quantile"]
           for r in quantiles.exact_quantiles(frame, ["v"], (0.1, 0.25, 0.5, 0.9)).collect()}
    for p, q in got.items():
        assert abs(q - np.quantile(values, p)) < 1e-9


def test_trend_change_is_null_then_percent(spark):
    products = spark.createDataFrame([("MI-006", "Milk")], "sku string, category string")
    sales = spark.createDataFrame([("MI-006", "2024-01-05", 1200.0), ("MI-006", "2024-02-05", 1500.0)],
                                  "sku string, sale_date string, units_sold double")
    rows = analytics.category_trends(
        sales.withColumn("sale_date", F.col("sale_date").cast("date")), products).collect()
    assert [r["delta_pct"] for r in rows] == [None, 25.0]


def test_arguments_are_checked(small):
    with pytest.raises(ValueError):
        analytics.top_products(small.weekly_categorised, 0)
    with pytest.raises(ValueError):
        analytics.sales_summary(small.daily_sales, small.products, "2001-01-02", "2001-01-01")


def test_correlations_are_pairwise_complete(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, None), (3.0, None, 5.0), (4.0, 7.0, 5.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    want = frame.toPandas().corr().fillna(0.0)
    for r in analytics.correlations(frame).collect():
        assert abs(r["corr"] - want.loc[r["left"], r["right"]]) < 1e-12


def test_series_means_do_not_move_with_the_order_of_rows(spark):
    """95 days over 32 weeks are 2.96875, a tie at four digits; plain sums fall on either side of it."""
    days = [7 / 3] * 15 + [10 / 3] * 7 + [11 / 3] * 10
    means = set()
    for order in (days, days[::-1], days[1::2] + days[::2]):
        frame = series(spark, order).coalesce(1).withColumns({
            "delivery_days": F.col("units_sold"), "price_unit": -F.col("units_sold"),
            "stock_available": F.when(F.col("units_sold") < 3, F.lit(float("inf"))), "sku_age": F.lit(1),
        })
        row = analytics.series_statistics(frame).withColumn("rounded", F.round("mean_dd", 4)).collect()[0]
        means.add((row["mean_dd"], row["mean_us"], row["mean_price"], row["rounded"], row["mean_stock"]))
    assert means == {(2.96875, 2.96875, -2.96875, 2.9688, float("inf"))}
    empty = frame.withColumn("price_unit", F.lit(None).cast("double"))
    assert analytics.series_statistics(empty).collect()[0]["mean_price"] is None
