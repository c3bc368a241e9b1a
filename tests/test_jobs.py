import pytest
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models import boosting, ridge
from shelfcast.operators.features import build_training_features
from shelfcast.plans import jobs
from shelfcast.session import scratch_path
from shelfcast.sources import loads
from shelfcast.sources.catalog import ModelCatalog

AS_OF = "2001-10-01"


def test_failed_gate_stops_retraining(spark, small):
    catalog = ModelCatalog(spark, scratch_path(spark, "catalog"))
    lineage = loads.open_table(spark, scratch_path(spark, "lineage"), "model_lineage")
    with pytest.raises(RuntimeError, match="target_next_week"):
        jobs.retrain(spark, small.weekly_categorised, catalog, lineage, AS_OF)


def test_scoring_twice_on_one_day_keeps_the_days_metrics(spark, small):
    root = scratch_path(spark, "scoring")
    log = loads.open_table(spark, root, "prediction_log")
    live = loads.open_table(spark, root, "model_performance_live")
    served = small.prediction_log.drop("actual_units", "scored_at")
    late = F.col("channel") == "Retail"

    def run():
        return jobs.score_predictions(log, live, small.products, small.daily_sales, AS_OF)

    log.insert_new(served.filter(~late))
    dry = jobs.score_predictions(log, live, small.products, small.daily_sales, AS_OF, dry_run=True)
    assert dry.count() > 0 and live.read().count() == 0
    first = run().agg(F.sum("samples")).first()[0]
    log.insert_new(served.filter(late))
    second = run().agg(F.sum("samples")).first()[0]
    scored = log.read().filter("scored_at IS NOT NULL").count()
    assert first < second == scored
    assert live.read().agg(F.sum("samples")).first()[0] == scored


def test_batch_without_known_products_falls_back(spark, small):
    batch = small.daily.filter(F.col("sku") == "BR-011").withColumn("sku", F.lit("XX-001"))
    history = jobs.batch_history(batch.drop("category"), small.weekly)
    row = history.orderBy("week").first()
    assert (row["category"], row["lifecycle_stage"], row["lag_1"]) == ("Milk", "Decline", 0.0)
    ages = history.filter("channel = 'Retail' AND region = 'PL-North'").orderBy("week").collect()
    assert [r["sku_age"] for r in ages[:2]] == [1, 2]


def test_stale_categories_need_a_known_run(spark):
    rows = [("Milk", "2024-01-01"), ("Juice", "2024-02-25"), ("Yogurt", None)]
    frame = spark.createDataFrame(rows, "category string, completed_at string").withColumn(
        "completed_at", F.col("completed_at").cast("timestamp"))
    stale = {r["category"] for r in jobs.stale_categories(frame, "2024-03-01").collect()}
    assert stale == {"Milk", "Yogurt"}
    none = frame.withColumn("completed_at", F.lit(None).cast("timestamp"))
    assert jobs.stale_categories(none, "2024-03-01").count() == 0
    assert jobs.days_since_retrain(none, "2024-03-01").first()[0] is None
    assert jobs.days_since_retrain(frame, "2024-02-01").first()[0] == 0


def test_retraining_rejects_promotes_and_reports_drift(spark, small):
    """No incumbent, then a far better incumbent, then a worse one, and a dry run."""
    panel = small.weekly_categorised.filter("category IN ('Milk', 'Juice')").persist()
    root = scratch_path(spark, "retrain")
    catalog = ModelCatalog(spark, f"{root}/models")
    lineage = loads.open_table(spark, root, "model_lineage")
    expected = {**K.GATE, "skus": 25, "missing_rate": 0.05}

    def run(**more):
        summary = jobs.retrain(spark, panel, catalog, lineage, AS_OF, expected=expected, interval="residual",
                               boosting_settings={"rounds": 5}, **more)
        return {r["category"]: r for r in summary.collect()}

    def pretend(category, mape, mean):
        name = S.model_name_text(category)
        card = {"mape": mape, "rmse": 1.0, "mae": 1.0, "r2": 0.0}
        catalog.save(lambda path: None, name, "ridge", card, ["lag_1"], category=category,
                     baselines={"lag_1": (mean, 0.001)}, metric_kind="walk_forward")

    dry = run(dry_run=True)
    assert {r["model_version"] for r in dry.values()} == {"forecaster_milk_v[dry-run]", "forecaster_juice_v[dry-run]"}
    assert lineage.read().count() == 0 and catalog.cards().count() == 0
    first = run()
    assert {r["decision"] for r in first.values()} == {"no_incumbent"} and catalog.cards().count() == 2
    assert all(r["drift_count"] == 0 for r in first.values())
    pretend("Milk", 0.001, -1000.0)
    pretend("Juice", 1e9, -1000.0)
    second = run()
    assert (second["Milk"]["decision"], second["Juice"]["decision"]) == ("rejected", "promoted")
    assert second["Milk"]["model_version"] == "forecaster_milk_vPENDING"
    assert second["Juice"]["model_version"] == "forecaster_juice_v3"
    assert second["Juice"]["incumbent_version"] == "forecaster_juice_v2"
    assert all(r["drift_count"] > 0 and "lag_1" in r["drift_warnings"] for r in second.values())
    assert lineage.read().count() == 4
    kind = {r["category"]: r["kind"] for r in catalog.latest().collect()}
    assert kind["Milk"] == "ridge" and catalog.get("forecaster_juice")["version"] == 3
    panel.unpersist()


def test_batch_from_a_catalog_of_both_kinds(spark, small):
    """Stored forecasts equal those of the models by themselves and carry their versions."""
    root = scratch_path(spark, "batch")
    catalog = ModelCatalog(spark, f"{root}/models")
    train = build_training_features(small.weekly_categorised, carry=("category",)).persist()
    linear = ridge.fit_ridge(train, ("category",), K.FEATURES).persist()
    boosted = boosting.fit_forecasters(train.filter("category = 'Milk'"), K.FEATURES, ("category",), rounds=5)
    for category in ("Milk", "Juice"):
        catalog.save_ridge(linear.filter(F.col("category") == category), S.model_name_text(category),
                           metrics={}, features=K.FEATURES, category=category)
    catalog.save_boosted(boosted[("Milk",)], "forecaster_milk", metrics={}, features=K.FEATURES, category="Milk")
    small.daily.write.parquet(f"{root}/input")
    assert jobs.run_batch_from_catalog(spark, root, f"{root}/input", small.weekly, catalog, 2, "one") == "one"
    stored = loads.open_table(spark, root, "batch_predictions").read().persist()
    versions = {r["model_version"] for r in stored.select("model_version").distinct().collect()}
    assert versions == {"forecaster_milk_v2", "forecaster_juice_v1"}
    keys = ("sku", "channel", "region", "week")
    for category, model in (("Milk", {"Milk": (boosted[("Milk",)], "")}), ("Juice", linear)):
        want = jobs.score_batch(small.daily, small.weekly, model, 2).filter(F.col("category") == category)
        both = want.join(stored, list(keys))
        gap = F.max(F.abs(F.col("point") - F.col("predicted_units").cast("double")))
        assert both.count() == want.count() > 0 and both.agg(gap).first()[0] < 1e-3
    train.unpersist()


def test_months_under_scoring_prune_the_facts_while_the_query_runs(spark, small):
    """The scan of the daily files is filtered by a subquery on their month, with no job before it."""
    first = small.prediction_log.agg(F.min("forecast_week")).first()[0]
    log = small.prediction_log.filter(F.col("forecast_week") < F.date_add(F.lit(first), 42))
    plan = jobs.weekly_actuals(small.daily_sales_by_month, log)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnotnull(_part" in plan
    want = jobs.weekly_actuals(small.daily_sales, log)
    got = jobs.weekly_actuals(small.daily_sales_by_month, log)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()


def test_months_of_a_keyed_table_prune_as_well(spark, small):
    table = loads.open_table(spark, scratch_path(spark, "t"), "daily_sales")
    table.upsert(small.daily_sales.filter("sale_date < '1997-01-01'"))
    table.upsert(small.daily_sales.filter("sale_date < '1996-07-01'").withColumn("units_sold", F.lit(1.0)))
    with_month = table.read(with_part=True)
    assert with_month.filter("_part <> date_format(sale_date, 'yyyy-MM')").count() == 0
    assert with_month.drop("_part").exceptAll(table.read()).count() == 0
    plan = with_month.filter("_part = '1996-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan


def test_etl_reads_the_daily_input_once_and_counts_on_the_way(spark, small):
    passed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    daily = small.daily.mapInArrow(seen, small.daily.schema)
    counts = jobs.full_etl(spark, daily, small.weekly, small.template, scratch_path(spark, "etl"))
    found = {r["table_name"]: r["row_count"] for r in counts.collect()}
    assert found["daily_rows"] == small.daily.count() == passed.value
    assert found["weekly_rows_aggregated"] == found["enriched_rows"] == small.weekly_base.count()
    assert found["weekly_rows_modeling"] == small.weekly.count()
