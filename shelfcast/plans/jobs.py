"""Batch jobs: load, ETL, scoring of served forecasts, training, batch forecasts."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models import boosting, folds, ridge, selection
from shelfcast.models.clustering import fit_clustering
from shelfcast.models.horizon import KeyedPredictor, linear_predictor, predict_horizon
from shelfcast.operators import analytics, behaviour, metrics
from shelfcast.operators.cleaning import clean_daily_data
from shelfcast.operators.features import build_training_features
from shelfcast.operators.fingerprint import fingerprint
from shelfcast.operators.quality import gate_passed, validation_report
from shelfcast.operators.weekly import aggregate_to_weekly, enrich_features, resample_weekly
from shelfcast.operators.windows import latest_sku_metadata, positions
from shelfcast.session import cut_lineage
from shelfcast.sources import catalog as cat
from shelfcast.sources import loads
from shelfcast.sources.snapshots import PARTITION
from shelfcast.sources.readers import (
    read_batch_parquet,
    read_daily_csv,
    read_enriched_csv,
    read_weekly_csv,
    write_artifacts,
)


# --- load and ETL ---------------------------------------------------------
def load_all(spark, root, daily, weekly, enriched):
    """Fills the four base tables; returns input rows per table."""
    return {
        "products": loads.load_products(spark, root, daily),
        "daily_sales": loads.load_daily_sales(spark, root, daily),
        "weekly_features": loads.load_weekly_features(spark, root, weekly),
        "enrichment_features": loads.load_enrichment_features(spark, root, enriched),
    }


def _counted(frame, seen, name):
    """The frame, its rows counted under `name` as they pass."""
    seen[name] = Observation(name)
    return frame.observe(seen[name], F.count(F.lit(1)).alias("row_count"))


def full_etl(spark, daily, weekly, template, folder, with_lags=False):
    """Clean, sum to weeks, enrich, write both artifacts; returns a row per stage count.

    Rows are counted while they pass on their way to the artifacts, so nothing is read for its
    count. The counts are a report: a stage that runs again after a lost executor may add its
    rows twice to them, never to the artifacts. `with_lags` adds the lag features, which the
    usual run leaves to the ready-made weekly file.
    """
    seen = {}
    cleaned = _counted(clean_daily_data(daily), seen, "daily_rows")
    sums = _counted(aggregate_to_weekly(cleaned), seen, "weekly_rows_aggregated")
    enriched = enrich_features(sums, template)
    if with_lags:
        from shelfcast.operators.windows import compute_lag_features

        enriched = compute_lag_features(enriched)
    write_artifacts(_counted(enriched, seen, "enriched_rows"), _counted(weekly, seen, "weekly_rows_modeling"), folder)
    counts = [(name, int(observed.get["row_count"])) for name, observed in seen.items()]
    return spark.createDataFrame(counts, "table_name string, row_count long")


def full_etl_from_files(spark, raw, folder):
    """The same from three CSV files: {"daily": path, "weekly": path, "template": path}."""
    return full_etl(
        spark, read_daily_csv(spark, raw["daily"]), read_weekly_csv(spark, raw["weekly"]),
        read_enriched_csv(spark, raw["template"]), folder,
    )


# --- live scoring ---------------------------------------------------------
def eligible_predictions(log, products, as_of):
    """Unscored predictions whose week has settled, with the category."""
    settled = F.date_sub(F.lit(as_of).cast("date"), K.SETTLE_DAYS)
    return (
        log.filter((F.col("forecast_week") <= settled) & F.col("scored_at").isNull())
        .join(products.select("sku", "category"), "sku")
    )


def facts_of_weeks(daily_sales, weeks):
    """Daily facts of the given weeks (a frame of distinct `forecast_week`), with their week.

    Where the facts carry the month that partitions their files, a semi join on the months of
    those weeks comes first and prunes the files while the query runs; months are bounded by the
    calendar, so they are broadcast.
    """
    if PARTITION in daily_sales.columns:
        ends = F.array(F.col("forecast_week"), F.date_add("forecast_week", 6))
        months = weeks.select(F.explode(ends).alias("day")).select(F.date_format("day", "yyyy-MM").alias(PARTITION))
        daily_sales = daily_sales.join(F.broadcast(months.distinct()), PARTITION, "left_semi").drop(PARTITION)
    return daily_sales.withColumn("forecast_week", S.week_start("sale_date")).join(weeks, "forecast_week", "left_semi")


def weekly_actuals(daily_sales, wanted):
    """Units per series and week, for the products and weeks under scoring."""
    weeks, skus = wanted.select(F.col("forecast_week")).distinct(), wanted.select("sku").distinct()
    return (
        facts_of_weeks(daily_sales, weeks).join(skus, "sku", "left_semi")
        .groupBy(*K.SERIES, "forecast_week").agg(F.sum("units_sold").alias("actual_units"))
    )


def match_actuals(log, products, daily_sales, as_of):
    """Eligible predictions with their actual units; unmatched ones are left out."""
    unscored = eligible_predictions(log, products, as_of).drop("actual_units")
    actuals = weekly_actuals(daily_sales, unscored)
    return unscored.join(actuals, [*K.SERIES, "forecast_week"])


def score_predictions(log_table, performance_table, products, daily_sales, as_of, dry_run=False):
    """Scores settled predictions and stores the day's metrics; returns the metrics.

    The day's metrics cover everything scored on that day, also by an earlier run.
    """
    number = {c: F.col(c).cast("double") for c in ("predicted_units", "actual_units")}
    log = log_table.read().withColumns(number)
    matched = cut_lineage(match_actuals(log, products, daily_sales, as_of))
    today = F.lit(as_of).cast("date")
    if dry_run:
        return _dated(metrics.live_metrics(matched), as_of)
    log_table.upsert(matched.select(
        *log_table.keys, "actual_units", F.lit(as_of).cast("timestamp").alias("scored_at")
    ), stable=True)
    scored_today = (
        log_table.read().withColumns(number).filter(F.col("scored_at").cast("date") == today)
        .join(products.select("sku", "category"), "sku")
    )
    performance_table.upsert(_dated(metrics.live_metrics(scored_today), as_of))
    return performance_table.read().filter(F.col("scored_date") == today)


def _dated(measured, as_of):
    return measured.select(
        F.lit(as_of).cast("date").alias("scored_date"), "model_version", "category", "samples",
        "live_mape", "live_rmse", "live_mae",
    )


# --- health ---------------------------------------------------------------
def live_mape_by_category(performance, as_of):
    cutoff = F.date_sub(F.lit(as_of).cast("date"), K.LIVE_WINDOW_DAYS)
    return (
        performance.filter(F.col("scored_date") >= cutoff).groupBy("category")
        .agg(F.avg(F.col("live_mape").cast("double")).alias("avg_mape"))
    )


def days_since_retrain(lineage, as_of):
    """Days since the last completed run, never negative, NULL without any."""
    last = F.max("completed_at").cast("date")
    age = F.datediff(F.lit(as_of).cast("date"), last)
    return lineage.agg(F.when(last.isNotNull(), F.greatest(F.lit(0), age)).alias("days_since"))


def stale_categories(lineage, as_of):
    """Categories without a completed run in the last 14 days; none when no run is known."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), K.STALE_MODEL_DAYS)
    recent = lineage.filter(F.col("completed_at") >= cutoff).select("category")
    known = lineage.agg(F.max("completed_at").isNotNull()).scalar()
    return lineage.filter(known).select("category").distinct().join(
        recent.distinct(), "category", "left_anti"
    )


# --- training -------------------------------------------------------------
def _per_category(frame):
    return {r["category"]: r.asDict() for r in frame.collect()}


def compare_on_folds(panel, boosting_settings, fold_settings):
    """Mean fold metrics of both kinds and the winner, one row per category."""
    features = cut_lineage(folds.fold_features(panel, **fold_settings))
    linear = cut_lineage(folds.mean_over_folds(folds.expanding_ridge_metrics(panel, **fold_settings)))
    boosted = cut_lineage(
        folds.mean_over_folds(folds.boosted_fold_metrics(features, **boosting_settings))
    )
    choice = selection.choose_model(boosted, linear, "category")
    won = boosted.withColumn("kind", F.lit("gbr")).unionByName(
        linear.withColumn("kind", F.lit("ridge"))
    )
    return choice.join(
        won.withColumnRenamed("kind", "winner"), ["category", "winner"]
    )


def _save(catalog, category, winner, linear, forecasters, features, **card):
    name = S.model_name_text(category)
    if winner == "ridge":
        model = linear.filter(F.col("category") == category)
        return catalog.save_ridge(model, name, features=features, category=category, **card)
    forecaster = forecasters[(category,)]
    fitted = {**card, "training_rows": forecaster.training_rows}
    return catalog.save_boosted(forecaster, name, features=features, category=category, **fitted)


def _boosted_of(train, categories, features, interval, settings):
    """Boosted forecasters of the given categories, grown in one job."""
    own = train.filter(F.col("category").isin(list(categories)))
    return boosting.fit_forecasters(own, features, ("category",), interval, **settings) if categories else {}


def _in_sample(train, forecasters):
    """{category: metrics} of forecasters on their own training rows, in one pass."""
    known = train.filter(F.col("category").isin([c for c, in forecasters]))
    scored = boosting.predict_by_key(known, forecasters, ("category",))
    return _per_category(metrics.evaluate(scored, "target", "point", "category"))


def retrain(spark, weekly, catalog, lineage_table, as_of, dry_run=False, expected=K.GATE,
            interval="quantile", boosting_settings=None, fold_settings=None):
    """Gate, comparison, drift, decision, save and lineage for every category.

    `weekly` is the panel with its category. Ridge models, fold features, fingerprints
    and baselines of all categories come from shared passes; the loop over categories
    only saves models. Returns one summary row per category.
    """
    boosting_settings, fold_settings = boosting_settings or {}, fold_settings or {}
    report = validation_report(weekly, as_of, allow_stale=True, expected=expected)
    if not gate_passed(report):
        failed = [r["message"] for r in report.filter("level = 'FAIL' AND NOT ok").collect()]
        raise RuntimeError(f"data validation failed: {failed}")
    panel = cut_lineage(weekly.dropna(subset=["category"]))
    folds.require_history(panel)
    compared = compare_on_folds(panel, boosting_settings, fold_settings)
    train = cut_lineage(build_training_features(panel, carry=("category",)))
    names = [c for c in K.FEATURES if c in train.columns]
    linear = cut_lineage(ridge.fit_ridge(train, ("category",), names))
    baselines = cut_lineage(metrics.feature_baselines(train, names, "category"))
    drift = metrics.drift_json(
        metrics.detect_drift(baselines, catalog.latest_baselines(), "category"), "category"
    )
    hashes = fingerprint(panel, "category").drop("rows")
    sizes = linear.select("category", "training_rows")
    decided = (
        selection.compare_to_incumbent(compared, catalog.incumbents())
        .join(hashes, "category").join(sizes, "category").join(drift, "category", "left")
        .fillna({"drift_warnings": "[]", "drift_count": 0})
    )
    rows = _per_category(cut_lineage(decided))
    known = cat.baselines_by_category(baselines)
    wanted = [] if dry_run else [
        c for c, r in rows.items() if r["winner"] == "gbr" and r["decision"] != "rejected"
    ]
    forecasters = _boosted_of(train, wanted, names, interval, boosting_settings)
    run_id, versions = uuid.uuid4().hex[:16], {}
    for category, row in rows.items():
        name = S.model_name_text(category)
        if dry_run:
            versions[category] = f"{name}_v[dry-run]"
        elif row["decision"] == "rejected":
            versions[category] = f"{name}_vPENDING"
        else:
            version = _save(
                catalog, category, row["winner"], linear, forecasters, names,
                metrics={m: row[m] for m in folds.METRICS},
                training_rows=row["training_rows"], baselines=known[category],
                metric_kind="walk_forward",
            )
            versions[category] = f"{name}_v{version}"
    summary = spark.createDataFrame(
        [(c, versions[c], r["winner"], r["mape"], r["rmse"], r["mae"], r["r2"],
          r["training_rows"], r["decision"], r["drift_count"], r["drift_warnings"],
          r["data_hash"], r["incumbent_version"], r["incumbent_mape"], r["rationale"])
         for c, r in rows.items()],
        "category string, model_version string, winner string, mape double, rmse double, "
        "mae double, r2 double, training_rows long, decision string, drift_count long, "
        "drift_warnings string, data_hash string, incumbent_version string, "
        "incumbent_mape double, notes string",
    )
    if not dry_run:
        record_lineage(lineage_table, summary, run_id)
    return summary


def record_lineage(lineage_table, summary, run_id):
    """One audit row per run and category, metrics limited to their decimal columns."""
    prefix = F.concat(F.lit(f"{run_id}_"), F.substring(F.lower("category"), 1, 4))
    now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return lineage_table.insert_new(summary.select(
        prefix.alias("run_id"), F.lit(now).cast("timestamp").alias("started_at"),
        F.lit(now).cast("timestamp").alias("completed_at"), "category", "model_version",
        "data_hash", F.col("training_rows").cast("int").alias("training_rows"),
        *[S.clamped_metric(m).alias(f"train_{m}") for m in folds.METRICS],
        "incumbent_version", S.clamped_metric("incumbent_mape").alias("incumbent_mape"),
        F.col("decision").alias("promotion_decision"), "drift_warnings", "notes",
    ))


def train_per_category(weekly, catalog, interval="quantile", **boosting_settings):
    """A boosted forecaster per category, saved with its in-sample metrics.

    Categories without training rows are skipped; the loop runs over categories.
    """
    if "category" not in weekly.columns:
        raise ValueError("weekly frame has no 'category' column")
    train = cut_lineage(
        build_training_features(weekly.dropna(subset=["category"]), carry=("category",))
    )
    names = [c for c in K.FEATURES if c in train.columns]
    saved = boosting.fit_forecasters(train, names, ("category",), interval, **boosting_settings)
    scored = _in_sample(train, saved)
    for (category,), forecaster in sorted(saved.items()):
        catalog.save_boosted(
            forecaster, S.model_name_text(category), features=names, category=category,
            training_rows=forecaster.training_rows,
            metrics={m: scored[category][m] for m in folds.METRICS},
        )
    return {category: forecaster for (category,), forecaster in saved.items()}


def train_all(weekly, catalog, starts=K.KMEANS_STARTS, interval="quantile",
              boosting_settings=None, fold_settings=None):
    """Comparison and final model per category, then the clusters; one summary row each."""
    boosting_settings, fold_settings = boosting_settings or {}, fold_settings or {}
    panel = cut_lineage(weekly.dropna(subset=["category"]))
    folds.require_history(panel)
    compared = cut_lineage(compare_on_folds(panel, boosting_settings, fold_settings))
    train = cut_lineage(build_training_features(panel, carry=("category",)))
    names = [c for c in K.FEATURES if c in train.columns]
    linear = cut_lineage(ridge.fit_ridge(train, ("category",), names))
    in_sample = _per_category(metrics.evaluate(
        ridge.predict_ridge(train, linear, ("category",), names), "target", "point", "category"
    ))
    sizes = {r["category"]: r["count"] for r in panel.groupBy("category").count().collect()}
    rows = _per_category(compared)
    wanted = [c for c, r in rows.items() if r["winner"] == "gbr"]
    forecasters = _boosted_of(train, wanted, names, interval, boosting_settings)
    if forecasters:
        in_sample |= _in_sample(train, forecasters)
    for category, row in rows.items():
        _save(catalog, category, row["winner"], linear, forecasters, names,
              metrics={m: in_sample[category][m] for m in folds.METRICS},
              training_rows=sizes[category])
    features = behaviour.sku_features(panel)
    clusters = fit_clustering(features, starts)
    catalog.save_clusters(clusters, metrics={"silhouette": clusters.silhouette}, features=[])
    counts = panel.groupBy("category").agg(F.count("*").alias("train_rows"))
    return compared.join(counts, "category").select(
        "category", "train_rows", "winner", *folds.METRICS, "rationale"
    ).orderBy("category")


# --- batch forecasts ------------------------------------------------------
def batch_history(batch, weekly_features):
    """Weekly history of a batch with the modelling columns it cannot know.

    Lags, deviation and momentum start at zero, the rolling mean at the week's own
    units; lifecycle and age come from the stored panel or fall back to fixed values.
    """
    weeks = resample_weekly(batch)
    if "category" not in weeks.columns:
        weeks = weeks.withColumn("category", F.lit(K.FALLBACK_CATEGORY))
    meta = latest_sku_metadata(weekly_features)
    calendar = S.calendar_columns()
    flags = {c: calendar[c] for c in ("is_holiday_week", "is_holiday_peak", "is_summer", "is_winter")}
    return (
        weeks.join(meta, "sku", "left").withColumns({
            **flags,
            **{c: F.lit(0.0) for c in ("lag_1", "lag_2", "rolling_std_4", "momentum")},
            "rolling_mean_4": F.col("units_sold"),
            "lifecycle_stage": F.coalesce("lifecycle_stage", F.lit(K.FALLBACK_STAGE)),
            "_age": F.coalesce("sku_age", F.lit(K.FALLBACK_AGE)),
        })
        .withColumn("sku_age", positions("_age")).drop("_age")
    )


def score_batch(batch, weekly_features, model, weeks=K.HORIZON_DEFAULT):
    """Forecasts for every series of a batch; categories without a model drop out.

    `model` is a ridge table (one row per category) or the forecasters of a catalog, as
    `ModelCatalog.forecasters` gives them.
    """
    history = batch_history(batch, weekly_features)
    if isinstance(model, dict):
        return predict_horizon(history, KeyedPredictor({c: f for c, (f, _) in model.items()}), weeks)
    return predict_horizon(history, linear_predictor(model), weeks)


def run_batch(spark, root, path, weekly_features, model, weeks=K.HORIZON_DEFAULT, batch_id=None):
    """Reads a batch file, forecasts it and stores the predictions; returns the batch id.

    `model` is as in score_batch; predictions carry the version of the model that made them.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")
    batch_id = batch_id or f"batch-{stamp}-{uuid.uuid4().hex[:6]}"
    forecast = score_batch(read_batch_parquet(spark, path), weekly_features, model, weeks)
    if isinstance(model, dict):
        pairs = [x for c, (_, version) in model.items() for x in (F.lit(c), F.lit(version))]
        version = F.create_map(*pairs)[F.col("category")] if pairs else F.lit(None).cast("string")
    else:
        version = F.concat(F.lit("ridge_"), F.col("category"))
    loads.insert_batch_predictions(spark, root, forecast.select(
        F.lit(batch_id).alias("batch_id"), "sku", "week", "channel", "region",
        F.col("point").alias("predicted_units"), F.col("lower").alias("confidence_lower"),
        F.col("upper").alias("confidence_upper"), version.alias("model_version"),
    ))
    return batch_id


def run_batch_from_catalog(spark, root, path, weekly_features, catalog, weeks=K.HORIZON_DEFAULT,
                           batch_id=None):
    """The same with the newest model of each category; categories without one drop out."""
    return run_batch(spark, root, path, weekly_features, catalog.forecasters(), weeks, batch_id)
