"""Walk-forward evaluation: growing training window, fixed test horizon, no shuffling.

Training windows only grow, so ridge models of all folds come from one pass over the panel: each
row adds to the moments of the weeks between two cuts, and a fold's moments are the running sum
up to its cut. Two things depend on the fold. The mean price that prices are divided by: price
and "price missing" stay columns of their own in the moments, and the ratio of a fold is a linear
map of them. Gaps at the start of a series that a later week fills: where that week lies beyond
the first cut that holds the row, the row is entered once per fold instead (new products near a
cut, few rows). Boosted trees differ from fold to fold, so their rows are dealt out per fold.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.models import boosting, ridge
from shelfcast.operators.features import build_training_features, encoded_features, stock_ratio
from shelfcast.operators.metrics import evaluate
from shelfcast.operators.windows import by_week, previous_promotion
from shelfcast.session import cut_lineage

FOLD = ("category", "fold")
METRICS = ("mape", "rmse", "mae", "r2")


def make_folds(weekly, splits=K.FOLDS["splits"], train_weeks=K.FOLDS["train_weeks"],
               test_weeks=K.FOLDS["test_weeks"]):
    """Fold boundaries per category: last training week, first and last test week.

    Weeks are the category's distinct ones, a few hundred rows. The number of splits
    shrinks to what the history supports; too short a history gives no fold.
    """
    order = Window.partitionBy("category").orderBy("week")
    weeks = (
        weekly.select("category", "week").distinct()
        .withColumn("position", F.row_number().over(order))
        .withColumn("available", F.count("*").over(Window.partitionBy("category")))
    )
    possible = F.floor((F.col("available") - train_weeks) / test_weeks)
    allowed = F.greatest(F.lit(1), F.least(F.lit(splits), possible))
    fold = F.explode(F.sequence(F.lit(1), F.lit(splits))).alias("fold")
    train_end = train_weeks + (F.col("fold") - 1) * test_weeks

    def week_at(position):
        return F.max(F.when(F.col("position") == position, F.col("week")))

    return (
        weeks.select("*", fold)
        .filter((F.col("fold") <= allowed) & (train_end + test_weeks <= F.col("available")))
        .groupBy("category", "fold").agg(
            week_at(train_end).alias("train_cut"), week_at(train_end + 1).alias("test_start"),
            week_at(train_end + test_weeks).alias("test_end"),
        )
    )


def require_history(weekly, train_weeks=K.FOLDS["train_weeks"], test_weeks=K.FOLDS["test_weeks"]):
    """Raises when a category has too few distinct weeks for one fold."""
    short = (
        weekly.select("category", "week").distinct().groupBy("category")
        .agg(F.count("*").alias("weeks")).filter(F.col("weeks") < train_weeks + test_weeks)
    ).collect()
    if short:
        raise ValueError(f"insufficient history: {[tuple(r) for r in short]}")


def fold_slices(weekly, folds):
    """Training and test rows of every fold (`role`), in one frame.

    Each row occurs once per fold it belongs to. The fold table has at most five rows
    per category.
    """
    role = (
        F.when(F.col("week") <= F.col("train_cut"), "train")
        .when(F.col("week").between(F.col("test_start"), F.col("test_end")), "test")
    )
    return weekly.join(folds, "category").withColumn("role", role).filter(
        F.col("role").isNotNull()
    ).drop("train_cut", "test_start", "test_end")


def fold_features(weekly, **settings):
    """Feature rows of all folds; test features come from the test slice alone.

    Price references and fills run inside (fold, role), so one plan builds what a
    loop over folds would.
    """
    slices = fold_slices(weekly, make_folds(weekly, **settings))
    return build_training_features(slices, groups=("fold", "role"), carry=("category", "week"))


def mean_over_folds(fold_metrics):
    return fold_metrics.groupBy("category").agg(
        *[F.avg(m).alias(m) for m in METRICS], F.count("*").alias("folds")
    )


def ridge_fold_metrics(features, names=K.FEATURES, alpha=K.RIDGE_ALPHA):
    """Metrics of all folds of all categories from one training and one scoring pass."""
    train = features.filter(F.col("role") == "train")
    test = features.filter(F.col("role") == "test")
    model = ridge.fit_ridge(train, FOLD, names, alpha=alpha)
    scored = ridge.predict_ridge(test, model, FOLD, names)
    return evaluate(scored, "target", "point", *FOLD)


def boosted_fold_metrics(features, names=K.FEATURES, **settings):
    """The same for boosted trees: one job grows the models of all categories and folds."""
    train = features.filter(F.col("role") == "train")
    test = features.filter(F.col("role") == "test")
    models = boosting.fit_forecasters(train, names, FOLD, interval="none", **settings)
    return evaluate(boosting.predict_by_key(test, models, FOLD), "target", "point", *FOLD)


#: What the price ratio is made of in the moments of all folds.
PRICE_PARTS = ("_price", "_no_price")


def _with_cuts(weekly, made):
    """Panel rows with their category's cuts in order and the number of cuts before their week."""
    cuts = made.groupBy("category").agg(F.array_sort(F.collect_list("train_cut")).alias("_cuts"))
    before = F.size(F.filter("_cuts", lambda c: c < F.col("week")))
    return weekly.join(cuts, "category").withColumn("_block", before)


def expanding_rows(weekly, made):
    """Training rows of all folds, each once: category, fold from which it counts, features, target.

    Rows of `_late` count in their fold only, and there is one for each fold that has them.
    """
    panel = _with_cuts(weekly, made)
    order = by_week()
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = [c for c in K.PANEL_FEATURES if c in panel.columns]
    kinds = {f.name: f.dataType for f in panel.schema.fields}
    known, since = {}, {}
    for c in gaps:
        own = F.last(c, ignorenulls=True).over(so_far)
        known[f"_v_{c}"] = F.coalesce(own, F.first(c, ignorenulls=True).over(everything)).cast(kinds[c])
        since[f"_w_{c}"] = F.when(own.isNull(), F.min(F.when(F.col(c).isNotNull(), F.col("week"))).over(everything))
    filled = panel.withColumns({
        **known, **since, **encoded_features(), "stock_to_demand_ratio": stock_ratio(), "promo_lag_1": previous_promotion(),
        "_price": F.coalesce("price_unit", F.lit(0.0)), "_no_price": F.col("price_unit").isNull(),
    }).filter((F.col("_block") < F.size("_cuts")) & F.col("target_next_week").isNotNull())
    first = F.get("_cuts", F.col("_block"))
    late = F.coalesce(F.greatest(F.lit(False), *[F.col(f"_w_{c}") > first for c in gaps]), F.lit(False))
    folds_of = F.when(late, F.sequence(F.col("_block") + 1, F.size("_cuts"))).otherwise(F.array(F.col("_block") + 1))
    dealt = filled.select("*", late.alias("_late"), F.explode(folds_of).alias("fold"))
    cut = F.get("_cuts", F.col("fold") - 1)
    values = {c: F.when(F.col(f"_w_{c}").isNull() | (F.col(f"_w_{c}") <= cut), F.col(f"_v_{c}")) for c in gaps}
    named = [c for c in (*K.DERIVED_FEATURES, *PRICE_PARTS) if c != "price_vs_category_avg"]
    return dealt.select(
        "category", "fold", "_late",
        *[F.coalesce(values[c].cast("double"), F.lit(0.0)).alias(c) for c in gaps],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in named],
        F.col("target_next_week").cast("double").alias("target"),
    )


def price_means(weekly, made):
    """Mean price of every fold's training weeks, by running sums over the cuts."""
    sums = _with_cuts(weekly, made).groupBy("category", "_block", F.size("_cuts").alias("folds")).agg(
        F.sum("price_unit").alias("sum"), F.count("price_unit").alias("n")
    )
    # a handful of rows a category
    fold = F.explode(F.sequence(F.lit(1), F.col("folds"))).alias("fold")
    return sums.select("*", fold).filter("_block < fold").groupBy("category", "fold").agg(
        F.try_divide(F.sum("sum"), F.sum("n")).alias("price_mean")
    )


def fit_expanding(weekly, made, names=K.FEATURES, alpha=K.RIDGE_ALPHA):
    """The ridge model of every category and fold from one pass over the panel (see ridge.fit_ridge)."""
    ratio = "price_vs_category_avg"
    rows = expanding_rows(weekly, made)
    names = list(names)
    columns = [c for c in names if c != ratio]
    parts = list(PRICE_PARTS) if ratio in names else []
    moments, pooled = ridge.group_moments(rows, ("category", "fold", "_late"), (*columns, *parts, "target"))
    size = len(columns) + len(parts) + 1

    def of_fold(mean, scatter, price_mean):
        """Moments of the features in their order, the target last."""
        turn, shift = np.zeros((len(names) + 1, size)), np.zeros(len(names) + 1)
        for i, name in enumerate(names):
            if name != ratio:
                turn[i, columns.index(name)] = 1
            elif price_mean:
                turn[i, len(columns)], turn[i, len(columns) + 1] = 1 / price_mean, 1
            else:
                shift[i] = 1
        turn[-1, -1] = 1
        return turn @ mean + shift, turn @ scatter @ turn.T

    def solve(key, own, prices):
        found = []
        for fold, price_mean in sorted(zip(prices["fold"], prices["price_mean"])):
            inside = own[np.where(own["_late"], own["fold"] == fold, own["fold"] <= fold)]
            if len(inside):
                n, mean, scatter = pooled(inside)
                mean, scatter = of_fold(mean, scatter, 0.0 if pd.isna(price_mean) else price_mean)
                found.append((*key, fold, *ridge.solved(n, mean, scatter, alpha)))
        return pd.DataFrame(found, columns=schema.names)

    schema = ridge.model_schema(made, FOLD)
    return moments.groupBy("category").cogroup(price_means(weekly, made).groupBy("category")).applyInPandas(solve, schema)


def test_rows(weekly, made):
    """Feature rows of all test windows; windows do not overlap, so each row occurs once."""
    inside = weekly.join(made, "category").filter(F.col("week").between(F.col("test_start"), F.col("test_end")))
    slices = inside.drop("train_cut", "test_start", "test_end")
    return build_training_features(slices, groups=("fold",), carry=("category", "week"))


def expanding_ridge_metrics(weekly, names=K.FEATURES, alpha=K.RIDGE_ALPHA, **fold_settings):
    """Metrics of the ridge models of all folds of all categories."""
    made = cut_lineage(make_folds(weekly, **fold_settings))
    model = fit_expanding(weekly, made, names, alpha)
    return evaluate(ridge.predict_ridge(test_rows(weekly, made), model, FOLD, names), "target", "point", *FOLD)


def walk_forward(weekly, kind="gbr", boosting_settings=None, **fold_settings):
    """Fold metrics per category for `gbr` or `ridge`."""
    if kind not in ("gbr", "ridge"):
        raise ValueError(f"unknown model kind: {kind!r}")
    if kind == "ridge":
        return expanding_ridge_metrics(weekly, **fold_settings)
    features = cut_lineage(fold_features(weekly, **fold_settings))
    return boosted_fold_metrics(features, **(boosting_settings or {}))
