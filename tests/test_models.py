import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.models import boosting, clustering, folds, growing, horizon, ridge
from shelfcast.models.clustering import ClusterModel, fit_clustering
from shelfcast.operators import behaviour
from shelfcast.operators.features import build_training_features
from shelfcast.operators.windows import recent_history
from shelfcast.session import cut_lineage, scratch_path
from tests.conftest import series


@pytest.fixture(scope="module")
def train(small):
    return build_training_features(small.weekly_categorised, carry=("category",)).persist()


def closed_form(x, y, alpha=1.0):
    xm, ym = x.mean(axis=0), y.mean()
    a, b = x - xm, y - ym
    beta = np.linalg.solve(a.T @ a + alpha * np.eye(x.shape[1]), a.T @ b)
    return ym - xm @ beta, beta


def test_ridge_matches_closed_form_per_group(spark, train):
    model = ridge.fit_ridge(train.repartition(7), ("category",), K.FEATURES)
    pandas = train.toPandas()
    for row in model.collect():
        own = pandas[pandas["category"] == row["category"]]
        x, y = own[list(K.FEATURES)].to_numpy(), own["target"].to_numpy()
        intercept, beta = closed_form(x, y)
        assert np.allclose(row["coefficients"], beta, atol=1e-7)
        assert abs(row["intercept"] - intercept) < 1e-4
        assert abs(row["residual_std"] - np.std(y - intercept - x @ beta)) < 1e-8


def test_folds_never_look_ahead(spark):
    frame = series(spark, range(30), {"category": F.lit("Milk")})
    made = folds.make_folds(frame, splits=3, train_weeks=20, test_weeks=2).collect()
    assert len(made) == 3
    assert all(r["train_cut"] < r["test_start"] <= r["test_end"] for r in made)
    with pytest.raises(ValueError, match="insufficient"):
        folds.require_history(frame)
    with pytest.raises(ValueError, match="unknown"):
        folds.walk_forward(frame, "forest")


def test_fold_features_use_their_slice_only(spark, small):
    """The one-plan fold features equal features built slice by slice."""
    panel = small.weekly_categorised.filter("category = 'Milk'").persist()
    fold = folds.make_folds(panel, splits=1).first()
    test = panel.filter(F.col("week").between(fold["test_start"], fold["test_end"]))
    want = build_training_features(test, carry=("week",)).agg(
        F.count("*"), F.sum("price_vs_category_avg"), F.sum("promo_lag_1"), F.sum("lag_2")).first()
    got = folds.fold_features(panel, splits=1).filter("role = 'test'").agg(
        F.count("*"), F.sum("price_vs_category_avg"), F.sum("promo_lag_1"), F.sum("lag_2")).first()
    assert np.allclose(list(want), list(got))


def test_boosted_forecaster_brackets_and_reloads(spark, train):
    own = train.filter("category = 'Milk'")
    model = boosting.train_boosted(own, K.FEATURES)
    assert model.point.feature.shape == (200, 63)
    scored = model.predict(own)
    assert scored.filter("lower > point OR upper < point").count() == 0
    share = scored.agg(F.avg(F.col("target").between(F.col("lower"), F.col("upper")).cast("int"))).first()[0]
    assert 0.7 < share < 0.95
    path = scratch_path(spark, "boosted")
    model.save(spark, path)
    again = boosting.BoostedForecaster.load(spark, path).predict(own)
    for c in ("point", "lower", "upper"):
        assert abs(scored.agg(F.sum(c)).first()[0] - again.agg(F.sum(c)).first()[0]) < 1e-6


@pytest.mark.parametrize("settings", [{}, {"splits": 4, "train_weeks": 60, "test_weeks": 3}])
def test_expanding_folds_equal_folds_fitted_one_by_one(spark, small, settings):
    """One pass over the panel gives what copied rows give, also where fills and prices depend on the fold."""
    panel = small.weekly_categorised.filter("category IN ('Milk', 'Juice')")
    made = cut_lineage(folds.make_folds(panel, **settings))
    cut = {r["category"]: r["train_cut"] for r in made.filter("fold = 2").collect()}["Milk"]
    odd = panel.withColumns({
        # a series whose first value lies beyond a cut, one that never has any, missing and changing prices
        "rolling_std_4": F.when((F.col("week") > F.lit(cut)) | (F.col("channel") != "Retail"), F.col("rolling_std_4")),
        "delivery_days": F.when(F.col("region") != "PL-South", F.col("delivery_days")),
        "price_unit": F.when(F.pmod(F.xxhash64("week", "sku"), F.lit(7)) > 0, F.col("price_unit") + F.month("week")),
    })
    made = cut_lineage(folds.make_folds(odd, **settings))
    copied = folds.fold_features(odd, **settings)
    want = ridge.fit_ridge(copied.filter("role = 'train'"), folds.FOLD, K.FEATURES)
    got = {(r["category"], r["fold"]): r for r in folds.fit_expanding(odd, made).collect()}
    late = folds.expanding_rows(odd, made).filter("_late").count()
    assert 0 < late < odd.count() / 2
    rows = want.collect()
    assert len(rows) == len(got) == made.count()
    for r in rows:
        own = got[r["category"], r["fold"]]
        assert own["training_rows"] == r["training_rows"]
        assert np.allclose(own["coefficients"], r["coefficients"], rtol=1e-6, atol=1e-7)
        assert np.isclose(own["intercept"], r["intercept"], rtol=1e-5) and np.isclose(own["residual_std"], r["residual_std"])
    first = folds.expanding_ridge_metrics(odd, **settings).orderBy(*folds.FOLD).collect()
    second = folds.ridge_fold_metrics(copied).orderBy(*folds.FOLD).collect()
    assert [(r["category"], r["fold"], r["samples"]) for r in first] == [(r["category"], r["fold"], r["samples"]) for r in second]
    assert np.allclose([r["mae"] for r in first], [r["mae"] for r in second], rtol=1e-6)


def grown_by_hand(x, y, quantile, rounds, depth, rate, min_leaf):
    """Fitted values of boosted trees, every cut between distinct values tried on the raw rows."""
    estimate = np.full(len(y), y.mean() if quantile is None else np.quantile(y, quantile, method="inverted_cdf"))
    for _ in range(rounds):
        residual = y - estimate
        gradient = residual if quantile is None else quantile - (residual < 0)
        leaves = [np.arange(len(y))]
        for _ in range(depth):
            split = []
            for rows in leaves:
                best, found, g = 1e-12, None, gradient[rows]
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f])[:-1]:
                        left = x[rows, f] <= cut
                        if min(left.sum(), (~left).sum()) >= min_leaf:
                            gain = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / len(g)
                            if gain > best + 1e-9:
                                best, found = gain, left
                split += [rows] if found is None else [rows[found], rows[~found]]
            leaves = split
        for rows in leaves:
            own = residual[rows]
            estimate[rows] += rate * (own.mean() if quantile is None else np.quantile(own, quantile, method="inverted_cdf"))
    return estimate


@pytest.fixture(scope="module")
def drawn(spark):
    random = np.random.default_rng(4)
    x = random.integers(0, 12, (400, 3)).astype(float)
    y = (x[:, 1] > 6) * 5.0 + x[:, 0] / 10 + random.normal(size=400) / 10
    frame = spark.createDataFrame([(int(i % 2), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                  "k int, a double, b double, c double, target double")
    return x, y, frame.repartition(5).persist()


HEADS = {"point": None, "lower": 0.1, "upper": 0.9}
SMALL = {"rounds": 10, "depth": 3, "rate": 0.3, "min_leaf": 15}


@pytest.mark.parametrize("task_rows", [0, 10**6])
def test_trees_equal_trees_grown_by_hand(spark, drawn, task_rows):
    x, y, frame = drawn
    found = boosting.fit_trees(frame, ["a", "b", "c"], ["k"], HEADS, task_rows=task_rows, **SMALL)
    assert set(found) == {(0,), (1,)}
    for k in (0, 1):
        own = np.arange(400) % 2 == k
        for name, quantile in HEADS.items():
            trees, rows = found[(k,)][name]
            assert rows == 200
            assert np.allclose(trees.score(x[own]), grown_by_hand(x[own], y[own], quantile, **SMALL), atol=1e-5)


def test_passes_and_tasks_give_the_same_trees_however_rows_are_dealt(spark, train, monkeypatch):
    settings = {"rounds": 11, "depth": 4}
    alone = boosting.fit_trees(train, K.FEATURES, ["category"], HEADS, **settings)
    monkeypatch.setattr(growing, "DIRECT", 3)
    monkeypatch.setattr(growing, "FAN_IN", 4)
    dealt = boosting.fit_trees(train.repartition(13), K.FEATURES, ["category"], HEADS, task_rows=1100, **settings)
    sizes = {r["category"]: r["count"] for r in train.groupBy("category").count().collect()}
    assert min(sizes.values()) <= 1100 < max(sizes.values())  # some by tasks, some by passes
    for (category,), heads in alone.items():
        for name, (trees, rows) in heads.items():
            other, other_rows = dealt[(category,)][name]
            assert rows == other_rows == sizes[category]
            for part in ("feature", "threshold", "value"):
                assert np.array_equal(getattr(trees, part), getattr(other, part)), (category, name, part)


def test_residual_summaries_keep_ranks():
    random = np.random.default_rng(8)
    values = random.normal(size=300_000)
    parts = [growing.compressed(np.stack([v, np.ones(len(v))])) for v in np.array_split(values, 90)]
    for _ in range(2):  # two levels of adding
        parts = [growing.compressed(np.concatenate(parts[i:i + 10], axis=1)) for i in range(0, len(parts), 10)]
    whole, ordered = np.concatenate(parts, axis=1), np.sort(values)
    for q in (0.01, 0.1, 0.5, 0.9, 0.99):
        rank = np.searchsorted(ordered, growing.lower_quantile(whole, q)) / len(values)
        assert abs(rank - q) < 0.002
    few = np.array([3.0, 1.0, 2.0, 2.0, 5.0])
    sample = growing.compressed(np.stack([few, np.ones(5)]))
    for q in (0.1, 0.2, 0.5, 0.81, 0.9):
        assert growing.lower_quantile(sample, q) == np.quantile(few, q, method="inverted_cdf")


def test_rows_without_a_target_or_of_one_value_are_no_trouble(spark):
    frame = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, None)], "x double, target double")
    (trees, rows), = boosting.fit_trees(frame, ["x", "missing"], [], {"point": None}, rounds=2)[()].values()
    assert rows == 2 and np.allclose(trees.score(np.array([[9.0, 0.0]])), 4.0)
    assert boosting.fit_trees(frame.limit(0), ["x"], [], {"point": None}) == {}


def test_models_of_all_keys_grow_in_one_job_and_stay_apart(spark, train):
    together = boosting.fit_forecasters(train, K.FEATURES, ("category",), "residual", rounds=5)
    alone = boosting.train_boosted(train.filter("category = 'Juice'"), K.FEATURES, "residual", rounds=5)
    assert len(together) == 5
    assert np.array_equal(together[("Juice",)].point.feature, alone.point.feature)
    assert np.allclose(together[("Juice",)].point.value, alone.point.value)
    scored = boosting.predict_by_key(train, {("Juice",): alone}, ("category",))
    assert scored.filter("category <> 'Juice' AND point IS NOT NULL").count() == 0


def brute_horizon(history, weights, weeks):
    """Step-by-step forecast of one series in plain Python."""
    rows = [dict(r) for r in history]
    out = []
    for _ in range(weeks):
        last = rows[-1]
        mean_price = np.mean([r["price_unit"] for r in rows])
        x = {
            "lag_1": last["lag_1"], "rolling_mean_4": last["rolling_mean_4"],
            "rolling_std_4": last["rolling_std_4"], "momentum": last["momentum"],
            "price_vs_category_avg": last["price_unit"] / mean_price,
            "stock_to_demand_ratio": last["stock_available"] / last["rolling_mean_4"],
            "promo_lag_1": rows[-2]["promotion_flag"] if len(rows) > 1 else 0,
        }
        y = sum(weights[k] * v for k, v in x.items())
        tail = [r["units_sold"] for r in rows[-3:]] + [y]
        new = dict(last, units_sold=y, lag_1=y, lag_2=last["lag_1"], momentum=y - last["lag_1"],
                   rolling_mean_4=np.mean(tail), rolling_std_4=np.std(tail, ddof=1))
        rows.append(new)
        out.append(y)
    return out


@pytest.mark.parametrize("length", [1, 2, 30])
def test_horizon_matches_brute_force(spark, length):
    units = [50 + (i * 37) % 23 for i in range(length)]
    frame = series(spark, units, {
        "price_unit": F.lit(2.0) + F.day("week") / 10, "stock_available": F.lit(90.0),
        "promotion_flag": F.day("week") % 2, "lifecycle_stage": F.lit("Mature"),
        "lag_1": F.col("units_sold") - 1, "lag_2": F.col("units_sold") - 2,
        "rolling_mean_4": F.col("units_sold") + 0.5, "rolling_std_4": F.lit(3.0),
        "momentum": F.lit(1.0), "category": F.lit("Milk"),
    })
    weights = {"lag_1": 0.3, "rolling_mean_4": 0.4, "rolling_std_4": 0.2, "momentum": 0.1,
               "price_vs_category_avg": 3.0, "stock_to_demand_ratio": 0.5, "promo_lag_1": 2.0}
    recent = recent_history(frame)
    model = spark.createDataFrame(
        [("Milk", 1, 0.0, [float(weights.get(c, 0.0)) for c in K.FEATURES], 1.0)],
        "category string, training_rows long, intercept double, coefficients array<double>, "
        "residual_std double")
    got = horizon.predict_horizon(recent, horizon.linear_predictor(model), 3).orderBy("week").collect()
    want = brute_horizon([r.asDict() for r in recent.orderBy("week").collect()], weights, 3)
    assert np.allclose([r["point"] for r in got], want)
    assert (got[1]["week"] - got[0]["week"]).days == 7


def test_horizon_length_is_checked(spark):
    with pytest.raises(ValueError):
        horizon.predict_horizon(series(spark, [1]), None, 13)


def test_uneven_arrays_raise(spark):
    frame = spark.sql("SELECT 'a' AS sku, array(DATE '2024-01-01') AS weeks, array(1D, 2D) AS "
                      "predicted_units, array(1D) AS confidence_lower, array(1D) AS confidence_upper")
    with pytest.raises(Exception, match="differ in length"):
        horizon.flatten_arrays(frame).collect()


def test_clusters_cover_all_skus(spark, small):
    features = behaviour.sku_features(small.weekly)
    model = fit_clustering(features, starts=1, k_range=(3, 4))
    labels = model.labels(features)
    assert labels.count() == 25 and 3 <= model.k <= 4
    with pytest.raises(ValueError):
        fit_clustering(features.limit(3), starts=1)
    path = scratch_path(spark, "clusters")
    model.save(spark, path)
    assert {tuple(r) for r in ClusterModel.load(spark, path).labels(features).collect()} == {
        tuple(r) for r in labels.collect()
    }
    with pytest.raises(KeyError):
        behaviour.similar_skus(labels, labels, "ZZ-999")


def test_cluster_summaries_hold_every_member_in_order(spark):
    """All SKUs of a cluster, however dealt out, also those without rows; the query names those of the panel."""
    from types import SimpleNamespace

    from shelfcast.queries import checks  # noqa: F401
    from shelfcast.queries.registry import REGISTERED

    code = F.concat(F.lit("MI-"), F.lpad(F.col("id").cast("string"), 3, "0"))
    skus = spark.range(1000).repartition(7).select(code.alias("sku"), (F.col("id") % 400 == 3).cast("int").alias("cluster"))
    sold = skus.filter("sku not in ('MI-003', 'MI-008')").withColumn("units_sold", F.substring("sku", 4, 3).cast("double"))
    weekly = sold.drop("cluster").unionAll(sold.drop("cluster"))
    names = spark.createDataFrame([(1, "Few")], "cluster int, cluster_description string")
    first, second = behaviour.cluster_summaries(weekly, skus, names).collect()
    assert second["members"] == ["MI-003", "MI-403", "MI-803"] and second["cluster_description"] == "Few"
    assert first["members"] == [f"MI-{i:03}" for i in range(1000) if i % 400 != 3] and first["sku_count"] == 997
    rows = REGISTERED["e39_cluster_summaries"].build(SimpleNamespace(products=skus.select("sku"), weekly=weekly)).collect()
    for i, r in enumerate(rows):
        own = [n for n in range(i, 1000, 4) if n not in (3, 8)]
        assert (r["members"], r["sku_count"]) == (",".join(f"MI-{n:03}" for n in own), len(own))
        assert r["avg_weekly_demand"] == pytest.approx(sum(own) / len(own))


def test_cluster_summaries_equal_their_sql(spark):
    import duckdb

    from shelfcast.queries import checks  # noqa: F401
    from shelfcast.queries.registry import REGISTERED

    query, folder = REGISTERED["e39_cluster_summaries"], "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("lineitem", "orders", "part", "customer", "nation"):
        con.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    answer = con.execute(query.oracle())
    names = [c[0] for c in answer.description]
    assert names == ["cluster_label", "cluster_description", "sku_count", "members", "avg_weekly_demand"]
    got = query.run(spark, folder)
    assert got.columns == names and {tuple(r) for r in got.collect()} == set(answer.fetchall())


def test_models_moved_together_equal_models_moved_alone(spark):
    """Centres after Lloyd steps equal those of plain loops over one model; empty clusters stay."""
    random = np.random.default_rng(6)
    x = np.concatenate([random.normal(c, 1.0, (60, 2)) for c in ((0, 0), (6, 0), (0, 7))])
    points = spark.createDataFrame([(i * 7919, r.tolist()) for i, r in enumerate(x)], "h long, x array<double>").repartition(4)
    starts = [x[random.choice(len(x), k, replace=False)] for k in (2, 3, 3, 5)] + [np.array([[0.0, 0.0], [1e6, 0.0]])]
    models, costs = clustering.lloyd(points, starts)
    for start, got, cost in zip(starts, models, costs):
        centres = start.copy()
        for _ in range(clustering.MOST_MOVES):
            nearest = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
            new = np.array([x[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(centres)])
            rest = ((new - centres) ** 2).sum(axis=1).max() <= clustering.REST
            last, centres = ((x - centres[nearest]) ** 2).sum(), new
            if rest:
                break
        assert np.allclose(got, centres) and np.isclose(cost, last)
    sums = clustering._sums_of_all(points, models[:4])
    scores = clustering._silhouettes(points, models[:4], sums)
    for centres, score in zip(models, scores):
        gaps, own = ((x[:, None] - x) ** 2).sum(axis=2), ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        each = []
        for i, c in enumerate(own):
            inside = gaps[i][own == c].sum() / max((own == c).sum() - 1, 1)
            outside = min(gaps[i][own == o].mean() for o in set(own) - {c})
            each.append((outside - inside) / max(inside, outside))
        assert np.isclose(score / len(x), np.mean(each))


def test_clusters_are_as_good_as_those_of_single_fits(spark, small):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = behaviour.sku_features(small.weekly)
    for k in (3, 4):
        model = fit_clustering(features, k_range=(k, k))
        scaled = features.select("sku", model.scaled().alias("x"))
        gaps = model.gaps(F.col("x"))
        cost = scaled.agg(F.sum(F.least(*gaps))).first()[0]
        vectors = scaled.select(array_to_vector("x").alias("features")).persist()
        single = min(KMeans(k=k, seed=42 + i).fit(vectors).summary.trainingCost for i in range(5))
        assert cost <= 1.02 * single
        # centres rest: assigning and averaging once more changes nothing
        assert model.labels(features).select("cluster").distinct().count() == k
