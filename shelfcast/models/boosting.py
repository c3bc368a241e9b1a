"""Boosted trees for the mean and for quantiles: every model and head of a job grows together.

Fitting works on all rows by histograms that Spark adds up (see growing); scoring is one
vectorised pass over the rows, whatever the number of trees and models.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.models.growing import TASK_ROWS, feature_array, grow, matrix

POINT = "point"
TREES = (
    "head string, start double, rate double, rounds int, training_rows long, "
    "feature array<int>, threshold array<double>, value array<double>"
)
SETTINGS = "features array<string>, low double, high double"
_SCORE_ROWS = 4096


@dataclass(frozen=True)
class Trees:
    """Complete binary trees in heap order: one row per tree, feature -1 marks a leaf."""

    start: float
    rate: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, matrix):
        parts = [self._score(matrix[i:i + _SCORE_ROWS]) for i in range(0, len(matrix), _SCORE_ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _score(self, matrix):
        rows, trees = np.arange(len(matrix))[:, None], np.arange(len(self.feature))
        node = np.zeros((len(matrix), len(trees)), dtype=np.int64)
        while True:
            split = self.feature[trees, node]
            if (split < 0).all():
                return self.start + self.rate * self.value[trees, node].sum(axis=1)
            below = matrix[rows, np.maximum(split, 0)] <= self.threshold[trees, node]
            node = np.where(split < 0, node, 2 * node + 2 - below)


def fit_trees(frame, features, keys, heads, rounds=K.BOOSTING["rounds"], depth=K.BOOSTING["depth"],
              rate=K.BOOSTING["rate"], min_leaf=K.BOOSTING["min_leaf"], task_rows=TASK_ROWS):
    """{key values: {head: (Trees, rows fitted)}} for every key in `frame` and every head.

    `heads` maps a head's name to its quantile, None for the mean. Every row with a target is
    fitted on. The dictionary holds rounds x nodes numbers per model and nothing that grows
    with the rows.
    """
    rows = frame.select(*keys, F.col("target").cast("double").alias("target"), feature_array(frame, features).alias("_x"))
    found = {}
    for key, name, head, grown, edges, n in grow(
        rows.where("target is not null"), keys, list(features), heads, rounds, depth, rate, min_leaf, task_rows
    ):
        feature = np.stack([t.feature for t in grown])
        threshold = np.zeros(feature.shape)
        for place in zip(*np.nonzero(feature >= 0)):
            threshold[place] = edges[feature[place]][grown[place[0]].bin[place[1]]]
        trees = Trees(head.start, rate, feature, threshold, np.stack([t.value for t in grown]) / rate)
        found.setdefault(key, {})[name] = (trees, n)
    return found


def _trees(row):
    def shaped(name, kind):
        return np.array(row[name], dtype=kind).reshape(row["rounds"], -1)

    return Trees(row["start"], row["rate"], shaped("feature", np.int32), shaped("threshold", float), shaped("value", float))


@dataclass
class BoostedForecaster:
    """Point model with two quantile heads, or with residual quantiles as offsets."""

    features: tuple
    point: Trees
    lower: Trees | None = None
    upper: Trees | None = None
    offsets: tuple = (0.0, 0.0)
    training_rows: int = 0

    def estimates(self, matrix):
        """point, lower and upper of every row; interval ends never cross the point."""
        point = self.point.score(matrix)
        if self.lower is None:
            low, high = (point + o for o in self.offsets)
        else:
            low, high = self.lower.score(matrix), self.upper.score(matrix)
        return point, np.minimum(low, point), np.maximum(high, point)

    def predict(self, frame):
        """Adds point, lower and upper."""
        return predict_by_key(frame, {(): self}, ())

    def save(self, spark, path):
        """Trees as a table with one row per head, next to the settings."""
        heads = {POINT: self.point, "lower": self.lower, "upper": self.upper}
        rows = [
            (name, t.start, t.rate, len(t.feature), self.training_rows, t.feature.ravel().tolist(),
             t.threshold.ravel().tolist(), t.value.ravel().tolist())
            for name, t in heads.items() if t is not None
        ]
        spark.createDataFrame(rows, TREES).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        row = [(list(self.features), *map(float, self.offsets))]
        spark.createDataFrame(row, SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark, path):
        settings = spark.read.parquet(f"{path}/settings").first()
        rows = {r["head"]: r for r in spark.read.parquet(f"{path}/trees").collect()}
        heads = [_trees(rows[n]) if n in rows else None for n in (POINT, "lower", "upper")]
        return BoostedForecaster(
            tuple(settings["features"]), *heads, offsets=(settings["low"], settings["high"]),
            training_rows=rows[POINT]["training_rows"],
        )


@dataclass
class LinearForecaster:
    """A ridge model with the same interface: the interval is z deviations of its residuals."""

    features: tuple
    intercept: float
    coefficients: np.ndarray
    residual_std: float
    training_rows: int = 0

    def estimates(self, matrix):
        point = self.intercept + matrix @ self.coefficients
        half = K.RESIDUAL_Z * self.residual_std
        return point, point - half, point + half


def estimates_by_key(forecasters, columns, owner, x):
    """Point, lower and upper of every row of `x` by the forecaster of its owner, NaN without one."""
    rows_of = {}
    for i, key in enumerate(owner):
        rows_of.setdefault(key, []).append(i)
    out = np.full((3, len(owner)), np.nan)
    for key, rows in rows_of.items():
        if key in forecasters:
            out[:, rows] = forecasters[key].estimates(x[np.ix_(rows, columns[key])])
    return out


def predict_by_key(frame, forecasters, keys):
    """Adds point, lower and upper, each row by the forecaster of its key values.

    `forecasters` maps tuples of key values to forecasters; rows of other keys get nulls.
    """
    keys = list(keys)
    added = (POINT, "lower", "upper")
    kept = [c for c in frame.columns if c not in added]
    names = sorted({c for f in forecasters.values() for c in f.features})
    columns = {k: [names.index(c) for c in f.features] for k, f in forecasters.items()}
    asked = frame.select(*kept, feature_array(frame, names).alias("_x"))

    def score(batches):
        for batch in batches:
            x = matrix(batch.column("_x"), len(names)) if names else np.zeros((batch.num_rows, 0))
            owner = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            out = estimates_by_key(forecasters, columns, owner, x)
            rest = batch.drop_columns(["_x"])
            made = [pa.array(o, pa.float64(), mask=np.isnan(o)) for o in out]
            yield pa.RecordBatch.from_arrays([*rest.columns, *made], names=[*rest.schema.names, *added])

    schema = frame.select(*kept).schema
    for name in added:
        schema = schema.add(name, "double")
    return asked.mapInArrow(score, schema)


def fit_forecasters(frame, features, keys=(), interval="quantile", **settings):
    """{key values: BoostedForecaster}: point models with the kind of interval asked for.

    `interval` is "quantile" (two heads), "residual" (quantiles of the residuals as offsets)
    or "none". All models of all keys grow together, pass by pass. `frame` holds the keys, the features and `target`.
    """
    keys = list(keys)
    heads = {POINT: None}
    if interval == "quantile":
        heads |= dict(zip(("lower", "upper"), K.QUANTILES))
    found = fit_trees(frame, features, keys, heads, **settings)
    made = {
        key: BoostedForecaster(
            tuple(features), trees[POINT][0], *(trees[h][0] if h in trees else None for h in ("lower", "upper")),
            training_rows=trees[POINT][1],
        )
        for key, trees in found.items()
    }
    if interval == "residual" and made:
        residual = F.col("target") - F.col(POINT)
        quantiles = F.percentile_approx(residual, list(K.QUANTILES), 10000).alias("q")
        scored = predict_by_key(frame, made, keys)
        for row in (scored.groupBy(*keys).agg(quantiles) if keys else scored.agg(quantiles)).collect():
            key = tuple(row[k] for k in keys)
            if key in made:
                made[key].offsets = tuple(row["q"])
    return made


def train_boosted(frame, features, interval="quantile", **settings):
    """One forecaster on all rows of `frame`."""
    return fit_forecasters(frame, features, (), interval, **settings)[()]
