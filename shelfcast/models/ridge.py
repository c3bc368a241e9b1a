"""Ridge regression for many groups at once.

One pass gathers, per group, the row count, means and scatter matrix of features and
target. Tasks reduce their rows to one small matrix per group with numpy and the
matrices merge in two salted steps, so the data itself is never shuffled and a hot
group costs no more than a cold one. The closed form is then solved per group.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import constants as K

SALT = 32


def _merge(a, b):
    """Pooled (n, mean, scatter) of two disjoint sets of rows."""
    if a is None:
        return b
    (n1, m1, s1), (n2, m2, s2) = a, b
    n, step = n1 + n2, m2 - m1
    return n, m1 + step * (n2 / n), s1 + s2 + np.outer(step, step) * (n1 * n2 / n)


def _summary(values):
    mean = values.mean(axis=0)
    centred = values - mean
    return len(values), mean, centred.T @ centred


def _moment_schema(keys, kinds):
    return T.StructType(
        [T.StructField(k, kinds[k]) for k in keys]
        + [T.StructField("salt", T.IntegerType()), T.StructField("n", T.LongType()),
           T.StructField("mean", T.ArrayType(T.DoubleType())),
           T.StructField("scatter", T.ArrayType(T.DoubleType()))]
    )


def group_moments(frame, keys, columns):
    """(n, mean, scatter) per group and salt, merged once."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    schema = _moment_schema(keys, kinds)
    size = len(columns)

    def per_task(batches):
        held = {}
        for batch in batches:
            for key, rows in batch.groupby(list(keys), sort=False):
                part = _summary(rows[list(columns)].to_numpy(dtype=float))
                held[key] = _merge(held.get(key), part)
        salt = np.random.default_rng().integers(SALT)
        yield pd.DataFrame(
            [(*key, salt, n, mean, scatter.ravel()) for key, (n, mean, scatter) in held.items()],
            columns=schema.names,
        )

    def pooled(rows):
        total = None
        for n, mean, scatter in zip(rows["n"], rows["mean"], rows["scatter"]):
            total = _merge(total, (n, np.asarray(mean), np.asarray(scatter).reshape(size, size)))
        return total

    def merge(key, rows):
        n, mean, scatter = pooled(rows)
        return pd.DataFrame([(*key, n, mean, scatter.ravel())], columns=schema.names)

    narrow = frame.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    partial = narrow.mapInPandas(per_task, schema)
    return partial.groupBy(*keys, "salt").applyInPandas(merge, schema), pooled


def model_schema(frame, keys):
    """Schema of a model table: the keys as `frame` has them, then the model."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    return T.StructType(
        [T.StructField(k, kinds[k]) for k in keys]
        + [T.StructField("training_rows", T.LongType()),
           T.StructField("intercept", T.DoubleType()),
           T.StructField("coefficients", T.ArrayType(T.DoubleType())),
           T.StructField("residual_std", T.DoubleType())]
    )


def solved(n, mean, scatter, alpha):
    """(rows, intercept, coefficients, residual deviation) from moments with the target last."""
    xx, xy, yy = scatter[:-1, :-1], scatter[:-1, -1], scatter[-1, -1]
    beta = np.linalg.solve(xx + alpha * np.eye(len(xx)), xy)
    squares = yy - 2 * beta @ xy + beta @ xx @ beta
    return n, mean[-1] - mean[:-1] @ beta, beta, np.sqrt(max(squares, 0.0) / n)


def fit_ridge(frame, keys, features, target="target", alpha=K.RIDGE_ALPHA):
    """Coefficients per group: training rows, intercept, coefficients, residual deviation.

    The intercept is not penalised; the deviation is the population one of the
    residuals.
    """
    keys, features = tuple(keys), tuple(features)
    moments, pooled = group_moments(frame, keys, (*features, target))
    schema = model_schema(frame, keys)

    def solve(key, rows):
        return pd.DataFrame([(*key, *solved(*pooled(rows), alpha))], columns=schema.names)

    return moments.groupBy(*keys).applyInPandas(solve, schema)


def ridge_score(features, intercept="intercept", coefficients="coefficients"):
    """Linear score as one expression."""
    score = F.col(intercept)
    for i, name in enumerate(features):
        score = score + F.col(name) * F.get(coefficients, F.lit(i))
    return score


def predict_ridge(frame, model, keys, features):
    """Point and interval per row; `model` has one row per group (category or fold).

    The model is computed once and broadcast when its row count allows, so scored rows
    are not shuffled and a hot group stays spread out.
    """
    ready = model.drop("training_rows")
    return score_with(frame, ready, keys, score_columns(features))


def score_columns(features):
    """Point and interval expressions over a row joined with its model."""
    point, margin = ridge_score(features), K.RESIDUAL_Z * F.col("residual_std")
    return {"point": point}, {"lower": F.col("point") - margin, "upper": F.col("point") + margin}


def score_with(frame, model, keys, columns):
    """Scoring with a model table that is ready to join."""
    point, interval = columns
    return (
        frame.join(model, list(keys)).withColumns(point).withColumns(interval)
        .drop("intercept", "coefficients", "residual_std")
    )
