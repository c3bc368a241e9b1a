"""Recursive forecasts of every series at once, step by step over the horizon.

A series' next state needs nothing but its own last one, so a task takes the steps of its series
one after another in memory, vectorised over series: one pass over one row a series, with no
shuffle or write between steps, whatever the kind of model.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.models import boosting
from shelfcast.models.growing import matrix
from shelfcast.operators.features import encoded_features, price_ratio
from shelfcast.operators.windows import by_week, last_rows, whole_series

#: Features that change from step to step; all others stay those of the last known week.
MOVING = (*K.LAG_COLUMNS, "price_vs_category_avg", "stock_to_demand_ratio", "promo_lag_1")
#: What a step needs of a series besides its features.
STATE = ("_u1", "_u2", "_u3", "_price_sum", "_price_n", "price_unit", "stock_available", "promotion_flag",
         "promo_lag_1", *K.LAG_COLUMNS)


def series_state(recent):
    """One row per series: its last row plus what later steps need of its history.

    Carries the last three units, the price sum and count, and the previous promotion
    flag, so no step looks at the history again.
    """
    order = by_week()
    units = F.col("units_sold")
    return last_rows(recent.withColumns({
        "_u1": units, "_u2": F.lag(units, 1).over(order), "_u3": F.lag(units, 2).over(order),
        "_price_sum": F.sum("price_unit").over(whole_series()),
        "_price_n": F.count("price_unit").over(whole_series()),
        "promo_lag_1": F.coalesce(F.lag("promotion_flag", 1).over(order), F.lit(0)),
        "_origin": F.col("week"),
    }))


def state_features(columns):
    """Features of the current state; missing values count as 0."""
    mean_price = F.try_divide(F.col("_price_sum"), F.col("_price_n"))
    derived = {
        **encoded_features(),
        "price_vs_category_avg": price_ratio(F.col("price_unit"), mean_price),
        "stock_to_demand_ratio": S.safe_divide("stock_available", "rolling_mean_4"),
        "promo_lag_1": F.col("promo_lag_1"),
    }
    present = set(columns)
    return {
        f"_x_{c}": F.coalesce(
            derived[c] if c in derived else F.col(c) if c in present else F.lit(0.0), F.lit(0.0)
        ).cast("double") for c in K.FEATURES
    }


class LinearPredictor:
    """Ridge models from a table with one row per key; rows without a model drop out."""

    def __init__(self, model, features=K.FEATURES, key="category"):
        self.model, self.key, self.features = model, key, tuple(features)

    def attach(self, state):
        ready = self.model.select(
            F.col(self.key).alias("_key"), F.col("intercept").alias("_intercept"),
            F.col("coefficients").alias("_coefficients"), F.col("residual_std").alias("_residual"),
        )
        return state.join(ready, F.col(self.key) == F.col("_key")).drop("_key")

    def estimator(self):
        """A function of a batch that gives the function of its feature matrix."""
        places = [K.FEATURES.index(c) for c in self.features]

        def of(batch):
            weights = matrix(batch.column("_coefficients"), len(places))
            start, residual = (batch.column(c).to_numpy() for c in ("_intercept", "_residual"))

            def estimates(x):
                point = start + (x[:, places] * weights).sum(axis=1)
                return point, point - K.RESIDUAL_Z * residual, point + K.RESIDUAL_Z * residual

            return estimates

        return of


class KeyedPredictor:
    """Forecasters of any kind by key; rows of other keys drop out."""

    def __init__(self, forecasters, key="category"):
        self.forecasters, self.key = {(k,): f for k, f in forecasters.items()}, key

    def attach(self, state):
        return state.filter(F.col(self.key).isin([k for k, in self.forecasters]))

    def estimator(self):
        forecasters, key = self.forecasters, self.key
        columns = {k: [K.FEATURES.index(c) for c in f.features] for k, f in forecasters.items()}

        def of(batch):
            owner = [(k,) for k in batch.column(key).to_pylist()]
            return lambda x: boosting.estimates_by_key(forecasters, columns, owner, x)

        return of


def linear_predictor(model, features=K.FEATURES, key="category"):
    """Predictor from a ridge model table with one row per category."""
    return LinearPredictor(model, features, key)


def _numbers(batch, name):
    """A column as doubles, NaN where it is missing."""
    return batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)


def _divided(a, b):
    """a / b, NaN where it has no value."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(b == 0, np.nan, a / b)


def _features_of(x, s):
    """The feature matrix of a state; missing values count as 0, a missing price ratio as 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cover = np.where(np.abs(s["rolling_mean_4"]) >= K.DIVISOR_FLOOR, s["stock_available"] / s["rolling_mean_4"], 0.0)
    ratio = _divided(s["price_unit"], _divided(s["_price_sum"], s["_price_n"]))
    moving = {**s, "price_vs_category_avg": np.where(np.isnan(ratio), 1.0, ratio), "stock_to_demand_ratio": cover}
    x = x.copy()
    for name in MOVING:
        x[:, K.FEATURES.index(name)] = moving[name]
    return np.where(np.isnan(x), 0.0, x)


def _next_state(s, point):
    """The state after `point` becomes the newest week.

    Lags move on, mean and deviation cover the last three units and the prediction; calendar,
    price and promotion columns stay those of the last known week.
    """
    window = np.stack([s["_u3"], s["_u2"], s["_u1"], point])
    known = (~np.isnan(window)).sum(axis=0)
    mean = _divided(np.nansum(window, axis=0), known.astype(float))
    squares = np.nansum((window - mean) ** 2, axis=0)
    priced = ~np.isnan(s["price_unit"])
    return {
        **s, "lag_2": s["lag_1"], "lag_1": point, "momentum": point - s["lag_1"], "rolling_mean_4": mean,
        "rolling_std_4": np.sqrt(_divided(squares, known - 1.0)),
        "_u3": s["_u2"], "_u2": s["_u1"], "_u1": point,
        "_price_sum": s["_price_sum"] + np.where(priced, s["price_unit"], 0.0), "_price_n": s["_price_n"] + priced,
        "promo_lag_1": s["promotion_flag"],
    }


def _walk(batch, estimates, weeks):
    """(step, point, lower, upper, state after it) of every step; interval ends never cross the point."""
    x = matrix(batch.column("_x"), len(K.FEATURES))
    s = {c: _numbers(batch, c) for c in STATE}
    s["_price_sum"] = np.nan_to_num(s["_price_sum"])
    for step in range(1, weeks + 1):
        point, lower, upper = estimates(_features_of(x, s))
        s = _next_state(s, point)
        yield step, point, np.fmin(lower, point), np.fmax(upper, point), s


def _state_rows(recent, predictor):
    """One row per series: features, state and what the predictor adds; absent columns are missing."""
    state = predictor.attach(series_state(recent))
    given = state.withColumns(state_features(state.columns)).withColumn("_x", F.array(*[F.col(f"_x_{c}") for c in K.FEATURES]))
    absent = {c: F.lit(None).cast("double") for c in STATE if c not in state.columns}
    kept = [c for c in (*K.SERIES, "category") if c in state.columns]
    added = [c for c in ("_intercept", "_coefficients", "_residual") if c in state.columns]
    return given.withColumns(absent).select(*kept, "_origin", "_x", *STATE, *added), kept


def _weeks_later(batch, step):
    days = batch.column("_origin").cast(pa.int32()).to_numpy(zero_copy_only=False)
    return pa.array(days + 7 * step, pa.int32()).cast(pa.date32())


def _missing(values):
    return pa.array(values, pa.float64(), mask=np.isnan(values))


def predict_horizon(recent, predictor, weeks=K.HORIZON_DEFAULT):
    """Forecast rows (series, week, point, lower, upper) for `weeks` weeks ahead.

    `recent` is the history of all series (see `recent_history`); `predictor` is a
    LinearPredictor or a KeyedPredictor.
    """
    if not 1 <= weeks <= K.HORIZON_MAX:
        raise ValueError(f"horizon must lie in 1..{K.HORIZON_MAX} weeks, got {weeks}")
    rows, kept = _state_rows(recent, predictor)
    of = predictor.estimator()
    schema = rows.select(*kept, F.col("_origin").alias("week")).schema
    for name in ("point", "lower", "upper"):
        schema = schema.add(name, "double")

    def run(batches):
        for batch in batches:
            for step, *values, _ in _walk(batch, of(batch), weeks):
                columns = [*[batch.column(c) for c in kept], _weeks_later(batch, step), *map(_missing, values)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def state_after(recent, predictor, steps=1):
    """Lag columns and previous promotion of every series after some steps, with its newest week."""
    rows, _ = _state_rows(recent, predictor)
    of, named = predictor.estimator(), (*K.LAG_COLUMNS, "promo_lag_1")
    schema = rows.select(*K.SERIES, F.col("_origin").alias("week")).schema
    for name in named:
        schema = schema.add(name, "double")

    def run(batches):
        for batch in batches:
            for step, *_, state in _walk(batch, of(batch), steps):
                pass
            columns = [*[batch.column(c) for c in K.SERIES], _weeks_later(batch, step), *[_missing(state[c]) for c in named]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("promo_lag_1", F.col("promo_lag_1").cast("int"))


def forecast_category(weekly, products, category, channel, region, predictor,
                      weeks=K.HORIZON_DEFAULT, history=K.HISTORY_WEEKS):
    """Forecasts of all products of a category in one channel and region.

    The scope filters come first; products without history drop out of the join.
    """
    from shelfcast.operators.windows import recent_history

    skus = products.filter(F.col("category") == category).select("sku", "category")
    scope = weekly.filter((F.col("channel") == channel) & (F.col("region") == region))
    return predict_horizon(recent_history(scope.join(skus, "sku"), history), predictor, weeks)


def as_arrays(forecast):
    """One row per series with parallel arrays in week order (at most 12 entries)."""
    entry = F.struct("week", "point", "lower", "upper")
    kept = [c for c in (*K.SERIES, "category") if c in forecast.columns]
    packed = forecast.groupBy(*kept).agg(F.array_sort(F.collect_list(entry)).alias("steps"))
    return packed.select(
        *kept, F.col("steps.week").alias("weeks"), F.col("steps.point").alias("predicted_units"),
        F.col("steps.lower").alias("confidence_lower"),
        F.col("steps.upper").alias("confidence_upper"),
    )


def flatten_arrays(forecasts):
    """Parallel arrays back to one row per week, in order; uneven arrays raise."""
    arrays = ("weeks", "predicted_units", "confidence_lower", "confidence_upper")
    kept = [c for c in forecasts.columns if c not in arrays]
    checked = forecasts.withColumn("weeks", F.when(
        S.same_length(*arrays), F.col("weeks")
    ).otherwise(F.raise_error(F.lit("forecast arrays differ in length"))))
    return checked.select(*kept, F.posexplode(F.arrays_zip(*arrays)).alias("position", "step")).select(
        *kept, "position", F.col("step.weeks").alias("week"), "step.predicted_units",
        "step.confidence_lower", "step.confidence_upper",
    )
