"""Series windows.

A series is (sku, channel, region) and holds at most one row per calendar week, so
a window partition is bounded by the calendar however large the input is. All
windows share one partitioning and ordering: Spark shuffles and sorts once.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S


def by_week(*keys, descending=False):
    order = F.col("week").desc() if descending else F.col("week")
    return Window.partitionBy(*(keys or K.SERIES)).orderBy(order)


def whole_series(*keys):
    return Window.partitionBy(*(keys or K.SERIES))


def add_lags(weekly, keys=K.SERIES):
    """Lag, rolling and momentum columns by row position, still with gaps at series starts."""
    order = by_week(*keys)
    previous_four = order.rowsBetween(-4, -1)
    units = F.col("units_sold")
    return weekly.withColumns({
        "lag_1": F.lag(units, 1).over(order),
        "lag_2": F.lag(units, 2).over(order),
        "rolling_mean_4": F.avg(units).over(previous_four),
        "rolling_std_4": F.stddev_samp(units).over(previous_four),
        "momentum": F.lag(units, 1).over(order) - F.lag(units, 2).over(order),
    })


def fill_series(frame, columns, keys=K.SERIES, mode="both"):
    """Last known value forward, then the first known value back, then zero.

    After the forward pass only leading gaps remain, and those take the first known
    value of the whole series, so the backward pass needs no second frame per row.
    `mode="forward"` leaves the backward pass out.
    """
    order = by_week(*keys)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {}
    for c in columns:
        steps = [F.last(c, ignorenulls=True).over(so_far)]
        if mode == "both":
            steps.append(F.first(c, ignorenulls=True).over(everything))
        filled[c] = F.coalesce(*steps, F.lit(0))
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    return frame.withColumns({c: e.cast(kinds[c]) for c, e in filled.items()})


def compute_lag_features(weekly, mode="both"):
    """Lag features with the gaps at series starts filled."""
    return fill_series(add_lags(weekly), K.LAG_COLUMNS, mode=mode)


def invalid_lifecycle_rows(weekly):
    """How many rows carry an unknown lifecycle stage."""
    bad = S.not_in("lifecycle_stage", K.LIFECYCLE_STAGES)
    return weekly.agg(F.count_if(bad).alias("bad_row_count"))


def next_week_target(weekly):
    """The next row's units as the training target."""
    return weekly.withColumn("target_next_week", F.lead("units_sold", 1).over(by_week()))


def previous_promotion(keys=K.SERIES):
    """Promotion flag of the previous row, 0 at the series start."""
    return F.coalesce(F.lag("promotion_flag", 1).over(by_week(*keys)), F.lit(0)).cast("int")


def recent_history(weekly, weeks=K.HISTORY_WEEKS):
    """The last `weeks` rows of every series."""
    newest_first = F.row_number().over(by_week(descending=True))
    return weekly.withColumn("_back", newest_first).filter(F.col("_back") <= weeks).drop("_back")


def last_rows(frame, keys=K.SERIES):
    """The last row of every series."""
    newest_first = F.row_number().over(by_week(*keys, descending=True))
    return frame.withColumn("_back", newest_first).filter(F.col("_back") == 1).drop("_back")


def latest_sku_metadata(weekly):
    """Latest lifecycle stage and age per SKU; ties between series go to the smallest key."""
    packed = F.struct(
        F.datediff("week", F.lit("1970-01-01").cast("date")).alias("day"),
        F.col("sku_age"), F.col("lifecycle_stage"),
    )
    return weekly.groupBy("sku").agg(F.max(packed).alias("_latest")).select(
        "sku", F.col("_latest.lifecycle_stage").alias("lifecycle_stage"),
        F.col("_latest.sku_age").alias("sku_age"),
    )


def first_rows(frame, key, order, columns):
    """First row per key in the given order, by partial aggregation instead of a sort."""
    packed = F.min_by(F.struct(*columns), F.col(order)).alias("_first")
    return frame.groupBy(key).agg(packed).select(key, "_first.*")


def positions(base, keys=K.SERIES):
    """Base value plus the zero-based position of the row in its series."""
    return F.col(base) + F.row_number().over(by_week(*keys)) - 1


def change_to_previous(frame, value, partition, order):
    """Percent change to the previous row of the partition."""
    window = Window.partitionBy(partition).orderBy(order)
    return S.percent_change(F.col(value), F.lag(value, 1).over(window))
