"""Cleaning of the daily frame: rows are flagged and counted, never dropped."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.schemas import DAILY


def require_columns(frame, names, what):
    missing = sorted(set(names) - set(frame.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


def clean_daily_data(daily):
    """Dates parsed (unreadable ones become NULL) and negative sales marked as returns."""
    require_columns(daily, DAILY.names, "daily frame")
    return daily.withColumns({
        "date": F.col("date").try_cast("date"),
        "is_return": S.holds(F.col("units_sold") < 0),
    })


def count_violations(daily):
    """Rows with unknown enumerations, prices about zero, or odd delivery days, in one pass."""
    enums = (
        S.not_in("category", K.CATEGORIES) | S.not_in("channel", K.CHANNELS)
        | S.not_in("region", K.REGIONS)
    )
    low, high = K.DELIVERY_RANGE
    days = F.col("delivery_days")
    return daily.agg(
        F.count_if(enums).alias("unknown_enums"),
        F.count_if(F.col("price_unit") <= K.MIN_PRICE).alias("non_positive_price"),
        F.count_if((days < low) | (days > high)).alias("delivery_out_of_range"),
    )


def add_category(weekly):
    """Category from the SKU prefix; unmapped SKUs keep NULL."""
    return weekly.withColumn("category", S.category_from_sku())


def unmapped_skus(weekly):
    return add_category(weekly).agg(F.count_if(F.col("category").isNull()).alias("unmapped"))
