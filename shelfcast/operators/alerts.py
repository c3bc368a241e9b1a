"""Anomaly rules: per-row rules as expressions, promotion rule per series."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S

ALERT_COLUMNS = ("sku", "channel", "region", "alert_type", "severity", "message",
                 "recommended_action")


def _one(c):
    return S.fixed_text(c, 1)


def row_rules(columns):
    """The five row rules in order: (type, severity, condition, message)."""
    units, mean = F.col("units_sold"), F.col("rolling_mean_4")
    std, stock, price = F.col("rolling_std_4"), F.col("stock_available"), F.col("price_unit")
    average = F.coalesce(F.col("price_avg"), price) if "price_avg" in columns else price
    demand = mean > 0
    cover = F.try_divide(stock, mean)
    deviation = F.try_divide(F.abs(price - average), average)
    return [
        ("demand_spike", "HIGH", demand & (units > mean + K.SPIKE_SIGMA * std),
         F.concat(F.lit("Units sold "), _one(units), F.lit(" exceeded mean+2.5σ ("), _one(mean),
                  F.lit(f"+{K.SPIKE_SIGMA}*"), _one(std), F.lit(")."))),
        ("demand_drop", "MEDIUM", demand & (units >= 0) & (units < mean - K.DROP_SIGMA * std),
         F.concat(F.lit("Units sold "), _one(units), F.lit(" below mean-2σ ("), _one(mean),
                  F.lit(f"-{K.DROP_SIGMA}*"), _one(std), F.lit(")."))),
        ("return_anomaly", "LOW", units < 0,
         F.concat(F.lit("Negative units_sold ("), _one(units),
                  F.lit(") — likely a return batch."))),
        ("stock_risk", "HIGH", demand & (cover < K.STOCK_RISK_WEEKS),
         F.concat(F.lit("Stock cover "), _one(cover),
                  F.lit(f" weeks below {K.STOCK_RISK_WEEKS}-week threshold."))),
        ("price_anomaly", "LOW", (average > 0) & (deviation > K.PRICE_DEVIATION),
         F.concat(F.lit("Price "), S.fixed_text(price, 2),
                  F.lit(" deviates >15% from 4-week avg "), S.fixed_text(average, 2),
                  F.lit("."))),
    ]


def detect_alerts(weekly):
    """One row per rule hit, with the week and the rule's ordinal as emission order."""
    hits = F.array_compact(F.array(*[
        F.when(condition, F.struct(
            F.lit(i).alias("rule"), F.lit(kind).alias("alert_type"),
            F.lit(severity).alias("severity"), message.alias("message"),
            F.lit(K.ALERT_TEXT[kind]).alias("recommended_action"),
        )) for i, (kind, severity, condition, message) in enumerate(row_rules(weekly.columns))
    ]))
    return weekly.select(*K.SERIES, "week", F.inline(hits))


def detect_cannibalisation(weekly):
    """Series whose promoted weeks sell less on average than the others."""
    from shelfcast.operators.analytics import promo_means

    promo, base = F.col("promo_avg"), F.col("non_promo_avg")
    return promo_means(weekly, *K.SERIES).filter(promo < base).select(
        *K.SERIES,
        F.lit("promo_cannibalization").alias("alert_type"), F.lit("MEDIUM").alias("severity"),
        F.concat(F.lit("Promo mean "), _one(promo), F.lit(" below non-promo mean "), _one(base),
                 F.lit("; consider lifting promo.")).alias("message"),
        F.lit(K.ALERT_TEXT["promo_cannibalization"]).alias("recommended_action"),
    )


def filter_alerts(alerts, sku=None, channel=None, region=None):
    for name, value in (("sku", sku), ("channel", channel), ("region", region)):
        if value is not None:
            alerts = alerts.filter(F.col(name) == value)
    return alerts


def check_alerts(weekly, sku=None, channel=None, region=None):
    """All rules within a scope; the scope is applied first, as rules never cross series."""
    scoped = filter_alerts(weekly, sku, channel, region)
    return detect_alerts(scoped).select(*ALERT_COLUMNS).unionByName(detect_cannibalisation(scoped))


def stamped(alerts, detected_at):
    return alerts.withColumn("detected_at", F.lit(detected_at).cast("timestamp"))
