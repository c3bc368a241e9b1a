"""Data contracts and the quality gate."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S


def _flag(c):
    return F.col(c).isin(0, 1)


def _between(c, low, high):
    return F.col(c).between(low, high)


def table_rules():
    """Valid-row conditions per table: the CHECK rules of the stored tables."""
    interval = (F.col("confidence_lower") <= F.col("predicted_units")) & (
        F.col("predicted_units") <= F.col("confidence_upper")
    )
    low, high = K.DELIVERY_RANGE
    channel, region = F.col("channel").isin(*K.CHANNELS), F.col("region").isin(*K.REGIONS)
    return {
        "products": {
            "sku_format": F.col("sku").rlike(K.SKU_PATTERN),
            "category_valid": F.col("category").isin(*K.CATEGORIES),
            "pack_type_valid": F.col("pack_type").isin(*K.PACK_TYPES),
        },
        "daily_sales": {
            "price_positive": F.col("price_unit") > 0,
            "delivery_range": _between("delivery_days", low, high),
            "promo_flag": _flag("promotion_flag"),
            "channel_valid": channel,
            "region_valid": region,
        },
        "weekly_features": {
            "lifecycle_valid": F.col("lifecycle_stage").isin(*K.LIFECYCLE_STAGES),
            "price_positive": F.col("price_unit") > 0,
            "promo_flag": _flag("promotion_flag"),
            "channel_valid": channel,
            "region_valid": region,
        },
        "enrichment_features": {
            "promo_rate": _between("promo_rate", 0, 1),
            "price_avg_positive": F.col("price_avg") >= 0,
        },
        "demand_forecasts": {"interval_valid": interval},
        "prediction_log": {"channel_valid": channel, "region_valid": region},
        "model_lineage": {
            "decision_valid": F.col("promotion_decision").isin(*K.PROMOTION_DECISIONS),
        },
    }


def row_contracts():
    """Row rules of the service models that go beyond the table rules."""
    return {
        "daily_sales": {"sku_format": F.col("sku").rlike(K.SKU_PATTERN)},
        "weekly_features": {
            "sku_format": F.col("sku").rlike(K.SKU_PATTERN),
            "week_number_range": _between("week_number", 1, 53),
            "month_range": _between("month", 1, 12),
            "year_range": _between("year", 2020, 2030),
            "sku_age_not_negative": F.col("sku_age") >= 0,
            "holiday_peak_flag": _flag("is_holiday_peak"),
            "holiday_week_flag": _flag("is_holiday_week"),
            "summer_flag": _flag("is_summer"),
            "winter_flag": _flag("is_winter"),
        },
        "enrichment_features": {
            "sku_format": F.col("sku").rlike(K.SKU_PATTERN),
            "deliveries_not_negative": F.col("deliveries") >= 0,
            "inflation_not_negative": F.col("inflation_index") >= 0,
            "school_flag": _flag("school_in_session"),
        },
    }


def _broken(valid):
    """A rule is broken only where it is known to be false, as in a database CHECK."""
    return F.coalesce(~valid, F.lit(False))


def rule_violations(frame, rules):
    """Broken rows per rule, counted in one pass."""
    counts = frame.agg(*[F.count_if(_broken(v)).alias(n) for n, v in rules.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules
    ])))


def failing_rows(frame, rules):
    """Rows that break a rule, with the names of the broken rules."""
    names = F.array_compact(F.array(*[F.when(_broken(v), F.lit(n)) for n, v in rules.items()]))
    return frame.withColumn("broken_rules", names).filter(F.size("broken_rules") > 0)


def enforce(frame, rules):
    """Strict mode: raises when any row breaks a rule, as a database insert would."""
    broken = [r for r in rule_violations(frame, rules).collect() if r["violations"]]
    if broken:
        raise ValueError(f"rules broken: { {r['rule']: r['violations'] for r in broken} }")
    return frame


def duplicate_keys(frame, keys):
    """Keys that occur more than once."""
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def orphans(child, parent, key="sku"):
    """Child keys without a parent row, each with its row count.

    Counts come before the anti join, so a hot orphan key is one row in it.
    """
    counts = child.groupBy(key).agg(F.count("*").alias("rows"))
    return counts.join(parent.select(key).distinct(), key, "left_anti")


def schema_checks(frame):
    """(name, level, ok, message) of the column and type checks, from the schema alone."""
    missing = [c for c in K.GATE_COLUMNS if c not in frame.columns]
    found = f"Missing columns: {missing}" if missing else "All 24 required columns present"
    checks = [("schema_columns", "FAIL", not missing, found)]
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    for name, kind in frame.dtypes:
        if name in K.GATE_COLUMNS and name not in K.GATE_TEXT_COLUMNS:
            if not kind.startswith(numeric):
                checks.append((f"dtype_{name}", "FAIL", False, f"Column '{name}' should be numeric"))
    return checks


def _percent(c):
    return F.concat(S.fixed_text(c * 100, 2), F.lit("%"))


def validation_report(frame, as_of, allow_stale=False, expected=K.GATE):
    """Gate report with one row per check: name, level, ok, message.

    Measures are first summed per series, so the rows are read once with map-side
    sums; distinct counts then run over the few series rows.
    """
    have = set(frame.columns)
    required = [c for c in K.GATE_COLUMNS if c in have]
    measured = [c for c in required if c not in K.GATE_MISSING_EXEMPT]
    numbers = {c: S.to_number(c) for c in ("units_sold", "price_unit") if c in have}
    keys = [c for c in K.SERIES if c in have]
    per_series = frame.groupBy(*keys).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in measured],
        *[F.sum(e).alias(f"_sum_{c}") for c, e in numbers.items()],
        *[F.count(e).alias(f"_n_{c}") for c, e in numbers.items()],
        *([F.max("week").alias("_latest")] if "week" in have else []),
    )
    one = per_series.agg(
        *[F.countDistinct(k).alias(f"_distinct_{k}") for k in keys],
        F.sum("_rows").alias("_rows"),
        *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in measured],
        *[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_n_{c}")).alias(f"_mean_{c}") for c in numbers],
        *([F.max("_latest").alias("_latest")] if "week" in have else []),
    )

    def row(name, level, ok, message):
        return F.struct(F.lit(name).alias("name"), F.lit(level).alias("level"),
                        F.coalesce(ok, F.lit(False)).alias("ok"), message.alias("message"))

    checks = [row(n, lv, F.lit(ok), F.lit(m)) for n, lv, ok, m in schema_checks(frame)]
    for key, plural, label in zip(K.SERIES, ("skus", "channels", "regions"),
                                  ("SKUs", "Channels", "Regions")):
        count = F.col(f"_distinct_{key}") if key in have else F.lit(0)
        wanted = expected[plural]
        text = F.concat(F.lit(f"{label}: "), count.cast("string"), F.lit(f" (expected {wanted})"))
        checks.append(row(f"cardinality_{plural}", "WARN", count == wanted, text))
    limit = expected["missing_rate"]
    for c in measured:
        rate = F.try_divide(F.col(f"_null_{c}"), F.col("_rows"))
        text = F.concat(F.lit(f"{c}: "), _percent(rate), F.lit(f" NaN (limit {limit:.0%})"))
        checks.append(row(f"missing_{c}", "FAIL", rate <= limit, text))
    for c, bounds, digits in (("units_sold", expected["units_mean"], 2),
                              ("price_unit", expected["price_mean"], 4)):
        if c in numbers:
            mean = F.col(f"_mean_{c}")
            text = F.concat(F.lit(f"{c} mean="), S.fixed_text(mean, digits),
                            F.lit(f" (expected [{bounds[0]},{bounds[1]}])"))
            checks.append(row(f"dist_{c}", "WARN", mean.between(*bounds), text))
    if "week" in have:
        age = F.datediff(F.lit(as_of).cast("date"), F.col("_latest"))
        text = F.concat(
            F.lit("Latest week "), F.col("_latest").cast("string"), F.lit(" is "),
            age.cast("string"),
            F.lit(f" days ago (--allow-stale={'set' if allow_stale else 'not set'})"),
        )
        fresh = (age <= expected["recency_days"]) | F.lit(allow_stale)
        checks.append(row("recency", "WARN", fresh, text))
    return one.select(F.inline(F.array(*checks)))


def gate_passed(report):
    """True unless a FAIL-level check failed (the report is a few dozen rows)."""
    return report.filter((F.col("level") == "FAIL") & ~F.col("ok")).isEmpty()


def enum_ok(frame):
    """Row-level validity of SKU format and enumerations."""
    return frame.withColumn(
        "row_ok",
        S.valid_sku() & ~S.not_in("channel", K.CHANNELS) & ~S.not_in("region", K.REGIONS),
    )
