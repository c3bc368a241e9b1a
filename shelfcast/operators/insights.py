"""One-line insights from sales, promotions, lifecycle, alerts and forecasts."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators import analytics


def _line(section, rank, text, weight=0.0):
    """Columns of an insight line; lines sort by section, weight and rank."""
    weight = F.lit(weight) if isinstance(weight, float) else weight
    return [F.lit(section).alias("section"), weight.alias("weight"), rank.alias("rank"),
            text.alias("insight")]


def growth_deltas(weekly):
    """Units per category in the last two months present anywhere; missing ones count 0."""
    monthly = analytics.units_by(weekly, "category", "monthly")
    months = monthly.select("period").distinct().orderBy(F.col("period").desc()).limit(2)
    newest = months.agg(F.max("period")).scalar()
    before = months.agg(F.when(F.count("*") == 2, F.min("period"))).scalar()

    def units_in(month):
        hit = F.when(F.col("period") == month, F.col("units_sold"))
        return F.coalesce(F.sum(hit), F.lit(0.0))

    totals = monthly.groupBy("category").agg(
        units_in(before).alias("previous"), units_in(newest).alias("current"),
        F.max(before.isNotNull()).alias("_two"),
    )
    delta = S.lift_percent("current", "previous")
    return totals.filter("_two").drop("_two").withColumn("delta_pct", delta)


def category_growth(weekly):
    delta = F.col("delta_pct")
    text = F.concat(
        F.col("category"), F.lit(" category demand "), F.when(delta > 0, "up").otherwise("down"),
        F.lit(" "), S.fixed_text(F.abs(delta), 1), F.lit("% MoM ("),
        S.fixed_text("previous", 0), F.lit(" -> "), S.fixed_text("current", 0), F.lit(" units)."),
    )
    return (
        growth_deltas(weekly).filter(F.abs(delta) >= K.GROWTH_REPORTED)
        .select(*_line(1, F.col("category"), text))
    )


def promo_effectiveness(weekly):
    """Categories whose SKUs gain at least 15 % on average, strongest first."""
    categories = weekly.groupBy("sku").agg(F.min_by("category", "week").alias("category"))
    lifts = (
        analytics.promo_impact(weekly).join(categories, "sku").dropna(subset=["category"])
        .groupBy("category").agg(F.avg("promo_lift_pct").alias("lift"))
        .filter(F.col("lift") >= K.PROMO_LIFT_STRONG)
    )
    text = F.concat(F.lit("Promotions in "), F.col("category"), F.lit(" produce a strong "),
                    S.fixed_text("lift", 1), F.lit("% average lift."))
    return lifts.select(*_line(2, F.col("category"), text, -F.col("lift")))


def lifecycle_lines(weekly):
    row = analytics.lifecycle_distribution(weekly)
    lines = [
        ("a", "decline",
         " SKUs in Decline lifecycle — consider markdown or rationalization."),
        ("b", "growth",
         " SKUs in Growth lifecycle — prioritize stocking and channel coverage."),
    ]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(rank).alias("rank"), F.col(stage).alias("n"),
                 F.concat(F.col(stage).cast("string"), F.lit(text)).alias("insight"))
        for rank, stage, text in lines
    ]))).filter("n > 0").select(*_line(3, F.col("rank"), F.col("insight")))


def alert_line(alerts):
    """How many HIGH alerts there are, with the first three in emission order."""
    high = alerts.filter(F.col("severity") == "HIGH")
    first = high.orderBy("sku", "channel", "region", "week", "rule").limit(3)
    place = F.struct("sku", "channel", "region", "week", "rule",
                     F.concat_ws("/", "sku", "alert_type").alias("text"))
    examples = first.agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(place)), lambda x: x["text"]), "; "
    )).scalar()
    counted = high.agg(F.count("*").alias("n")).filter("n > 0")
    text = F.concat(F.col("n").cast("string"), F.lit(" HIGH-severity alerts active (e.g. "),
                    examples, F.lit(")."))
    return counted.select(*_line(4, F.lit(""), text))


def forecast_line(forecasts):
    """Series with the highest forecast total; rows are (series, week, predicted_units)."""
    best = (
        forecasts.groupBy(*K.SERIES)
        .agg(F.sum("predicted_units").alias("total"), F.count("*").alias("weeks"))
        .orderBy(F.col("total").desc(), *K.SERIES).limit(1)
    )
    text = F.concat(
        F.lit("Highest forecasted demand: "), F.col("sku"), F.lit(" ("), F.col("channel"),
        F.lit(" / "), F.col("region"), F.lit(") at "), S.fixed_text("total", 0),
        F.lit(" units over "), F.col("weeks").cast("string"), F.lit(" weeks."),
    )
    return best.select(*_line(5, F.lit(""), text))


def generate_insights(weekly, alerts, forecasts=None, limit=K.INSIGHT_LIMIT):
    """The first insights in section order, all with `limit=None` (sections are a handful of rows)."""
    parts = [category_growth(weekly)]
    if "category" in weekly.columns:
        parts.append(promo_effectiveness(weekly))
    parts += [lifecycle_lines(weekly), alert_line(alerts)]
    if forecasts is not None:
        parts.append(forecast_line(forecasts))
    lines = reduce(lambda a, b: a.unionByName(b), parts)
    order = ("section", "weight", "rank")
    first = lines if limit is None else lines.orderBy(*order).limit(limit)
    return first.select(F.row_number().over(Window.orderBy(*order)).alias("ordinal"), "insight")
