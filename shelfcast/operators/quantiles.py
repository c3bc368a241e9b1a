"""Exact quantiles without gathering a column in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.session import cut_lineage


def _cells(frame, columns):
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    return frame.select(F.explode(pairs).alias("cell")).select("cell.*").filter(
        S.nan_to_null("value").isNotNull()
    )


def exact_quantiles(frame, columns, probabilities=(0.25, 0.5, 0.75)):
    """Quantiles with linear interpolation, one row per (metric, probability).

    Equal values collapse to counts first, so a value that fills a third of the rows
    is one row. The counts are range-partitioned and ranked inside each range; the
    ranges' totals (one row per task and metric) give every range its offset.
    """
    counts = _cells(frame, columns).groupBy("metric", "value").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange("metric", "value").withColumn(
        "part", F.spark_partition_id()
    )
    ranged = cut_lineage(ranged)  # the partition number must not change between uses
    totals = ranged.groupBy("metric", "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("metric").orderBy("part")
    offsets = totals.select(
        "metric", "part",
        (F.sum("rows").over(before) - F.col("rows")).alias("offset"),
        F.sum("rows").over(Window.partitionBy("metric")).alias("total"),
    )
    inside = Window.partitionBy("metric", "part").orderBy("value")
    ranked = (
        ranged.withColumn("upto", F.sum("n").over(inside)).join(offsets, ["metric", "part"])
        .withColumn("last", F.col("offset") + F.col("upto") - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    position = F.col("probability") * (F.col("total") - 1)
    low, high = F.floor(position), F.ceil(position)
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    hits = (
        ranked.select("metric", "value", "first", "last", "total", wanted)
        .filter((F.col("last") >= low) & (F.col("first") <= high))
    )
    at_low = F.max(F.when((F.col("first") <= low) & (F.col("last") >= low), F.col("value")))
    at_high = F.max(F.when((F.col("first") <= high) & (F.col("last") >= high), F.col("value")))
    found = hits.groupBy("metric", "probability").agg(
        at_low.alias("low"), at_high.alias("high"),
        F.max(position - low).alias("part"),
    )
    return found.select(
        "metric", "probability",
        (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("quantile"),
    )


def describe(frame, columns):
    """Count, mean, deviation, extremes and quartiles, one row per column."""
    value = {c: S.nan_to_null(F.col(c).cast("double")) for c in columns}
    measures = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    wide_basics = frame.agg(*[
        F.struct(*[f(value[c]).alias(n) for n, f in measures.items()]).alias(c) for c in columns
    ])
    basics = wide_basics.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), *[F.col(f"{c}.{n}").alias(n) for n in measures])
        for c in columns
    ])))
    quartile = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    wide = exact_quantiles(frame, columns, tuple(quartile)).groupBy("metric").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n)
        for p, n in quartile.items()
    ])
    return basics.join(wide, "metric", "left").select(
        "metric", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
