"""Demand behaviour per SKU, the input of clustering, and reports on given clusters."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S
from shelfcast.operators.quantiles import exact_quantiles
from shelfcast.operators.analytics import promo_means


def trend_slope(weekly):
    """Least-squares slope of units against the SKU's row number.

    The window is one SKU: channels x regions x weeks rows at most.
    """
    order = Window.partitionBy("sku").orderBy("week", "channel", "region")
    numbered = weekly.select(
        "sku", "units_sold", (F.row_number().over(order) - 1).cast("double").alias("position")
    )
    return numbered.groupBy("sku").agg(
        F.coalesce(F.regr_slope("units_sold", "position"), F.lit(0.0)).alias("trend_slope")
    )


def promo_sensitivity(weekly):
    """Promotion mean over base mean; 1 when a side is missing or the base is zero."""
    promo, base = F.col("promo_avg"), F.col("non_promo_avg")
    ratio = F.when(promo.isNull() | base.isNull(), 1.0).otherwise(S.safe_divide(promo, base, 1.0))
    return promo_means(weekly, "sku").select("sku", ratio.alias("promo_sensitivity"))


def seasonality_strength(weekly):
    monthly = weekly.groupBy("sku", "month").agg(F.avg("units_sold").alias("m"))
    ratio = F.coalesce(F.try_divide(F.max("m"), F.min("m")), F.lit(1.0))
    return monthly.groupBy("sku").agg(ratio.alias("seasonality_strength"))


def sku_features(weekly):
    """Seven behaviour features per SKU; missing values become 0."""
    basics = weekly.groupBy("sku").agg(
        F.avg("units_sold").alias("avg_weekly_demand"),
        F.stddev_samp("units_sold").alias("_std"),
        F.avg("price_unit").alias("_price"),
        S.encode(F.mode("lifecycle_stage", True), K.LIFECYCLE_CODE).alias(
            "lifecycle_stage_encoded"),
    )
    top_price = basics.agg(F.max("_price")).scalar()
    ceiling = F.when(top_price != 0, top_price).otherwise(1.0)
    joined = (
        basics.join(seasonality_strength(weekly), "sku").join(trend_slope(weekly), "sku")
        .join(promo_sensitivity(weekly), "sku")
    )
    return joined.select(
        "sku", "avg_weekly_demand",
        S.safe_divide("_std", "avg_weekly_demand").alias("demand_coefficient_of_variation"),
        "seasonality_strength", "trend_slope", "promo_sensitivity", "lifecycle_stage_encoded",
        F.try_divide("_price", ceiling).alias("price_point_normalized"),
    ).fillna(0.0)


def label_clusters(features, labels):
    """Readable label per cluster from the means of its SKUs."""
    limits = K.CLUSTER_LIMITS
    steady, seasonal, promo, niche, middle = K.CLUSTER_LABELS
    median = exact_quantiles(features, ("avg_weekly_demand",), (0.5,)).select("quantile").scalar()
    means = features.join(labels, "sku").groupBy("cluster").agg(*[
        F.avg(c).alias(c) for c in K.CLUSTER_FEATURES
    ])
    big = F.col("avg_weekly_demand") > median
    even = F.col("demand_coefficient_of_variation") < limits["cv"]
    label = (
        F.when(big & even, steady)
        .when(F.col("seasonality_strength") > limits["seasonality"], seasonal)
        .when(F.col("promo_sensitivity") > limits["promo"], promo)
        .when(F.col("lifecycle_stage_encoded") < limits["lifecycle"], niche)
        .otherwise(middle)
    )
    return means.select("cluster", label.alias("cluster_description"))


def similar_skus(labels, descriptions, sku):
    """Cluster of one SKU and the other SKUs in it, one row each; raises when unknown."""
    own = labels.filter(F.col("sku") == sku).select("cluster")
    if own.isEmpty():
        raise KeyError(f"sku {sku!r} has no cluster")
    return (
        labels.join(own, "cluster").filter(F.col("sku") != sku)
        .join(descriptions, "cluster", "left")
        .select(
            F.lit(sku).alias("sku"),
            F.concat(F.lit("cluster_"), F.col("cluster").cast("string")).alias("cluster_label"),
            F.coalesce("cluster_description", F.lit("Unlabeled")).alias("cluster_description"),
            F.col("sku").alias("similar_sku"),
        )
    )


def _named(clusters, descriptions):
    """Label and description of every cluster of a frame, instead of its number."""
    described = clusters.join(descriptions, "cluster", "left")
    return described.withColumns({
        "cluster_label": F.concat(F.lit("cluster_"), F.col("cluster").cast("string")),
        "cluster_description": F.coalesce("cluster_description", F.lit("Unlabeled")),
    }).drop("cluster")


def cluster_members(labels, descriptions):
    """One row per member, in the order of label and SKU; no cluster gathers in one row or task."""
    return _named(labels.select("cluster", "sku"), descriptions).select(
        "cluster_label", "cluster_description", "sku"
    ).orderBy("cluster_label", "sku")


def cluster_summaries(weekly, labels, descriptions):
    """Members in order, their number and the mean units over the members' rows, per cluster.

    Rows are summed per SKU before the labels join, so no cluster's rows gather. Its SKUs do, as the
    result has them in one list: at most the 676,000 codes of two letters and three digits.
    """
    per_sku = weekly.groupBy("sku").agg(
        F.sum("units_sold").alias("_units"), F.count("units_sold").alias("_rows")
    )
    grouped = labels.join(per_sku, "sku", "left").groupBy("cluster").agg(
        F.count("sku").alias("sku_count"),
        F.array_sort(F.collect_list("sku")).alias("members"),
        F.coalesce(F.try_divide(F.sum("_units"), F.sum("_rows")), F.lit(0.0)).alias("avg_weekly_demand"),
    )
    return _named(grouped, descriptions).select(
        "cluster_label", "cluster_description", "sku_count", "members", "avg_weekly_demand"
    ).orderBy("cluster_label")
