"""Choice between model kinds and between challenger and incumbent."""

from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.functions import scalars as S


def choose_model(boosted, linear, *keys):
    """Winner per key from two metric frames, with the reason.

    The boosted model must lower MAPE by at least 5 %, else ridge wins.
    """
    pair = boosted.select(*keys, F.col("mape").alias("gbr_mape")).join(
        linear.select(*keys, F.col("mape").alias("ridge_mape")), list(keys)
    )
    gain = F.when(
        F.col("ridge_mape") > 0,
        F.try_divide(F.col("ridge_mape") - F.col("gbr_mape"), F.col("ridge_mape")) * 100.0,
    ).otherwise(0.0)
    small = F.col("improvement_pct") < K.MODEL_CHOICE_TOLERANCE
    text = S.fixed_text("improvement_pct", 2)
    kept = F.concat(F.lit("GBR improved MAPE by only "), text,
                    F.lit(f"% (< {K.MODEL_CHOICE_TOLERANCE}%). Simpler Ridge baseline wins."))
    won = F.concat(F.lit("GBR improved MAPE by "), text,
                   F.lit("% over Ridge — primary model retained."))
    return pair.withColumn("improvement_pct", gain).withColumns({
        "winner": F.when(small, "ridge").otherwise("gbr"),
        "rationale": F.when(small, kept).otherwise(won),
    })


def promotion_decision(candidate="mape", incumbent="incumbent_mape", known="has_incumbent"):
    """Decision for a challenger: equality at 1.05 times the incumbent still promotes.

    A missing metric counts as infinite; without an incumbent there is nothing to beat.
    """
    worst = F.lit(float("inf"))
    new, old = F.coalesce(F.col(candidate), worst), F.coalesce(F.col(incumbent), worst)
    return (
        F.when(~F.coalesce(F.col(known), F.lit(False)), "no_incumbent")
        .when(new > old * K.INCUMBENT_TOLERANCE, "rejected").otherwise("promoted")
    )


def compare_to_incumbent(candidates, incumbents, key="category"):
    """Candidates with the incumbent's MAPE and version and the decision."""
    old = incumbents.select(
        key, F.col("mape").alias("incumbent_mape"),
        F.col("version").alias("incumbent_version"), F.lit(True).alias("has_incumbent"),
    )
    joined = candidates.join(old, key, "left")
    return joined.withColumn("decision", promotion_decision()).drop("has_incumbent")
