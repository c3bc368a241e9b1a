"""Model catalog: saved models with numbered versions and a card per version."""

import re
from datetime import datetime, timezone

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.models.boosting import BoostedForecaster, LinearForecaster
from shelfcast.models.clustering import ClusterModel
from shelfcast.schemas import MODEL_CARD


def checked_name(name):
    if not re.fullmatch(K.MODEL_NAME_PATTERN, name):
        raise ValueError(f"invalid model name: {name!r}")
    return name


class ModelCatalog:
    """Models below a shared folder; cards are appended JSON rows, one per version."""

    def __init__(self, spark, root):
        self.spark = spark
        self.root = root

    def cards(self):
        try:
            return self.spark.read.schema(MODEL_CARD).json(f"{self.root}/cards")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MODEL_CARD)

    def list_models(self, name=None):
        """Cards by name and number, so version 10 follows version 9."""
        cards = self.cards()
        if name is not None:
            cards = cards.filter(F.col("name") == name)
        return cards.orderBy("name", "version")

    def latest(self):
        """The newest card of every name."""
        newest = F.max_by(F.struct(*MODEL_CARD.names), "version").alias("card")
        return self.cards().groupBy("name").agg(newest).select("card.*")

    def latest_baselines(self):
        """Feature baselines of the newest version per category, in long form."""
        return self.latest().select(
            "category", F.explode("feature_baselines").alias("feature", "b")
        ).select("category", "feature", "b.mean", "b.std")

    def incumbents(self):
        """Newest version and MAPE per category, walk-forward metrics only.

        In-sample metrics of other versions are not comparable and are left out.
        """
        cards = self.cards().filter(F.col("metric_kind") == "walk_forward")
        newest = F.max_by(F.struct("name", "version", "metrics"), "version").alias("card")
        return cards.dropna(subset=["category"]).groupBy("category").agg(newest).select(
            "category", F.concat(F.col("card.name"), F.lit("_v"),
                                 F.col("card.version").cast("string")).alias("version"),
            F.try_element_at("card.metrics", F.lit("mape")).alias("mape"),
        )

    def get(self, name, version="latest"):
        """Card of one version: "latest", a number, or a number as text."""
        found = self.list_models(checked_name(name))
        if version != "latest":
            found = found.filter(F.col("version") == int(version))
        rows = found.orderBy(F.col("version").desc()).limit(1).collect()
        if not rows:
            raise FileNotFoundError(f"model {name!r} version {version} not found")
        return rows[0]

    def save(self, save_to, name, kind, metrics, features, training_rows=0, category=None,
             baselines=None, metric_kind="in_sample"):
        """Writes the model through `save_to(path)`, then its card; returns the version."""
        checked_name(name)
        newest = self.list_models(name).agg(F.max("version")).first()[0] or 0
        version, stamp = newest + 1, datetime.now(timezone.utc).strftime("%Y%m%d-%H%M%S")
        path = f"{self.root}/models/{name}_v{version}_{stamp}"
        save_to(path)
        card = {
            "name": name, "version": version, "kind": kind, "path": path,
            "metrics": {k: float(v) for k, v in metrics.items()}, "metric_kind": metric_kind,
            "features": list(features), "training_rows": int(training_rows),
            "category": category, "created_at": stamp,
            "feature_baselines": dict(baselines or {}),
        }
        row = self.spark.createDataFrame([tuple(card[c] for c in MODEL_CARD.names)], MODEL_CARD)
        row.coalesce(1).write.mode("append").json(f"{self.root}/cards")
        return version

    def save_ridge(self, model, name, **card):
        """A ridge model is its coefficient table."""
        return self.save(lambda path: model.coalesce(1).write.parquet(path), name, "ridge", **card)

    def save_boosted(self, forecaster, name, **card):
        return self.save(lambda path: forecaster.save(self.spark, path), name, "gbr", **card)

    def save_clusters(self, model, name="clusterer", **card):
        return self.save(lambda path: model.save(self.spark, path), name, "clusters", **card)

    def load(self, card):
        """The model behind a card: coefficient table, forecaster or clusters."""
        if card["kind"] == "ridge":
            return self.spark.read.parquet(card["path"])
        if card["kind"] == "clusters":
            return ClusterModel.load(self.spark, card["path"])
        return BoostedForecaster.load(self.spark, card["path"])

    def forecasters(self):
        """{category: (forecaster, version)} with the newest model of every category.

        A handful of models, each of a size that does not depend on the rows it was fitted on.
        """
        cards = self.cards().filter("kind in ('ridge', 'gbr') and category is not null")
        newest = cards.groupBy("category").agg(F.max_by(F.struct(*MODEL_CARD.names), F.struct("version", "created_at")).alias("card"))
        found = {}
        for card in newest.select("card.*").collect():
            model = self.load(card)
            if card["kind"] == "ridge":
                row = model.first()
                model = LinearForecaster(
                    tuple(card["features"]), row["intercept"], np.array(row["coefficients"]),
                    row["residual_std"], card["training_rows"],
                )
            found[card["category"]] = model, f"{card['name']}_v{card['version']}"
        return found


def baselines_by_category(long_baselines):
    """{category: {feature: (mean, std)}} from a long frame of a few dozen rows."""
    result = {}
    for row in long_baselines.collect():
        result.setdefault(row["category"], {})[row["feature"]] = (row["mean"], row["std"])
    return result
