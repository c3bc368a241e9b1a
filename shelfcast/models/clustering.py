"""K-Means over SKU behaviour: every number of clusters and every start fitted together.

The models of all k and starts move in step. A pass over the points takes their distances to the
centres of all models at once (one matrix product a batch) and sends sums by model and cluster,
whose number does not depend on the points; Spark adds them up and the driver moves the centres.
Starting centres come from k-means||: a few passes draw candidates far from the ones before, in
proportion to their squared distance, and k of a start's weighted candidates are chosen on the
driver. One more pass gives the silhouettes of the best start of each k.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import constants as K
from shelfcast.session import cut_lineage

MODEL = "k int, silhouette double, mean array<double>, deviation array<double>, centres array<array<double>>"
#: Passes that draw candidates, passes that move centres at most, and the squared move that counts as rest.
DRAWS, MOST_MOVES, REST = 2, 20, 1e-8


@dataclass
class ClusterModel:
    mean: np.ndarray
    deviation: np.ndarray
    centres: np.ndarray
    k: int
    silhouette: float

    def scaled(self):
        """Array of standardised features as one expression."""
        return F.array(*[
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - float(m)) / float(s)
            for c, m, s in zip(K.CLUSTER_FEATURES, self.mean, self.deviation)
        ])

    def gaps(self, scaled):
        """Squared distance to every centre."""
        return [
            sum(((F.get(scaled, F.lit(i)) - float(x)) * (F.get(scaled, F.lit(i)) - float(x)) for i, x in enumerate(c)), F.lit(0.0))
            for c in self.centres
        ]

    def labels(self, features):
        """Cluster per SKU: the nearest centre, the first of equals."""
        gaps = self.gaps(F.col("_x"))
        nearest = F.array_position(F.array(*gaps), F.least(*gaps)) - 1
        return features.select("sku", self.scaled().alias("_x")).select("sku", nearest.cast("int").alias("cluster"))

    def save(self, spark, path):
        row = (self.k, float(self.silhouette), *(a.tolist() for a in (self.mean, self.deviation, self.centres)))
        spark.createDataFrame([row], MODEL).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path):
        row = spark.read.parquet(path).first()
        return ClusterModel(*(np.array(row[c]) for c in ("mean", "deviation", "centres")), row["k"], row["silhouette"])


def _mixed(h, *salts):
    """Uniform numbers in (0, 1) from 64-bit hashes, other ones for other salts."""
    h = h.astype(np.uint64)
    for salt in salts:
        h = h + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2**53


def _points(batch):
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _squared(x, centres):
    """Squared distances of points to centres, never below zero."""
    gaps = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    return np.maximum(gaps, 0.0)


def _added(points, parts):
    """Sums over all points of the number arrays that `parts(x)` gives for a batch."""

    def run(batches):
        total = 0
        for batch in batches:
            total = total + parts(_points(batch))
        if not isinstance(total, int):
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "value"])

    table = points.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(table.num_rows)
    out[table.column("cell").to_numpy()] = table.column("value").to_numpy()
    return out


def _assigned_sums(x, centres):
    """Per cluster: points, sum of squared distances, sum of squared lengths, sums of coordinates."""
    gaps = _squared(x, centres)
    nearest = gaps.argmin(axis=1)
    owner = np.zeros((len(centres), len(x)))
    owner[nearest, np.arange(len(x))] = 1
    facts = np.column_stack([np.ones(len(x)), gaps[np.arange(len(x)), nearest], (x * x).sum(axis=1), x])
    return owner @ facts


def _sums_of_all(points, models):
    """One array of cluster sums for each model, from one pass."""
    found = _added(points, lambda x: np.concatenate([_assigned_sums(x, c) for c in models]))
    return np.split(found.reshape(sum(map(len, models)), -1), np.cumsum([len(c) for c in models])[:-1])


def _candidates(points, starts, most, seed):
    """Candidate centres of every start by k-means||, and how many points are nearest to each."""
    found = [np.zeros((0, 0))] * starts
    for turn in range(DRAWS + 1):
        wanted, before = (1 if turn == 0 else 2 * most), list(found)

        def run(batches):
            for batch in batches:
                x, h = _points(batch), batch.column("h").to_numpy()
                for start, own in enumerate(before):
                    far = _squared(x, own).min(axis=1) if len(own) else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        key = -np.log(_mixed(h, seed, start, turn)) / far
                    near = np.flatnonzero(far > 1e-12)
                    near = near[np.argsort(key[near], kind="stable")[:wanted]]
                    if len(near):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([start] * len(near), pa.int32()), pa.array(key[near]), pa.array(x[near].tolist())],
                            names=["start", "key", "x"],
                        )

        drawn = points.mapInArrow(run, "start int, key double, x array<double>")
        turn_of = F.row_number().over(Window.partitionBy("start").orderBy("key", "x"))
        for row in drawn.withColumn("n", turn_of).filter(F.col("n") <= wanted).orderBy("start", "n").collect():
            own = found[row["start"]]
            found[row["start"]] = np.array([*own, row["x"]]) if len(own) else np.array([row["x"]])
    return found, [sums[:, 0] for sums in _sums_of_all(points, found)]


def _chosen(candidates, weights, k, random):
    """k of the weighted candidates, each drawn in proportion to its squared distance from those before."""
    far = np.ones(len(candidates))
    picked = []
    for _ in range(min(k, len(candidates))):
        share = weights * far
        share = share if share.sum() > 0 else np.ones(len(candidates))
        picked.append(random.choice(len(candidates), p=share / share.sum()))
        far = _squared(candidates, candidates[picked]).min(axis=1)
    return candidates[picked]


def lloyd(points, models):
    """(centres, cost) of every model once its centres rest, all moved in the same passes."""
    models, costs, moving = [m.copy() for m in models], [0.0] * len(models), list(range(len(models)))
    for _ in range(MOST_MOVES):
        moved = []
        for i, sums in zip(moving, _sums_of_all(points, [models[i] for i in moving])):
            n, costs[i] = sums[:, :1], float(sums[:, 1].sum())
            new = np.where(n > 0, sums[:, 3:] / np.maximum(n, 1), models[i])
            if ((new - models[i]) ** 2).sum(axis=1).max() > REST:
                moved.append(i)
            models[i] = new
        moving = moved
        if not moving:
            break
    return models, costs


def _silhouettes(points, models, sums):
    """Mean silhouette of squared distances of every model, from the sums of its clusters.

    The mean squared distance of a point to a cluster follows from the cluster's size, its sum of
    squared lengths and its sum of coordinates, so no pair of points is looked at.
    """

    def parts(x):
        out = []
        for centres, own in zip(models, sums):
            n = own[:, 0]
            nearest = _squared(x, centres).argmin(axis=1)
            lengths = (x * x).sum(axis=1)[:, None]
            total = np.maximum(n * lengths + own[:, 2] - 2 * x @ own[:, 3:].T, 0.0)
            rows = np.arange(len(x))
            inside = total[rows, nearest] / np.maximum(n[nearest] - 1, 1)
            others = np.where(n > 0, total / np.maximum(n, 1), np.inf)
            others[rows, nearest] = np.inf
            outside, alone = others.min(axis=1), n[nearest] <= 1
            larger = np.maximum(inside, outside)
            out.append(np.where(alone | (larger == 0), 0.0, (outside - inside) / np.where(larger == 0, 1, larger)).sum())
        return np.array(out)

    return _added(points, parts)


def fit_clustering(features, starts=K.KMEANS_STARTS, k_range=K.K_RANGE, seed=42):
    """Best of several starts per k, then the k with the best silhouette.

    The silhouette uses squared distances and needs one pass; the plain-distance version would
    compare all pairs of SKUs. A missing feature counts as 0.
    """
    raw = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in K.CLUSTER_FEATURES]
    facts = [F.count(F.lit(1)), *[f(c) for c in raw for f in (F.avg, F.stddev_samp)]]
    written = cut_lineage(features.select("sku", *[c.alias(n) for c, n in zip(raw, K.CLUSTER_FEATURES)]))
    count, *found = written.agg(*facts).first()
    if count < k_range[0] + 1:
        raise ValueError(f"need at least {k_range[0] + 1} SKUs to cluster, got {count}")
    mean, deviation = np.array(found[0::2], dtype=float), np.array(found[1::2], dtype=float)
    scaling = ClusterModel(mean, np.where(deviation > 0, deviation, 1.0), np.zeros((0, 0)), 0, 0.0)
    points = cut_lineage(written.select(F.xxhash64("sku").alias("h"), scaling.scaled().alias("x"))).persist()
    sizes = range(k_range[0], min(k_range[1], count - 1) + 1)
    candidates, weights = _candidates(points, starts, max(sizes), seed)
    plan = [(k, start) for k in sizes for start in range(starts)]
    models, costs = lloyd(points, [
        _chosen(candidates[s], weights[s], k, np.random.default_rng((seed, s, k))) for k, s in plan
    ])
    best = {}
    for (k, _), centres, cost in zip(plan, models, costs):
        if k not in best or cost < best[k][0]:
            best[k] = cost, centres
    chosen = [best[k][1] for k in sizes]
    sums = _sums_of_all(points, chosen)
    scores = _silhouettes(points, chosen, sums)
    points.unpersist()
    usable = [(score, -k, c) for score, k, c, own in zip(scores, sizes, chosen, sums) if 2 <= (own[:, 0] > 0).sum() < count]
    if not usable:
        raise RuntimeError("no number of clusters gave a usable partition")
    score, k, centres = max(usable, key=lambda u: u[:2])
    return ClusterModel(scaling.mean, scaling.deviation, centres, -k, float(score))
