"""Clustering of windows and labels for those far from their centroid."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.functions.scalars import euclidean, label_text, label_when, squared_distance_to
from tapewatch.operators.joins import with_own_centroid
from tapewatch.operators.quantiles import percentile_threshold
from tapewatch.schema import ANOMALY_QUANTILE, FEATURES, K_VALUES, LABELED, MIN_TRAINING_ROWS
from tapewatch.session import settle


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip")


def scaler(output: str = "scaled_features") -> StandardScaler:
    return StandardScaler(inputCol="raw_features", outputCol=output, withMean=True, withStd=True)


def prepare(df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit assembler and scaler once; the prepared rows are what every k is fitted on."""
    model = Pipeline(stages=[assembler(), scaler()]).fit(df)
    return model, model.transform(df)


def scale_params(df: DataFrame, features: Sequence[str] = FEATURES) -> tuple[list[float], list[float]]:
    """Mean and sample standard deviation of each feature: one pass, one row."""
    row = df.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                 *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    return [row[f"m_{f}"] for f in features], [row[f"s_{f}"] for f in features]


def scaled(feature: str, mean: float, std: float) -> Column:
    """Standardised feature; a feature without spread scales to 0."""
    return (F.col(feature) - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)


def standardise(df: DataFrame, features: Sequence[str] = FEATURES, prefix: str = "z_",
                params: tuple[Sequence[float], Sequence[float]] | None = None) -> DataFrame:
    mean, std = params or scale_params(df, features)
    return df.withColumns({f"{prefix}{f}": scaled(f, m, s) for f, m, s in zip(features, mean, std)})


def kmeans_fit(prepared: DataFrame, k: int, seed: int = 42, max_iter: int = 20) -> KMeansModel:
    return KMeans(featuresCol="scaled_features", predictionCol="prediction", k=k, seed=seed,
                  maxIter=max_iter).fit(prepared)


def silhouette_score(predictions: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance, from the evaluator."""
    return ClusteringEvaluator(featuresCol="scaled_features", predictionCol="prediction",
                               metricName="silhouette").evaluate(predictions)


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """The same score from per-cluster sums, so the cost is linear in rows: one row, one column.

    Two passes: k rows of sums (count, coordinate sums, squared norms), then the mean over points.
    """
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    sums = (df.groupBy(cluster)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(norm).alias("q"),
                 *[F.sum(c).alias(f"y_{c}") for c in columns])
            .orderBy(cluster).collect())  # one row per cluster

    def mean_distance(s) -> Column:
        dot = sum((F.col(c) * F.lit(s[f"y_{c}"]) for c in columns), F.lit(0.0))
        return norm + F.lit(s["q"] / s["n"]) - 2.0 * dot / F.lit(float(s["n"]))

    own, others = F.lit(None).cast("double"), []
    size = F.lit(None).cast("long")
    for s in sums:
        here = F.col(cluster) == s[cluster]
        n = s["n"]
        own = F.when(here, mean_distance(s) * F.lit(n / (n - 1) if n > 1 else 0.0)).otherwise(own)
        size = F.when(here, F.lit(n)).otherwise(size)
        others.append(F.when(~here, mean_distance(s)))
    nearest = F.array_min(F.array(*others)) if others else F.lit(None)
    scored = df.select(own.alias("a"), nearest.alias("b"), size.alias("n"))
    score = (F.when(F.col("n") == 1, 0.0)
             .when(F.col("a") < F.col("b"), 1.0 - F.col("a") / F.col("b"))
             .when(F.col("a") > F.col("b"), F.col("b") / F.col("a") - 1.0)
             .otherwise(0.0))
    return scored.agg(F.avg(score).alias("silhouette"))


@dataclass
class Choice:
    model: KMeansModel
    k: int
    score: float
    scores: dict[int, float]


def choose_k(prepared: DataFrame, ks: Sequence[int] = K_VALUES, seed: int = 42) -> Choice:
    """Fit every k, side by side, and keep the best silhouette; a tie keeps the smaller k."""
    @inheritable_thread_target(prepared.sparkSession)
    def attempt(k: int) -> tuple[KMeansModel, float]:
        model = kmeans_fit(prepared, k, seed)
        return model, silhouette_score(model.transform(prepared))

    order = sorted(ks)
    with ThreadPoolExecutor(len(order)) as pool:
        tried = dict(zip(order, pool.map(attempt, order)))
    scores = {k: s for k, (_, s) in tried.items()}
    best = max(order, key=lambda k: (scores[k], -k))
    return Choice(tried[best][0], best, scores[best], scores)


#: rows from which the seeds of a sweep are drawn
SEED_ROWS = 2_000


@dataclass
class Sweep:
    """Centres, cost (sum of squared distances), silhouette and number of Lloyd steps of each k, and the scans it took."""

    centres: dict[int, list[list[float]]]
    costs: dict[int, float]
    scores: dict[int, float]
    steps: dict[int, int]
    scans: int

    @property
    def best(self) -> int:
        return max(sorted(self.scores), key=lambda k: (self.scores[k], -k))


def _seed_rows(rows: DataFrame, columns: Sequence[str], seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    """A weighted sample that stands for all rows: half the chance is even, half goes by the squared distance to the mean,
    so the few rows far out, which cost the most, are in it. Two scans; ``SEED_ROWS`` rows come to the driver."""
    spread = sum((F.var_pop(c) for c in columns), F.lit(0.0))
    row = rows.agg(F.count(F.lit(1)).alias("n"), spread.alias("v"), *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)]).first()
    if not row["n"]:
        return None
    far = squared_distance_to(columns, [row[f"m_{i}"] for i in range(len(columns))])
    chance = F.lit(0.5 / row["n"]) + (far * F.lit(0.5 / (row["n"] * row["v"])) if row["v"] else F.lit(0.5 / row["n"]))
    sample = (rows.withColumn("_p", chance).withColumn("_key", -F.log(1.0 - F.rand(seed)) / F.col("_p"))
              .orderBy("_key").limit(SEED_ROWS + 1).collect())
    # a row is in when its key is below that of the first row left out; a sample of all rows weighs each once
    reach = sample.pop()["_key"] if len(sample) > SEED_ROWS else np.inf
    points = np.array([[r[c] for c in columns] for r in sample], float)
    return points, 1.0 / -np.expm1(-np.array([r["_p"] for r in sample]) * reach)


def _apart(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)


def _local_lloyd(points: np.ndarray, weights: np.ndarray, centres: np.ndarray, steps: int = 30) -> tuple[float, np.ndarray]:
    for _ in range(steps):
        nearest = _apart(points, centres).argmin(axis=1)
        centres = np.array([np.average(points[nearest == j], axis=0, weights=weights[nearest == j]) if (nearest == j).any() else centres[j]
                            for j in range(len(centres))])
    return float((_apart(points, centres).min(axis=1) * weights).sum()), centres


def _seeds(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator, tries: int = 16) -> np.ndarray:
    """Spread-out starting centres: each next one drawn by its squared distance to those before; the best of some tries."""
    found = []
    for _ in range(tries):
        centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < k:
            cost = _apart(points, centres).min(axis=1) * weights
            centres = np.vstack([centres, points[rng.choice(len(points), p=cost / cost.sum()) if cost.sum() > 0 else rng.integers(len(points))]])
        found.append(_local_lloyd(points, weights, centres))
    return min(found, key=lambda f: f[0])[1]


def sweep_k(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = K_VALUES, seed: int = 42, max_iter: int = 20,
            tol: float = 1e-4) -> Sweep | None:
    """K-Means for all k together: every scan takes one Lloyd step for each k that still moves.

    So a sweep scans the rows as often as its slowest k needs, not as often as all need in sum, twice before for the seeds
    and once more for the silhouettes of all. Rows with a null or NaN coordinate are left out; None when there is no other. Per scan a row per k
    and cluster comes to the driver. Settle ``df`` first when it is costly.
    """
    known = [F.col(c).isNotNull() & ~F.isnan(c) for c in columns]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).filter(reduce(lambda a, b: a & b, known))
    sample, rng = _seed_rows(rows, columns, seed), np.random.default_rng(seed)
    if sample is None:
        return None
    centres = {k: _seeds(*sample, k, rng).tolist() for k in sorted(ks)}
    active, steps, costs, scans = set(centres), dict.fromkeys(centres, 0), {}, 2
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))

    def assigned(k: int) -> Column:
        return F.array(*[squared_distance_to(columns, c) for c in centres[k]])

    sums: dict[int, dict] = {}
    while active:
        each = [F.struct(F.lit(k).alias("k"), assigned(k).alias("d")) for k in sorted(active)]
        placed = rows.select(*columns, norm.alias("_q"), F.explode(F.array(*[
            F.struct(e["k"].alias("k"), (F.array_position(e["d"], F.array_min(e["d"])) - 1).alias("j"), F.array_min(e["d"]).alias("d2"))
            for e in each])).alias("a"))
        found = placed.groupBy("a.k", "a.j").agg(F.count(F.lit(1)).alias("n"), F.sum("a.d2").alias("cost"), F.sum("_q").alias("q"),
                                                 *[F.sum(c).alias(f"y_{i}") for i, c in enumerate(columns)]).collect()
        scans += 1
        for k in sorted(active):
            mine = {r["j"]: r for r in found if r["k"] == k}
            costs[k] = sum(r["cost"] for r in mine.values())
            sums[k] = mine
            moved = [[mine[j][f"y_{i}"] / mine[j]["n"] for i in range(len(columns))] if j in mine else c for j, c in enumerate(centres[k])]
            far = max(sum((a - b) ** 2 for a, b in zip(x, y)) ** 0.5 for x, y in zip(centres[k], moved))
            if far <= tol or steps[k] >= max_iter:
                active.discard(k)  # costs and sums are those of the centres that stay
            else:
                centres[k], steps[k] = moved, steps[k] + 1
    return Sweep(centres, costs, _silhouettes(rows, columns, centres, sums), steps, scans + 1)


def _silhouettes(rows: DataFrame, columns: Sequence[str], centres: dict[int, list[list[float]]], sums: dict[int, dict]) -> dict[int, float]:
    """Mean silhouette (squared Euclidean) of every k in one scan, from the sums of each cluster."""
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    scores = []
    for k, mine in sums.items():
        def mean_distance(s) -> Column:
            dot = sum((F.col(c) * F.lit(s[f"y_{i}"]) for i, c in enumerate(columns)), F.lit(0.0))
            return norm + F.lit(s["q"] / s["n"]) - 2.0 * dot / F.lit(float(s["n"]))

        apart = F.array(*[squared_distance_to(columns, c) for c in centres[k]])
        home = F.array_position(apart, F.array_min(apart)) - 1
        own, size, others = F.lit(None).cast("double"), F.lit(None).cast("long"), []
        for j, s in mine.items():
            here = home == j
            own = F.when(here, mean_distance(s) * F.lit(s["n"] / (s["n"] - 1) if s["n"] > 1 else 0.0)).otherwise(own)
            size = F.when(here, F.lit(s["n"])).otherwise(size)
            others.append(F.when(~here, mean_distance(s)))
        nearest = F.array_min(F.array(*others))
        scores.append(F.avg(F.when(size == 1, 0.0).when(own < nearest, 1.0 - own / nearest)
                            .when(own > nearest, nearest / own - 1.0).otherwise(0.0)).alias(f"k{k}"))
    found = rows.agg(*scores).first()
    return {k: found[f"k{k}"] for k in sums}


def centroid_distance(df: DataFrame, centroids: Sequence[Sequence[float]], point: Column | str,
                      cluster: str = "prediction") -> DataFrame:
    """Adds the Euclidean distance of ``point`` (array) to the centroid of the row's cluster."""
    return (with_own_centroid(df, centroids, cluster)
            .withColumn("distance_to_centroid", euclidean(point, "centroid")).drop("centroid"))


def label_anomalies(df: DataFrame, q: float = ANOMALY_QUANTILE, exact: bool = True,
                    threshold: float | None = None) -> DataFrame:
    """Rows strictly beyond the q-th percentile of the distances are anomalous."""
    if threshold is None:
        threshold = percentile_threshold(df, "distance_to_centroid", q, exact)
    flag = label_when(F.col("distance_to_centroid") > F.lit(threshold), 1, 0)
    return df.withColumn("label_binary", flag).withColumn("label", label_text("label_binary"))


@dataclass(frozen=True)
class Readiness:
    rows: int
    positives: int
    trainable: bool
    has_both_classes: bool


def check_trainable(df: DataFrame, label: str | None = None, features: Sequence[str] = FEATURES,
                    min_rows: int = MIN_TRAINING_ROWS) -> Readiness:
    """Enough complete rows, and both classes present? One aggregate."""
    clean = df.dropna(subset=[*features, *([label] if label else [])])
    positives = F.count_if(F.col(label) == 1) if label else F.lit(0)
    rows, hits = clean.agg(F.count(F.lit(1)), positives).first()
    return Readiness(rows, hits, rows >= min_rows, 0 < hits < rows)


def cluster_and_label(features: DataFrame, ks: Sequence[int] = K_VALUES, q: float = ANOMALY_QUANTILE,
                      exact: bool = True, seed: int = 42) -> tuple[DataFrame, Choice] | None:
    """Feature table to labelled table, or None with fewer than 20 complete rows.

    Features and distances are settled, because every later step reads them again; the prepared
    vectors are cached over the sweep of k and released whatever happens.
    """
    clean = settle(features.dropna(subset=FEATURES), "features")
    if not check_trainable(clean).trainable:
        return None
    _, prepared = prepare(clean)
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        choice = choose_k(prepared, ks, seed)
        centroids = [list(map(float, c)) for c in choice.model.clusterCenters()]
        assigned = choice.model.transform(prepared)
        distances = centroid_distance(assigned, centroids, vector_to_array("scaled_features"))
        settled = settle(distances.drop("raw_features", "scaled_features"), "distances")
    finally:
        prepared.unpersist()
    return label_anomalies(settled, q, exact).select(*LABELED), choice
