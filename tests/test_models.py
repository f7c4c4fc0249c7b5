"""Invariants of the fitted models; centroid values themselves are not compared."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tapewatch.functions.scalars import unpack_vector
from tapewatch.operators import classify, cluster
from tapewatch.plans.catalog.base import features
from tapewatch.plans.flow import window_keys
from tapewatch.schema import FEATURES, LABELED
from tapewatch.session import settle

Z = [f"z_{f}" for f in FEATURES]


@pytest.fixture(scope="module")
def windows(spark, sf):
    return settle(features(spark, sf))


@pytest.fixture(scope="module")
def prepared(windows):
    return cluster.prepare(windows)[1].cache()


@pytest.fixture(scope="module")
def labeled(windows):
    return settle(cluster.cluster_and_label(windows)[0])


def test_choice_has_the_best_score(prepared):
    choice = cluster.choose_k(prepared)
    assert set(choice.scores) == {3, 4, 5}
    assert choice.score == max(choice.scores.values()) and len(choice.model.clusterCenters()) == choice.k


def test_same_seed_same_result(prepared):
    a, b = (cluster.kmeans_fit(prepared, 3) for _ in range(2))
    assert [list(c) for c in a.clusterCenters()] == [list(c) for c in b.clusterCenters()]


def test_silhouette_equals_the_evaluator(prepared):
    assigned = cluster.kmeans_fit(prepared, 4).transform(prepared)
    wide = unpack_vector(assigned.select("prediction", "scaled_features"), "scaled_features", Z)
    assert cluster.silhouette(wide, Z).first()[0] == pytest.approx(cluster.silhouette_score(assigned), abs=1e-9)


def test_distance_is_to_the_own_and_nearest_centroid(prepared):
    model = cluster.kmeans_fit(prepared, 3)
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    point = vector_to_array("scaled_features")
    out = cluster.centroid_distance(model.transform(prepared), centers, point).withColumn("p", point)
    for r in out.limit(50).collect():
        all_distances = [sum((a - b) ** 2 for a, b in zip(r.p, c)) ** 0.5 for c in centers]
        assert r.distance_to_centroid == pytest.approx(min(all_distances))
        assert r.distance_to_centroid == pytest.approx(all_distances[r.prediction])


def test_labels(labeled):
    assert labeled.columns == LABELED
    edge = labeled.agg(F.percentile("distance_to_centroid", 0.95)).first()[0]
    wrong = labeled.filter((F.col("distance_to_centroid") > edge) != (F.col("label") == "anomalo"))
    assert wrong.count() == 0
    assert labeled.filter((F.col("label") == "anomalo") != (F.col("label_binary") == 1)).count() == 0


def test_approximate_threshold_is_close(labeled):
    n = labeled.count()
    out = cluster.label_anomalies(labeled.drop("label", "label_binary"), exact=False)
    assert abs(out.filter("label_binary = 1").count() - 0.05 * n) <= 0.01 * n + 1


def test_split_is_a_partition_and_ignores_partitioning(labeled):
    train, test = classify.split(labeled, window_keys())
    assert train.count() + test.count() == labeled.count()
    again, _ = classify.split(labeled.repartition(3), window_keys())
    assert train.select("symbol", "window_start").exceptAll(again.select("symbol", "window_start")).count() == 0
    a, b = classify.random_split(labeled)
    assert a.count() + b.count() == labeled.count()


def test_metrics_equal_the_evaluators(labeled):
    rows = labeled.withColumnRenamed("prediction", "kmeans_cluster")
    model = classify.lr_fit(rows)
    scored = settle(model.transform(rows))
    want = classify.evaluator_metrics(scored)
    got = classify.classification_metrics(scored).first()
    for name in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1"):
        assert got[name] == pytest.approx(want[name], abs=1e-9)
    # rank by the raw margin, as the evaluator does
    margin = scored.withColumn("margin", vector_to_array("rawPrediction")[1])
    assert classify.auc_roc(margin, "margin").first()[0] == pytest.approx(want["auc_roc"], abs=1e-9)
    sums = scored.select((vector_to_array("probability")[0] + vector_to_array("probability")[1]).alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_parameters_round_trip(spark, labeled, tmp_path):
    model = classify.lr_fit(labeled.drop("prediction"))
    classify.save_model(model, str(tmp_path / "m"))
    assert classify.params_of(classify.load_model(str(tmp_path / "m"))) == classify.params_of(model)
    table = classify.model_params(spark, model).first()
    assert table.feature_cols == FEATURES and len(table.coefficients) == 4
    report = classify.coefficients(spark, model).collect()
    assert report[-1].feature == "intercept"
    assert abs(report[0].coefficient) >= abs(report[1].coefficient)


def test_training_without_anomalies_still_fits(labeled):
    model = classify.lr_fit(labeled.drop("prediction").withColumn("label_binary", F.lit(0)))
    assert classify.score(labeled.drop("prediction"), model).filter("prediction = 1").count() == 0


def blobs(spark, n=900):
    import random
    rnd = random.Random(8)
    rows = [(rnd.gauss(10 * (i % 3), 1), rnd.gauss(-5 * (i % 3), 1)) for i in range(n)]
    return spark.createDataFrame(rows, "x double, y double")


def test_sweep_equals_the_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from tapewatch.operators.cluster import kmeans_fit, silhouette_score, sweep_k
    df = blobs(spark).cache()
    found = sweep_k(df, ["x", "y"], (2, 3, 4, 6))
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="scaled_features").transform(df)
    assert found.best == 3 and found.scans == max(found.steps.values()) + 4
    assert set(found.steps) == {2, 3, 4, 6}
    for k in found.costs:
        model = kmeans_fit(vectors, k)
        assert found.costs[k] <= 1.01 * model.summary.trainingCost
    model = kmeans_fit(vectors, 3)
    assert found.costs[3] == pytest.approx(model.summary.trainingCost, rel=1e-3)
    assert found.scores[3] == pytest.approx(silhouette_score(model.transform(vectors)), rel=1e-6)
    assert sorted(found.centres[3]) == [pytest.approx(sorted(c.tolist() for c in model.clusterCenters())[i], abs=1e-3) for i in range(3)]


def test_sweep_edges(spark):
    from tapewatch.operators.cluster import sweep_k
    assert sweep_k(spark.createDataFrame([], "x double"), ["x"]) is None
    assert sweep_k(spark.createDataFrame([(None,), (float("nan"),)], "x double"), ["x"]) is None
    # fewer different rows than clusters, and a row that is left out
    same = sweep_k(spark.createDataFrame([(1.0,), (1.0,), (5.0,), (None,)], "x double"), ["x"], (1, 2, 4))
    assert same.costs[1] == pytest.approx(32 / 3) and same.costs[2] == same.costs[4] == 0
    assert same.scores[1] == 0 and same.scores[2] == pytest.approx(2 / 3)
