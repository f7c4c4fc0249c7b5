"""Anomaly labels and classifier, with given parameters (SQL-comparable) and fitted ones."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tapewatch.functions.scalars import unpack_vector
from tapewatch.operators import classify, cluster
from tapewatch.operators.joins import assign_nearest, with_own_centroid
from tapewatch.operators.summaries import confusion, group_count
from tapewatch.plans.catalog.base import EVENT_FEATURES, FEATURE_COLUMNS, features, query, r
from tapewatch.plans.flow import window_keys
from tapewatch.schema import FEATURES, PUBLISHED_COEFFICIENTS, PUBLISHED_INTERCEPT
from tapewatch.session import fresh_path, settle

# Query parameters: three centroids in scaled space.
CENTROIDS = [[0.0, -0.5, -0.5, -0.5], [0.2, 0.8, 0.3, 0.8], [-0.3, -1.0, 1.5, -1.0]]
Z = [f"z_{f}" for f in FEATURES]


def windows_once(spark, sf):
    """Features settled: scaling, thresholds and labels each read them."""
    return settle(features(spark, sf), "features")


def assigned(spark, sf):
    return assign_nearest(cluster.standardise(windows_once(spark, sf)), Z, CENTROIDS)


def labeled(spark, sf):
    return cluster.label_anomalies(assigned(spark, sf))


def scored(spark, sf):
    """Published weights on scaling taken from the data."""
    windows = windows_once(spark, sf)
    mean, std = cluster.scale_params(windows)
    params = classify.ModelParams(mean, std, PUBLISHED_COEFFICIENTS, PUBLISHED_INTERCEPT)
    return classify.score_with_params(windows, params)


def rated(spark, sf):
    """Published-weight predictions beside the distance labels of the same windows."""
    base = labeled(spark, sf).drop("prediction", "label")
    mean, std = cluster.scale_params(base)
    params = classify.ModelParams(mean, std, PUBLISHED_COEFFICIENTS, PUBLISHED_INTERCEPT)
    return classify.score_with_params(base, params)


_SCALING = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)
_Z = ", ".join(f"({f} - m_{f}) / s_{f} AS z_{f}" for f in FEATURES)


def _d2(centroid: list[float]) -> str:
    return " + ".join(f"(z_{f} - ({c})::DOUBLE) * (z_{f} - ({c})::DOUBLE)" for f, c in zip(FEATURES, centroid))


SCALED_SQL = f"""{EVENT_FEATURES}, scaling AS (SELECT {_SCALING} FROM feats),
scaled AS (SELECT feats.*, {_Z} FROM feats CROSS JOIN scaling)"""
ASSIGNED_SQL = f"""{SCALED_SQL},
distances AS (SELECT *, {_d2(CENTROIDS[0])} AS d0, {_d2(CENTROIDS[1])} AS d1, {_d2(CENTROIDS[2])} AS d2 FROM scaled),
assigned AS (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS prediction,
  sqrt(least(d0, d1, d2)) AS distance_to_centroid FROM distances)"""
LABELED_SQL = f"""{ASSIGNED_SQL},
labeled AS (SELECT *, CASE WHEN distance_to_centroid > (SELECT quantile_cont(distance_to_centroid, 0.95) FROM assigned)
                      THEN 1 ELSE 0 END AS label_binary,
  CASE WHEN distance_to_centroid > (SELECT quantile_cont(distance_to_centroid, 0.95) FROM assigned)
       THEN 'anomalo' ELSE 'normal' END AS label FROM assigned)"""
_LOGIT = f"({PUBLISHED_INTERCEPT})::DOUBLE" + "".join(
    f" + ({c})::DOUBLE * z_{f}" for f, c in zip(FEATURES, PUBLISHED_COEFFICIENTS))


def _scored_sql(source: str) -> str:
    return f"""logits AS (SELECT *, {_LOGIT} AS logit FROM {source}),
probs AS (SELECT *, CASE WHEN logit >= 0 THEN 1 / (1 + exp(-logit)) ELSE exp(logit) / (1 + exp(logit)) END
          AS probability FROM logits),
scored AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN probability >= 0.5 THEN 'anomalo' ELSE 'normal' END AS label FROM probs)"""


SCORED_SQL = f"{SCALED_SQL}, {_scored_sql('scaled')}"
RATED_SQL = (f"{LABELED_SQL}, plain AS (SELECT * EXCLUDE (prediction, label) FROM labeled), "
             f"{_scored_sql('plain')}")


@query("standardise", f"WITH {SCALED_SQL} SELECT symbol, window_start, {r(*Z)} FROM scaled")
def _(spark, sf):
    return cluster.standardise(windows_once(spark, sf)).select("symbol", "window_start", *Z)


@query("assembled_vectors", f"WITH {EVENT_FEATURES} SELECT symbol, window_start, {FEATURE_COLUMNS} FROM feats")
def _(spark, sf):
    vectors = cluster.assembler().transform(features(spark, sf)).select("symbol", "window_start", "raw_features")
    return unpack_vector(vectors, "raw_features", FEATURES)


@query("prepared_vectors", f"WITH {SCALED_SQL} SELECT symbol, window_start, {r(*Z)} FROM scaled")
def _(spark, sf):
    _, prepared = cluster.prepare(windows_once(spark, sf))
    return unpack_vector(prepared.select("symbol", "window_start", "scaled_features"), "scaled_features", Z)


@query("assign_nearest", f"""WITH {ASSIGNED_SQL} SELECT symbol, window_start, prediction,
  round(distance_to_centroid, 6) AS distance_to_centroid FROM assigned""")
def _(spark, sf):
    return assigned(spark, sf).select("symbol", "window_start", "prediction", "distance_to_centroid")


@query("own_centroid", f"""WITH {ASSIGNED_SQL} SELECT symbol, window_start,
  CASE prediction WHEN 0 THEN 0.0 WHEN 1 THEN 0.2 ELSE -0.3 END::DOUBLE AS centroid_pct_return FROM assigned""")
def _(spark, sf):
    return (with_own_centroid(assigned(spark, sf), CENTROIDS)
            .select("symbol", "window_start", F.get("centroid", F.lit(0)).alias("centroid_pct_return")))


@query("centroid_distance", f"""WITH {ASSIGNED_SQL} SELECT symbol, window_start,
  round(distance_to_centroid, 6) AS distance_to_centroid FROM assigned""")
def _(spark, sf):
    known = assigned(spark, sf).drop("distance_to_centroid")
    return (cluster.centroid_distance(known, CENTROIDS, F.array(*Z))
            .select("symbol", "window_start", "distance_to_centroid"))


@query("label_anomalies", f"""WITH {LABELED_SQL} SELECT symbol, window_start, label, label_binary,
  round(distance_to_centroid, 6) AS distance_to_centroid FROM labeled""")
def _(spark, sf):
    return labeled(spark, sf).select("symbol", "window_start", "label", "label_binary", "distance_to_centroid")


_NORM = " + ".join(f"z_{f} * z_{f}" for f in FEATURES)
_SUMS = ", ".join(f"sum(z_{f}) AS y_{f}" for f in FEATURES)
_DOT = " + ".join(f"z_{f} * y_{f}" for f in FEATURES)


@query("silhouette", f"""WITH {ASSIGNED_SQL},
sums AS (SELECT prediction AS c, count(*) AS n, sum({_NORM}) AS q, {_SUMS} FROM assigned GROUP BY 1),
pairs AS (SELECT a.symbol, a.window_start, prediction, c, n, {_NORM} + q / n - 2 * ({_DOT}) / n AS d
          FROM assigned a CROSS JOIN sums),
points AS (SELECT symbol, window_start, any_value(n) FILTER (WHERE c = prediction) AS n,
             any_value(d * n / (n - 1)) FILTER (WHERE c = prediction) AS a, min(d) FILTER (WHERE c <> prediction) AS b
           FROM pairs GROUP BY 1, 2)
SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
  AS silhouette FROM points""")
def _(spark, sf):
    return cluster.silhouette(assigned(spark, sf), Z)


@query("check_trainable", f"""WITH {LABELED_SQL} SELECT count(*) AS rows, sum(label_binary)::BIGINT AS positives,
  count(*) >= 20 AS trainable, sum(label_binary) BETWEEN 1 AND count(*) - 1 AS has_both_classes FROM labeled""")
def _(spark, sf):
    ready = cluster.check_trainable(labeled(spark, sf), "label_binary")
    return spark.range(1).select(
        F.lit(ready.rows).cast("long").alias("rows"), F.lit(ready.positives).cast("long").alias("positives"),
        F.lit(ready.trainable).alias("trainable"), F.lit(ready.has_both_classes).alias("has_both_classes"))


# the lowest 0.8 of all 32-bit hashes
_IS_TRAIN = "('0x' || substr(md5(symbol || '|' || window_start), 1, 8))::BIGINT < 3435973836"


@query("split", f"""WITH {EVENT_FEATURES} SELECT symbol, window_start,
  CASE WHEN {_IS_TRAIN} THEN 'train' ELSE 'test' END AS side FROM feats""")
def _(spark, sf):
    side = F.when(classify.is_train(window_keys()), "train").otherwise("test")
    return features(spark, sf).select("symbol", "window_start", side.alias("side"))


@query("score_with_params", f"""WITH {SCORED_SQL} SELECT symbol, window_start, {r('logit', 'probability')},
  prediction, label FROM scored""")
def _(spark, sf):
    return scored(spark, sf).select("symbol", "window_start", "logit", "probability", "prediction", "label")


@query("logit_contributions", f"WITH {SCALED_SQL} " + " UNION ALL ".join(
    f"SELECT symbol, window_start, '{f}' AS feature, round(({c})::DOUBLE * z_{f}, 6) AS contribution FROM scaled"
    for f, c in zip(FEATURES, PUBLISHED_COEFFICIENTS)))
def _(spark, sf):
    windows = windows_once(spark, sf)
    mean, std = cluster.scale_params(windows)
    params = classify.ModelParams(mean, std, PUBLISHED_COEFFICIENTS, PUBLISHED_INTERCEPT)
    return classify.logit_contributions(windows, params, ["symbol", "window_start"])


@query("prediction_view", f"""WITH {SCORED_SQL} SELECT symbol, window_start, prediction,
  round(1 - probability, 6) AS prob_normal, round(probability, 6) AS prob_anomalo, label AS label_predicted FROM scored""")
def _(spark, sf):
    p = F.col("probability")
    vectors = scored(spark, sf).select("symbol", "window_start", "prediction",
                                       array_to_vector(F.array(1 - p, p)).alias("probability"))
    return classify.prediction_view(vectors)


@query("prediction_classes", f'WITH {SCORED_SQL} SELECT prediction, count(*) AS "count" FROM scored GROUP BY 1')
def _(spark, sf):
    return group_count(scored(spark, sf), "prediction")


@query("confusion_matrix", f"""WITH {RATED_SQL} SELECT label_binary, prediction, count(*) AS "count"
FROM scored GROUP BY 1, 2""")
def _(spark, sf):
    return confusion(rated(spark, sf))


@query("classification_metrics", f"""WITH {RATED_SQL},
classes AS (SELECT c, count(*) FILTER (WHERE label_binary = c)::DOUBLE AS actual, count(*) FILTER (WHERE prediction = c)::DOUBLE AS said,
  count(*) FILTER (WHERE label_binary = c AND prediction = c)::DOUBLE AS hit FROM scored, (SELECT unnest([0, 1]) AS c) GROUP BY c),
rates AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p, CASE WHEN actual > 0 THEN hit / actual ELSE 0 END AS q FROM classes),
f AS (SELECT *, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END AS f1 FROM rates)
SELECT round(sum(hit) / sum(actual), 6) AS accuracy, round(sum(p * actual) / sum(actual), 6) AS weighted_precision,
  round(sum(q * actual) / sum(actual), 6) AS weighted_recall, round(sum(f1 * actual) / sum(actual), 6) AS weighted_f1 FROM f""")
def _(spark, sf):
    return classify.classification_metrics(rated(spark, sf))


@query("auc_roc", f"""WITH {RATED_SQL},
per AS (SELECT round(probability, 9) AS s, count(*) FILTER (WHERE label_binary = 1) AS pos,
               count(*) FILTER (WHERE label_binary = 0) AS neg FROM scored GROUP BY 1),
cum AS (SELECT *, sum(neg) OVER (ORDER BY s) - neg AS neg_before FROM per)
SELECT round((sum(pos * (neg_before + neg / 2)) / (sum(pos) * sum(neg)::DOUBLE))::DOUBLE, 6) AS auc_roc FROM cum""")
def _(spark, sf):
    return classify.auc_roc(rated(spark, sf).withColumn("probability", F.round("probability", 9)))


def _fitted(spark, sf):
    """Classifier fitted on the training side of the distance labels."""
    rows = labeled(spark, sf).drop("prediction")
    train, test = classify.split(rows, window_keys())
    return classify.lr_fit(train), train, test


def _differing(a, b, keys):
    """Rows of two scorings, and how many have another prediction or probability."""
    other = b.select(*keys, F.col("prediction").alias("p2"), F.col("prob_anomalo").alias("q2"))
    far = (F.col("prediction") != F.col("p2")) | (F.abs(F.col("prob_anomalo") - F.col("q2")) > 1e-9)
    return a.join(other, keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(far).alias("differing"))


_TEST_ROWS = f"WITH {EVENT_FEATURES} SELECT count(*) AS rows, 0::BIGINT AS differing FROM feats WHERE NOT ({_IS_TRAIN})"


@query("fitted_scores_match_params", _TEST_ROWS)
def _(spark, sf):
    model, _, test = _fitted(spark, sf)
    by_model = unpack_vector(classify.score(test, model), "probability", ["prob_normal", "prob_anomalo"])
    by_params = classify.score_with_params(test, classify.params_of(model), at_boundary=0)
    return _differing(by_model, by_params.withColumnRenamed("probability", "prob_anomalo"),
                      ["symbol", "window_start"])


@query("saved_model_scores_match", _TEST_ROWS)
def _(spark, sf):
    model, _, test = _fitted(spark, sf)
    path = fresh_path(spark, "classifier")
    classify.save_model(model, path)
    names = ["prob_normal", "prob_anomalo"]
    before = unpack_vector(classify.score(test, model), "probability", names)
    after = unpack_vector(classify.score(test, classify.load_model(path)), "probability", names)
    return _differing(before, after, ["symbol", "window_start"])


@query("fitted_scores")
def _(spark, sf):
    model, _, _ = _fitted(spark, sf)
    out = classify.score(windows_once(spark, sf), model)
    return unpack_vector(out, "probability", ["prob_normal", "prob_anomalo"])


@query("fitted_coefficients")
def _(spark, sf):
    return classify.coefficients(spark, _fitted(spark, sf)[0])


@query("fitted_coefficients_complete", "SELECT true AS strongest_first, 4::BIGINT AS features, true AS intercept_last")
def _(spark, sf):
    rows = [tuple(r) for r in classify.coefficients(spark, _fitted(spark, sf)[0]).collect()]  # five rows
    sizes = [abs(c) for _, c in rows[:-1]]
    return spark.range(1).select(F.lit(sizes == sorted(sizes, reverse=True)).alias("strongest_first"),
                                 F.lit(len({f for f, _ in rows} & set(FEATURES))).cast("long").alias("features"),
                                 F.lit(rows[-1][0] == "intercept").alias("intercept_last"))


@query("model_params", "WITH " + EVENT_FEATURES + ", train AS (SELECT * FROM feats WHERE " + _IS_TRAIN + ") "
       + " UNION ALL ".join(f"SELECT '{f}' AS feature, round(avg({f}), 6) AS mean, "
                            f"round(stddev_samp({f}), 6) AS std FROM train" for f in FEATURES))
def _(spark, sf):
    row = classify.model_params(spark, _fitted(spark, sf)[0])
    return row.select(F.explode(F.arrays_zip("feature_cols", "mean", "std")).alias("x")).select(
        F.col("x.feature_cols").alias("feature"), "x.mean", "x.std")


@query("kmeans_points_at_nearest", f"WITH {EVENT_FEATURES} SELECT count(*) AS windows, 0::BIGINT AS misplaced FROM feats")
def _(spark, sf):
    _, prepared = cluster.prepare(windows_once(spark, sf))
    model = cluster.kmeans_fit(prepared, 3)
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    wide = unpack_vector(model.transform(prepared).select("prediction", "scaled_features"), "scaled_features", Z)
    again = assign_nearest(wide, Z, centers, cluster="nearest")
    return again.agg(F.count(F.lit(1)).alias("windows"),
                     F.count_if(F.col("nearest") != F.col("prediction")).alias("misplaced"))


@query("choose_k")
def _(spark, sf):
    _, prepared = cluster.prepare(windows_once(spark, sf))
    choice = cluster.choose_k(prepared.persist())
    prepared.unpersist()
    rows = [(k, s, k == choice.k) for k, s in choice.scores.items()]
    return spark.createDataFrame(rows, "k int, silhouette double, chosen boolean")


@query("choose_k_is_best", "SELECT '3,4,5' AS tried, true AS chosen_is_best, true AS within_bounds")
def _(spark, sf):
    _, prepared = cluster.prepare(windows_once(spark, sf))
    choice = cluster.choose_k(prepared.persist())
    prepared.unpersist()
    best = min(k for k, s in choice.scores.items() if s == max(choice.scores.values()))
    return spark.range(1).select(F.lit(",".join(map(str, sorted(choice.scores)))).alias("tried"),
                                 F.lit(choice.k == best).alias("chosen_is_best"),
                                 F.lit(all(-1 <= s <= 1 for s in choice.scores.values())).alias("within_bounds"))


@query("sweep_k", f"""WITH {EVENT_FEATURES}
SELECT k, (SELECT count(*) FROM feats) AS windows, true AS cost_within, true AS fewer_scans FROM (SELECT unnest([3, 4, 5]) AS k)""")
def _(spark, sf):
    """All k in one scan per Lloyd step: costs at most one percent above the library's, scans those of the slowest k."""
    windows = settle(cluster.standardise(windows_once(spark, sf)), "scaled")
    found = cluster.sweep_k(windows, Z)
    _, prepared = cluster.prepare(windows)
    prepared = prepared.persist()
    library = {k: cluster.kmeans_fit(prepared, k).summary.trainingCost for k in found.costs}
    prepared.unpersist()
    fewer = found.scans == max(found.steps.values()) + 4
    rows = [(k, found.costs[k] <= 1.01 * library[k], fewer) for k in sorted(found.costs)]
    return (spark.createDataFrame(rows, "k int, cost_within boolean, fewer_scans boolean")
            .join(windows.agg(F.count(F.lit(1)).alias("windows")), how="cross"))  # one row


@query("cluster_and_label")
def _(spark, sf):
    return cluster.cluster_and_label(features(spark, sf))[0]  # settles its input


@query("cluster_and_label_separates", f"""WITH {EVENT_FEATURES} SELECT count(*) AS windows, true AS separated,
  true AS at_most_5_pct_and_one FROM feats""")
def _(spark, sf):
    out = cluster.cluster_and_label(features(spark, sf))[0]
    hit, far = F.col("label") == "anomalo", F.col("distance_to_centroid")
    windows = F.count(F.lit(1))
    return out.agg(windows.alias("windows"),
                   (F.min(F.when(hit, far)) > F.max(F.when(~hit, far))).alias("separated"),
                   ((F.count_if(hit) - 1) * 20 <= windows).alias("at_most_5_pct_and_one"))
