"""Supervised classifier on labelled windows: split, fit, evaluate, score, explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.functions.scalars import label_text, label_when, sigmoid, unpack_vector
from tapewatch.operators.cluster import assembler, scaled, scaler
from tapewatch.operators.ordering import running_total
from tapewatch.operators.summaries import confusion
from tapewatch.schema import FEATURES, PREDICTIONS


def is_train(keys: Sequence[Column | str], ratio: float = 0.8) -> Column:
    """Side of a row by the md5 of its key: the same on any cluster, for any ratio."""
    digest = F.md5(F.concat_ws("|", *keys))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < F.lit(int(ratio * (1 << 32)))


def split(df: DataFrame, keys: Sequence[Column | str], ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash; independent of partitioning, unlike a random split.

    Both sides read ``df``: settle it first when it is costly, or take ``is_train`` as a column.
    """
    train = is_train(keys, ratio)
    return df.filter(train), df.filter(~train)


def random_split(df: DataFrame, ratio: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([ratio, 1.0 - ratio], seed=seed)
    return train, test


def lr_pipeline(label: str = "label_binary", max_iter: int = 20, reg_param: float = 0.1,
                elastic_net: float = 0.0) -> Pipeline:
    regression = LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net)
    return Pipeline(stages=[assembler(), scaler("features"), regression])


def lr_fit(train: DataFrame, **params) -> PipelineModel:
    return lr_pipeline(**params).fit(train)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_clusters(path: str) -> KMeansModel:
    return KMeansModel.load(path)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Apply the saved pipeline to a batch or a stream and keep the prediction layout."""
    scored = model.transform(df)
    return scored.select(*[c for c in PREDICTIONS if c in scored.columns])


@dataclass(frozen=True)
class ModelParams:
    """What a linear classifier on standardised features needs: a handful of numbers."""

    mean: Sequence[float]
    std: Sequence[float]
    coefficients: Sequence[float]
    intercept: float
    features: Sequence[str] = tuple(FEATURES)


def params_of(model: PipelineModel) -> ModelParams:
    _, scale, regression = model.stages
    return ModelParams([float(v) for v in scale.mean], [float(v) for v in scale.std],
                       [float(v) for v in regression.coefficients], float(regression.intercept))


def model_params(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The parameters as a one-row table."""
    p = params_of(model)
    return spark.createDataFrame(
        [(list(p.features), p.mean, p.std, p.coefficients, p.intercept)],
        "feature_cols array<string>, mean array<double>, std array<double>, "
        "coefficients array<double>, intercept double")


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature, strongest first, and the intercept."""
    p = params_of(model)
    rows = [*zip(p.features, p.coefficients), ("intercept", p.intercept)]
    return (spark.createDataFrame(rows, "feature string, coefficient double")
            .orderBy((F.col("feature") == "intercept"), F.desc(F.abs("coefficient"))))


def _terms(params: ModelParams) -> dict[str, Column]:
    return {f: F.lit(float(c)) * scaled(f, m, s)
            for f, m, s, c in zip(params.features, params.mean, params.std, params.coefficients)}


def score_with_params(df: DataFrame, params: ModelParams, at_boundary: int = 1) -> DataFrame:
    """Score without a model object: logit, anomaly probability, prediction and label.

    A probability of exactly 0.5 counts as anomalous; ``at_boundary=0`` decides as the fitted
    classifier does.
    """
    logit = F.lit(float(params.intercept))
    for term in _terms(params).values():
        logit = logit + term
    p = F.col("probability")
    hit = p >= 0.5 if at_boundary else p > 0.5
    return (df.withColumn("logit", logit).withColumn("probability", sigmoid("logit"))
            .withColumn("prediction", label_when(hit, 1, 0))
            .withColumn("label", label_text("prediction")))


def logit_contributions(df: DataFrame, params: ModelParams, keys: Sequence[str]) -> DataFrame:
    """Long form: one row per window and feature with its share of the logit."""
    wide = df.select(*keys, *[c.alias(f) for f, c in _terms(params).items()])
    return wide.unpivot(list(keys), list(params.features), "feature", "contribution")


def prediction_view(predictions: DataFrame) -> DataFrame:
    """Readable table: probabilities as two columns and the label in words."""
    return (unpack_vector(predictions, "probability", ["prob_normal", "prob_anomalo"])
            .withColumn("label_predicted", label_text("prediction")))


def classification_metrics(df: DataFrame, label: str = "label_binary",
                           prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted precision, recall and F1, from the confusion counts.

    The counts are one row per pair of classes; everything after the first aggregate is tiny.
    """
    counts = confusion(df.select(F.col(label).cast("double").alias("l"),
                                 F.col(prediction).cast("double").alias("p")), "l", "p")
    sides = (counts.select(F.explode(F.array(
        F.struct(F.col("l").alias("c"), F.col("count").alias("actual"), F.lit(0).cast("long").alias("said"),
                 F.when(F.col("l") == F.col("p"), F.col("count")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("actual"), F.col("count").alias("said"),
                 F.lit(0).cast("long").alias("hit")))).alias("x")).select("x.*"))
    per_class = sides.groupBy("c").agg(F.sum("actual").alias("actual"), F.sum("said").alias("said"),
                                       F.sum("hit").alias("hit"))
    precision = F.coalesce(F.try_divide("hit", "said"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    rated = per_class.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    weight, total = F.col("actual"), F.sum("actual")
    return rated.withColumn("f1", f1).agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("precision") * weight) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * weight) / total).alias("weighted_recall"),
        (F.sum(F.col("f1") * weight) / total).alias("weighted_f1"))


def evaluator_metrics(predictions: DataFrame, label: str = "label_binary") -> dict[str, float]:
    """The same four numbers from the MLlib evaluator, and its area under the ROC curve."""
    multi = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    out = {name: multi.evaluate(predictions, {multi.metricName: metric}) for name, metric in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"))}
    out["auc_roc"] = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="rawPrediction", numBins=0).evaluate(predictions)
    return out


def auc_roc(df: DataFrame, score_col: str = "probability", label: str = "label_binary") -> DataFrame:
    """Exact area under the ROC curve from ranks; ties count half.

    Rows are first counted per distinct score, so many equal scores cost nothing, and the counts
    are accumulated over range partitions. Null when a class is missing.
    """
    per_score = df.groupBy(F.col(score_col).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    ranked = running_total(per_score, ["score"], ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    return ranked.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg").cast("double")).alias("auc_roc"))
