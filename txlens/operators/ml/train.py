"""MLlib training and evaluation.

The split is a hash split on the transaction id (reproducible whatever the
partitioning), class weights are computed on the training side only, and
the training frame is persisted once (MEMORY_AND_DISK) and released after.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.ml.prep import add_class_weights, prepare_features
from txlens.operators.ordering import hash_split
from txlens.schema import LABEL, ML_FEATURES, WEIGHT

ASSEMBLED = "features_raw"
FEATURES = "features"


def build_pipeline(features: list[str] | None = None, label: str = LABEL, weight: str = WEIGHT,
                   model: str = "logistic", max_iter: int = 50, reg_param: float = 0.1,
                   elastic_net: float = 0.0, seed: int = 42) -> Pipeline:
    """M1-M4 (+X1/X2): assembler (keep invalid) -> scaler (mean, std) -> classifier."""
    features = features or ML_FEATURES
    assembler = VectorAssembler(inputCols=features, outputCol=ASSEMBLED, handleInvalid="keep")
    scaler = StandardScaler(inputCol=ASSEMBLED, outputCol=FEATURES, withMean=True, withStd=True)
    if model == "logistic":
        clf = LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol=weight, maxIter=max_iter,
                                 regParam=reg_param, elasticNetParam=elastic_net, family="binomial")
    elif model == "random_forest":
        clf = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, weightCol=weight, seed=seed)
    elif model == "gbt":
        clf = GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=weight, seed=seed, maxIter=20)
    else:
        raise ValueError(f"unknown model {model!r}")
    return Pipeline(stages=[assembler, scaler, clf])


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict
    predictions: DataFrame


def evaluate(predictions: DataFrame, label: str = LABEL) -> dict:
    """M6: area under PR and ROC."""
    out = {}
    for metric in ("areaUnderPR", "areaUnderROC"):
        ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName=metric)
        out[metric] = float(ev.evaluate(predictions))
    return out


def train_and_evaluate(df: DataFrame, features: list[str] | None = None, model: str = "logistic",
                       train_ratio: float = 0.8, seed: int = 42, id_col: str = "TRANSACTION_ID",
                       weights_from: str = "all") -> TrainResult:
    """M5: prepare -> weights -> hash split -> fit -> predict -> evaluate.

    ``weights_from``: class weights from ``all`` prepared rows, or from the
    ``train`` side only.  The prepared rows are computed once and kept while
    weights, fit and evaluation read them."""
    features = features or ML_FEATURES
    prepared = prepare_features(df, features, keep=[id_col]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = add_class_weights(prepared) if weights_from == "all" else prepared
        train, test = hash_split(rows, id_col, (train_ratio, 1.0 - train_ratio), seed)
        if weights_from == "train":
            train = add_class_weights(train)
        if train.select(LABEL).distinct().limit(2).count() < 2:
            raise ValueError("Training split contains only one class.")
        if test.isEmpty():
            raise ValueError("Test split is empty.")
        fitted = build_pipeline(features, model=model, seed=seed).fit(train)
        metrics = evaluate(fitted.transform(test))
    finally:
        prepared.unpersist()
    return TrainResult(fitted, metrics, fitted.transform(test))


def scores(predictions: DataFrame, id_col: str = "TRANSACTION_ID", label: str = LABEL) -> DataFrame:
    """Probability of the positive class, p[1]."""
    return predictions.select(id_col, label, "prediction",
                              vector_to_array("probability")[1].alias("score"))


def confusion_matrix(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """A10: counts by (label, prediction), pivoted to a 2x2 matrix."""
    return (predictions.groupBy(label).pivot("prediction", [0.0, 1.0]).agg(F.count(F.lit(1)))
                       .select(label, F.coalesce(F.col("`0.0`"), F.lit(0)).alias("pred_0"),
                               F.coalesce(F.col("`1.0`"), F.lit(0)).alias("pred_1"))
                       .orderBy(label))


def coefficients(spark: SparkSession, model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """M9: logistic coefficients by feature, sorted by absolute size, with sign."""
    features = features or ML_FEATURES
    lr = model.stages[-1]
    coefs = [float(c) for c in lr.coefficients.toArray()]
    rows = [(f, c, abs(c), "increases risk" if c > 0 else "decreases risk") for f, c in zip(features, coefs)]
    df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double, effect string")
    return df.orderBy(F.desc("abs_coefficient"))


def metrics_frame(spark: SparkSession, metrics: dict, model: str = "logistic") -> DataFrame:
    """The metrics dict as a small DataFrame."""
    return spark.createDataFrame([(model, k, float(v)) for k, v in sorted(metrics.items())],
                                 "model string, metric string, value double")
