"""Registered queries: MLlib preparation, training, evaluation and curves
(A7-A10, E15, E17, M1-M10, X1, X2, O9, O10)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txlens.operators.ml import curves, prep, train
from txlens.operators.ordering import hash_sample, hash_split
from txlens.plans.registry import query, r6
from txlens.plans.sql import R, R6, with_
from txlens.schema import LABEL, ML_FEATURES, WEIGHT
from txlens.sources import adapters as ad


def _tx(spark, sf):
    return ad.events_tx(spark, sf, True)


@query("class_balance", with_("feat_a") +
       f"SELECT TX_FRAUD, count(*) AS count, {R('count(*) / (SELECT count(*) FROM feat_a)', 6)} AS ratio "
       "FROM feat_a GROUP BY TX_FRAUD")
def q_balance(spark, sf):
    """Rows per class and share."""
    return prep.class_balance(_tx(spark, sf))


@query("class_weights", with_("feat_a") +
       f"SELECT TX_FRAUD, count(*) AS n_c, {R6('(SELECT count(*) FROM feat_a) / (2.0 * count(*))')} AS class_weight "
       "FROM feat_a GROUP BY TX_FRAUD")
def q_weights(spark, sf):
    """Balanced weight n / (k * n_c) per class."""
    return r6(prep.class_weights(_tx(spark, sf)), WEIGHT)


@query("weight_check", with_("feat_a") +
       f"SELECT CAST(TX_FRAUD AS DOUBLE) AS TX_FRAUD, {R6('(SELECT count(*) FROM feat_a) / (2.0 * count(*))')} AS class_weight, "
       "count(*) AS count FROM feat_a GROUP BY TX_FRAUD")
def q_weight_check(spark, sf):
    """Rows per (label, weight) after weighting the prepared frame."""
    w = prep.add_class_weights(prep.prepare_features(_tx(spark, sf)))
    return r6(prep.weight_check(w), WEIGHT)


_FEATURE_SQL = ", ".join(
    (f"{R6('CAST(' + c + ' AS DOUBLE)')} AS {c}" if c == "customer_avg_amount" else f"CAST({c} AS DOUBLE) AS {c}")
    for c in ML_FEATURES)


@query("ml_feature_frame", with_("feat_a") +
       f"SELECT TRANSACTION_ID, {_FEATURE_SQL}, CAST(TX_FRAUD AS DOUBLE) AS TX_FRAUD FROM feat_a")
def q_features(spark, sf):
    """The 8 features as doubles (NULL -> 0) and the label."""
    return r6(prep.prepare_features(_tx(spark, sf), keep=["TRANSACTION_ID"]), "customer_avg_amount")


@query("ml_scaled_stats", with_("feat_a") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {R6(f'avg(CAST({c} AS DOUBLE))')} AS mean, {R6(f'stddev_samp(CAST({c} AS DOUBLE))')} AS std FROM feat_a"
    for c in ML_FEATURES))
def q_scaled(spark, sf):
    """M1/M2: assembler + StandardScaler fitted on all rows; its mean and std per feature."""
    prepared = prep.prepare_features(_tx(spark, sf))
    model = Pipeline(stages=[
        VectorAssembler(inputCols=ML_FEATURES, outputCol="features_raw", handleInvalid="keep"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]).fit(prepared)
    sc = model.stages[-1]
    rows = [(f, float(m), float(s)) for f, m, s in zip(ML_FEATURES, sc.mean.toArray(), sc.std.toArray())]
    return r6(spark.createDataFrame(rows, "feature string, mean double, std double"), "mean", "std")


@query("ml_assembled", with_("feat_a") +
       f"SELECT TRANSACTION_ID, {_FEATURE_SQL}, CAST(TX_FRAUD AS DOUBLE) AS TX_FRAUD FROM feat_a")
def q_assembled(spark, sf):
    """M1: assembled feature vectors (handleInvalid=keep), one column per place of the vector."""
    prepared = prep.prepare_features(_tx(spark, sf), keep=["TRANSACTION_ID"])
    va = VectorAssembler(inputCols=ML_FEATURES, outputCol="features_raw", handleInvalid="keep")
    rows = va.transform(prepared).select("TRANSACTION_ID", vector_to_array("features_raw").alias("v"), LABEL)
    return r6(rows.select("TRANSACTION_ID", *[F.col("v")[i].alias(c) for i, c in enumerate(ML_FEATURES)], LABEL),
              "customer_avg_amount")


def _fit(spark, sf, model="logistic"):
    return train.train_and_evaluate(_tx(spark, sf), model=model)


@query("ml_train")
def q_train(spark, sf):
    """M3/M4/M5: weighted logistic regression pipeline fitted on the hash-split train side;
    training summary (iterations, final objective, test rows)."""
    res = _fit(spark, sf)
    lr = res.model.stages[-1]
    summ = lr.summary
    rows = [("total_iterations", float(summ.totalIterations)),
            ("final_objective", float(summ.objectiveHistory[-1])),
            ("test_rows", float(res.predictions.count()))]
    return spark.createDataFrame(rows, "metric string, value double")


@query("ml_coefficients")
def q_coefficients(spark, sf):
    """M9: coefficients by feature, sorted by absolute size, with the direction of the effect."""
    return train.coefficients(spark, _fit(spark, sf).model)


@query("ml_predictions")
def q_predictions(spark, sf):
    """M5: predictions on the hash-split test side."""
    return _fit(spark, sf).predictions.select("TRANSACTION_ID", LABEL, "prediction")


@query("ml_scores")
def q_scores(spark, sf):
    """Positive-class probability p[1] per test row."""
    return train.scores(_fit(spark, sf).predictions)


@query("ml_metrics")
def q_metrics(spark, sf):
    """M6: area under PR and ROC of the logistic model."""
    return train.metrics_frame(spark, _fit(spark, sf).metrics)


@query("confusion_matrix")
def q_confusion(spark, sf):
    """A10: 2x2 counts of (label, prediction)."""
    return train.confusion_matrix(_fit(spark, sf).predictions)


@query("ml_random_forest")
def q_rf(spark, sf):
    """Class-weighted random forest, same pipeline; PR/ROC areas."""
    return train.metrics_frame(spark, _fit(spark, sf, "random_forest").metrics, "random_forest")


@query("ml_gbt")
def q_gbt(spark, sf):
    """Class-weighted gradient-boosted trees; PR/ROC areas."""
    return train.metrics_frame(spark, _fit(spark, sf, "gbt").metrics, "gbt")


@query("ml_report")
def q_report(spark, sf):
    """Load -> class balance -> train -> evaluate, as one metrics table."""
    tx = _tx(spark, sf)
    bal = prep.class_balance(tx)
    res = train.train_and_evaluate(tx)
    m = train.metrics_frame(spark, res.metrics)
    rows = bal.select(F.lit("logistic").alias("model"),
                      F.concat(F.lit("class_share_"), F.col(LABEL).cast("string")).alias("metric"),
                      F.col("ratio").alias("value"))
    return m.unionByName(rows)


def _scored(spark, sf):
    ev = ad.read_table(spark, sf, "events")
    return ev.select(F.col("value").alias("score"), (F.col("event_type") == F.lit("error")).alias("label"))


_PER_SCORE = ("SELECT value AS score, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS pos, "
              "sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS neg FROM events WHERE value IS NOT NULL GROUP BY value")
_CUM = (f"SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp, "
        f"sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM ({_PER_SCORE}) p")


@query("roc_curve", f"""SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT score, {R6("fp / (SELECT sum(neg) FROM (" + _PER_SCORE + ") a)")},
  {R6("tp / (SELECT sum(pos) FROM (" + _PER_SCORE + ") b)")} FROM ({_CUM}) c""")
def q_roc(spark, sf):
    """M7: ROC points of a fixed score (amount) for label event_type='error'."""
    return r6(curves.roc_curve(_scored(spark, sf), "score", "label"), "fpr", "tpr")


@query("pr_curve", f"""SELECT score AS threshold, {R6("tp / (tp + fp)")} AS precision,
  {R6("tp / (SELECT sum(pos) FROM (" + _PER_SCORE + ") b)")} AS recall FROM ({_CUM}) c
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0""")
def q_pr(spark, sf):
    """M8: precision-recall points of the same fixed score."""
    return r6(curves.pr_curve(_scored(spark, sf), "score", "label"), "precision", "recall")


# the key's hash, as in ordering.key_hash
_HASH = "CAST('0x' || substr(md5(concat_ws(':', CAST(TRANSACTION_ID AS VARCHAR), '42')), 1, 12) AS BIGINT)"


@query("hash_sample", with_("feat_a") + f"SELECT TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_FRAUD FROM feat_a "
       f"WHERE {_HASH} < {round(0.01 * 2 ** 48)}")
def q_sample(spark, sf):
    """Deterministic 1 % sample of transactions by hash of the id."""
    return hash_sample(ad.events_tx(spark, sf), "TRANSACTION_ID", 0.01, 42).select(
        "TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", LABEL)


@query("hash_split", with_("feat_a") + f"SELECT CASE WHEN {_HASH} < {round(0.8 * 2 ** 48)} THEN 'train' ELSE 'test' END AS side, "
       "count(*) AS count, sum(TRANSACTION_ID)::BIGINT AS ids FROM feat_a GROUP BY 1")
def q_split(spark, sf):
    """Reproducible 80/20 split by hash of the id; rows per side and the sum of their ids."""
    tr, te = hash_split(ad.events_tx(spark, sf), "TRANSACTION_ID", (0.8, 0.2), 42)
    both = [d.select(F.lit(side).alias("side"), "TRANSACTION_ID") for d, side in ((tr, "train"), (te, "test"))]
    return both[0].unionByName(both[1]).groupBy("side").agg(
        F.count(F.lit(1)).alias("count"), F.sum("TRANSACTION_ID").alias("ids"))
