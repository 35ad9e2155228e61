"""Training, scoring and metrics against a plain Newton fit and curves by brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from support import SF001

from txlens.operators.ml import prep, train
from txlens.operators.ordering import hash_sample, hash_split
from txlens.plans import q_ml
from txlens.schema import LABEL, ML_FEATURES
from txlens.sources import adapters as ad


def key_hash(key, seed=42):
    text = f"{key}:{seed}" if key is not None else str(seed)
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / 2 ** 48


def areas(label, score):
    """Areas under ROC and PR: one point per different score, trapezoids, PR from its first precision."""
    pos, neg = (label == 1).sum(), (label == 0).sum()
    roc, pr = [(0.0, 0.0)], []
    for s in sorted(set(score), reverse=True):
        tp, fp = ((score >= s) & (label == 1)).sum(), ((score >= s) & (label == 0)).sum()
        roc.append((fp / neg, tp / pos))
        pr.append((tp / pos, tp / (tp + fp)))
    pr = [(0.0, pr[0][1])] + pr
    area = lambda points: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    return area(roc), area(pr)


def newton(x, y, w, reg=0.1):
    """Weighted logistic regression, the penalty on coefficients of unit-variance features, by Newton steps.
    Returns coefficients, intercept and the objective as a function of both."""
    mean = (w[:, None] * x).sum(0) / w.sum()
    var = (w[:, None] * (x - mean) ** 2).sum(0) / (w.sum() - (w ** 2).sum() / w.sum())
    a = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag(np.append(reg * var, 0.0))

    def objective(b):
        z = a @ b
        return (w * (np.logaddexp(0, z) - y * z)).sum() / w.sum() + b @ penalty @ b / 2

    b = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ b))
        grad = a.T @ (w * (p - y)) / w.sum() + penalty @ b
        hess = (a * (w * p * (1 - p))[:, None]).T @ a / w.sum() + penalty + 1e-12 * np.eye(len(b))
        b = b - np.linalg.solve(hess, grad)
    return b, objective


@pytest.fixture(scope="module")
def fitted(spark):
    tx = ad.events_tx(spark, SF001, True)
    rows = prep.prepare_features(tx, keep=["TRANSACTION_ID"]).toPandas()
    return train.train_and_evaluate(tx), rows


def test_logistic_fit_scores_and_metrics(spark, fitted):
    result, rows = fitted
    in_train = rows["TRANSACTION_ID"].map(key_hash).to_numpy() < 0.8
    x, y = rows[ML_FEATURES].to_numpy(float), rows[LABEL].to_numpy(float)
    counts = {c: (y == c).sum() for c in (0.0, 1.0)}
    w = np.array([len(y) / (2 * counts[c]) for c in y])                  # weights of all prepared rows
    mean, std = x[in_train].mean(0), x[in_train].std(0, ddof=1)
    z = np.where(std > 0, (x - mean) / np.where(std > 0, std, 1), 0.0)
    best, objective = newton(z[in_train], y[in_train], w[in_train])

    lr = result.model.stages[-1]
    ours = np.append(lr.coefficients.toArray(), lr.intercept)
    assert objective(best) - 1e-12 <= objective(ours) <= objective(best) + 1e-6
    assert lr.summary.objectiveHistory[-1] == pytest.approx(objective(ours), abs=1e-9)
    assert np.abs(ours - best).max() < 0.01

    scored = train.scores(result.predictions).toPandas().set_index("TRANSACTION_ID")
    test = rows[~in_train]
    assert sorted(scored.index) == sorted(test["TRANSACTION_ID"])
    scored = scored.loc[test["TRANSACTION_ID"]]
    p = 1 / (1 + np.exp(-(z[~in_train] @ ours[:-1] + ours[-1])))
    assert np.abs(scored["score"].to_numpy() - p).max() < 1e-9
    assert (scored["prediction"].to_numpy() == (p > 0.5)).all()

    label = test[LABEL].to_numpy()
    roc, pr = areas(label, scored["score"].to_numpy())
    assert result.metrics["areaUnderROC"] == pytest.approx(roc, abs=1e-9)
    assert result.metrics["areaUnderPR"] == pytest.approx(pr, abs=1e-9)

    matrix = {r[LABEL]: (r["pred_0"], r["pred_1"]) for r in train.confusion_matrix(result.predictions).collect()}
    assert matrix == {c: tuple(int(((label == c) & ((p > 0.5) == k)).sum()) for k in (0, 1)) for c in (0.0, 1.0)}

    coefs = train.coefficients(spark, result.model).collect()
    by_size = sorted(zip(ML_FEATURES, ours), key=lambda v: -abs(v[1]))
    assert [r["feature"] for r in coefs] == [f for f, _ in by_size]
    assert all((r["effect"] == "increases risk") == (r["coefficient"] > 0) for r in coefs)


def test_report_holds_class_shares_and_areas(spark, fitted):
    result, rows = fitted
    got = {r["metric"]: r["value"] for r in q_ml.q_report(spark, SF001).collect()}
    share = (rows[LABEL] == 1).mean()
    assert got == pytest.approx({"class_share_0": 1 - share, "class_share_1": share, **result.metrics}, abs=1e-6)


@pytest.mark.parametrize("model", ["random_forest", "gbt"])
def test_tree_models_areas_and_separable_label(spark, model):
    """The reported areas are those of the scores, and a label that follows a feature is learnt."""
    from pyspark.sql import functions as F

    tx = ad.events_tx(spark, SF001, True).withColumn(LABEL, (F.col("tx_hour") >= 15).cast("int"))
    result = train.train_and_evaluate(tx, model=model)
    scored = train.scores(result.predictions).toPandas()
    roc, pr = areas(scored[LABEL].to_numpy(), scored["score"].to_numpy())
    assert result.metrics["areaUnderROC"] == pytest.approx(roc, abs=1e-9) and roc > 0.99
    assert result.metrics["areaUnderPR"] == pytest.approx(pr, abs=1e-9)
    assert ((scored["score"] > 0.5) == (scored["prediction"] == 1)).all()


def test_hash_sample_and_split_follow_the_key(spark):
    keys = [None, *range(-500, 2000)]
    df = spark.createDataFrame([(k, "x") for k in keys], "k long, n_rows string")
    got = [r["k"] for r in hash_sample(df.repartition(7), "k", 0.1, 3).collect()]
    assert sorted(got, key=str) == sorted([k for k in keys if key_hash(k, 3) < 0.1], key=str)
    a, b = hash_split(df, "k", (3, 1), 3)
    left, right = {r["k"] for r in a.collect()}, {r["k"] for r in b.collect()}
    assert left == {k for k in keys if key_hash(k, 3) < 0.75} and left | right == set(keys) and not left & right
