"""Quality classifier: regularised quadratic discriminant analysis.

Each document becomes a vector of transformed statistics of its text, by
built-in functions.  One grouped aggregate over all labelled training rows
gives every class's count, sums and products; its covariance is shrunk
towards the pooled one and towards a multiple of the identity, its Cholesky
factor is kept with the model, and the score is the difference of the two
Gaussian log densities (Mahalanobis terms by solving with the factors),
made a probability by a calibration on the same training rows.

Defined results: a NULL or empty text has the statistics of the empty
text; rows with a NULL or unknown label teach nothing; without rows of
both classes every score is the share of good ones (1 without any);
repeated rows are scored each; extra columns are ignored whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import computed, fresh, held_out, ship_package
from txlens.llm.quality_rules import STOP_WORDS

SHRINK_POOLED, SHRINK_IDENTITY = 0.3, 0.1
BINS = 400                                # of the calibration's histogram
FEATURES = ("log_words", "mean_word", "symbols", "capitals", "exclamations", "digits", "punctuation", "lines",
            "distinct_words", "distinct_lines", "stop_words", "letters")


def statistics(df: DataFrame, out: str, text_col: str) -> DataFrame:
    """``df`` plus ``out``: array<double> in the order of ``FEATURES``."""
    w, ln = fresh(df, f"{out}_words"), fresh(df, f"{out}_lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = (df.withColumn(w, F.array_remove(F.split(text, "[ \\x09-\\x0D]+"), ""))
          .withColumn(ln, F.array_remove(F.split(text, "\n"), "")))
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    lines = F.greatest(F.size(ln), F.lit(1)).cast("double")
    share = lambda keep: F.sqrt(F.length(F.regexp_replace(text, f"[^{keep}]+", "")) / chars)
    stop = [v for x in STOP_WORDS for v in (x, x.capitalize())]
    return df.withColumn(out, computed(F.array(
        F.log1p(F.size(w).cast("double")),
        F.log1p(F.length(F.array_join(F.col(w), "")) / n),
        share("#*$%&|<>~^=_"),
        share("\\p{Lu}"),
        share("!"),
        share("0-9"),
        share(".,;:?"),
        F.sqrt(F.size(ln) / n),
        F.size(F.array_distinct(F.col(w))) / n,
        F.size(F.array_distinct(F.col(ln))) / lines,
        F.sqrt(F.size(F.filter(F.col(w), lambda x: x.isin(stop))) / n),
        share("\\p{L}"),
    ))).drop(w, ln)


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple                          # of class 0 and 1, of the scaled statistics
    factors: tuple                        # inverse Cholesky factors
    logdets: tuple
    line: tuple                           # calibration: constant and slope
    prior: float

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 minus that of class 0, compressed to keep its order at the far ends."""
        z = (x - self.centre) / self.scale
        part = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets):
            d = (z - mean) @ factor.T
            part.append(-0.5 * ((d * d).sum(1) + logdet))
        r = part[1] - part[0]
        return np.sign(r) * np.log1p(np.abs(r))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        t = self.line[0] + self.line[1] * self.log_ratio(x)
        return 1 / (1 + np.exp(-np.clip(t, -500, 500)))


def _moments(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: count, sums, products - one row each, so small whatever the data."""
    d = len(FEATURES)
    x: list[Column] = [F.col("x")[i] for i in range(d)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
    prods = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    out = {}
    for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), *sums, *prods).collect():
        p = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r["y"]] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), p)
    return out


def _calibrate(hist: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Constant and slope of a logistic curve through (ratio, bad, good) counts."""
    r = np.array([h[0] for h in hist])
    bad, good = np.array([h[1] for h in hist], float), np.array([h[2] for h in hist], float)
    a, w = np.c_[np.ones(len(r)), r], np.array([0.0, 1.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        n = bad + good
        grad = a.T @ (good - n * p) - 0.5 * (w - np.array([0.0, 1.0]))
        step = np.linalg.solve((a.T * (n * p * (1 - p))) @ a + 0.5 * np.eye(2), grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 1e-3))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Learn from every labelled row outside the held-out fold; an id with both labels counts as 0.

    Only labelled documents' statistics (twelve numbers a row) are shuffled."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("i"))).groupBy("i").agg(F.min("y").alias("y"))
    narrow = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(~held_out(F.col("i")))
    rows = statistics(narrow, "x", "t").select("i", "x").join(known, "i").select("x", "y").persist()
    try:
        moments = _moments(rows)
        total = sum(m[0] for m in moments.values())
        prior = moments[1][0] / total if 1 in moments else (1.0 if not total else 0.0)
        if len(moments) < 2 or min(m[0] for m in moments.values()) < 2:
            none = np.zeros(len(FEATURES))
            return Model(none, none + 1, (), (), (), (0.0, 1.0), prior)
        centre = sum(m[1] for m in moments.values()) / total
        spread = sum(m[2] for m in moments.values()) / total - np.outer(centre, centre)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-12)) + 1e-6
        means, covs = [], []
        for y in (0, 1):
            n, s, p = moments[y]
            means.append((s / n - centre) / scale)
            covs.append((p / n - np.outer(s / n, s / n)) / np.outer(scale, scale))
        pooled = sum(moments[y][0] * covs[y] for y in (0, 1)) / total
        factors, logdets = [], []
        for c in covs:
            c = (1 - SHRINK_POOLED) * c + SHRINK_POOLED * pooled
            c = (1 - SHRINK_IDENTITY) * c + SHRINK_IDENTITY * max(np.trace(c) / len(c), 1e-3) * np.eye(len(c))
            chol = np.linalg.cholesky(c)
            factors.append(np.linalg.inv(chol))
            logdets.append(2 * float(np.log(np.diag(chol)).sum()))
        model = Model(centre, scale, tuple(means), tuple(factors), tuple(logdets), (0.0, 1.0), prior)
        ratio = _ratio_column(rows, model)
        hist = (ratio.withColumn("b", F.round(F.col("r") * 20).cast("int")).groupBy("b")
                .agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")).collect())
        line = _calibrate([(h["b"] / 20, h["bad"], h["good"]) for h in hist])
        return Model(centre, scale, tuple(means), tuple(factors), tuple(logdets), line, prior)
    finally:
        rows.unpersist()


def _matrix(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), len(FEATURES))


def _ratio_column(rows: DataFrame, model: Model) -> DataFrame:
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(model.log_ratio(_matrix(b.column(0))))],
                                                 names=["y", "r"])

    return rows.select("x", "y").mapInArrow(run, "y int, r double")


def score_column(model: Model):
    """A function of the statistics column -> score, for ``withColumn`` (vectorised)."""
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), dtype=np.float64).reshape(len(x), len(FEATURES))))

    return F.pandas_udf(run, "double")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    scored = statistics(narrow, "x", "t").select("doc_id", score_column(model)("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, columns unchanged."""
    ship_package(docs.sparkSession)
    x, s = fresh(docs, "qda_x"), fresh(docs, "qda_score")
    scored = statistics(docs, x, text_col).withColumn(s, score_column(model)(F.col(x)))
    return scored.filter(F.col(s) >= threshold).select(*docs.columns)
