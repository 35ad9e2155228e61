"""ROC and precision-recall curve points (M7, M8), distributed.

One point per distinct score (threshold = score, predicted positive when
score >= threshold), from cumulative positive/negative counts in descending
score order.  The cumulative sums use range partitioning + per-partition
offsets (a partition-count-sized table), never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.stats import one_row
from txlens.session import ensure_checkpoint_dir


def _cumulative(per_score: DataFrame, n_parts: int) -> DataFrame:
    """Add cum_pos / cum_neg over descending score to (score, pos, neg)."""
    ensure_checkpoint_dir(per_score.sparkSession)
    order = F.desc("score")
    ranged = (per_score.repartitionByRange(n_parts, order)
                       .select("*", F.spark_partition_id().alias("_pid"))
                       .checkpoint(eager=True))
    tot = ranged.groupBy("_pid").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    off = tot.select("_pid",
                     (F.sum("_p").over(Window.orderBy("_pid")) - F.col("_p")).alias("_po"),
                     (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_no"))
    w = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("score", "pos", "neg", "_pid",
                          F.sum("pos").over(w).alias("_lp"), F.sum("neg").over(w).alias("_ln"))
    return (local.join(F.broadcast(off), "_pid")
                 .select("score", (F.col("_lp") + F.col("_po")).alias("tp"),
                         (F.col("_ln") + F.col("_no")).alias("fp")))


def _per_score(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    pos = F.when(F.col(label_col).cast("double") > 0.5, 1).otherwise(0)
    return (df.select(F.col(score_col).cast("double").alias("score"), pos.alias("_y"))
              .filter(F.col("score").isNotNull())
              .groupBy("score").agg(F.sum("_y").cast("bigint").alias("pos"),
                                    F.sum(1 - F.col("_y")).cast("bigint").alias("neg")))


def roc_curve(df: DataFrame, score_col: str, label_col: str, n_parts: int | None = None) -> DataFrame:
    """M7: (threshold, fpr, tpr) for every distinct score plus the (0, 0) start."""
    spark = df.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = _per_score(df, score_col, label_col)
    tot = one_row(per, F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = F.lit(tot["P"]), F.lit(tot["N"])
    cum = _cumulative(per, n_parts)
    pts = cum.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("fp"), N).alias("fpr"), F.try_divide(F.col("tp"), P).alias("tpr"))
    start = spark.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                  F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(df: DataFrame, score_col: str, label_col: str, n_parts: int | None = None) -> DataFrame:
    """M8: (threshold, precision, recall) per distinct score plus the (1, 0) end point."""
    spark = df.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = _per_score(df, score_col, label_col)
    P = F.lit(one_row(per, F.sum("pos"))[0])
    cum = _cumulative(per, n_parts)
    pts = cum.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     F.try_divide(F.col("tp"), P).alias("recall"))
    end = spark.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)
