"""Ordering helpers: global row positions, sketch quantiles, top-k, hash sample/split (exact quantiles: ``selection``).

``with_global_index`` gives every row its 0-based position in a total order
without a single-partition window: range-partition + sort, count rows per
partition, turn the counts (one row per partition — a proven size bound)
into offsets, add the in-partition record number.  The ranged frame is
checkpointed to the shared checkpoint folder so the partition ids are
stable across the two uses and survive executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.operators.selection import exact_quantiles  # noqa: F401  (its place for callers)
from txlens.session import ensure_checkpoint_dir

_LOW_BITS = 33  # monotonically_increasing_id: record number in the low 33 bits


def with_global_index(df: DataFrame, order_cols: list, name: str = "row_index",
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = (df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
                .select("*", F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid"))
                .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), _LOW_BITS)
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .select(*[F.col(c) for c in df.columns], (F.col("_off") + local).alias(name)))


def approx_quantiles(df: DataFrame, value_col: str, probs: list[float], group_col: str | None = None,
                     accuracy: int = 100000) -> DataFrame:
    """Bounded-memory sketch quantiles for very large inputs."""
    keys = [group_col] if group_col else []
    arr = F.percentile_approx(F.col(value_col).cast("double"), probs, accuracy)
    g = df.groupBy(*keys) if keys else df.groupBy()
    out = g.agg(arr.alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(f"q_{i}") for i in range(len(probs))])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """orderBy(...).limit(k) -> TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


_HASH_RANGE = 1 << 48


def key_hash(key: str, seed: int) -> Column:
    """A whole number in [0, 2^48) from the MD5 of ``key`` as text and the seed: the same in every
    engine, whatever the partitioning.  All rows without a key share one number."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Deterministic Bernoulli-like sample by a hash of the key (partitioning-independent)."""
    return df.filter(key_hash(key, seed) < F.lit(round(fraction * _HASH_RANGE)))


def hash_split(df: DataFrame, key: str, weights: tuple[float, float] = (0.8, 0.2), seed: int = 42):
    """Reproducible train/test split by hash of a key (randomSplit depends on partitioning)."""
    h, cut = key_hash(key, seed), F.lit(round(weights[0] / sum(weights) * _HASH_RANGE))
    return df.filter(h < cut), df.filter(h >= cut)


def chronological_id(df: DataFrame, time_col: str = "TX_DATETIME", tie_col: str = "TRANSACTION_ID",
                     name: str = "TX_INDEX") -> DataFrame:
    """Surrogate id 0..n-1 in time order (ties broken by tie_col)."""
    return with_global_index(df, [time_col, tie_col], name)
