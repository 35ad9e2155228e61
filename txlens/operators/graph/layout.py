"""Static adjacency laid out once for iterative graph algorithms.

Every step of LPA / PageRank / components joins the (large, unchanging)
adjacency with the (small, changing) per-vertex state on the source vertex.
Re-shuffling the adjacency every step is the dominant cost at scale, so it
is written once as a table *bucketed* by (src, _salt) in the shared
checkpoint folder; each step then shuffles only the vertex state to match
the buckets, and the adjacency is read in place.

Bucketed scans cannot be split by AQE's skew-join rule, so hot source
vertices are salted explicitly: a vertex with more than ``hot_rows``
adjacency rows has them spread over ``ceil(rows / hot_rows)`` salts (hash of
the neighbour), and its state row is replicated once per salt.  The hot-
vertex table has at most ``rows / hot_rows`` entries, which bounds its
broadcast.

The tables go with ``drop()`` or at the end of a ``with`` block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlens.functions.stats import one_row
from txlens.operators.skew import HOT_KEY_ROWS
from txlens.session import Scratch, delete_path, scratch_path, written
from txlens.sources.sinks import create_database

STATE_DB = "txlens_state"
TASK_ROWS = 2_000_000      # adjacency rows, or messages, of one task


def partitions_for(spark: SparkSession, rows: int) -> int:
    """The session's shuffle width, or more where a task would hold more than ``TASK_ROWS`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def number_ids(vertices: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, num, copies): every id that is not NULL with its place 0, 1, ... in the order of the ids, and its rows.

    Ranges are sorted each in its task and written; the rows of the ranges (one row per partition) give where each starts."""
    ids = scratch.written(vertices.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("copies")), "ids")
    n = partitions_for(ids.sparkSession, ids.count())
    ranged = scratch.written(ids.repartitionByRange(n, "id").sortWithinPartitions("id").select(
        "id", "copies", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "ids_ranged")
    # the record number starts anew in each partition
    starts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_low"))
    starts = starts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n") - F.col("_low")).alias("_shift"))
    return scratch.written(ranged.join(F.broadcast(starts), "_pid").select(
        "id", (F.col("_mid") + F.col("_shift")).alias("num"), "copies"), "numbers")


class SaltedAdjacency:
    """adjacency(src, dst, ...) bucketed by (src, _salt) + its hot-vertex table."""

    def __init__(self, adj: DataFrame, hot_rows: int = HOT_KEY_ROWS, name: str = "adj", degrees: DataFrame | None = None):
        """``degrees``: (src, _rows, ...) of an ``adj`` that only reads written tables, so that it is neither written nor counted again."""
        spark = adj.sparkSession
        self.spark = spark
        plain = None
        if degrees is None:
            # the input feeds two passes (degrees, then the bucketed write): written once
            plain = scratch_path(spark, f"{name}_plain")
            adj.write.parquet(plain)
            adj = spark.read.schema(adj.schema).parquet(plain)
            rows = adj.count()
            deg = adj.groupBy("src").agg(F.count(F.lit(1)).alias("_rows"))
        else:
            deg = degrees.select("src", "_rows")
            rows = one_row(deg, F.coalesce(F.sum("_rows"), F.lit(0)))[0]
        self.n = partitions_for(spark, rows)     # buckets grow with the rows
        width = F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int")
        hot = deg.filter(F.col("_rows") > F.lit(hot_rows)).select("src", width.alias("_w"))
        self.hot = written(hot, f"{name}_hot")          # <= rows / hot_rows entries
        self.any_hot = not self.hot.isEmpty()
        salt = F.when(F.col("_w").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("_w")).cast("int"))
        salted = adj.join(F.broadcast(self.hot), "src", "left").select(*adj.columns, salt.alias("_salt"))
        create_database(spark, STATE_DB, scratch_path(spark, f"{STATE_DB}.db"))
        table, self.path = f"{STATE_DB}.{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, name)
        (salted.repartition(self.n, "src", "_salt")        # one bucket per task -> n files
               .write.mode("overwrite").bucketBy(self.n, "src", "_salt")
               .option("path", self.path).saveAsTable(table))
        if plain is not None:
            delete_path(spark, plain)
        self.name, self.table = table, spark.table(table)

    def drop(self) -> None:
        """Drop the table and its files; frames that read it are no longer usable."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)

    def __enter__(self) -> "SaltedAdjacency":
        return self

    def __exit__(self, *error) -> None:
        self.drop()

    def state_for_join(self, state: DataFrame, key: str = "id") -> DataFrame:
        """Per-vertex state renamed to src, replicated once per salt of a hot vertex."""
        s = state.withColumnRenamed(key, "src").join(F.broadcast(self.hot), "src", "left")
        salts = F.sequence(F.lit(0), F.coalesce(F.col("_w"), F.lit(1)) - F.lit(1))
        return s.select(*[c for c in s.columns if c != "_w"], F.explode(salts).alias("_salt"))

    def join(self, state: DataFrame, key: str = "id") -> DataFrame:
        """adjacency rows with the state of their source vertex (no shuffle of the adjacency, and no sort: a bucket is
        streamed past the state of its vertices, at most as many as its rows, about ``TASK_ROWS``)."""
        return self.table.join(self.state_for_join(state, key).hint("shuffle_hash"), ["src", "_salt"]).drop("_salt")
