"""Session defaults and the shared scratch/checkpoint location.

On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
(HDFS/S3/...).  All lineage cuts and scratch tables of this library go
there.  Only when nothing is configured (unit tests, a laptop) do we create
a private folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Fixed defaults for the session we build ourselves (tests, bench).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",   # only applies when this process launches the JVM
}


def get_session(master: str = "local[8]", app: str = "txlens",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; set a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="txlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return f"{root}/txlens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts the lineage, survives
    lost executors, and (unlike a checkpoint, whose plan runs once to count and once to write) is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Written tables of one operator that go when it is done: ``with Scratch() as scratch: scratch.written(...)``.
    What the operator returns must not read them."""

    def __init__(self):
        self.paths: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> "Scratch":
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        self.paths.append((df.sparkSession, path))
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        for spark, path in self.paths:
            delete_path(spark, path)
        self.paths = []
