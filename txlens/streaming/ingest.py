"""Incremental ingestion of raw CSV drops into the cleaned, month-partitioned table.

The batch ETL cleans everything at once; new monthly files arrive over time.
A Structured Streaming file source picks up new CSV files; each micro-batch
(``foreachBatch``):

1. parses the new rows (E1-E5, calendar, flags) and writes them to a
   *bronze* table partitioned by (tx_year_month, _batch) with dynamic
   partition overwrite — a retried batch rewrites exactly its own folders,
   so the step is idempotent;
2. recomputes the month features (W1-W3) for the months the batch touched,
   from all bronze rows of those months (partition pruning), stages the
   result and dynamically overwrites only those months of the *silver*
   (cleaned) table.

So the silver table always equals the batch ETL over all files received so
far, whatever the micro-batch boundaries — the month features need whole
months, which a per-batch computation would get wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.clean import add_calendar, add_month_features, add_risk_flags, parse_raw
from txlens.schema import CLEANED_COLUMNS, PARTITION_COLUMN, RAW_SCHEMA
from txlens.session import scratch_path
from txlens.sources import readers, sinks

BATCH_COL = "_batch"


def _upsert_months(spark: SparkSession, batch: DataFrame, batch_id: int, bronze: str, silver: str) -> None:
    parsed = add_risk_flags(add_calendar(parse_raw(batch))).select("*", F.lit(batch_id).alias(BATCH_COL))
    (parsed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(PARTITION_COLUMN, BATCH_COL).parquet(bronze))
    # months touched by this batch: at most the months the batch spans (tiny)
    months = [r[0] for r in parsed.select(PARTITION_COLUMN).distinct().collect()]
    if not months:
        return
    known = [m for m in months if m is not None]
    rows = spark.read.parquet(bronze)
    cond = F.col(PARTITION_COLUMN).isin(*known) if known else F.lit(False)
    if len(known) < len(months):
        cond = cond | F.col(PARTITION_COLUMN).isNull()
    month_rows = rows.filter(cond).drop(BATCH_COL)
    recomputed = add_month_features(month_rows).select(*CLEANED_COLUMNS)
    staged = scratch_path(spark, f"silver-stage-{batch_id}")
    sinks.write_parquet(recomputed, staged)          # never read and overwrite the same files
    sinks.write_parquet(readers.read_cleaned_parquet(spark, staged).select(*CLEANED_COLUMNS), silver)


def start_ingest(spark: SparkSession, source_dir: str, bronze: str, silver: str, checkpoint: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the incremental ingest; returns the StreamingQuery."""
    reader = (spark.readStream.schema(RAW_SCHEMA).option("header", "true").option("escape", '"')
                   .option("multiLine", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    writer = (raw.writeStream.option("checkpointLocation", checkpoint)
                 .foreachBatch(lambda df, bid: _upsert_months(spark, df, bid, bronze, silver)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_available(spark: SparkSession, source_dir: str, root: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Process every file now in ``source_dir`` and return the silver table."""
    root = root or scratch_path(spark, "stream")
    bronze, silver, ckpt = f"{root}/bronze", f"{root}/silver", f"{root}/_checkpoint"
    q = start_ingest(spark, source_dir, bronze, silver, ckpt, True, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return readers.read_cleaned_parquet(spark, silver).select(*CLEANED_COLUMNS)
