"""Writers and catalog (K1-K7).

Partitioned writes REBALANCE on the month first: AQE splits a month with a
third of the rows over many tasks instead of one, and each task writes into
one month directory.  ``maxRecordsPerFile`` bounds file size.  Overwrites are
dynamic: only the months present in the frame are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.schema import CLEANED_TABLE_DDL, PARTITION_COLUMN

MAX_RECORDS_PER_FILE = 5_000_000


def _layout(df: DataFrame, partition_col: str = PARTITION_COLUMN, laid_out: bool = False) -> DataFrame:
    """REBALANCE by the partition column: one shuffle by month, then AQE splits
    a month that is too big into several tasks and merges small ones, so a
    month holding a third of the data is written in parallel and files stay
    near the advisory size.  (A range repartition would also spread it but
    needs a sampling pass over the whole input first.)  Rows that are ``laid_out``, dealt by month and slices
    of large months already, stay as they are."""
    if laid_out:
        return df
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", partition_col)
    # without AQE nothing would split a big month: range-partition on
    # (month, a spreading column) instead, at the price of a sampling pass
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = [c for c in ("CUSTOMER_ID", "TRANSACTION_ID") if c in df.columns][:1]
    return df.repartitionByRange(n, partition_col, *spread)


def write_parquet(df: DataFrame, path: str, partition_col: str = PARTITION_COLUMN, mode: str = "overwrite",
                  laid_out: bool = False) -> None:
    """K1/K4: Parquet snappy, partitioned by month, dynamic partition overwrite."""
    (_layout(df, partition_col, laid_out).write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_col)
        .parquet(path))


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """K6: CREATE DATABASE IF NOT EXISTS (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def save_external_table(df: DataFrame, table: str, path: str, partition_col: str = PARTITION_COLUMN, laid_out: bool = False) -> None:
    """K2: drop + save an external (path-backed) Parquet table, partitioned."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (_layout(df, partition_col, laid_out).write.mode("overwrite").format("parquet")
        .option("path", path).option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_col).saveAsTable(table))


def register_external_table(spark: SparkSession, table: str, location: str) -> None:
    """K7: typed partitioned DDL over an existing directory, then discover partitions."""
    spark.sql(CLEANED_TABLE_DDL.format(table=table, location=location))
    spark.sql(f"MSCK REPAIR TABLE {table}")


def save_managed_orc(df: DataFrame, table: str, partition_col: str = PARTITION_COLUMN, laid_out: bool = False) -> None:
    """K3: drop + save a managed ORC snappy table, partitioned."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (_layout(df, partition_col, laid_out).write.mode("overwrite").format("orc")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_col).saveAsTable(table))


# A text column comes back as it was written: spaces stay, and NULL and empty text are told apart (fixed marker).
CSV_NULL = "\\N"
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "nullValue": CSV_NULL}


def write_monthly_csv(df: DataFrame, path: str, month_expr=None, month_col: str = "TX_MONTH") -> None:
    """K5: headered CSV, one directory per month (the month column lives in the path).

    NULL is written as ``CSV_NULL``, empty text as empty, other text as it is; a text that is ``CSV_NULL`` itself
    reads back as NULL (``readers.read_monthly_csv``)."""
    m = month_expr if month_expr is not None else F.date_format("TX_DATETIME", "yyyy-MM")
    out = df.select("*", m.alias(month_col))
    (_layout(out, month_col).write.mode("overwrite").options(**CSV_OPTIONS)
        .partitionBy(month_col).csv(path))


def catalog_listing(spark: SparkSession, db: str) -> DataFrame:
    """K6: SHOW TABLES IN db as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {db}")
