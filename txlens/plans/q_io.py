"""Registered queries: sources, sinks and catalog.

Each query writes into a fresh folder under the shared checkpoint root
(``spark.checkpoint.dir``), then reads the result back through the reader
under test, so the answer is the data that went through the round trip.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from txlens.operators.clean import add_features, clean_transactions
from txlens.plans.q_clean import _EXTRA as CLEAN_EXTRA, CLEAN_COLS, raw_a
from txlens.plans.registry import query, r6
from txlens.plans.sql import R6, with_
from txlens.schema import CLEANED_COLUMNS
from txlens.session import Scratch, scratch_path
from txlens.sources import adapters as ad
from txlens.sources import readers, sinks

_B_COLS = ("TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS, "
           "TX_FRAUD, TX_FRAUD_SCENARIO, tx_date, tx_year_month, tx_hour, tx_day_of_week, is_weekend, is_night, "
           "customer_tx_count, " + R6("customer_avg_amount") + " AS customer_avg_amount, terminal_tx_count")
MONTH = ad.SPARSE_MONTH


def _db_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _clean_cols(df):
    return r6(df.select(*CLEANED_COLUMNS), "customer_avg_amount")


def _store_b(spark, sf, write) -> None:
    """``write(frame, laid_out=True)`` with mapping B, cleaned.  Its base columns are written once: the passes that look for hot
    groups and count the months take no join of their own."""
    with Scratch() as scratch:
        base = scratch.written(ad.lineitem_base(spark, sf), "lineitem_base")
        write(add_features(base, by_month=True), laid_out=True)


def _write_b(spark, sf) -> str:
    path = scratch_path(spark, "cleaned-parquet")
    _store_b(spark, sf, lambda tx, **how: sinks.write_parquet(tx, path, **how))
    return path


def _write_raw_csv(spark, sf) -> str:
    path = scratch_path(spark, "raw-csv")
    (raw_a(spark, sf).repartition(4).write.mode("overwrite").option("header", "true")
        .option("escape", '"').csv(path))
    return path


@query("csv_roundtrip", with_("clean_a", extra=CLEAN_EXTRA) + f"SELECT {CLEAN_COLS} FROM clean_a")
def q_csv(spark, sf):
    """Raw text of mapping A written as headered CSV files, read back by glob and cleaned."""
    path = _write_raw_csv(spark, sf)
    return _clean_cols(clean_transactions(readers.read_raw_csv(spark, f"{path}/*.csv")))


@query("parquet_roundtrip", with_("feat_b") + f"SELECT {_B_COLS} FROM feat_b")
def q_parquet_roundtrip(spark, sf):
    """K1 + S3: month-partitioned snappy Parquet written and read back (partition discovery)."""
    return _clean_cols(readers.read_cleaned_parquet(spark, _write_b(spark, sf)))


@query("parquet_scan", with_("feat_b") + "SELECT TRANSACTION_ID, TX_AMOUNT, tx_year_month FROM feat_b")
def q_parquet_scan(spark, sf):
    """S3: narrow scan of the partitioned directory (ReadSchema has two columns)."""
    return readers.read_cleaned_parquet(spark, _write_b(spark, sf)).select("TRANSACTION_ID", "TX_AMOUNT", "tx_year_month")


@query("month_slice", with_("feat_b") +
       f"SELECT TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, tx_year_month FROM feat_b WHERE tx_year_month = '{MONTH}'")
def q_month_slice(spark, sf):
    """Equality on the partition column -> only that month's directory is listed and read."""
    df = readers.read_cleaned_parquet(spark, _write_b(spark, sf), months=[MONTH])
    return df.select("TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "tx_year_month")


@query("overwrite_month", with_("feat_b") +
       f"SELECT {_B_COLS} FROM feat_b WHERE tx_year_month <> '{MONTH}' OR TX_FRAUD = 1")
def q_overwrite(spark, sf):
    """K4: rewriting one month (its fraud rows only) replaces that month and keeps all others."""
    path = _write_b(spark, sf)
    month = readers.read_cleaned_parquet(spark, path, months=[MONTH]).filter(F.col("TX_FRAUD") == 1)
    month = month.select(*CLEANED_COLUMNS)
    staged = scratch_path(spark, "month-stage")
    sinks.write_parquet(month, staged)          # stage first: never read and overwrite the same files
    sinks.write_parquet(readers.read_cleaned_parquet(spark, staged), path)
    return _clean_cols(readers.read_cleaned_parquet(spark, path))


def _db(spark, prefix):
    db = _db_name(prefix)
    sinks.create_database(spark, db, scratch_path(spark, f"{db}.db"))
    return db


@query("table_scan", with_("feat_b") + f"SELECT {_B_COLS} FROM feat_b")
def q_table_scan(spark, sf):
    """K2 + S4: external Parquet table saved at a path, scanned by name through SQL."""
    db = _db(spark, "txlens_ext")
    _store_b(spark, sf, lambda tx, **how: sinks.save_external_table(tx, f"{db}.cleaned_transactions", scratch_path(spark, "external"), **how))
    return _clean_cols(spark.sql(f"SELECT * FROM {db}.cleaned_transactions"))


@query("external_table", with_("feat_b") + f"SELECT {_B_COLS} FROM feat_b")
def q_external_ddl(spark, sf):
    """K7: typed partitioned DDL over an existing Parquet directory (+ partition repair)."""
    db = _db(spark, "txlens_ddl")
    path = _write_b(spark, sf)
    sinks.register_external_table(spark, f"{db}.cleaned_transactions", path)
    return _clean_cols(readers.read_table(spark, f"{db}.cleaned_transactions"))


@query("orc_table", with_("feat_b") + f"SELECT {_B_COLS} FROM feat_b")
def q_orc(spark, sf):
    """K3: managed ORC snappy table, partitioned by month, read back by name."""
    db = _db(spark, "txlens_orc")
    _store_b(spark, sf, lambda tx, **how: sinks.save_managed_orc(tx, f"{db}.cleaned_transactions", **how))
    return _clean_cols(readers.read_table(spark, f"{db}.cleaned_transactions"))


@query("monthly_csv", with_("raw_a", extra=CLEAN_EXTRA) + "SELECT *, substr(TX_DATETIME, 1, 7) AS TX_MONTH FROM raw_a")
def q_monthly_csv(spark, sf):
    """K5: one CSV directory per month (month lives in the path), read back with the month column."""
    path = scratch_path(spark, "monthly-csv")
    sinks.write_monthly_csv(raw_a(spark, sf), path, month_expr=F.substring("TX_DATETIME", 1, 7))
    return readers.read_monthly_csv(spark, path)


@query("catalog_listing", with_("tx_b") + "SELECT 'txlens_cat' AS namespace, 'cleaned_transactions' AS tableName, "
       "false AS isTemporary, count(*) AS n_rows FROM tx_b")
def q_catalog(spark, sf):
    """K6: CREATE DATABASE / saveAsTable / DROP TABLE / SHOW TABLES, with the rows of the listed table."""
    db = _db(spark, "txlens_cat")
    tx = ad.lineitem_tx(spark, sf)
    sinks.save_external_table(tx, f"{db}.cleaned_transactions", scratch_path(spark, "cat"))
    sinks.save_external_table(tx.limit(0), f"{db}.dropped", scratch_path(spark, "cat"))
    spark.sql(f"DROP TABLE {db}.dropped")
    rows = spark.table(f"{db}.cleaned_transactions").count()
    return sinks.catalog_listing(spark, db).select(
        F.regexp_replace("namespace", "_[0-9a-f]{10}$", "").alias("namespace"), "tableName", "isTemporary",
        F.lit(rows).cast("bigint").alias("n_rows"))


@query("file_audit")
def q_audit(spark, sf):
    """Files of a written CSV folder with sizes and the non-empty check."""
    path = _write_raw_csv(spark, sf)
    return readers.audit_files(spark, path).select(
        F.regexp_replace("path", r"^.*/", "").alias("file"), "bytes", "ok")


@query("load_with_fallback", with_("clean_a", extra=CLEAN_EXTRA) + f"SELECT {CLEAN_COLS} FROM clean_a")
def q_fallback(spark, sf):
    """Missing table -> first CSV folder with files -> cleaned frame."""
    path = _write_raw_csv(spark, sf)
    df, source = readers.load_transactions(spark, f"missing_db_{uuid.uuid4().hex[:6]}.none",
                                           [scratch_path(spark, "empty"), path])
    if not re.match(r"^csv:", source):
        raise RuntimeError(source)
    return _clean_cols(df)


@query("stream_ingest", with_("clean_a", extra=CLEAN_EXTRA) + f"SELECT {CLEAN_COLS} FROM clean_a")
def q_stream(spark, sf):
    """Streaming: raw CSV drops ingested one file per micro-batch; months recomputed per batch."""
    from txlens.streaming.ingest import ingest_available
    src = scratch_path(spark, "stream-src")
    (raw_a(spark, sf).repartitionByRange(4, "TX_DATETIME").write.mode("overwrite")
        .option("header", "true").option("escape", '"').csv(src))
    return _clean_cols(ingest_available(spark, src, max_files_per_trigger=1))
