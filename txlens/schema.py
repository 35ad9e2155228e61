"""Data model: raw CSV columns, the 18-column cleaned table, ML features."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values that must equal the reference's for right results ------
RAW_COLUMNS = [
    "TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT",
    "TX_TIME_SECONDS", "TX_TIME_DAYS", "TX_FRAUD", "TX_FRAUD_SCENARIO",
]
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FORMAT = "yyyy-MM"
BAD_ID_MARKER = "#VALUE!"
WEEKEND_DAYS = ["Sat", "Sun"]
WEEKDAY_ORDER = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
NIGHT_HOURS = (0, 6)  # 0 <= hour < 6
CUSTOMER_PREFIX = "C_"
TERMINAL_PREFIX = "T_"
CUSTOMER_TYPE = "Customer"
TERMINAL_TYPE = "Terminal"
PARTITION_COLUMN = "tx_year_month"
ML_FEATURES = [
    "TX_AMOUNT", "TX_TIME_SECONDS", "tx_hour", "is_weekend", "is_night",
    "customer_tx_count", "customer_avg_amount", "terminal_tx_count",
]
LABEL = "TX_FRAUD"
WEIGHT = "class_weight"
# --------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BASE_SCHEMA = T.StructType([
    T.StructField("TRANSACTION_ID", T.LongType()),
    T.StructField("TX_DATETIME", T.TimestampType()),
    T.StructField("CUSTOMER_ID", T.LongType()),
    T.StructField("TERMINAL_ID", T.LongType()),
    T.StructField("TX_AMOUNT", T.DoubleType()),
    T.StructField("TX_TIME_SECONDS", T.LongType()),
    T.StructField("TX_TIME_DAYS", T.IntegerType()),
    T.StructField("TX_FRAUD", T.IntegerType()),
    T.StructField("TX_FRAUD_SCENARIO", T.IntegerType()),
])

CLEANED_SCHEMA = T.StructType(list(BASE_SCHEMA.fields) + [
    T.StructField("tx_date", T.DateType()),
    T.StructField("tx_year_month", T.StringType()),
    T.StructField("tx_hour", T.IntegerType()),
    T.StructField("tx_day_of_week", T.StringType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("is_night", T.IntegerType()),
    T.StructField("customer_tx_count", T.LongType()),
    T.StructField("customer_avg_amount", T.DoubleType()),
    T.StructField("terminal_tx_count", T.LongType()),
])

CLEANED_COLUMNS = [f.name for f in CLEANED_SCHEMA.fields]
BASE_COLUMNS = [f.name for f in BASE_SCHEMA.fields]

# Partitioned external-table DDL of the cleaned table (K7).
CLEANED_TABLE_DDL = """
CREATE TABLE IF NOT EXISTS {table} (
  TRANSACTION_ID BIGINT, TX_DATETIME TIMESTAMP, CUSTOMER_ID BIGINT, TERMINAL_ID BIGINT,
  TX_AMOUNT DOUBLE, TX_TIME_SECONDS BIGINT, TX_TIME_DAYS INT, TX_FRAUD INT,
  TX_FRAUD_SCENARIO INT, tx_date DATE, tx_hour INT, tx_day_of_week STRING,
  is_weekend INT, is_night INT, customer_tx_count BIGINT, customer_avg_amount DOUBLE,
  terminal_tx_count BIGINT, tx_year_month STRING)
USING PARQUET
PARTITIONED BY (tx_year_month)
LOCATION '{location}'
"""
