"""Registered queries: cleaning job and monthly features."""

from __future__ import annotations

from txlens.operators import clean
from txlens.plans.registry import query, r6
from txlens.plans.sql import R6, features_sql, with_
from txlens.sources import adapters as ad

_RAW_A = "SELECT CAST(TRANSACTION_ID AS VARCHAR) AS TRANSACTION_ID, strftime(TX_DATETIME, '%Y-%m-%d %H:%M:%S') AS TX_DATETIME, " \
         "CAST(CUSTOMER_ID AS VARCHAR) AS CUSTOMER_ID, CAST(TERMINAL_ID AS VARCHAR) AS TERMINAL_ID, " \
         "CAST(TX_AMOUNT AS VARCHAR) AS TX_AMOUNT, CAST(TX_TIME_SECONDS AS VARCHAR) AS TX_TIME_SECONDS, " \
         "CAST(TX_TIME_DAYS AS VARCHAR) AS TX_TIME_DAYS, CAST(TX_FRAUD AS VARCHAR) AS TX_FRAUD, " \
         "CAST(TX_FRAUD_SCENARIO AS VARCHAR) AS TX_FRAUD_SCENARIO FROM tx_a"
# the share of spoiled text, by the number in the id
_DIRTY_A = """SELECT
  CASE event_id % 97 WHEN 1 THEN '#VALUE!' WHEN 2 THEN NULL WHEN 3 THEN 'abc' || TRANSACTION_ID
    WHEN 4 THEN TRANSACTION_ID || '.0' WHEN 5 THEN '  ' || TRANSACTION_ID || ' ' WHEN 6 THEN '1e3'
    ELSE TRANSACTION_ID END AS TRANSACTION_ID,
  CASE event_id % 83 WHEN 1 THEN 'not a date' ELSE TX_DATETIME END AS TX_DATETIME, CUSTOMER_ID, TERMINAL_ID,
  CASE event_id % 89 WHEN 2 THEN 'n/a' WHEN 3 THEN '' ELSE TX_AMOUNT END AS TX_AMOUNT,
  CASE event_id % 89 WHEN 6 THEN TX_TIME_SECONDS || '.9' ELSE TX_TIME_SECONDS END AS TX_TIME_SECONDS,
  CASE event_id % 89 WHEN 4 THEN TX_TIME_DAYS || '.0' WHEN 5 THEN '.5' ELSE TX_TIME_DAYS END AS TX_TIME_DAYS,
  CASE event_id % 89 WHEN 1 THEN TX_FRAUD || '.0' ELSE TX_FRAUD END AS TX_FRAUD,
  CASE event_id % 89 WHEN 7 THEN 'x' ELSE TX_FRAUD_SCENARIO END AS TX_FRAUD_SCENARIO
FROM (SELECT *, CAST(TRANSACTION_ID AS BIGINT) AS event_id FROM pure_a) p"""
_EXTRA = {"pure_a": (_RAW_A, ["tx_a"]), "raw_a": (_DIRTY_A, ["pure_a"])}


def _whole(c: str, kind: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\s*[+-]?\\.[0-9]+\\s*') THEN CAST(0 AS {kind}) ELSE TRY_CAST(nullif("
            f"regexp_extract({c}, '^\\s*([+-]?[0-9]+)(\\.[0-9]*)?\\s*$', 1), '') AS {kind}) END AS {c}")


# ids that are still no number are dropped
_TYPED_A = (f"SELECT * FROM (SELECT {_whole('TRANSACTION_ID', 'BIGINT')}, "
            f"try_strptime(TX_DATETIME, '%Y-%m-%d %H:%M:%S') AS TX_DATETIME, {_whole('CUSTOMER_ID', 'BIGINT')}, "
            f"{_whole('TERMINAL_ID', 'BIGINT')}, TRY_CAST(TX_AMOUNT AS DOUBLE) AS TX_AMOUNT, "
            f"{_whole('TX_TIME_SECONDS', 'BIGINT')}, {_whole('TX_TIME_DAYS', 'INTEGER')}, {_whole('TX_FRAUD', 'INTEGER')}, "
            f"{_whole('TX_FRAUD_SCENARIO', 'INTEGER')} FROM raw_a WHERE raw_a.TRANSACTION_ID IS NOT NULL "
            "AND raw_a.TRANSACTION_ID <> '#VALUE!') t WHERE TRANSACTION_ID IS NOT NULL")
_EXTRA["typed_a"] = (_TYPED_A, ["raw_a"])
_FILLED_A = ("SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, COALESCE(TX_AMOUNT, 0.0) AS TX_AMOUNT, "
             "COALESCE(TX_TIME_SECONDS, 0) AS TX_TIME_SECONDS, COALESCE(TX_TIME_DAYS, 0) AS TX_TIME_DAYS, "
             "COALESCE(TX_FRAUD, 0) AS TX_FRAUD, COALESCE(TX_FRAUD_SCENARIO, 0) AS TX_FRAUD_SCENARIO FROM typed_a")
_EXTRA["filled_a"] = (_FILLED_A, ["typed_a"])
_EXTRA["clean_a"] = (features_sql("filled_a"), ["filled_a"])

CLEAN_COLS = ("TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS, "
              "TX_FRAUD, TX_FRAUD_SCENARIO, tx_date, tx_year_month, tx_hour, tx_day_of_week, is_weekend, is_night, "
              "customer_tx_count, " + R6("customer_avg_amount") + " AS customer_avg_amount, terminal_tx_count")


def raw_a(spark, sf):
    return ad.with_dirt(ad.raw_from_events(ad.read_table(spark, sf, "events")))


@query("clean_rows", with_("raw_a", extra=_EXTRA) +
       "SELECT * FROM raw_a WHERE TRANSACTION_ID IS NOT NULL AND TRANSACTION_ID <> '#VALUE!'")
def q_clean_rows(spark, sf):
    """E1 over mapping A in its raw text layout."""
    return clean.filter_valid_ids(raw_a(spark, sf))


@query("typed_cast", with_("typed_a", extra=_EXTRA) + "SELECT * FROM typed_a")
def q_typed_cast(spark, sf):
    """Text -> typed columns (try_cast / try_to_timestamp)."""
    return clean.cast_types(clean.filter_valid_ids(raw_a(spark, sf)))


@query("null_defaults", with_("filled_a", extra=_EXTRA) + "SELECT * FROM filled_a")
def q_null_defaults(spark, sf):
    """E5: NULL -> defaults after the casts."""
    return clean.parse_raw(raw_a(spark, sf))


@query("calendar_parts", with_("tx_a") +
       "SELECT TRANSACTION_ID, CAST(TX_DATETIME AS DATE) AS tx_date, strftime(TX_DATETIME, '%Y-%m') AS tx_year_month, "
       "CAST(hour(TX_DATETIME) AS INTEGER) AS tx_hour, strftime(TX_DATETIME, '%a') AS tx_day_of_week FROM tx_a")
def q_calendar_parts(spark, sf):
    """E4 over mapping A."""
    return clean.add_calendar(ad.events_base(spark, sf)).select(
        "TRANSACTION_ID", "tx_date", "tx_year_month", "tx_hour", "tx_day_of_week")


@query("risk_flags", with_("feat_a") + "SELECT TRANSACTION_ID, tx_hour, tx_day_of_week, is_weekend, is_night FROM feat_a")
def q_risk_flags(spark, sf):
    """E6 over mapping A."""
    return clean.add_risk_flags(clean.add_calendar(ad.events_base(spark, sf))).select(
        "TRANSACTION_ID", "tx_hour", "tx_day_of_week", "is_weekend", "is_night")


@query("clean_transactions", with_("clean_a", extra=_EXTRA) + f"SELECT {CLEAN_COLS} FROM clean_a")
def q_clean_transactions(spark, sf):
    """The whole cleaning job on the raw text layout of mapping A (18 columns)."""
    return r6(clean.clean_transactions(raw_a(spark, sf)), "customer_avg_amount")


@query("customer_month_features", with_("feat_b") +
       f"SELECT TRANSACTION_ID, tx_year_month, CUSTOMER_ID, customer_tx_count, {R6('customer_avg_amount')} AS customer_avg_amount FROM feat_b")
def q_customer_month_features(spark, sf):
    """W1/W2 on mapping B (83 months)."""
    df = ad.lineitem_tx(spark, sf, True).select("TRANSACTION_ID", "tx_year_month", "CUSTOMER_ID",
                                          "customer_tx_count", "customer_avg_amount")
    return r6(df, "customer_avg_amount")


@query("terminal_month_features", with_("feat_b") +
       "SELECT TRANSACTION_ID, tx_year_month, TERMINAL_ID, terminal_tx_count FROM feat_b")
def q_terminal_month_features(spark, sf):
    """W3 on mapping B."""
    return ad.lineitem_tx(spark, sf, True).select("TRANSACTION_ID", "tx_year_month", "TERMINAL_ID", "terminal_tx_count")


@query("reject_rows", with_("raw_a", extra=_EXTRA) +
       "SELECT *, CASE WHEN TRANSACTION_ID IS NULL THEN 'null_id' WHEN TRANSACTION_ID = '#VALUE!' THEN 'error_marker' "
       "ELSE 'non_numeric_id' END AS reject_reason FROM raw_a WHERE TRANSACTION_ID IS NULL OR TRANSACTION_ID = '#VALUE!' "
       "OR NOT regexp_full_match(TRANSACTION_ID, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)\\s*')")
def q_reject_rows(spark, sf):
    """Audit side output of the cleaning job (rows it drops)."""
    return clean.reject_rows(raw_a(spark, sf))

