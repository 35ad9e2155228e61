"""Registered queries: fraud-rate trends and daily/monthly reports."""

from __future__ import annotations

from txlens.operators import trends
from txlens.plans.registry import query, r6
from txlens.plans.sql import AVG2, I64, R, R6, with_
from txlens.sources import adapters as ad


def _rate_sql(src: str, key: str, with_amount: bool = True, with_ratio: bool = True, order: str | None = None) -> str:
    cols = [key, "count(*) AS total_transactions", f"{I64('sum(TX_FRAUD)')} AS fraud_transactions"]
    if with_amount:
        cols.append(f"{AVG2('TX_AMOUNT')} AS avg_tx_amount")
    if with_ratio:
        cols.append(f"{R('sum(TX_FRAUD) / count(*)', 4)} AS fraud_rate")
    cols.append(f"{R('sum(TX_FRAUD) / count(*) * 100', 2)} AS fraud_rate_pct")
    return f"SELECT {', '.join(cols)} FROM {src} GROUP BY {key}"


@query("fraud_rate_hourly", with_("feat_a") + _rate_sql("feat_a", "tx_hour"))
def q_hourly(spark, sf):
    """A2 on mapping A (time of day)."""
    return trends.fraud_rate_hourly(ad.events_tx(spark, sf))


@query("fraud_rate_weekday", with_("feat_b") +
       "SELECT *, CAST(list_position(['Mon','Tue','Wed','Thu','Fri','Sat','Sun'], tx_day_of_week) AS INTEGER) AS day_order "
       "FROM (" + _rate_sql("feat_b", "tx_day_of_week") + ") r")
def q_weekday(spark, sf):
    """A3 on mapping B (all weekdays over 83 months)."""
    return trends.fraud_rate_weekday(ad.lineitem_tx(spark, sf))


@query("fraud_rate_daily", with_("feat_b") + _rate_sql("feat_b", "tx_date", False, False))
def q_daily(spark, sf):
    """A4 on mapping B."""
    return trends.fraud_rate_daily(ad.lineitem_tx(spark, sf))


@query("fraud_rate_daily_mean", with_("feat_b") +
       f"SELECT {R6('avg(fraud_rate_pct)')} AS mean_daily_fraud_rate_pct, count(*) AS n_days FROM ("
       + _rate_sql("feat_b", "tx_date", False, False) + ") d")
def q_daily_mean(spark, sf):
    """A5: mean of the daily fraud rate %."""
    return r6(trends.fraud_rate_daily_mean(ad.lineitem_tx(spark, sf)), "mean_daily_fraud_rate_pct")


@query("fraud_rate_peak", with_("feat_a") + "SELECT * FROM (" + _rate_sql("feat_a", "tx_hour") +
       ") h ORDER BY fraud_rate_pct DESC NULLS LAST, tx_hour ASC LIMIT 1")
def q_peak(spark, sf):
    """A5: the peak hour (first on ties)."""
    return trends.fraud_rate_peak(ad.events_tx(spark, sf))


@query("monthly_summary", with_("feat_b") +
       f"""SELECT tx_year_month, count(*) AS total_transactions, count(DISTINCT CUSTOMER_ID) AS unique_customers,
  count(DISTINCT TERMINAL_ID) AS unique_terminals,
  {I64("sum(CASE WHEN TX_FRAUD = 1 THEN 1 ELSE 0 END)")} AS total_fraud_tx,
  {AVG2('TX_AMOUNT')} AS avg_tx_amount, min(tx_date) AS earliest_date, max(tx_date) AS latest_date
FROM feat_b GROUP BY tx_year_month""")
def q_monthly(spark, sf):
    """The month report of the import check, on mapping B."""
    return trends.monthly_summary(ad.lineitem_tx(spark, sf))


_DAILY_SQL = (f"SELECT TX_TIME_DAYS, count(CUSTOMER_ID) AS nb_tx_per_day, {I64('sum(TX_FRAUD)')} AS nb_fraud_per_day, "
              "count(DISTINCT CASE WHEN TX_FRAUD > 0 THEN CUSTOMER_ID END) AS nb_fraudcard_per_day "
              "FROM feat_a GROUP BY TX_TIME_DAYS")


@query("daily_fraud_stats", with_("feat_a") + _DAILY_SQL)
def q_daily_stats(spark, sf):
    """A20 on mapping A."""
    return trends.daily_fraud_stats(ad.events_tx(spark, sf))


@query("daily_stats_long", with_("feat_a") +
       f"SELECT TX_TIME_DAYS, 'nb_tx_per_day' AS stat_type, {R6('nb_tx_per_day / 50.0')} AS value FROM ({_DAILY_SQL}) d "
       f"UNION ALL SELECT TX_TIME_DAYS, 'nb_fraud_per_day', CAST(nb_fraud_per_day AS DOUBLE) FROM ({_DAILY_SQL}) d "
       f"UNION ALL SELECT TX_TIME_DAYS, 'nb_fraudcard_per_day', CAST(nb_fraudcard_per_day AS DOUBLE) FROM ({_DAILY_SQL}) d")
def q_daily_long(spark, sf):
    """The three daily series in long form."""
    return r6(trends.daily_stats_long(ad.events_tx(spark, sf)), "value")


@query("fraud_totals", with_("feat_a") +
       f"SELECT count(*) AS n_rows, {I64('sum(TX_FRAUD)')} AS n_fraud, {R('avg(TX_FRAUD)', 6)} AS fraud_share FROM feat_a")
def q_fraud_totals(spark, sf):
    """Global fraud count and share."""
    return trends.fraud_totals(ad.events_tx(spark, sf))
