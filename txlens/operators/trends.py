"""Fraud-rate trends and daily/monthly reports.

All are hash aggregates: partial aggregation happens map-side, so a hot
hour/day/month key costs one partial row per task, never a skewed task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import money_avg, pct, ratio, weekday_number
from txlens.functions.stats import one_row


def fraud_rate_by(df: DataFrame, key: str, with_amount: bool = True, with_ratio: bool = True) -> DataFrame:
    """total / fraud counts, avg amount (2 dp), rate (4 dp), rate % (2 dp) per key."""
    aggs = [F.count(F.lit(1)).alias("total_transactions"),
            F.sum("TX_FRAUD").alias("fraud_transactions")]
    if with_amount:
        aggs.append(money_avg("TX_AMOUNT").alias("avg_tx_amount"))
    out = df.groupBy(key).agg(*aggs)
    cols = ["*"]
    if with_ratio:
        cols.append(F.round(ratio("fraud_transactions", "total_transactions"), 4).alias("fraud_rate"))
    cols.append(pct("fraud_transactions", "total_transactions", 2).alias("fraud_rate_pct"))
    return out.select(*cols)


def fraud_rate_hourly(df: DataFrame) -> DataFrame:
    """A2: rate by hour of day, ordered by hour."""
    return fraud_rate_by(df, "tx_hour").orderBy("tx_hour")


def fraud_rate_weekday(df: DataFrame) -> DataFrame:
    """A3: rate by weekday, ordered Mon..Sun (explicit day number column)."""
    out = fraud_rate_by(df, "tx_day_of_week")
    return (out.select("*", weekday_number("tx_day_of_week").alias("day_order"))
               .orderBy("day_order"))


def fraud_rate_daily(df: DataFrame) -> DataFrame:
    """A4: rate by calendar date (no amount / plain ratio), ordered by date."""
    return fraud_rate_by(df, "tx_date", with_amount=False, with_ratio=False).orderBy("tx_date")


def fraud_rate_daily_mean(df: DataFrame) -> DataFrame:
    """A5: mean of the daily rate % — the reference line of the daily chart."""
    daily = fraud_rate_by(df, "tx_date", with_amount=False, with_ratio=False)
    return daily.agg(F.avg("fraud_rate_pct").alias("mean_daily_fraud_rate_pct"),
                     F.count(F.lit(1)).alias("n_days"))


def fraud_rate_peak(df: DataFrame) -> DataFrame:
    """A5: the hour with the highest rate % (first hour on ties, like idxmax)."""
    hourly = fraud_rate_by(df, "tx_hour")
    return hourly.orderBy(F.desc_nulls_last("fraud_rate_pct"), F.asc("tx_hour")).limit(1)


def monthly_summary(df: DataFrame) -> DataFrame:
    """Per month rows, distinct customers/terminals, fraud rows, avg, first/last date."""
    return (df.groupBy("tx_year_month")
              .agg(F.count(F.lit(1)).alias("total_transactions"),
                   F.count_distinct("CUSTOMER_ID").alias("unique_customers"),
                   F.count_distinct("TERMINAL_ID").alias("unique_terminals"),
                   F.sum(F.when(F.col("TX_FRAUD") == 1, 1).otherwise(0)).cast("bigint").alias("total_fraud_tx"),
                   money_avg("TX_AMOUNT").alias("avg_tx_amount"),
                   F.min("tx_date").alias("earliest_date"),
                   F.max("tx_date").alias("latest_date"))
              .orderBy("tx_year_month"))


def daily_fraud_stats(df: DataFrame) -> DataFrame:
    """Per simulation day: transactions, frauds, distinct defrauded cards."""
    return (df.groupBy("TX_TIME_DAYS")
              .agg(F.count("CUSTOMER_ID").alias("nb_tx_per_day"),
                   F.sum("TX_FRAUD").alias("nb_fraud_per_day"),
                   F.count_distinct(F.when(F.col("TX_FRAUD") > 0, F.col("CUSTOMER_ID"))).alias("nb_fraudcard_per_day"))
              .orderBy("TX_TIME_DAYS"))


def daily_stats_long(df: DataFrame, tx_scale: float = 50.0) -> DataFrame:
    """The three daily series stacked long (transactions scaled by 1/50)."""
    wide = daily_fraud_stats(df).select(
        "TX_TIME_DAYS",
        (F.col("nb_tx_per_day") / F.lit(tx_scale)).alias("nb_tx_per_day"),
        F.col("nb_fraud_per_day").cast("double").alias("nb_fraud_per_day"),
        F.col("nb_fraudcard_per_day").cast("double").alias("nb_fraudcard_per_day"),
    )
    return wide.unpivot("TX_TIME_DAYS",
                        ["nb_tx_per_day", "nb_fraud_per_day", "nb_fraudcard_per_day"],
                        "stat_type", "value")


def scenario_counts(df: DataFrame) -> DataFrame:
    """Rows and frauds per fraud scenario, with the share of all rows."""
    out = df.groupBy("TX_FRAUD_SCENARIO").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("TX_FRAUD").alias("n_fraud"),
        money_avg("TX_AMOUNT").alias("avg_tx_amount"))
    total = F.lit(one_row(df, F.count(F.lit(1)))[0])
    return out.select("*", F.round(ratio("n_rows", total), 6).alias("share")).orderBy("TX_FRAUD_SCENARIO")


def fraud_totals(df: DataFrame) -> DataFrame:
    """Global fraud sum and mean (share of fraudulent rows)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum("TX_FRAUD").alias("n_fraud"),
                  F.round(F.avg("TX_FRAUD"), 6).alias("fraud_share"))
