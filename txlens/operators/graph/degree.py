"""Degrees, connection outliers and terminal risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import pct
from txlens.operators.skew import attach_group_stats
from txlens.schema import CUSTOMER_PREFIX, TERMINAL_PREFIX


def in_degrees(edges: DataFrame, prefix: str | None = TERMINAL_PREFIX) -> DataFrame:
    """In-degree per vertex (plain groupBy on dst), optionally only one vertex kind."""
    e = edges.select("dst")
    if prefix:
        e = e.filter(F.col("dst").startswith(prefix))
    return e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))


def top_in_degree(edges: DataFrame, n: int = 10) -> DataFrame:
    """The n busiest terminals (id breaks ties for a stable answer)."""
    return in_degrees(edges).orderBy(F.desc("inDegree"), F.asc("id")).limit(n)


def customer_connections(edges: DataFrame) -> DataFrame:
    """Per customer: transactions, distinct terminals, amount, frauds."""
    return (edges.filter(F.col("src").startswith(CUSTOMER_PREFIX))
                 .groupBy("src")
                 .agg(F.count("TRANSACTION_ID").alias("total_transactions"),
                      F.count_distinct("dst").alias("distinct_pos_count"),
                      F.sum("TX_AMOUNT").alias("total_amount"),
                      F.sum("TX_FRAUD").alias("fraud_tx_count")))


def connection_stats(conn: DataFrame) -> DataFrame:
    """Mean and sample stddev of distinct terminals and of transactions (one row)."""
    return conn.agg(F.avg("distinct_pos_count").alias("avg_pos"),
                    F.stddev_samp("distinct_pos_count").alias("std_pos"),
                    F.avg("total_transactions").alias("avg_tx"),
                    F.stddev_samp("total_transactions").alias("std_tx"))


def degree_outliers(conn: DataFrame, k: float = 3.0) -> DataFrame:
    """Customers beyond mean + k*sigma on either measure, with z-score (2 dp).

    The four statistics are one global aggregate (one row) brought to the
    driver once and used as literals — no cross join.
    """
    st = connection_stats(conn).first()
    avg_pos, std_pos, avg_tx, std_tx = (F.lit(st[c]).cast("double") for c in ("avg_pos", "std_pos", "avg_tx", "std_tx"))
    out = conn.filter((F.col("distinct_pos_count") > avg_pos + F.lit(k) * std_pos)
                      | (F.col("total_transactions") > avg_tx + F.lit(k) * std_tx))
    z = F.round(F.try_divide(F.col("distinct_pos_count") - avg_pos, std_pos), 2)
    return out.select("*", z.alias("z_score_pos")).orderBy(
        F.desc("distinct_pos_count"), F.desc("z_score_pos"), F.asc("src"))


def terminal_risk(edges: DataFrame) -> DataFrame:
    """Per terminal: transactions, frauds, rate %, amount, fraud amount."""
    return (edges.filter(F.col("dst").startswith(TERMINAL_PREFIX))
                 .groupBy("dst")
                 .agg(F.count("TRANSACTION_ID").alias("total_tx"),
                      F.sum("TX_FRAUD").alias("fraud_tx_count"),
                      pct(F.sum("TX_FRAUD"), F.count("TRANSACTION_ID"), 2).alias("fraud_rate_pct"),
                      F.sum("TX_AMOUNT").alias("total_amount"),
                      F.sum(F.col("TX_AMOUNT") * F.col("TX_FRAUD")).alias("fraud_amount")))


def high_risk_terminals(edges: DataFrame, min_fraud: int = 5, min_rate: float = 15.0) -> DataFrame:
    """Terminals with >= min_fraud frauds or rate % > min_rate, riskiest first."""
    return (terminal_risk(edges)
            .filter((F.col("fraud_tx_count") >= min_fraud) | (F.col("fraud_rate_pct") > min_rate))
            .orderBy(F.desc("fraud_tx_count"), F.desc("fraud_rate_pct"), F.asc("dst")))


def high_risk_subgraph_edges(edges: DataFrame, min_fraud: int = 5, min_rate: float = 15.0) -> DataFrame:
    """Only the edges into high-risk terminals (all vertices kept).

    Each edge gets its terminal's counts; a hot terminal is split over tasks."""
    into = attach_group_stats(edges.filter(F.col("dst").startswith(TERMINAL_PREFIX)), ["dst"],
                              {"_tx": F.count("TRANSACTION_ID"), "_frauds": F.sum("TX_FRAUD")})
    risky = (F.col("_frauds") >= min_fraud) | (pct("_frauds", "_tx", 2) > min_rate)
    return into.filter(risky).select(*edges.columns)
