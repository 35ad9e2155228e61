"""Registered queries: customer behaviour, segments and distributions
(A1, E16, W4-W7, O7, A23, A24, A28-A30, X5)."""

from __future__ import annotations

import math

from txlens.operators import behavior
from txlens.operators.graph import build, degree
from txlens.operators.ordering import chronological_id
from txlens.plans.registry import query, r6
from txlens.plans.sql import AVG2, I64, R, R6, with_
from txlens.sources import adapters as ad

_PROFILE = (f"SELECT CUSTOMER_ID, count(TRANSACTION_ID) AS customer_tx_count, {AVG2('TX_AMOUNT')} AS customer_avg_amount, "
            f"{R('sum(TX_AMOUNT)', 2)} AS total_spent, {R('max(TX_AMOUNT)', 2)} AS max_tx_amount, "
            f"count(DISTINCT TERMINAL_ID) AS unique_terminals_used, {I64('sum(TX_FRAUD)')} AS total_fraud_count "
            "FROM feat_a GROUP BY CUSTOMER_ID")
_GROUPED = ("SELECT *, CASE WHEN total_fraud_count = 0 THEN 'normal' ELSE 'has_fraud' END AS customer_group "
            "FROM profile_a")
EXTRA = {"profile_a": (_PROFILE, ["feat_a"]), "grouped_a": (_GROUPED, ["profile_a"])}


def profile_a(spark, sf):
    return behavior.customer_profile(ad.events_tx(spark, sf))


@query("customer_profile", with_("profile_a", extra=EXTRA) + "SELECT * FROM profile_a")
def q_profile(spark, sf):
    """A1: spending profile of every customer."""
    return profile_a(spark, sf)


@query("customer_group", with_("grouped_a", extra=EXTRA) + "SELECT * FROM grouped_a")
def q_group(spark, sf):
    """Normal vs has-fraud customers."""
    return behavior.customer_group(profile_a(spark, sf))


_Z = ("SELECT TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID, TX_DATETIME, TX_AMOUNT, TX_FRAUD, "
      "avg(TX_AMOUNT) OVER (PARTITION BY CUSTOMER_ID) AS cust_avg, "
      "stddev_samp(TX_AMOUNT) OVER (PARTITION BY CUSTOMER_ID) AS cust_std FROM feat_a")
EXTRA["z_a"] = (_Z, ["feat_a"])


@query("customer_zscore", with_("z_a", extra=EXTRA) +
       f"SELECT TRANSACTION_ID, CUSTOMER_ID, TX_AMOUNT, {R6('cust_avg')} AS cust_avg, {R6('cust_std')} AS cust_std, "
       f"{R6('(TX_AMOUNT - cust_avg) / cust_std')} AS amount_zscore FROM z_a")
def q_zscore(spark, sf):
    """All-time customer mean / stddev and z-score on each row."""
    z = behavior.customer_zscore(ad.events_tx(spark, sf))
    return r6(z.select("TRANSACTION_ID", "CUSTOMER_ID", "TX_AMOUNT", "cust_avg", "cust_std", "amount_zscore"),
              "cust_avg", "cust_std", "amount_zscore")


_SPIKES = ("SELECT * FROM z_a WHERE hour(TX_DATETIME) < 6 AND TX_AMOUNT > cust_avg + 3 * cust_std AND cust_std > 0")
EXTRA["spikes_a"] = (_SPIKES, ["z_a"])


@query("night_spikes", with_("spikes_a", extra=EXTRA) +
       f"SELECT TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, {R6('cust_avg')} AS cust_avg, "
       f"{R6('cust_std')} AS cust_std FROM spikes_a")
def q_spikes(spark, sf):
    """Night transactions above mean + 3 sigma of their customer."""
    s = behavior.night_spikes(ad.events_tx(spark, sf))
    return r6(s.select("TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "cust_avg", "cust_std"),
              "cust_avg", "cust_std")


_SPIKE_CUST = (f"SELECT CUSTOMER_ID, count(TRANSACTION_ID) AS night_spike_tx_count, count(DISTINCT TERMINAL_ID) AS unique_pos_count, "
               f"{R('max(TX_AMOUNT)', 2)} AS max_spike_amount, {R('avg(cust_avg)', 2)} AS normal_avg_amount, "
               f"{I64('sum(TX_FRAUD)')} AS fraud_cases_detected FROM spikes_a GROUP BY CUSTOMER_ID")
EXTRA["spike_cust_a"] = (_SPIKE_CUST, ["spikes_a"])


def _spike_customers_sql(min_terminals: int) -> str:
    return f"SELECT * FROM spike_cust_a WHERE unique_pos_count > {min_terminals}"


@query("night_spike_customers", with_("spike_cust_a", extra=EXTRA) + _spike_customers_sql(1))
def q_spike_customers(spark, sf):
    """Customers with night spikes on more than one terminal."""
    return behavior.night_spike_customers(ad.events_tx(spark, sf), 3.0, 1)


# O7 ranks every customer with a night spike (one terminal or more), so the
# two top-k reports have rows at every scale.
@query("night_spike_top_pos", with_("spike_cust_a", extra=EXTRA) + _spike_customers_sql(0) +
       " ORDER BY unique_pos_count DESC, CUSTOMER_ID ASC LIMIT 10")
def q_top_pos(spark, sf):
    """Top 10 night-spike customers by distinct terminals."""
    return behavior.night_spike_top_pos(ad.events_tx(spark, sf), 10, 3.0, 0)


@query("night_spike_top_amount", with_("spike_cust_a", extra=EXTRA) + _spike_customers_sql(0) +
       " ORDER BY max_spike_amount DESC, CUSTOMER_ID ASC LIMIT 8")
def q_top_amount(spark, sf):
    """Top 8 night-spike customers by spike amount."""
    return behavior.night_spike_top_amount(ad.events_tx(spark, sf), 8, 3.0, 0)


# O7 with the filter of the original (more than one terminal), at two deviations, where the given days have such customers.
_REPEAT = ("SELECT CUSTOMER_ID, count(TRANSACTION_ID) AS night_spike_tx_count, count(DISTINCT TERMINAL_ID) AS unique_pos_count, "
           f"{R('max(TX_AMOUNT)', 2)} AS max_spike_amount, {R('avg(cust_avg)', 2)} AS normal_avg_amount, "
           f"{I64('sum(TX_FRAUD)')} AS fraud_cases_detected FROM z_a WHERE hour(TX_DATETIME) < 6 AND cust_std > 0 "
           "AND TX_AMOUNT > cust_avg + 2 * cust_std GROUP BY CUSTOMER_ID HAVING count(DISTINCT TERMINAL_ID) > 1")
EXTRA["repeat_a"] = (_REPEAT, ["z_a"])


@query("night_spike_repeat_pos", with_("repeat_a", extra=EXTRA) +
       "SELECT * FROM repeat_a ORDER BY unique_pos_count DESC, CUSTOMER_ID ASC LIMIT 10")
def q_repeat_pos(spark, sf):
    """Top 10 of the customers with night spikes on several terminals, by terminals."""
    return behavior.night_spike_top_pos(ad.events_tx(spark, sf), 10, 2.0)


@query("night_spike_repeat_amount", with_("repeat_a", extra=EXTRA) +
       "SELECT * FROM repeat_a ORDER BY max_spike_amount DESC, CUSTOMER_ID ASC LIMIT 8")
def q_repeat_amount(spark, sf):
    """Top 8 of the customers with night spikes on several terminals, by amount."""
    return behavior.night_spike_top_amount(ad.events_tx(spark, sf), 8, 2.0)


def _tercile_sql(src: str, col: str, label: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL "
            f"WHEN {col} <= (SELECT quantile_cont({col}, 1.0/3.0) FROM {src}) THEN 'Low' "
            f"WHEN {col} <= (SELECT quantile_cont({col}, 2.0/3.0) FROM {src}) THEN 'Medium' ELSE 'High' END AS {label}")


_SEG = (f"SELECT *, {_tercile_sql('profile_a', 'customer_tx_count', 'tx_count_group')}, "
        f"{_tercile_sql('profile_a', 'customer_avg_amount', 'avg_amount_group')} FROM profile_a")
EXTRA["seg_a"] = (_SEG, ["profile_a"])


@query("customer_segments", with_("seg_a", extra=EXTRA) + "SELECT * FROM seg_a")
def q_segments(spark, sf):
    """Exact tercile labels on frequency and average amount."""
    return behavior.customer_segments(profile_a(spark, sf))


def _cell(label: str) -> str:
    return R(f"avg(CASE WHEN tx_count_group = '{label}' THEN "
             f"(CASE WHEN total_fraud_count > 0 THEN 1.0 ELSE 0.0 END) END) * 100", 2)


@query("segment_matrix", with_("seg_a", extra=EXTRA) +
       f"SELECT avg_amount_group, {_cell('Low')} AS freq_low, {_cell('Medium')} AS freq_medium, "
       f"{_cell('High')} AS freq_high FROM seg_a GROUP BY avg_amount_group")
def q_matrix(spark, sf):
    """% of customers with fraud per (amount tercile x frequency tercile)."""
    return behavior.segment_matrix(profile_a(spark, sf))


_PER = (f"SELECT CUSTOMER_ID, CAST(datediff('day', max(tx_date), (SELECT max(tx_date) FROM feat_a)) AS INTEGER) AS recency_days, "
        f"count(TRANSACTION_ID) AS frequency, {R('sum(TX_AMOUNT)', 2)} AS monetary FROM feat_a GROUP BY CUSTOMER_ID")
EXTRA["rfm_per"] = (_PER, ["feat_a"])


@query("rfm_segments", with_("rfm_per", extra=EXTRA) + f"""SELECT *, {_tercile_sql('rfm_per', 'recency_days', 'recency_group')},
  {_tercile_sql('rfm_per', 'frequency', 'frequency_group')}, {_tercile_sql('rfm_per', 'monetary', 'monetary_group')}
FROM rfm_per""")
def q_rfm(spark, sf):
    """Recency / frequency / monetary terciles per customer."""
    return behavior.rfm_segments(ad.events_tx(spark, sf))


_CONN = ("SELECT src, count(DISTINCT dst) AS distinct_pos_count FROM edges_a WHERE starts_with(src, 'C_') GROUP BY src")


@query("degree_histogram", with_("edges_a") + f"""SELECT bin, {R6('lo + bin * w')} AS bin_start,
  {R6('lo + (bin + 1) * w')} AS bin_end, n FROM (
  SELECT b.bin, s.lo, s.w, count(*) AS n FROM (
    SELECT CAST(CASE WHEN s.hi = s.lo THEN 0 ELSE least(floor((c.distinct_pos_count - s.lo) / s.w), 29) END AS INTEGER) AS bin
    FROM ({_CONN}) c, (SELECT CAST(min(distinct_pos_count) AS DOUBLE) AS lo, CAST(max(distinct_pos_count) AS DOUBLE) AS hi,
       (CAST(max(distinct_pos_count) AS DOUBLE) - CAST(min(distinct_pos_count) AS DOUBLE)) / 30 AS w FROM ({_CONN}) c2) s) b,
    (SELECT CAST(min(distinct_pos_count) AS DOUBLE) AS lo,
       (CAST(max(distinct_pos_count) AS DOUBLE) - CAST(min(distinct_pos_count) AS DOUBLE)) / 30 AS w FROM ({_CONN}) c3) s
  GROUP BY b.bin, s.lo, s.w) h""")
def q_hist(spark, sf):
    """30-bin histogram of distinct terminals per customer."""
    conn = degree.customer_connections(build.graph_edges(ad.events_tx(spark, sf)))
    return r6(behavior.histogram(conn, "distinct_pos_count", 30), "bin_start", "bin_end")


@query("boxplot_stats", with_("grouped_a", extra=EXTRA) + f"""SELECT customer_group, {R6('q1')} AS q1, {R6('median')} AS median,
  {R6('q3')} AS q3, {R6('q3 - q1')} AS iqr, {R6('whisker_low')} AS whisker_low, {R6('whisker_high')} AS whisker_high,
  n_outliers, n FROM (
  SELECT g.customer_group, q.q1, q.median, q.q3,
    min(CASE WHEN v >= q.q1 - 1.5 * (q.q3 - q.q1) AND v <= q.q3 + 1.5 * (q.q3 - q.q1) THEN v END) AS whisker_low,
    max(CASE WHEN v >= q.q1 - 1.5 * (q.q3 - q.q1) AND v <= q.q3 + 1.5 * (q.q3 - q.q1) THEN v END) AS whisker_high,
    {I64('sum(CASE WHEN v >= q.q1 - 1.5 * (q.q3 - q.q1) AND v <= q.q3 + 1.5 * (q.q3 - q.q1) THEN 0 ELSE 1 END)')} AS n_outliers,
    count(*) AS n
  FROM (SELECT customer_group, CAST(customer_tx_count AS DOUBLE) AS v FROM grouped_a) g
  JOIN (SELECT customer_group, quantile_cont(customer_tx_count, 0.25) AS q1, quantile_cont(customer_tx_count, 0.5) AS median,
          quantile_cont(customer_tx_count, 0.75) AS q3 FROM grouped_a GROUP BY customer_group) q
    ON g.customer_group IS NOT DISTINCT FROM q.customer_group
  GROUP BY g.customer_group, q.q1, q.median, q.q3) b""")
def q_box(spark, sf):
    """Box-plot data of transactions per customer, by customer group."""
    grouped = behavior.customer_group(profile_a(spark, sf))
    out = behavior.boxplot_stats(grouped, "customer_tx_count", "customer_group")
    return r6(out, "q1", "median", "q3", "iqr", "whisker_low", "whisker_high")


@query("density_curve", with_("grouped_a", extra=EXTRA) + f""", st AS (
  SELECT customer_group, count(*) AS n, stddev_samp(customer_avg_amount) * pow(count(*), -0.2) AS bw,
         min(customer_avg_amount) AS vmin, max(customer_avg_amount) AS vmax
  FROM grouped_a WHERE customer_avg_amount IS NOT NULL GROUP BY customer_group),
st2 AS (SELECT *, vmin - 3.0 * bw AS gmin, vmax + 3.0 * bw AS gmax FROM st WHERE bw > 0 AND vmax > vmin),
grid AS (SELECT st2.*, CAST(g.gi AS INTEGER) AS gi, gmin + g.gi * (gmax - gmin) / 199 AS x FROM st2, range(200) g(gi))
SELECT grid.customer_group, grid.gi, {R6('grid.x')} AS x,
  {R6(f'sum(exp(-0.5 * pow((grid.x - a.customer_avg_amount) / grid.bw, 2)) / (grid.bw * {math.sqrt(2 * math.pi)!r} * grid.n))')} AS density
FROM grid JOIN grouped_a a ON a.customer_group IS NOT DISTINCT FROM grid.customer_group AND a.customer_avg_amount IS NOT NULL
GROUP BY grid.customer_group, grid.gi, grid.x
UNION ALL SELECT customer_group, 0, {R6('vmin')}, NULL FROM st WHERE NOT coalesce(bw > 0 AND vmax > vmin, false)""")
def q_density(spark, sf):
    """Gaussian KDE (200 points, Scott bandwidth) of average amount per group."""
    grouped = behavior.customer_group(profile_a(spark, sf))
    return r6(behavior.density_curve(grouped, "customer_avg_amount", "customer_group"), "x", "density")


@query("chronological_id", with_("tx_a") +
       "SELECT TRANSACTION_ID, TX_DATETIME, row_number() OVER (ORDER BY TX_DATETIME, TRANSACTION_ID) - 1 AS TX_INDEX FROM tx_a")
def q_chrono(spark, sf):
    """0-based chronological surrogate id (distributed, no single-partition window)."""
    return chronological_id(ad.events_base(spark, sf).select("TRANSACTION_ID", "TX_DATETIME"))
