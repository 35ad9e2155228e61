"""Fraud-scenario labelling (J7, J8, J9) as joins instead of per-day loops.

Inputs are the transactions and the compromise windows as tables:
terminal windows (TERMINAL_ID, day) and customer windows (CUSTOMER_ID, day).
A window covers days [day, day + length).  Windows are not unfolded into days: time is cut into spans of the
windows' length, an interval is known to each span that it touches (two for a single window), and a transaction
looks in its own span.  Terminal windows are first merged to disjoint intervals, so a transaction meets
at most two of its terminal's rows.  A hot (terminal, span) is dealt over tasks (``skew.grid_join``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.functions.stats import one_row
from txlens.operators.selection import first_rows
from txlens.operators.skew import CELL_ROWS, salted_lookup

# --- fixed values of the reference's fraud scenarios ------------------------
AMOUNT_THRESHOLD = 220.0
TERMINAL_WINDOW_DAYS = 28
CUSTOMER_WINDOW_DAYS = 14
CARD_FRAUD_SHARE_DIVISOR = 3
CARD_FRAUD_AMOUNT_FACTOR = 5.0
# -----------------------------------------------------------------------------


def merged_windows(windows: DataFrame, id_col: str, length: int) -> DataFrame:
    """Disjoint intervals (id, start, end) that cover the same days as the windows [day, day + length)."""
    days = windows.select(id_col, F.col("day").cast("bigint").alias("start")).filter(
        F.col(id_col).isNotNull() & F.col("start").isNotNull()).distinct()
    order = Window.partitionBy(id_col).orderBy("start")                       # one row per day of an id at most
    gap = F.col("start") > F.lag("start").over(order) + F.lit(length)
    island = F.sum(F.when(gap, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (days.withColumn("_island", island).groupBy(id_col, "_island")
            .agg(F.min("start").alias("start"), (F.max("start") + F.lit(length)).alias("end")).drop("_island"))


def _by_span(intervals: DataFrame, length: int) -> DataFrame:
    """Intervals once per span of ``length`` days that they touch."""
    return intervals.withColumn("_span", F.explode(F.sequence(
        F.floor(F.col("start") / F.lit(length)), F.floor((F.col("end") - 1) / F.lit(length)))))


def label_amount(tx: DataFrame, threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """Amount > threshold -> fraud, scenario 1 (on top of existing labels)."""
    hit = F.col("TX_AMOUNT") > F.lit(threshold)
    return tx.withColumns({
        "TX_FRAUD": F.when(hit, F.lit(1)).otherwise(F.col("TX_FRAUD")),
        "TX_FRAUD_SCENARIO": F.when(hit, F.lit(1)).otherwise(F.col("TX_FRAUD_SCENARIO")),
    })


def label_terminal_compromise(tx: DataFrame, windows: DataFrame, length: int = TERMINAL_WINDOW_DAYS,
                              cell_rows: int = CELL_ROWS) -> DataFrame:
    """Rows on a compromised terminal inside its window -> fraud, scenario 2."""
    spans = _by_span(merged_windows(windows, "TERMINAL_ID", length), length)
    # the intervals of a span as one short list (two at most): one row per (terminal, span) to meet
    lists = spans.groupBy("TERMINAL_ID", "_span").agg(F.collect_list(F.struct("start", "end")).alias("_open"))
    at = tx.withColumn("_span", F.floor(F.col("TX_TIME_DAYS") / F.lit(length)))
    j = salted_lookup(at, lists, ["TERMINAL_ID", "_span"], cell_rows)
    inside = F.exists("_open", lambda w: (w["start"] <= F.col("TX_TIME_DAYS")) & (F.col("TX_TIME_DAYS") < w["end"]))
    j = j.withColumn("_hit", F.when(inside, True))
    hit = F.col("_hit").isNotNull()
    return j.withColumns({
        "TX_FRAUD": F.when(hit, F.lit(1)).otherwise(F.col("TX_FRAUD")),
        "TX_FRAUD_SCENARIO": F.when(hit, F.lit(2)).otherwise(F.col("TX_FRAUD_SCENARIO")),
    }).drop("_hit").select(*tx.columns)


def card_compromise_picks(tx: DataFrame, windows: DataFrame, order: list[Column],
                          length: int = CUSTOMER_WINDOW_DAYS) -> DataFrame:
    """J8 step: per window day, the first floor(n/3) of its n rows in ``order``.

    Returns (TRANSACTION_ID, picks) — how many windows picked each row.  ``order`` are numeric columns.
    The border of a window day's first third comes from a histogram of its order values that is narrowed to
    the border bin (``selection.first_rows``): candidates are counted, not sorted, and a window day
    with most candidates is spread like any other.
    """
    names = [f"_o{i}" for i in range(len(order))]
    # a customer has one window per day at most
    spans = _by_span(windows.select("CUSTOMER_ID", F.col("day").alias("window_day"), F.col("day").cast("bigint").alias("start"),
                                    (F.col("day").cast("bigint") + length).alias("end")), length)
    cand = tx.select("TRANSACTION_ID", "CUSTOMER_ID", "TX_TIME_DAYS", *[o.alias(n) for o, n in zip(order, names)])
    cand = cand.withColumn("_span", F.floor(F.col("TX_TIME_DAYS") / F.lit(length)))
    cand = cand.join(spans, ["CUSTOMER_ID", "_span"]).filter("start <= TX_TIME_DAYS AND TX_TIME_DAYS < end").select(
        "TRANSACTION_ID", "window_day", *names)
    picked = first_rows(cand, "window_day", names, F.floor(F.col("n") / F.lit(CARD_FRAUD_SHARE_DIVISOR)))
    return picked.groupBy("TRANSACTION_ID").agg(F.count(F.lit(1)).alias("picks"))


def label_card_compromise(tx: DataFrame, windows: DataFrame, order: list[Column],
                          length: int = CUSTOMER_WINDOW_DAYS) -> DataFrame:
    """Picked rows get amount x 5^picks, fraud, scenario 3."""
    picks = card_compromise_picks(tx, windows, order, length)
    j = tx.join(picks, "TRANSACTION_ID", "left")
    hit = F.col("picks").isNotNull()
    factor = F.pow(F.lit(CARD_FRAUD_AMOUNT_FACTOR), F.col("picks").cast("double"))
    return j.withColumns({
        "TX_AMOUNT": F.when(hit, F.col("TX_AMOUNT") * factor).otherwise(F.col("TX_AMOUNT")),
        "TX_FRAUD": F.when(hit, F.lit(1)).otherwise(F.col("TX_FRAUD")),
        "TX_FRAUD_SCENARIO": F.when(hit, F.lit(3)).otherwise(F.col("TX_FRAUD_SCENARIO")),
    }).select(*tx.columns)


def label_scenarios(tx: DataFrame, terminal_windows: DataFrame, customer_windows: DataFrame,
                    order: list[Column]) -> DataFrame:
    """J9 then J7 then J8 (later scenarios overwrite the scenario number)."""
    base = tx.withColumns({"TX_FRAUD": F.lit(0), "TX_FRAUD_SCENARIO": F.lit(0)})
    return label_card_compromise(
        label_terminal_compromise(label_amount(base), terminal_windows), customer_windows, order)


def scenario_increments(tx: DataFrame, terminal_windows: DataFrame, customer_windows: DataFrame,
                        order: list[Column]) -> DataFrame:
    """Frauds added by each scenario step (a row already fraud is not
    counted again): one row with nb_frauds_scenario_1/2/3 and the total."""
    base = tx.withColumns({"TX_FRAUD": F.lit(0), "TX_FRAUD_SCENARIO": F.lit(0)})
    # the flag after each step rides along as a column: one pass, no self-join
    s1 = label_amount(base).withColumn("_f1", F.col("TX_FRAUD"))
    s2 = label_terminal_compromise(s1, terminal_windows).withColumn("_f2", F.col("TX_FRAUD"))
    s3 = label_card_compromise(s2, customer_windows, order)
    return s3.agg(F.sum("_f1").alias("nb_frauds_scenario_1"),
                  (F.sum("_f2") - F.sum("_f1")).alias("nb_frauds_scenario_2"),
                  (F.sum("TX_FRAUD") - F.sum("_f2")).alias("nb_frauds_scenario_3"),
                  F.sum("TX_FRAUD").alias("nb_frauds_total"))


def rule_windows(tx: DataFrame, id_col: str, modulus: int = 10) -> DataFrame:
    """Deterministic compromise windows derived from the data (test rule):
    for every simulated day d below the last day, the ids with id % m == d % m."""
    last = F.lit(one_row(tx, F.max("TX_TIME_DAYS"))[0])
    days = tx.select(F.col("TX_TIME_DAYS").alias("day")).distinct().filter(F.col("day") < last)
    ids = tx.select(id_col).distinct().filter(F.col(id_col).isNotNull())
    return (ids.select(id_col, F.pmod(F.col(id_col), F.lit(modulus)).alias("_k"))
               .join(days.select("day", F.pmod(F.col("day"), F.lit(modulus)).alias("_k")), "_k")
               .select(id_col, "day"))
