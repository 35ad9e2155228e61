"""Registered queries: fraud-scenario labelling, radius join, place."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlens.operators import labeling, spatial, trends
from txlens.plans.registry import query, r6
from txlens.plans.sql import AVG2, I64, R, R6, with_
from txlens.sources import adapters as ad

# FIXTURES rule: hash order shared by Spark and SQL for the 1/3 pick of J8
ORDER_MULT, ORDER_MOD = 7919, 10007


def _order():
    return [F.pmod(F.col("TRANSACTION_ID") * F.lit(ORDER_MULT), F.lit(ORDER_MOD)), F.col("TRANSACTION_ID")]


def _windows_sql(id_col: str) -> str:
    return (f"SELECT t.{id_col}, d.day FROM (SELECT DISTINCT {id_col} FROM tx_a WHERE {id_col} IS NOT NULL) t "
            f"JOIN (SELECT DISTINCT TX_TIME_DAYS AS day FROM tx_a WHERE TX_TIME_DAYS < (SELECT max(TX_TIME_DAYS) FROM tx_a)) d "
            f"ON t.{id_col} % 10 = d.day % 10")


EXTRA = {
    "tw": (_windows_sql("TERMINAL_ID"), ["tx_a"]),
    "cw": (_windows_sql("CUSTOMER_ID"), ["tx_a"]),
    "tw_days": ("SELECT DISTINCT TERMINAL_ID, day + CAST(g AS INTEGER) AS TX_TIME_DAYS FROM tw, range(28) r(g)", ["tw"]),
    "j9": ("SELECT * REPLACE (CASE WHEN TX_AMOUNT > 220 THEN 1 ELSE 0 END AS TX_FRAUD, "
           "CASE WHEN TX_AMOUNT > 220 THEN 1 ELSE 0 END AS TX_FRAUD_SCENARIO) FROM tx_a", ["tx_a"]),
}


def _j7(src: str) -> str:
    return (f"SELECT s.* REPLACE (CASE WHEN d.TERMINAL_ID IS NOT NULL THEN 1 ELSE s.TX_FRAUD END AS TX_FRAUD, "
            f"CASE WHEN d.TERMINAL_ID IS NOT NULL THEN 2 ELSE s.TX_FRAUD_SCENARIO END AS TX_FRAUD_SCENARIO) "
            f"FROM {src} s LEFT JOIN tw_days d ON s.TERMINAL_ID = d.TERMINAL_ID AND s.TX_TIME_DAYS = d.TX_TIME_DAYS")


def _picks(src: str) -> str:
    return f"""SELECT TRANSACTION_ID, count(*) AS picks FROM (
  SELECT c.TRANSACTION_ID,
    row_number() OVER (PARTITION BY w.day ORDER BY (c.TRANSACTION_ID * {ORDER_MULT}) % {ORDER_MOD}, c.TRANSACTION_ID) AS rn,
    count(*) OVER (PARTITION BY w.day) AS n
  FROM {src} c JOIN cw w ON c.CUSTOMER_ID = w.CUSTOMER_ID AND c.TX_TIME_DAYS >= w.day AND c.TX_TIME_DAYS < w.day + 14) r
WHERE rn <= floor(n / 3) GROUP BY TRANSACTION_ID"""


def _j8(src: str) -> str:
    return (f"SELECT s.* REPLACE (CASE WHEN p.picks IS NOT NULL THEN s.TX_AMOUNT * pow(5.0, p.picks) ELSE s.TX_AMOUNT END AS TX_AMOUNT, "
            f"CASE WHEN p.picks IS NOT NULL THEN 1 ELSE s.TX_FRAUD END AS TX_FRAUD, "
            f"CASE WHEN p.picks IS NOT NULL THEN 3 ELSE s.TX_FRAUD_SCENARIO END AS TX_FRAUD_SCENARIO) "
            f"FROM {src} s LEFT JOIN ({_picks(src)}) p ON s.TRANSACTION_ID = p.TRANSACTION_ID")


EXTRA["j7_only"] = (_j7("tx_a"), ["tx_a", "tw_days"])
EXTRA["j8_only"] = (_j8("tx_a"), ["tx_a", "cw"])
EXTRA["j97"] = (_j7("j9"), ["j9", "tw_days"])
EXTRA["labeled"] = (_j8("j97"), ["j97", "cw"])


def _base(spark, sf):
    return ad.events_base(spark, sf)


def _labeled(spark, sf):
    base = _base(spark, sf)
    return labeling.label_scenarios(base, labeling.rule_windows(base, "TERMINAL_ID"),
                                    labeling.rule_windows(base, "CUSTOMER_ID"), _order())


@query("label_terminal_compromise", with_("j7_only", extra=EXTRA) +
       "SELECT TRANSACTION_ID, TX_FRAUD, TX_FRAUD_SCENARIO FROM j7_only")
def q_j7(spark, sf):
    """28-day compromised-terminal windows as an equi-join on (terminal, day)."""
    base = _base(spark, sf)
    out = labeling.label_terminal_compromise(base, labeling.rule_windows(base, "TERMINAL_ID"))
    return out.select("TRANSACTION_ID", "TX_FRAUD", "TX_FRAUD_SCENARIO")


@query("label_card_compromise", with_("j8_only", extra=EXTRA) +
       f"SELECT TRANSACTION_ID, {R6('TX_AMOUNT')} AS TX_AMOUNT, TX_FRAUD, TX_FRAUD_SCENARIO FROM j8_only")
def q_j8(spark, sf):
    """14-day compromised-card windows, a third of each window's rows x5 (x5^k if picked k times)."""
    base = _base(spark, sf)
    out = labeling.label_card_compromise(base, labeling.rule_windows(base, "CUSTOMER_ID"), _order())
    return r6(out.select("TRANSACTION_ID", "TX_AMOUNT", "TX_FRAUD", "TX_FRAUD_SCENARIO"), "TX_AMOUNT")


@query("label_scenarios", with_("labeled", extra=EXTRA) +
       f"SELECT TRANSACTION_ID, {R6('TX_AMOUNT')} AS TX_AMOUNT, TX_FRAUD, TX_FRAUD_SCENARIO FROM labeled")
def q_j9(spark, sf):
    """J9 + J7 + J8: the three scenarios in order (later ones overwrite the scenario)."""
    return r6(_labeled(spark, sf).select("TRANSACTION_ID", "TX_AMOUNT", "TX_FRAUD", "TX_FRAUD_SCENARIO"), "TX_AMOUNT")


@query("scenario_counts", with_("labeled", extra=EXTRA) +
       f"SELECT TX_FRAUD_SCENARIO, count(*) AS n_rows, {I64('sum(TX_FRAUD)')} AS n_fraud, "
       f"{AVG2('TX_AMOUNT')} AS avg_tx_amount, {R('count(*) / (SELECT count(*) FROM labeled)', 6)} AS share "
       "FROM labeled GROUP BY TX_FRAUD_SCENARIO")
def q_scenarios(spark, sf):
    """Rows, frauds, average amount and share per scenario after labelling."""
    return trends.scenario_counts(_labeled(spark, sf))


@query("scenario_increments", with_("j9", "j97", "labeled", extra=EXTRA) + f"""SELECT
  (SELECT {I64('sum(TX_FRAUD)')} FROM j9) AS nb_frauds_scenario_1,
  (SELECT {I64('sum(TX_FRAUD)')} FROM j97) - (SELECT {I64('sum(TX_FRAUD)')} FROM j9) AS nb_frauds_scenario_2,
  (SELECT {I64('sum(TX_FRAUD)')} FROM labeled) - (SELECT {I64('sum(TX_FRAUD)')} FROM j97) AS nb_frauds_scenario_3,
  (SELECT {I64('sum(TX_FRAUD)')} FROM labeled) AS nb_frauds_total""")
def q_increments(spark, sf):
    """Frauds added by each scenario step (amount, terminal, card)."""
    base = _base(spark, sf)
    return labeling.scenario_increments(base, labeling.rule_windows(base, "TERMINAL_ID"),
                                        labeling.rule_windows(base, "CUSTOMER_ID"), _order())


@query("terminals_within_radius", with_("cust_d", "term_d") + """SELECT c.CUSTOMER_ID,
  COALESCE(p.terminal_list, '') AS terminal_list, CAST(COALESCE(p.nb_terminals, 0) AS INTEGER) AS nb_terminals
FROM cust_d c LEFT JOIN (
  SELECT c.CUSTOMER_ID, string_agg(CAST(t.TERMINAL_ID AS VARCHAR), ',' ORDER BY t.TERMINAL_ID) AS terminal_list,
         count(*) AS nb_terminals
  FROM cust_d c JOIN term_d t
    ON sqrt(pow(c.x_customer_id - t.x_terminal_id, 2) + pow(c.y_customer_id - t.y_terminal_id, 2)) < 5
  GROUP BY c.CUSTOMER_ID) p ON c.CUSTOMER_ID = p.CUSTOMER_ID""")
def q_radius(spark, sf):
    """Terminals within radius 5 of each customer (grid-cell equi-join + exact distance)."""
    cust = ad.customer_profiles(ad.read_table(spark, sf, "customer"))
    term = ad.terminal_profiles(ad.read_table(spark, sf, "supplier"))
    out = spatial.terminals_within_radius(cust, term, 5.0)
    return out.select("CUSTOMER_ID",
                      F.array_join(F.transform("available_terminals", lambda x: x.cast("string")), ",").alias("terminal_list"),
                      "nb_terminals")


@query("terminals_in_reach", with_("cust_d", "term_d") + """SELECT c.CUSTOMER_ID,
  (SELECT count(*) FROM term_d t
   WHERE sqrt(pow(c.x_customer_id - t.x_terminal_id, 2) + pow(c.y_customer_id - t.y_terminal_id, 2)) < 20) AS nb_terminals
FROM cust_d c""")
def q_reach(spark, sf):
    """Number of terminals within radius 20 of each customer, by an adaptive quadtree, without pairs."""
    cust = ad.customer_profiles(ad.read_table(spark, sf, "customer"))
    term = ad.terminal_profiles(ad.read_table(spark, sf, "supplier"))
    return spatial.terminals_in_reach(cust, term, 20.0)


@query("fraud_rate_by_cell", with_("feat_b", "term_d") + f"""SELECT cell, count(*) AS total_transactions,
  {I64('sum(TX_FRAUD)')} AS fraud_transactions, {AVG2('TX_AMOUNT')} AS avg_tx_amount,
  {R('sum(TX_FRAUD) / count(*)', 4)} AS fraud_rate, {R('sum(TX_FRAUD) / count(*) * 100', 2)} AS fraud_rate_pct
FROM (SELECT f.TX_FRAUD, f.TX_AMOUNT,
        CAST(CAST(floor(t.x_terminal_id / 10.0) AS INTEGER) AS VARCHAR) || '_' ||
        CAST(CAST(floor(t.y_terminal_id / 10.0) AS INTEGER) AS VARCHAR) AS cell
      FROM feat_b f JOIN term_d t ON f.TERMINAL_ID = t.TERMINAL_ID) j GROUP BY cell""")
def q_cell(spark, sf):
    """Fraud rate per 10x10 grid cell of the terminal location (mapping B + supplier grid)."""
    term = ad.terminal_profiles(ad.read_table(spark, sf, "supplier"))
    return spatial.fraud_rate_by_cell(ad.lineitem_tx(spark, sf), term, 10.0)
