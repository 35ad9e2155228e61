"""DuckDB SQL building blocks for the oracles (independent re-statements of
each operator in plain SQL over the same tables).

Spark's ``round`` on a double is HALF_UP on the shortest decimal string of
the value; ``R`` reproduces that in DuckDB (its ``round(double)`` works on
the binary value).  Unrounded floating sums are compared at 6 decimals on
both sides (``R6``) because summation order differs between engines.
"""

from __future__ import annotations


def R(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def R6(expr: str) -> str:
    """Same comparison projection as ``registry.r6`` (1e-9 nudge, 6 dp)."""
    return R(f"({expr}) + 1e-9", 6)


def AVG2(col: str) -> str:
    """Mean of the unrounded amounts, rounded once to cents (2 dp)."""
    return R(f"sum(CAST({col} AS DECIMAL(28,10))) / count({col})", 2)


def I64(expr: str) -> str:
    return f"CAST(({expr}) AS BIGINT)"


# ---- mapping CTEs ---------------------------------------------------------

_SECS_A = "((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000000)"
_SECS_B = "((epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1992-01-01 00:00:00')) // 1000000)"

_TX_A = f"""SELECT event_id AS TRANSACTION_ID, CAST(ts AS TIMESTAMP) AS TX_DATETIME, user_id AS CUSTOMER_ID,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID, value AS TX_AMOUNT,
  CAST({_SECS_A} AS BIGINT) AS TX_TIME_SECONDS, CAST({_SECS_A} // 86400 AS INTEGER) AS TX_TIME_DAYS,
  CAST(value > 220 AS INTEGER) AS TX_FRAUD, CAST(value > 220 AS INTEGER) AS TX_FRAUD_SCENARIO
FROM events"""


def _tx_b(terminal: str, where: str = "") -> str:
    return f"""SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS TRANSACTION_ID,
  CAST(l_shipdate AS TIMESTAMP) AS TX_DATETIME, o_custkey AS CUSTOMER_ID, CAST({terminal} AS BIGINT) AS TERMINAL_ID,
  l_extendedprice AS TX_AMOUNT, CAST({_SECS_B} AS BIGINT) AS TX_TIME_SECONDS,
  CAST({_SECS_B} // 86400 AS INTEGER) AS TX_TIME_DAYS,
  CAST(l_extendedprice > 100000 AS INTEGER) AS TX_FRAUD, CAST(l_extendedprice > 100000 AS INTEGER) AS TX_FRAUD_SCENARIO
FROM lineitem JOIN orders ON l_orderkey = o_orderkey {where}"""


def features_sql(src: str) -> str:
    return f"""SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS,
  TX_TIME_DAYS, TX_FRAUD, TX_FRAUD_SCENARIO, tx_date, tx_year_month, tx_hour, tx_day_of_week,
  CASE WHEN tx_day_of_week IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN tx_hour >= 0 AND tx_hour < 6 THEN 1 ELSE 0 END AS is_night,
  count(TRANSACTION_ID) OVER (PARTITION BY tx_year_month, CUSTOMER_ID) AS customer_tx_count,
  avg(TX_AMOUNT) OVER (PARTITION BY tx_year_month, CUSTOMER_ID) AS customer_avg_amount,
  count(TRANSACTION_ID) OVER (PARTITION BY tx_year_month, TERMINAL_ID) AS terminal_tx_count
FROM (SELECT *, CAST(TX_DATETIME AS DATE) AS tx_date, strftime(TX_DATETIME, '%Y-%m') AS tx_year_month,
             CAST(hour(TX_DATETIME) AS INTEGER) AS tx_hour, strftime(TX_DATETIME, '%a') AS tx_day_of_week
      FROM {src}) s"""


def _edges(src: str) -> str:
    return f"SELECT 'C_' || CAST(CUSTOMER_ID AS VARCHAR) AS src, 'T_' || CAST(TERMINAL_ID AS VARCHAR) AS dst, * FROM {src}"


def _vertices(src: str) -> str:
    return (f"SELECT DISTINCT src AS id, 'Customer' AS type FROM {src} UNION ALL "
            f"SELECT DISTINCT dst AS id, 'Terminal' AS type FROM {src}")


def _lpa_steps(prefix: str, vertices: str, edges: str, steps: int) -> dict[str, tuple[str, list[str]]]:
    out = {
        f"{prefix}_adj": (f"SELECT src, dst, count(*) AS w FROM {edges} GROUP BY src, dst", [edges]),
        f"{prefix}_wadj": (f"SELECT src, dst, w FROM {prefix}_adj UNION ALL SELECT dst AS src, src AS dst, w FROM {prefix}_adj",
                           [f"{prefix}_adj"]),
        f"{prefix}_l0": (f"SELECT id, id AS label FROM {vertices}", [vertices]),
    }
    for i in range(1, steps + 1):
        prev = f"{prefix}_l{i - 1}"
        out[f"{prefix}_l{i}"] = (f"""SELECT v.id, COALESCE(b.lab, v.label) AS label FROM {prev} v LEFT JOIN (
  SELECT id, arg_min(label, (-score, label)) AS lab FROM (
    SELECT a.dst AS id, l.label, sum(a.w) AS score FROM {prefix}_wadj a JOIN {prev} l ON a.src = l.id
    GROUP BY a.dst, l.label) g GROUP BY id) b ON v.id = b.id""", [prev, f"{prefix}_wadj"])
    return out


CTES: dict[str, tuple[str, list[str]]] = {
    "tx_a": (_TX_A, []),
    "tx_b": (_tx_b("l_suppkey"), []),
    "tx_c": (_tx_b("l_partkey"), []),
    "tx_m": (_tx_b("l_partkey", "WHERE l_shipdate >= TIMESTAMP '1998-04-01' AND l_shipdate < TIMESTAMP '1998-05-01'"), []),
    "feat_a": (features_sql("tx_a"), ["tx_a"]),
    "feat_b": (features_sql("tx_b"), ["tx_b"]),
    "feat_c": (features_sql("tx_c"), ["tx_c"]),
    "feat_m": (features_sql("tx_m"), ["tx_m"]),
    "edges_a": (_edges("feat_a"), ["feat_a"]),
    "edges_c": (_edges("feat_c"), ["feat_c"]),
    "edges_m": (_edges("feat_m"), ["feat_m"]),
    "vert_a": (_vertices("edges_a"), ["edges_a"]),
    "vert_c": (_vertices("edges_c"), ["edges_c"]),
    "und_a": ("SELECT DISTINCT src, dst FROM edges_a UNION SELECT DISTINCT dst, src FROM edges_a", ["edges_a"]),
    "und_c": ("SELECT DISTINCT src, dst FROM edges_c UNION SELECT DISTINCT dst, src FROM edges_c", ["edges_c"]),
    "root_a": ("SELECT 'C_' || CAST(CUSTOMER_ID AS VARCHAR) AS id FROM feat_a GROUP BY CUSTOMER_ID "
               "ORDER BY sum(TX_FRAUD) DESC, CUSTOMER_ID ASC LIMIT 1", ["feat_a"]),
    "root_c": ("SELECT 'C_' || CAST(CUSTOMER_ID AS VARCHAR) AS id FROM feat_c GROUP BY CUSTOMER_ID "
               "ORDER BY sum(TX_FRAUD) DESC, CUSTOMER_ID ASC LIMIT 1", ["feat_c"]),
    "cust_d": ("SELECT c_custkey AS CUSTOMER_ID, CAST((c_custkey * 37) % 1000 AS DOUBLE) / 10.0 AS x_customer_id, "
               "CAST((c_custkey * 91) % 1000 AS DOUBLE) / 10.0 AS y_customer_id FROM customer", []),
    "term_d": ("SELECT s_suppkey AS TERMINAL_ID, CAST((s_suppkey * 53) % 1000 AS DOUBLE) / 10.0 AS x_terminal_id, "
               "CAST((s_suppkey * 17) % 1000 AS DOUBLE) / 10.0 AS y_terminal_id FROM supplier", []),
}
CTES.update(_lpa_steps("lpa_c", "vert_c", "edges_c", 5))
CTES["labels_c"] = ("SELECT v.id, v.type, l.label FROM vert_c v JOIN lpa_c_l5 l ON v.id = l.id", ["vert_c", "lpa_c_l5"])


def with_(*names: str, extra: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """A WITH clause holding the named CTEs and everything they depend on."""
    lib = dict(CTES)
    lib.update(extra or {})
    ordered: list[str] = []

    def visit(n: str):
        if n in ordered:
            return
        for d in lib[n][1]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{lib[n][0]}\n)" for n in ordered) + "\n"
