"""Graph features as ML inputs (X7): degrees, terminal risk and community on each edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import pct
from txlens.operators.skew import HOT_KEY_ROWS, attach_group_stats


def graph_features(edges: DataFrame, labels: DataFrame | None = None, label_col: str = "label",
                   hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Every transaction with its customer's out-degree, its terminal's in-degree
    and fraud rate %, and (if given) the customer's community label.

    Aggregates joined back on their keys with hot keys salted (a terminal
    with a third of all edges is spread over many tasks).
    """
    out = attach_group_stats(edges, ["src"], {"customer_degree": F.count(F.lit(1))}, hot_rows)
    out = attach_group_stats(out, ["dst"], {
        "terminal_degree": F.count(F.lit(1)),
        "terminal_fraud_rate_pct": pct(F.sum("TX_FRAUD"), F.count(F.lit(1)), 2)}, hot_rows)
    if labels is not None:
        lab = labels.select(F.col("id").alias("src"), F.col(label_col).alias("customer_community"))
        out = out.join(lab, "src")
    return out
