"""Global statistics as driver-side scalars.

A global aggregate has exactly one row, so bringing it to the driver is a
proven size bound.  Used where a statistic feeds a later expression several
times (thresholds, bounds, totals): one small job, then plain literals —
no cross join, and no per-reference re-execution of a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row


def one_row(df: DataFrame, *aggs: Column) -> Row:
    """Evaluate global aggregates over ``df``; returns their single row."""
    return df.agg(*aggs).first()
