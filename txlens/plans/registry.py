"""The named-query registry behind ``__spark_entry__``.

``@query(name, sql)`` registers a callable ``(spark, sf_dir) -> DataFrame``
and, when SQL can express it, the DuckDB oracle that must give the same
rows.  Queries without an oracle are checked on row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


NUDGE = 1e-9


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Comparison projection: named float columns rounded half-up to 6 dp after
    a 1e-9 nudge, so a float sum that lands a hair under an exact tie (x.xxxxxx5)
    in one engine and on it in the other still gives the same digits."""
    return df.select(*[F.round(F.col(c) + F.lit(NUDGE), 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def load_all() -> None:
    # importing the modules fills the registry
    from txlens.plans import (  # noqa: F401
        q_behavior, q_clean, q_graph, q_io, q_label, q_ml, q_trends,
    )
