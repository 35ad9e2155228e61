"""Reusable Column expressions (all JVM-side, codegen friendly)."""

from txlens.functions.columns import (  # noqa: F401
    calendar_columns, is_night, is_weekend, money_avg, parse_timestamp, pct, ratio,
    spark_round, vertex_id, weekday_number,
)
