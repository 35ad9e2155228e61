"""Cleaning job: raw string columns -> typed, feature-enriched 18-column table.

E1 filter_valid_ids, E2/E3 cast_types, E4 add_calendar, E5 fill_defaults,
E6 add_risk_flags, W1-W3 add_month_features, E7 clean_transactions.

All stages are one lazy plan; Catalyst collapses the projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import calendar_columns, is_night, is_weekend, parse_timestamp, whole_number
from txlens.operators.skew import HOT_KEY_ROWS, attach_group_stats, window_group_stats
from txlens.schema import BAD_ID_MARKER, BASE_COLUMNS, CLEANED_COLUMNS

_CASTS = {
    "TRANSACTION_ID": "bigint",
    "CUSTOMER_ID": "bigint",
    "TERMINAL_ID": "bigint",
    "TX_AMOUNT": "double",
    "TX_TIME_SECONDS": "bigint",
    "TX_TIME_DAYS": "int",
    "TX_FRAUD": "int",
    "TX_FRAUD_SCENARIO": "int",
}

# NULL -> default after the cast (E5).  Ids and the timestamp keep NULL.
_DEFAULTS = {
    "TX_AMOUNT": (0.0, "double"),
    "TX_TIME_SECONDS": (0, "bigint"),
    "TX_TIME_DAYS": (0, "int"),
    "TX_FRAUD": (0, "int"),
    "TX_FRAUD_SCENARIO": (0, "int"),
}


def filter_valid_ids(raw: DataFrame, id_col: str = "TRANSACTION_ID") -> DataFrame:
    """Drop rows whose id is NULL or the spreadsheet error marker."""
    c = F.col(id_col)
    return raw.filter(c.isNotNull() & (c != F.lit(BAD_ID_MARKER)))


def cast_types(df: DataFrame) -> DataFrame:
    """Typed casts that give NULL on bad input (ANSI-safe).

    Whole numbers may be written with a fraction or spaces (``1.0``, `` 7 ``),
    as spreadsheets export them.  Rows whose id is still no number are dropped
    (``reject_rows`` reports them): ids of the cleaned table are never NULL.
    """
    exprs = []
    for c in df.columns:
        if c == "TX_DATETIME":
            exprs.append(parse_timestamp(F.col(c).cast("string")).alias(c))
        elif c in _CASTS:
            whole = _CASTS[c] != "double" and df.schema[c].dataType.typeName() == "string"
            exprs.append((whole_number(c, _CASTS[c]) if whole else F.col(c).try_cast(_CASTS[c])).alias(c))
        else:
            exprs.append(F.col(c))
    out = df.select(*exprs)
    if "TRANSACTION_ID" in out.columns:
        out = out.filter(F.col("TRANSACTION_ID").isNotNull())
    return out


def fill_defaults(df: DataFrame) -> DataFrame:
    """E5: NULL amounts/times/labels -> 0."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(_DEFAULTS[c][0]).cast(_DEFAULTS[c][1])).alias(c) if c in _DEFAULTS else F.col(c)
        for c in df.columns
    ])


def add_calendar(df: DataFrame, ts_col: str = "TX_DATETIME") -> DataFrame:
    """tx_date, tx_year_month, tx_hour, tx_day_of_week."""
    cal = calendar_columns(ts_col)
    keep = [c for c in df.columns if c not in cal]
    return df.select(*keep, *[e.alias(n) for n, e in cal.items()])


def add_risk_flags(df: DataFrame) -> DataFrame:
    """is_weekend (Sat/Sun) and is_night (0 <= hour < 6); NULL -> 0."""
    return df.select(
        *[c for c in df.columns if c not in ("is_weekend", "is_night")],
        is_weekend("tx_day_of_week").alias("is_weekend"),
        is_night("tx_hour").alias("is_night"),
    )


# Join-key sentinels standing for NULL (a NULL month or id forms its own
# group, as a window partition would); neither can be a real value.
_NULL_MONTH = "__null__"
_NULL_ID = -(2 ** 63)


def _key(c: str, sentinel):
    return F.coalesce(F.col(c), F.lit(sentinel))


def add_month_features(df: DataFrame, hot_rows: int = HOT_KEY_ROWS, by_month: bool = False) -> DataFrame:
    """Monthly per-customer count/avg and per-terminal count on each row.

    Grouped aggregates joined back on NULL-free keys instead of two window
    specs: map-side partial aggregation, and a hot (month, customer) or
    (month, terminal) group is split over several tasks by salting (see
    ``operators.skew``) where a window would sort the whole group in one task.
    Both aggregates read the narrow input, not the joined rows.  The month travels as its key alone.

    ``by_month``, for tables that are written by month from a stored ``df``: windows with the hot groups apart, whose last
    shuffle deals the rows by month as the writer needs them (``sinks``: ``laid_out``).
    """
    mk, ck, tk = _key("tx_year_month", _NULL_MONTH), _key("CUSTOMER_ID", _NULL_ID), _key("TERMINAL_ID", _NULL_ID)
    keep = [c for c in df.columns if c not in ("customer_tx_count", "customer_avg_amount", "terminal_tx_count")]
    base = df.select(*[c for c in keep if c != "tx_year_month"], mk.alias("_mk"), ck.alias("_ck"), tk.alias("_tk"))
    customer = {"customer_tx_count": F.count("TRANSACTION_ID"), "customer_avg_amount": F.avg("TX_AMOUNT")}
    terminal = {"terminal_tx_count": F.count("TRANSACTION_ID")}
    if by_month:
        out = window_group_stats(base, ["_mk", "_ck"], customer, hot_rows)
        out = window_group_stats(out, ["_mk", "_tk"], terminal, hot_rows, source=base, within="_mk")
    else:
        out = attach_group_stats(base, ["_mk", "_ck"], customer, hot_rows)
        out = attach_group_stats(out, ["_mk", "_tk"], terminal, hot_rows, source=base)
    month = F.when(F.col("_mk") != F.lit(_NULL_MONTH), F.col("_mk")).alias("tx_year_month")
    return out.select(*[month if c == "tx_year_month" else F.col(c) for c in keep],
                      "customer_tx_count", "customer_avg_amount", "terminal_tx_count")


def add_features(base: DataFrame, month_features: bool = True, hot_rows: int = HOT_KEY_ROWS, by_month: bool = False) -> DataFrame:
    """Typed base columns -> the 18-column cleaned table.

    ``month_features=False`` stops after the calendar parts and flags (15
    columns) for analyses that never read the three monthly features.  Calendar parts and flags are taken
    after the monthly features, so their shuffles carry the base columns alone.  ``by_month``: see ``add_month_features``.
    """
    if not month_features:
        out = add_risk_flags(add_calendar(base))
        return out.select(*[c for c in CLEANED_COLUMNS if c in out.columns])
    narrow = base.select(*[c for c in BASE_COLUMNS if c in base.columns],
                         calendar_columns("TX_DATETIME")["tx_year_month"].alias("tx_year_month"))
    return add_risk_flags(add_calendar(add_month_features(narrow, hot_rows, by_month))).select(*CLEANED_COLUMNS)


def parse_raw(raw: DataFrame) -> DataFrame:
    """E1 + E2/E3 + E5 over the raw string columns."""
    return fill_defaults(cast_types(filter_valid_ids(raw.select(*BASE_COLUMNS))))


def clean_transactions(raw: DataFrame) -> DataFrame:
    """The whole cleaning job as one lazy plan."""
    return add_features(parse_raw(raw))


def reject_rows(raw: DataFrame) -> DataFrame:
    """Rows the cleaning job drops (audit side output), with a reason."""
    idc = F.col("TRANSACTION_ID")
    reason = (F.when(idc.isNull(), F.lit("null_id"))
               .when(idc == F.lit(BAD_ID_MARKER), F.lit("error_marker"))
               .when(whole_number(idc, "bigint").isNull(), F.lit("non_numeric_id")))
    return raw.select("*", reason.alias("reject_reason")).filter(F.col("reject_reason").isNotNull())
