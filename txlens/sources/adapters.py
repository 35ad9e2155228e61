"""Adapters from the driver's test tables onto the transaction data model.

Mapping A  events              -> transactions (one month, time of day, dense graph)
Mapping B  lineitem x orders   -> transactions (many months, midnight timestamps)
Mapping C  B with terminal = part (the graph for communities)
Mapping D  customer / supplier -> customer and terminal profiles on a grid

The adapters only project and join; filters on raw columns (e.g. the month
slice of C) are written against the scan columns so they reach Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.clean import add_features
from txlens.schema import BASE_COLUMNS, TS_FORMAT

# --- fixed values of the test mappings ------------------------------------
EVENTS_EPOCH = "2024-01-01 00:00:00"
ORDERS_EPOCH = "1992-01-01 00:00:00"
EVENTS_FRAUD_AMOUNT = 220.0          # scenario 1 threshold of the reference
LINEITEM_FRAUD_PRICE = 100000.0
SPARSE_MONTH = "1998-04"
GRID_RULE = {"customer": (37, 91), "terminal": (53, 17)}  # (x mult, y mult) % 1000 / 10
# --------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def month_bounds(month: str) -> tuple[str, str]:
    """'yyyy-MM' -> ('yyyy-MM-01 00:00:00', first instant of the next month)."""
    y, m = (int(p) for p in month.split("-"))
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}-{m:02d}-01 00:00:00", f"{ny:04d}-{nm:02d}-01 00:00:00"


def _seconds_since(ts_ntz, epoch: str):
    """Whole seconds of wall-clock time since ``epoch`` (both local date-times,
    so the result does not move with the session time zone or DST)."""
    return F.timestamp_diff("SECOND", F.lit(epoch).cast("timestamp_ntz"), ts_ntz.cast("timestamp_ntz")).cast("bigint")


def transactions_from_events(events: DataFrame, fraud_amount: float = EVENTS_FRAUD_AMOUNT) -> DataFrame:
    """Mapping A: the 9 typed base columns from ``events``."""
    ts = F.col("ts").cast("timestamp")
    secs = _seconds_since(F.col("ts"), EVENTS_EPOCH)
    fraud = (F.col("value") > F.lit(fraud_amount)).cast("int")
    return events.select(
        F.col("event_id").alias("TRANSACTION_ID"),
        ts.alias("TX_DATETIME"),
        F.col("user_id").alias("CUSTOMER_ID"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("TERMINAL_ID"),
        F.col("value").alias("TX_AMOUNT"),
        secs.alias("TX_TIME_SECONDS"),
        F.floor(secs / F.lit(86400)).cast("int").alias("TX_TIME_DAYS"),
        fraud.alias("TX_FRAUD"),
        fraud.alias("TX_FRAUD_SCENARIO"),
    )


def raw_from_events(events: DataFrame) -> DataFrame:
    """Mapping A rendered as the raw all-string CSV layout (input of E7)."""
    base = transactions_from_events(events)
    return base.select(*[
        (F.date_format("TX_DATETIME", TS_FORMAT) if c == "TX_DATETIME" else F.col(c).cast("string")).alias(c)
        for c in BASE_COLUMNS
    ])


def with_dirt(raw: DataFrame) -> DataFrame:
    """Spoil a fixed share of the raw text, by the number in the id: ids that are
    missing, marked, no number, or whole numbers with a fraction or spaces; labels and
    times with a fraction; amounts, days and timestamps that do not parse."""
    n = F.col("TRANSACTION_ID").try_cast("bigint")
    at = lambda m, k: n % m == k
    txt = lambda c, suffix: F.concat(F.col(c), F.lit(suffix))
    spoiled = {
        "TRANSACTION_ID": F.when(at(97, 1), F.lit("#VALUE!")).when(at(97, 2), F.lit(None).cast("string"))
        .when(at(97, 3), F.concat(F.lit("abc"), F.col("TRANSACTION_ID"))).when(at(97, 4), txt("TRANSACTION_ID", ".0"))
        .when(at(97, 5), F.concat(F.lit("  "), F.col("TRANSACTION_ID"), F.lit(" "))).when(at(97, 6), F.lit("1e3")),
        "TX_FRAUD": F.when(at(89, 1), txt("TX_FRAUD", ".0")),
        "TX_AMOUNT": F.when(at(89, 2), F.lit("n/a")).when(at(89, 3), F.lit("")),
        "TX_TIME_DAYS": F.when(at(89, 4), txt("TX_TIME_DAYS", ".0")).when(at(89, 5), F.lit(".5")),
        "TX_TIME_SECONDS": F.when(at(89, 6), txt("TX_TIME_SECONDS", ".9")),
        "TX_FRAUD_SCENARIO": F.when(at(89, 7), F.lit("x")),
        "TX_DATETIME": F.when(at(83, 1), F.lit("not a date")),
    }
    return raw.select(*[(spoiled[c].otherwise(F.col(c)) if c in spoiled else F.col(c)).alias(c) for c in raw.columns])


def transactions_from_lineitem(lineitem: DataFrame, orders: DataFrame, month: str | None = None,
                               terminal: str = "l_suppkey",
                               fraud_price: float = LINEITEM_FRAUD_PRICE) -> DataFrame:
    """Mapping B (terminal=l_suppkey) or C (terminal=l_partkey), of one month if given."""
    li = lineitem.select("l_orderkey", "l_linenumber", terminal, "l_extendedprice", "l_shipdate")
    if month is not None:
        lo, hi = month_bounds(month)
        # plain literal bounds on the scan column -> Parquet row-group pushdown
        li = li.filter((F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz"))
                       & (F.col("l_shipdate") < F.lit(hi).cast("timestamp_ntz")))
    o = orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ts = F.col("l_shipdate").cast("timestamp")
    secs = _seconds_since(F.col("l_shipdate"), ORDERS_EPOCH)
    fraud = (F.col("l_extendedprice") > F.lit(fraud_price)).cast("int")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("TRANSACTION_ID"),
        ts.alias("TX_DATETIME"),
        F.col("o_custkey").alias("CUSTOMER_ID"),
        F.col(terminal).cast("bigint").alias("TERMINAL_ID"),
        F.col("l_extendedprice").alias("TX_AMOUNT"),
        secs.alias("TX_TIME_SECONDS"),
        F.floor(secs / F.lit(86400)).cast("int").alias("TX_TIME_DAYS"),
        fraud.alias("TX_FRAUD"),
        fraud.alias("TX_FRAUD_SCENARIO"),
    )


def events_tx(spark: SparkSession, sf_dir: str, month_features: bool = False) -> DataFrame:
    """Mapping A, cleaned: 18 columns with ``month_features``, else the 15
    columns before the monthly features (what most analyses read)."""
    return add_features(transactions_from_events(read_table(spark, sf_dir, "events")), month_features)


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"))


def lineitem_tx(spark: SparkSession, sf_dir: str, month_features: bool = False) -> DataFrame:
    """Mapping B, cleaned (83 months at sf0.01); see ``events_tx``."""
    return add_features(transactions_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                                   read_table(spark, sf_dir, "orders")), month_features)


def lineitem_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_lineitem(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"))


def sparse_tx(spark: SparkSession, sf_dir: str, month: str | None = None, month_features: bool = False) -> DataFrame:
    """Mapping C, cleaned: terminal = part, every month unless one is named; see ``events_tx``."""
    return add_features(transactions_from_lineitem(read_table(spark, sf_dir, "lineitem"),
                                                   read_table(spark, sf_dir, "orders"),
                                                   month=month, terminal="l_partkey"), month_features)


def _grid(c, mult: int):
    return (F.pmod(c * F.lit(mult), F.lit(1000)) / F.lit(10.0)).cast("double")


def customer_profiles(customer: DataFrame) -> DataFrame:
    """Mapping D: customer locations on the 100x100 grid."""
    mx, my = GRID_RULE["customer"]
    return customer.select(
        F.col("c_custkey").alias("CUSTOMER_ID"),
        _grid(F.col("c_custkey"), mx).alias("x_customer_id"),
        _grid(F.col("c_custkey"), my).alias("y_customer_id"),
    )


def terminal_profiles(supplier: DataFrame) -> DataFrame:
    """Mapping D: terminal locations on the 100x100 grid."""
    mx, my = GRID_RULE["terminal"]
    return supplier.select(
        F.col("s_suppkey").alias("TERMINAL_ID"),
        _grid(F.col("s_suppkey"), mx).alias("x_terminal_id"),
        _grid(F.col("s_suppkey"), my).alias("y_terminal_id"),
    )
