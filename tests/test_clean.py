"""Cleaning job: edge rows, types, flags and monthly features."""

import datetime as dt

from pyspark.sql import types as T

from support import rows
from txlens.operators import clean
from txlens.schema import CLEANED_COLUMNS, CLEANED_SCHEMA, RAW_SCHEMA

RAW = [
    # id, datetime, customer, terminal, amount, secs, days, fraud, scenario
    ("1", "2018-04-06 00:30:00", "10", "100", "12.50", "1800", "0", "0", "0"),    # Fri, hour 0
    ("2", "2018-04-07 05:59:59", "10", "101", "100.00", "107999", "1", "1", "1"),  # Sat, hour 5
    ("3", "2018-04-08 06:00:00", "11", "100", "", "194400", "2", "", ""),          # Sun, hour 6, NULL amount
    ("4", "2018-04-09 23:10:00", "11", "100", "7.25", "", "", "0", "0"),           # Mon, hour 23
    ("5", "2018-05-01 12:00:00", "10", "100", "3.00", "2592000", "30", "0", "0"),   # next month
    ("6", "not a date", "12", "102", "1.00", "5", "0", "0", "0"),                   # bad date -> NULL month
    (None, "2018-04-06 00:00:00", "10", "100", "1.00", "0", "0", "0", "0"),          # NULL id -> dropped
    ("#VALUE!", "2018-04-06 00:00:00", "10", "100", "1.00", "0", "0", "0", "0"),     # marker -> dropped
    ("abc", "2018-04-06 00:00:00", "10", "100", "1.00", "0", "0", "0", "0"),         # non-numeric -> dropped
]


def raw_df(spark):
    return spark.createDataFrame(RAW, RAW_SCHEMA)


def test_filter_valid_ids_drops_null_and_marker(spark):
    out = clean.filter_valid_ids(raw_df(spark))
    assert sorted(r[0] for r in out.select("TRANSACTION_ID").collect()) == ["1", "2", "3", "4", "5", "6", "abc"]


def test_cleaned_schema_and_no_null_ids(spark):
    out = clean.clean_transactions(raw_df(spark))
    assert out.columns == CLEANED_COLUMNS
    assert out.schema == T.StructType([T.StructField(f.name, f.dataType, True) for f in CLEANED_SCHEMA.fields]) \
        or [f.dataType for f in out.schema.fields] == [f.dataType for f in CLEANED_SCHEMA.fields]
    got = {r["TRANSACTION_ID"]: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert all(r["TX_AMOUNT"] is not None and r["TX_TIME_SECONDS"] is not None for r in got.values())


def test_defaults_calendar_and_flags(spark):
    got = {r["TRANSACTION_ID"]: r for r in clean.clean_transactions(raw_df(spark)).collect()}
    assert got[3]["TX_AMOUNT"] == 0.0 and got[3]["TX_FRAUD"] == 0 and got[3]["TX_FRAUD_SCENARIO"] == 0
    assert got[4]["TX_TIME_SECONDS"] == 0 and got[4]["TX_TIME_DAYS"] == 0
    assert [got[i]["tx_day_of_week"] for i in (1, 2, 3, 4)] == ["Fri", "Sat", "Sun", "Mon"]
    assert [got[i]["is_weekend"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert [got[i]["tx_hour"] for i in (1, 2, 3, 4)] == [0, 5, 6, 23]
    assert [got[i]["is_night"] for i in (1, 2, 3, 4)] == [1, 1, 0, 0]
    assert got[1]["tx_date"] == dt.date(2018, 4, 6) and got[1]["tx_year_month"] == "2018-04"
    # unparsable date: NULL timestamp, NULL month, flags 0
    assert got[6]["TX_DATETIME"] is None and got[6]["tx_year_month"] is None
    assert got[6]["is_weekend"] == 0 and got[6]["is_night"] == 0


def test_month_features_are_scoped_to_month(spark):
    got = {r["TRANSACTION_ID"]: r for r in clean.clean_transactions(raw_df(spark)).collect()}
    # customer 10 has rows 1, 2 in April and 5 in May
    assert got[1]["customer_tx_count"] == 2 and got[5]["customer_tx_count"] == 1
    assert abs(got[1]["customer_avg_amount"] - 56.25) < 1e-9
    # terminal 100 in April: rows 1, 3, 4
    assert got[1]["terminal_tx_count"] == 3 and got[5]["terminal_tx_count"] == 1
    # NULL month forms its own group (like a window partition)
    assert got[6]["customer_tx_count"] == 1 and got[6]["terminal_tx_count"] == 1


def test_reject_rows_reasons(spark):
    out = rows(clean.reject_rows(raw_df(spark)), "TRANSACTION_ID", "reject_reason")
    assert sorted(r[1] for r in out) == ["error_marker", "non_numeric_id", "null_id"]


def test_empty_frame(spark):
    out = clean.clean_transactions(spark.createDataFrame([], RAW_SCHEMA))
    assert out.count() == 0 and out.columns == CLEANED_COLUMNS


def test_month_features_plan_has_no_window(spark):
    out = clean.clean_transactions(raw_df(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_whole_numbers_as_a_plain_cast_gives_them(spark):
    from txlens.functions.columns import whole_number
    want = {"1.0": 1, " 7 ": 7, "-2.9": -2, "3.": 3, ".5": 0, "+4": 4, "1e3": None, "1.x": None, "": None, "abc": None,
            "99999999999999999999": None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r["t"]: r["n"] for r in df.select("t", whole_number("t", "bigint").alias("n")).collect()} == want


def test_labels_written_with_a_fraction_survive(spark):
    row = ("1.0", "2018-04-06 00:30:00", "10.0", "100", "12.50", "1800.0", "1.0", "1.0", "1.0")
    got = clean.clean_transactions(spark.createDataFrame([row], RAW_SCHEMA)).collect()[0]
    assert (got["TRANSACTION_ID"], got["CUSTOMER_ID"], got["TX_FRAUD"], got["TX_FRAUD_SCENARIO"], got["TX_TIME_DAYS"]) == (
        1, 10, 1, 1, 1)


def test_average_rounds_once(spark):
    from txlens.functions.columns import money_avg
    for amounts, want in (((1.004, 1.004, 1.011), 1.01), ((1.0, 1.006), 1.00), ((50.26, 50.27), 50.27)):
        df = spark.createDataFrame([(a,) for a in amounts], "TX_AMOUNT double")
        assert df.agg(money_avg("TX_AMOUNT")).first()[0] == want
