"""Texts through CSV, money means of any amount, whole numbers in odd spellings."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from txlens.functions.columns import money_avg, money_sum, whole_number
from txlens.schema import RAW_SCHEMA
from txlens.session import scratch_path
from txlens.sources import readers, sinks


def test_monthly_csv_keeps_the_text_it_got(spark):
    odd = ["  393 ", "", None, 'a "quoted" text', "comma, here", " ", "\\", "tab\there", "null", '""', "é漢", "#VALUE!", "two\nlines"]
    n = len(RAW_SCHEMA.fields)
    rows = [tuple(f"2024-0{1 + k % 2}-03 00:00:00" if f.name == "TX_DATETIME" else t if j == 0 else odd[(k + j) % len(odd)]
                  for j, f in enumerate(RAW_SCHEMA.fields)) for k, t in enumerate(odd)]
    df = spark.createDataFrame(rows, RAW_SCHEMA).repartition(3)
    path = scratch_path(spark, "t-csv")
    sinks.write_monthly_csv(df, path, month_expr=F.substring("TX_DATETIME", 1, 7))
    back = readers.read_monthly_csv(spark, path, multiline=True)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:n] for r in back.collect()), key=key) == sorted(rows, key=key)
    assert {r.TX_MONTH for r in back.collect()} == {"2024-01", "2024-02"}


def test_money_means_of_any_amount(spark):
    groups = {"tie": [50.26, 50.27], "neg": [-50.26, -50.27, None], "plain": [0.1] * 7 + [12.345678], "huge": [1e19, 1.0],
              "nan": [float("nan"), 1.0], "inf": [float("inf"), 5.0], "none": [None], "edge": [4e8, 4e8 - 0.5], "zero": [-0.0, 0.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r["k"]: (r["a"], r["s"]) for r in df.groupBy("k").agg(money_avg("v").alias("a"), money_sum("v").alias("s")).collect()}
    for k in ("tie", "neg", "plain", "zero"):
        vs = [Decimal(repr(v)) for v in groups[k] if v is not None]
        assert got[k][0] == float((sum(vs) / len(vs)).quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert got[k][1] == pytest.approx(float(sum(vs)))
    assert got["huge"] == (5e18, 1e19) and got["none"] == (None, None)
    assert math.isnan(got["nan"][0]) and math.isnan(got["nan"][1]) and got["inf"] == (math.inf, math.inf)
    assert got["edge"][0] == 4e8 - 0.25


def test_money_mean_does_not_depend_on_the_order(spark):
    rnd = random.Random(9)
    rows = [(k % 5, round(rnd.uniform(0, 300), 2)) for k in range(4000)]
    runs = []
    for p in (1, 3, 7):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double").repartition(p)
        runs.append(sorted(tuple(r) for r in df.groupBy("k").agg(money_avg("v"), money_sum("v")).collect()))
    assert runs[0] == runs[1] == runs[2]


def test_whole_numbers_in_odd_spellings(spark):
    want = {"7": 7, " 7 ": 7, "+5": 5, "-2.9": -2, "1.0": 1, "1.": 1, ".5": 0, "-.5": 0, "1e3": None, "abc": None, "": None,
            "99999999999999999999": None, "1.5x": None, "--1": None, None: None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r["t"]: r["n"] for r in df.select("t", whole_number("t", "bigint").alias("n")).collect()} == want
