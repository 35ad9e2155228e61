"""Selection by narrowed histograms, interval labelling and binned density, against plain computations."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from txlens.operators import behavior, labeling, selection
from txlens.operators.selection import exact_quantiles, first_rows

PROBS = [0.0, 0.25, 1 / 3, 0.5, 2 / 3, 0.9, 1.0]


@pytest.mark.parametrize("kind", ["ties", "wide", "skewed", "one", "equal", "close"])
def test_quantiles_equal_numpy(spark, kind):
    rnd = np.random.default_rng(1)
    v = {"ties": rnd.integers(0, 7, 3000).astype(float), "wide": rnd.normal(size=3000) * 1e300, "skewed": rnd.lognormal(0, 9, 3000),
         "one": np.array([4.25]), "equal": np.full(500, -2.5), "close": 1.0 + rnd.integers(0, 40, 2000) * 2.0 ** -52}[kind]
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)] * 5, "v double").repartition(4)
    for small in (10_000, 6):
        got = exact_quantiles(df, "v", PROBS, small=small).first()
        want = np.quantile(v, PROBS) if kind != "wide" else np.quantile(v / 1e300, PROBS) * 1e300
        assert np.allclose(list(got), want, rtol=1e-12, atol=0)


def test_quantiles_by_group_with_null_nan_and_infinite(spark):
    rnd = random.Random(2)
    rows = [("a", rnd.gauss(0, 5)) for _ in range(400)] + [(None, rnd.gauss(9, 1)) for _ in range(50)]
    rows += [("b", float("inf"))] * 3 + [("b", 1.0), ("b", float("-inf"))] + [("c", float("nan")), ("c", 2.0), ("c", 3.0)] + [("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: tuple(r)[1:] for r in exact_quantiles(df, "v", [0.0, 0.5, 1.0], "k", small=9).collect()}
    assert set(got) == {"a", None, "b", "c"}
    for k in ("a", None):
        assert np.allclose(got[k], np.quantile([v for g, v in rows if g == k], [0, 0.5, 1]))
    assert got["b"] == (-math.inf, math.inf, math.inf)
    assert got["c"][:2] == (2.0, 3.0) and math.isnan(got["c"][2])
    assert exact_quantiles(df.limit(0), "v", [0.5]).first()[0] is None
    assert exact_quantiles(df.limit(0), "v", [0.5], "k").collect() == []


def test_neighbouring_whole_numbers_beyond_doubles(spark):
    base = 1 << 60
    df = spark.range(500).select(F.lit("x").alias("k"), (F.lit(base) + F.col("id") % 100).alias("o"), "id")
    got = first_rows(df, "k", ["o", "id"], F.lit(123), small=5).collect()
    want = sorted(((base + i % 100, i) for i in range(500)))[:123]
    assert sorted((r["o"], r["id"]) for r in got) == want


def test_first_rows_by_several_columns(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, 2, 2, None]), rnd.choice([0.0, 0.5, 1.5, None]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, o double, id long").repartition(3)
    got = first_rows(df, "k", ["o", "id"], F.floor(F.col("n") / 3), small=4).collect()
    want = []
    for k in (1, 2, None):
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, r[1] or 0.0, r[2]))
        want += mine[:len(mine) // 3]
    assert sorted(r["id"] for r in got) == sorted(r[2] for r in want)
    twins = spark.createDataFrame([(1, 1.0, 5)] * 9, "k int, o double, id long")
    assert first_rows(twins, "k", ["o", "id"], F.lit(4)).count() == 4


def _tx(spark, rows):
    return spark.createDataFrame([(i, c, t, 100.0, d, 0, 0) for i, (c, t, d) in enumerate(rows)],
                                 "TRANSACTION_ID long, CUSTOMER_ID long, TERMINAL_ID long, TX_AMOUNT double, TX_TIME_DAYS int, "
                                 "TX_FRAUD int, TX_FRAUD_SCENARIO int")


def test_terminal_windows_that_overlap_touch_and_stand_alone(spark):
    rnd = random.Random(4)
    windows = [(0, d) for d in (3, 10, 31, 59, 200, 228, 300)] + [(1, 0), (1, 0), (2, 400)] + [(t, rnd.randrange(500)) for t in range(3, 12) for _ in range(6)]
    rows = [(1, 0 if k % 3 else k % 14, rnd.randrange(520)) for k in range(3000)] + [(1, None, 5), (1, 0, None)]
    tx = _tx(spark, rows)
    w = spark.createDataFrame(windows, "TERMINAL_ID long, day int")
    merged = sorted(tuple(r) for r in labeling.merged_windows(w.filter("TERMINAL_ID = 0"), "TERMINAL_ID", 28).collect())
    assert merged == [(0, 3, 87), (0, 200, 256), (0, 300, 328)]
    for cell in (500_000, 50):                             # the second deals the hot terminal over salts
        got = {r["TRANSACTION_ID"]: (r["TX_FRAUD"], r["TX_FRAUD_SCENARIO"])
               for r in labeling.label_terminal_compromise(tx, w, cell_rows=cell).collect()}
        assert len(got) == len(rows)
        for i, (_, t, d) in enumerate(rows):
            hit = d is not None and any(t == x and s <= d < s + 28 for x, s in windows)
            assert got[i] == ((1, 2) if hit else (0, 0)), (i, t, d)


def test_card_windows_with_a_hot_day(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(30), 1, rnd.randrange(40)) for _ in range(1500)]
    windows = [(c, 7) for c in range(0, 30, 2)] + [(c, rnd.randrange(30)) for c in range(30)]
    windows = sorted(set(windows))
    tx, w = _tx(spark, rows), spark.createDataFrame(windows, "CUSTOMER_ID long, day int")
    picks = {r["TRANSACTION_ID"]: r["picks"] for r in labeling.card_compromise_picks(
        tx, w, [F.col("TRANSACTION_ID") % 7, F.col("TRANSACTION_ID")]).collect()}
    want = {}
    for day in {d for _, d in windows}:
        who = {c for c, d in windows if d == day}
        cand = sorted((i % 7, i) for i, (c, _, d) in enumerate(rows) if c in who and day <= d < day + 14)
        for _, i in cand[:len(cand) // 3]:
            want[i] = want.get(i, 0) + 1
    assert picks == want


def test_binned_density_is_close_to_the_exact_sum(spark):
    rnd = np.random.default_rng(6)
    groups = {"a": rnd.normal(50, 9, 400), None: rnd.lognormal(3, 0.7, 300), "one": np.array([3.0]), "same": np.full(8, 1.25)}
    df = spark.createDataFrame([(k, float(x)) for k, v in groups.items() for x in v] + [("none", None)], "g string, v double")
    out = behavior.density_curve(df, "v", "g").collect()
    for k in ("a", None):
        v = groups[k]
        mine = sorted((r["gi"], r["x"], r["density"]) for r in out if r["g"] == k)
        bw = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 200)
        exact = np.exp(-0.5 * ((x[:, None] - v) / bw) ** 2).sum(1) / (bw * math.sqrt(2 * math.pi) * len(v))
        d = (v.max() - v.min()) / (2 * behavior.DENSITY_BINS * bw)
        assert len(mine) == 200 and np.allclose([m[1] for m in mine], x)
        assert np.abs(np.array([m[2] for m in mine]) - exact).max() <= 0.4 / bw * (d ** 7 / 5040 * 30 + 1e-12)
    assert [(r["x"], r["density"]) for r in out if r["g"] == "one"] == [(3.0, None)]
    assert [(r["x"], r["density"]) for r in out if r["g"] == "same"] == [(1.25, None)]
    assert not [r for r in out if r["g"] == "none"] and len(out) == 402


def test_oracle_sql_keeps_null_and_degenerate_groups(spark):
    """The two distribution queries' SQL over groups that the given data does not have."""
    from txlens.plans import oracle_sql
    rows = [("a", 10.0, 3), ("a", 12.0, 4), ("a", 30.0, 9), (None, 5.0, 1), (None, 8.0, 2), ("one", 7.0, 6), ("same", 2.0, 2), ("same", 2.0, 2)]
    df = spark.createDataFrame(rows, "customer_group string, customer_avg_amount double, customer_tx_count long")
    con = duckdb.connect()
    con.execute("CREATE TABLE fixture (customer_group VARCHAR, customer_avg_amount DOUBLE, customer_tx_count BIGINT)")
    con.executemany("INSERT INTO fixture VALUES (?, ?, ?)", rows)

    def sql(name):
        text = oracle_sql()[name]
        at = text.index("grouped_a AS (")
        depth, end = 1, at + len("grouped_a AS (")
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        rest = text[end:].lstrip()
        return "WITH grouped_a AS (SELECT * FROM fixture) " + (", " + rest[1:] if rest.startswith(",") else rest)

    got = behavior.density_curve(df, "customer_avg_amount", "customer_group").collect()
    want = con.execute(sql("density_curve")).fetchall()
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want] and len(got) == 402
    for a, b in zip(got, want):
        assert a[2] == pytest.approx(b[2], abs=2e-6) and (a[3] is None) == (b[3] is None)
        assert a[3] is None or a[3] == pytest.approx(b[3], abs=2e-6)
    box = sorted((tuple(r) for r in behavior.boxplot_stats(df, "customer_tx_count", "customer_group").collect()), key=key)
    names = behavior.boxplot_stats(df, "customer_tx_count", "customer_group").columns
    cur = con.execute(sql("boxplot_stats"))
    cols = [d[0] for d in cur.description]
    want = sorted((tuple(r[cols.index(n)] for n in names) for r in cur.fetchall()), key=key)
    assert len(box) == 4 and [tuple(map(lambda x: round(x, 5) if isinstance(x, float) else x, r)) for r in box] == \
        [tuple(map(lambda x: round(x, 5) if isinstance(x, float) else x, r)) for r in want]
