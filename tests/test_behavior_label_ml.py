"""Behaviour, ordering, labelling, spatial and ML operators on hand-made rows."""

import datetime as dt
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlens.operators import behavior, labeling, ordering, spatial
from txlens.operators.ml import curves, prep, train
from txlens.schema import ML_FEATURES

TX_SCHEMA = ("TRANSACTION_ID long, TX_DATETIME timestamp, CUSTOMER_ID long, TERMINAL_ID long, TX_AMOUNT double, "
             "TX_TIME_DAYS int, TX_FRAUD int, TX_FRAUD_SCENARIO int")


def tx(spark, data):
    return spark.createDataFrame(data, TX_SCHEMA)


def ts(h, d=1):
    return dt.datetime(2024, 1, d, h, 0, 0)


def test_night_spikes_sigma_zero_and_single_row(spark):
    data = [(i, ts(2, i % 28 + 1), 1, 1, 10.0, 0, 0, 0) for i in range(1, 11)]   # sigma = 0
    data += [(100, ts(3), 2, 5, 1.0, 0, 0, 0)]                                      # one row: sigma NULL
    data += [(200 + i, ts(12, i % 28 + 1), 3, 7, 10.0, 0, 0, 0) for i in range(40)]
    data += [(300, ts(1), 3, 8, 900.0, 0, 1, 1)]                                    # night spike
    data += [(400 + i, ts(12, i % 28 + 1), 4, 7, 10.0, 0, 0, 0) for i in range(40)]
    data += [(500, ts(14), 4, 9, 900.0, 0, 0, 0)]                                   # day-time: not night
    spikes = behavior.night_spikes(tx(spark, data))
    assert [r["TRANSACTION_ID"] for r in spikes.collect()] == [300]
    amounts = [10.0] * 40 + [900.0]
    r = spikes.first()
    assert np.isclose(r["cust_avg"], np.mean(amounts)) and np.isclose(r["cust_std"], np.std(amounts, ddof=1))


def test_night_spike_customers_equal_rows_of_night_spikes(spark):
    import collections
    data = [(i, ts(12, i % 28 + 1), i % 3, i % 5, 10.0 + i % 2, 0, i % 7 == 0, 0) for i in range(150)]
    data += [(1000 + i, ts(i % 5, 2), i % 2, i, 500.0 + i, 0, 1, 1) for i in range(4)]
    data = [(*d[:6], int(d[6]), d[7]) for d in data]
    frame = tx(spark, data)
    seen = collections.defaultdict(list)
    for r in behavior.night_spikes(frame).collect():
        seen[r["CUSTOMER_ID"]].append(r)
    got = {r["CUSTOMER_ID"]: r for r in behavior.night_spike_customers(frame, min_terminals=0).collect()}
    assert set(got) == set(seen) and seen
    for c, rs in seen.items():
        assert got[c]["night_spike_tx_count"] == len(rs)
        assert got[c]["unique_pos_count"] == len({r["TERMINAL_ID"] for r in rs})
        assert got[c]["max_spike_amount"] == max(r["TX_AMOUNT"] for r in rs)
        assert got[c]["fraud_cases_detected"] == sum(r["TX_FRAUD"] for r in rs)


def test_exact_quantiles_match_numpy(spark):
    vals = [float(x) for x in [5, 1, 9, 3, 3, 7, 2, 8, 10, 4, 6]]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = ordering.exact_quantiles(df, "v", [0.25, 1 / 3, 0.5, 2 / 3, 0.75]).first()
    assert np.allclose(list(got), np.quantile(vals, [0.25, 1 / 3, 0.5, 2 / 3, 0.75]))
    grouped = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 10.0), ("b", 20.0), ("b", 30.0)], "g string, v double")
    got = {r["g"]: r["q_0"] for r in ordering.exact_quantiles(grouped, "v", [0.5], "g").collect()}
    assert got == {"a": 1.5, "b": 20.0}


def test_terciles_equal_values(spark):
    prof = spark.createDataFrame([(i, 5, 10.0, 0) for i in range(6)],
                                 "CUSTOMER_ID long, customer_tx_count long, customer_avg_amount double, total_fraud_count long")
    seg = behavior.customer_segments(prof)
    assert {r["tx_count_group"] for r in seg.collect()} == {"Low"}


def test_global_index_matches_sort(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1009).alias("k"), F.col("id"))
    idx = ordering.with_global_index(df, ["k", "id"], "i", num_partitions=7)
    got = [r["id"] for r in idx.orderBy("i").collect()]
    exp = [r["id"] for r in df.orderBy("k", "id").collect()]
    assert got == exp
    assert sorted(r["i"] for r in idx.collect()) == list(range(1000))


def test_card_compromise_row_picked_twice(spark):
    # customer 1, 6 rows on days 0..5; windows start day 0 and 2 (both cover days 2..5)
    data = [(i, ts(10, i + 1), 1, 1, 10.0, i, 0, 0) for i in range(6)]
    windows = spark.createDataFrame([(1, 0), (1, 2)], "CUSTOMER_ID long, day int")
    out = labeling.label_card_compromise(tx(spark, data), windows, [F.col("TRANSACTION_ID")], length=14)
    got = {r["TRANSACTION_ID"]: (r["TX_AMOUNT"], r["TX_FRAUD_SCENARIO"]) for r in out.collect()}
    # window 0: 6 rows -> first 2 (ids 0, 1); window 2: rows 2..5 -> first 1 (id 2)
    assert got[0] == (50.0, 3) and got[1] == (50.0, 3) and got[2] == (50.0, 3)
    assert got[3] == (10.0, 0)
    windows2 = spark.createDataFrame([(1, 0), (1, 0 + 0)], "CUSTOMER_ID long, day int").distinct()
    windows3 = windows2.unionByName(spark.createDataFrame([(1, 1)], "CUSTOMER_ID long, day int"))
    out3 = labeling.label_card_compromise(tx(spark, data), windows3, [F.col("TRANSACTION_ID")], length=14)
    amt = {r["TRANSACTION_ID"]: r["TX_AMOUNT"] for r in out3.collect()}
    assert amt[1] == 250.0  # picked by window 0 and window 1 -> x25


def test_terminal_compromise_window_bounds(spark):
    data = [(d, ts(10, d + 1), 1, 7, 10.0, d, 0, 0) for d in range(0, 31)]
    windows = spark.createDataFrame([(7, 1)], "TERMINAL_ID long, day int")
    out = labeling.label_terminal_compromise(tx(spark, data), windows)
    hit = sorted(r["TX_TIME_DAYS"] for r in out.collect() if r["TX_FRAUD_SCENARIO"] == 2)
    assert hit == list(range(1, 29))


def test_label_scenarios_order(spark):
    data = [(1, ts(1), 1, 7, 300.0, 0, 0, 0), (2, ts(2), 2, 8, 10.0, 0, 0, 0)]
    tw = spark.createDataFrame([(7, 0)], "TERMINAL_ID long, day int")
    cw = spark.createDataFrame([], "CUSTOMER_ID long, day int")
    out = {r["TRANSACTION_ID"]: r for r in labeling.label_scenarios(tx(spark, data), tw, cw, [F.col("TRANSACTION_ID")]).collect()}
    assert out[1]["TX_FRAUD_SCENARIO"] == 2 and out[1]["TX_FRAUD"] == 1  # scenario 2 overwrites 1
    assert out[2]["TX_FRAUD"] == 0


def test_radius_join_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    cust = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 100, (200, 2)))]
    term = [(j, float(x), float(y)) for j, (x, y) in enumerate(rng.uniform(0, 100, (300, 2)))]
    c = spark.createDataFrame(cust, "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    t = spark.createDataFrame(term, "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")
    got = {r["CUSTOMER_ID"]: list(r["available_terminals"]) for r in spatial.terminals_within_radius(c, t, 7.5).collect()}
    for i, x, y in cust:
        exp = sorted(j for j, tx_, ty in term if np.sqrt((x - tx_) ** 2 + (y - ty) ** 2) < 7.5)
        assert got[i] == exp


def test_counts_in_reach_match_brute_force(spark):
    rng = np.random.default_rng(8)
    crowd = rng.normal(50, 0.5, (600, 2)).tolist() + [[50.0, 50.0]] * 60     # a dense cell, and places that no split parts
    term = [(j, x, y) for j, (x, y) in enumerate(rng.uniform(0, 100, (300, 2)).tolist() + crowd + [[10.0, 10.0], [-3.0, -4.0]])]
    cust = [(i, x, y) for i, (x, y) in enumerate(rng.uniform(0, 100, (60, 2)).tolist() + rng.normal(50, 4, (60, 2)).tolist()
                                                 + [[50.0, 50.0], [50.0, 57.5], [0.0, 0.0], [17.5, 10.0], [-3.0, -4.0]])]
    cust += [(7, 1.0, 1.0), (900, None, 1.0), (901, 3.0, float("nan"))]
    c = spark.createDataFrame(cust, "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    t = spark.createDataFrame([*term, (9999, None, None)], "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")

    def near(x, y, r):
        if x is None or y is None:
            return 0
        return sum(np.sqrt((x - a) ** 2 + (y - b) ** 2) < r for _, a, b in term)

    got = sorted(map(tuple, spatial.terminals_in_reach(c, t, 7.5, leaf_rows=8).collect()))
    assert got == sorted((i, near(x, y, 7.5)) for i, x, y in cust)
    tree = spatial.quadtree(t, 7.5, leaf_rows=8)
    big = tree.groupBy("cx", "cy", "depth", "lx", "ly").agg(F.count("*").alias("n"), F.countDistinct("tx", "ty").alias("places"))
    assert tree.count() == len(term) and [r["n"] for r in big.filter("n > 8 and places = 1").collect()] == [60]
    assert big.filter(f"n > 8 and places > 1 and depth < {spatial.MAX_DEPTH}").count() == 0
    assert spatial.terminals_in_reach(c, t.limit(0), 5.0).agg({"nb_terminals": "sum"}).first()[0] == 0
    assert spatial.terminals_in_reach(c.limit(0), t, 5.0).count() == 0


def test_roc_curve_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 50, 400).astype(float)
    labels = rng.integers(0, 2, 400)
    df = spark.createDataFrame([(float(s), int(l)) for s, l in zip(scores, labels)], "score double, label int")
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in curves.roc_curve(df, "score", "label", 5).collect()}
    P, N = labels.sum(), (1 - labels).sum()
    for thr in np.unique(scores):
        tp = ((scores >= thr) & (labels == 1)).sum()
        fp = ((scores >= thr) & (labels == 0)).sum()
        assert np.isclose(roc[thr][0], fp / N) and np.isclose(roc[thr][1], tp / P)
    assert roc[None] == (0.0, 0.0)


def _ml_frame(spark, one_class=False):
    data = []
    for i in range(25):
        fraud = 0 if (one_class or i < 20) else 1
        data.append((i, 10.0 + i * (30 if fraud else 1), 1000 * i, i % 24, i % 2, int(i % 24 < 6), 3, 20.0, 5, fraud))
    return spark.createDataFrame(data, "TRANSACTION_ID long, TX_AMOUNT double, TX_TIME_SECONDS long, tx_hour int, "
                                       "is_weekend int, is_night int, customer_tx_count long, customer_avg_amount double, "
                                       "terminal_tx_count long, TX_FRAUD int")


def test_feature_list_and_missing_column(spark):
    assert ML_FEATURES == ["TX_AMOUNT", "TX_TIME_SECONDS", "tx_hour", "is_weekend", "is_night",
                           "customer_tx_count", "customer_avg_amount", "terminal_tx_count"]
    with pytest.raises(ValueError):
        prep.prepare_features(_ml_frame(spark).drop("tx_hour"))


def test_class_weights_minority_heavier_and_one_class_error(spark):
    w = prep.add_class_weights(prep.prepare_features(_ml_frame(spark)))
    ws = {r["TX_FRAUD"]: r["class_weight"] for r in w.select("TX_FRAUD", "class_weight").distinct().collect()}
    assert ws[1.0] > ws[0.0] and abs(ws[1.0] - 25 / 10) < 1e-9
    with pytest.raises(ValueError, match="Need both classes"):
        prep.add_class_weights(prep.prepare_features(_ml_frame(spark, one_class=True)))


def test_pipeline_stages_and_params():
    p = train.build_pipeline()
    names = [type(s).__name__ for s in p.getStages()]
    assert names == ["VectorAssembler", "StandardScaler", "LogisticRegression"]
    lr = p.getStages()[-1]
    assert lr.getMaxIter() == 50 and lr.getRegParam() == 0.1 and lr.getElasticNetParam() == 0.0
    assert p.getStages()[0].getHandleInvalid() == "keep"


def test_pr_curve_end_point(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1)], "score double, label int")
    pr = [tuple(r) for r in curves.pr_curve(df, "score", "label").collect()]
    assert (None, 1.0, 0.0) in pr
    assert (0.9, 1.0, 0.5) in pr


def test_density_and_boxes_keep_every_group(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("one", 7.0), ("same", 3.0), ("same", 3.0), (None, 1.0), (None, 5.0),
            ("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = behavior.density_curve(df, "v", "g", grid=50).collect()
    by = {g: [r for r in out if r["g"] == g] for g in ("a", None, "one", "same", "empty")}
    assert {g: len(x) for g, x in by.items()} == {"a": 50, None: 50, "one": 1, "same": 1, "empty": 0}
    for g, x in (("one", 7.0), ("same", 3.0)):
        assert (by[g][0]["gi"], by[g][0]["x"], by[g][0]["density"]) == (0, x, None)
    for g, vals in (("a", [1.0, 2.0, 4.0]), (None, [1.0, 5.0])):
        bw = statistics.stdev(vals) * len(vals) ** -0.2
        for r in by[g]:
            want = sum(math.exp(-0.5 * ((r["x"] - x) / bw) ** 2) for x in vals) / (bw * math.sqrt(2 * math.pi) * len(vals))
            assert abs(r["density"] - want) < 1e-9
    boxes = {r["g"]: r for r in behavior.boxplot_stats(df.filter("v is not null"), "v", "g").collect()}
    assert {g: r["n"] for g, r in boxes.items()} == {"a": 3, "one": 1, "same": 2, None: 2}
    assert (boxes[None]["median"], boxes[None]["whisker_low"], boxes[None]["whisker_high"]) == (3.0, 1.0, 5.0)
