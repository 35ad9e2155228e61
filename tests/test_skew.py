"""A terminal holding a third of all rows: results stay exact and AQE splits the hot join key."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.operators.clean import add_features
from txlens.operators.graph import build, degree, motif

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_tx(spark, n=6000):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        terminal = 0 if i % 3 == 0 else 1 + i % 40          # terminal 0: a third of all rows
        rows.append((i, base + dt.timedelta(minutes=7 * i), i % 97, terminal, float(i % 250) + 0.25,
                     7 * 60 * i, (7 * i) // 1440, int(i % 250 > 220), int(i % 250 > 220)))
    return spark.createDataFrame(rows, "TRANSACTION_ID long, TX_DATETIME timestamp, CUSTOMER_ID long, TERMINAL_ID long, "
                                       "TX_AMOUNT double, TX_TIME_SECONDS long, TX_TIME_DAYS int, TX_FRAUD int, "
                                       "TX_FRAUD_SCENARIO int")


def test_month_features_exact_with_hot_keys_salted(spark, skew_conf):
    tx = skewed_tx(spark)
    out = add_features(tx, hot_rows=300)    # terminal 0 holds ~2000 rows per month -> ~7 salts
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "BroadcastHashJoin" in plan
    m = F.date_format("TX_DATETIME", "yyyy-MM")
    wc, wt = Window.partitionBy(m, "CUSTOMER_ID"), Window.partitionBy(m, "TERMINAL_ID")
    ref = tx.select("TRANSACTION_ID", F.count("TRANSACTION_ID").over(wc).alias("c"),
                    F.avg("TX_AMOUNT").over(wc).alias("a"), F.count("TRANSACTION_ID").over(wt).alias("t"))
    got = out.join(ref, "TRANSACTION_ID")
    assert got.count() == 6000
    bad = got.filter((F.col("c") != F.col("customer_tx_count")) | (F.col("t") != F.col("terminal_tx_count"))
                     | (F.abs(F.col("a") - F.col("customer_avg_amount")) > 1e-9))
    assert bad.count() == 0


def test_salted_join_spreads_the_hot_key(spark):
    from txlens.operators.skew import attach_group_stats
    df = spark.range(0, 9000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1)).alias("k"), "id")
    out = attach_group_stats(df, ["k"], {"n": F.count(F.lit(1))}, hot_rows=500)
    got = {r["k"]: r["n"] for r in out.select("k", "n").distinct().collect()}
    assert got[0] == 3000 and sum(1 for r in out.collect()) == 9000
    # rows of the hot key land in >= 6 different (key, salt) partitions of the join
    per_task = (out.filter(F.col("k") == 0).groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(per_task) >= 2


def test_terminal_risk_and_chains_with_hot_terminal(spark, skew_conf):
    tx = skewed_tx(spark, 1500)
    g = build.build_graph(tx)
    risk = {r["dst"]: r["total_tx"] for r in degree.terminal_risk(g.edges).collect()}
    assert risk["T_0"] == 500
    fast = motif.infection_chains(g.edges)
    naive = motif.infection_chains_naive(g.vertices, g.edges)
    assert fast.count() == naive.count()
    assert fast.exceptAll(naive).count() == 0


def test_salted_adjacency_is_read_in_place(spark):
    """Steps of the iterative algorithms shuffle only the vertex state, never the adjacency,
    and a hot vertex's adjacency is spread over several salts."""
    from txlens.operators.graph.layout import SaltedAdjacency
    adj = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("T_0")).otherwise(F.concat(F.lit("T_"), (F.col("id") % 50 + 1).cast("string"))).alias("src"),
        F.concat(F.lit("C_"), F.col("id").cast("string")).alias("dst"))
    layout = SaltedAdjacency(adj, hot_rows=200, name="t_adj")
    assert layout.hot.filter(F.col("src") == "T_0").first()["_w"] == 5
    state = adj.select(F.col("src").alias("id")).distinct().select("id", F.lit(1).alias("x"))
    joined = layout.join(state)
    assert joined.count() == 3000
    lines = joined._jdf.queryExecution().executedPlan().toString().split("\n")
    i = next(k for k, line in enumerate(lines) if "t_adj" in line)
    # walk up the ancestors of the adjacency scan to the join: no Exchange on the way
    depth, ancestors = lines[i].find("+-"), []
    for line in reversed(lines[:i]):
        d = line.find("+-")
        if 0 <= d < depth:
            ancestors.append(line)
            depth = d
            if "Join" in line:
                break
    assert ancestors and "Join" in ancestors[-1]
    assert not any("Exchange" in line for line in ancestors)
    salts = layout.table.filter(F.col("src") == "T_0").select("_salt").distinct().count()
    assert salts == 5


def test_chains_of_a_terminal_heavy_on_both_sides_are_a_grid(spark, skew_conf):
    """Terminal 0 holds a third of the frauds and of the clean rows: its pairs are spread over cells."""
    from txlens.operators import skew
    g = build.build_graph(skewed_tx(spark, 1500))
    fast = motif.infection_chains(g.edges, cell_rows=40)
    naive = motif.infection_chains_naive(g.vertices, g.edges)
    assert fast.count() == naive.count() and fast.exceptAll(naive).count() == 0
    fraud = g.edges.filter("TX_FRAUD = 1").select("dst", F.col("src").alias("a")).distinct()
    clean = g.edges.filter("TX_FRAUD = 0").select("dst", F.col("src").alias("b"), "TRANSACTION_ID")
    grid = skew.grid_of(skew.key_counts(fraud, ["dst"]), skew.key_counts(clean, ["dst"]), ["dst"], 40)
    cells = {r["dst"]: r["_rows"] * r["_cols"] for r in grid.collect()}
    assert cells["T_0"] >= 10 and set(cells) == {"T_0"}
    pairs = skew.grid_join(fraud, clean, ["dst"], grid).filter("dst = 'T_0'")
    tasks = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= 4 and max(tasks) <= sum(tasks) * 0.6


def test_fragments_do_not_follow_the_order_of_rows(spark):
    """A task that runs again with its rows in another order deals them alike, and equal rows are spread."""
    from txlens.operators import skew
    rows = [(0, i % 40) for i in range(400)] + [(0, 99)] * 400

    def dealt(data):
        df = spark.createDataFrame(spark.sparkContext.parallelize(data, 4), "k int, v int")
        grid = spark.createDataFrame([(0, 8, 3)], "k int, _rows int, _cols int")
        out = skew._dealt(df, ["k"], grid, "_rows", "_cols", "_i", "_j")
        return sorted(tuple(r) for r in out.select(F.spark_partition_id(), "k", "v", "_i", "_j").collect())

    quarters = [rows[i:i + 200] for i in range(0, 800, 200)]
    there, back = dealt(sum(quarters, [])), dealt(sum([q[::-1] for q in quarters], []))
    assert there == back and len(there) == 3 * 800
    assert len({i for _, _, v, i, _ in there if v == 99}) > 1 and {i for _, _, _, i, _ in there} == set(range(8))
