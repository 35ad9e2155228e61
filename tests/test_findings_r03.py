"""Steps whose shuffles, sorts or tasks grew faster than their input."""

import datetime as dt
import re

from pyspark.sql import functions as F

from support import SF001
from txlens.operators import skew, spatial
from txlens.operators.clean import add_features
from txlens.operators.graph import build, community, motif
from txlens.operators.graph.layout import SaltedAdjacency, number_ids
from txlens.plans import q_graph
from txlens.session import Scratch
from txlens.sources import sinks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _edges(spark, n=400):
    return spark.createDataFrame([(f"C_{k % 23}", f"T_{k * k % 11}", k, float(k), int(k % 13 == 0), 7 * k % 301) for k in range(n)],
                                 "src string, dst string, TRANSACTION_ID long, TX_AMOUNT double, TX_FRAUD int, TX_TIME_SECONDS long")


def _vertices(e):
    ids = e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    return ids.select("id", F.substring("id", 1, 1).alias("type"))


def test_chains_shuffle_no_pairs_of_frauds_and_visitors(spark):
    """nothing is grouped by (fraud customer, terminal, visitor)."""
    e = _edges(spark)
    chains = motif.infection_chains(e)
    assert not re.search(r"keys=\[a#\d+L?, t1#\d+L?, b#", _plan(chains))
    naive = motif.infection_chains_naive(_vertices(e), e)
    assert chains.count() == naive.count() > 0 and chains.exceptAll(naive).count() == 0


def test_chains_of_a_victim_with_several_lists_of_terminals(spark, monkeypatch):
    monkeypatch.setattr(motif, "LIST_ROWS", 2)
    e = _edges(spark)
    chains, naive = motif.infection_chains(e, cell_rows=20), motif.infection_chains_naive(_vertices(e), e)
    assert chains.count() == naive.count() > 0 and chains.exceptAll(naive).count() == 0


def test_chains_skip_edges_without_ends_or_time(spark):
    e = _edges(spark, 120)
    holes = spark.createDataFrame([(None, "T_1", 900, 1.0, 1, 0), ("C_1", None, 901, 1.0, 0, 50), ("C_2", "T_1", 902, 1.0, 0, None),
                                   ("C_3", "T_1", 903, 1.0, None, 60)], e.schema)
    got, want = motif.infection_chains(e.unionByName(holes)), motif.infection_chains(e)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_motif_order_starts_where_fewest_rows_are_joined_again(spark):
    """of two small terms of one size, the one that meets the large term on the rarer vertex leads."""
    terms = motif.parse_pattern("(a)-[e1]->(t1); (b)-[e2]->(t1); (b)-[e3]->(t2)")
    sizes = {"e1": (1167, 800, 100), "e2": (98833, 1500, 100), "e3": (1167, 800, 100)}
    assert [t.edge for t in motif.plan_order(sizes, terms)] == ["e3", "e2", "e1"]


def test_terminals_of_a_place_are_listed_once(spark):
    """customers of one place share a list; repeated customers, and those without id or place, as before."""
    places = [(k, float(k % 3), 0.0) for k in range(30)] + [(5, 50.0, 0.0), (7, 1.0, 0.0), (None, 0.0, 0.0), (40, None, 0.0),
                                                            (41, 900.0, 0.0), (42, float("nan"), 0.0)]
    c = spark.createDataFrame(places, "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    stops = [(k, float(k % 5), float(k % 2)) for k in range(20)] + [(99, 50.5, 0.0), (98, None, 0.0)]
    t = spark.createDataFrame(stops, "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")
    got = spatial.terminals_within_radius(c, t, 2.0)
    assert "keys=[x#" in _plan(got)
    near = lambda x, y: [i for i, a, b in stops if None not in (x, a) and ((x - a) ** 2 + (y - b) ** 2) ** 0.5 < 2.0]
    of = {}
    for i, x, y in places:
        of[i] = sorted(of.get(i, []) + near(x, y))
    of[None] = []
    want = sorted((i if i is not None else -1, of[i], len(of[i])) for i, _, _ in places)
    assert sorted((r[0] if r[0] is not None else -1, list(r[1]), r[2]) for r in got.collect()) == want


def test_votes_take_one_shuffle_and_no_sort_of_the_adjacency(spark):
    """A step of label propagation streams the adjacency and shuffles its messages once, hot vertices apart."""
    adj = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "T_0").otherwise(F.concat(F.lit("T_"), (F.col("id") % 50 + 1).cast("string"))).alias("src"),
                                   F.concat(F.lit("C_"), (F.col("id") % 70).cast("string")).alias("dst"), F.lit(1).cast("long").alias("w"))
    state = adj.select(F.col("src").alias("id")).distinct().select("id", F.substring("id", 3, 1).alias("label"))
    for hot_rows in (200, 2_000_000):
        with SaltedAdjacency(adj, hot_rows, "t_votes") as layout:
            joined = layout.join(state)
            plan = _plan(joined)
            assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
            messages = joined.select(F.col("dst").alias("id"), "label", F.col("w").alias("score"))
            votes = community._votes(messages, layout, 3000)
            best = votes.groupBy("id").agg(F.max("score"))
            if not layout.any_hot:
                assert _plan(best).count("Exchange hash") == _plan(joined).count("Exchange hash") + 1
            want = adj.join(state.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id"), "label").agg(F.sum("w").alias("score"))
            assert votes.exceptAll(want).count() == 0 and want.exceptAll(votes).count() == 0


def test_votes_of_repeated_and_missing_vertices(spark):
    """A vertex listed twice votes twice, an end that is no vertex does not vote."""
    e = _edges(spark, 12).select("src", "dst").distinct()
    v = spark.createDataFrame([("C_0",), ("C_1",), ("C_1",), ("T_0",), ("T_1",), ("T_4",)], "id string")
    got = {r["id"]: r["label"] for r in community.label_propagation(v, e, 1).collect()}
    weight = {"C_0": 1, "C_1": 2, "T_0": 1, "T_1": 1, "T_4": 1}
    pairs = [(r["src"], r["dst"]) for r in e.collect()]
    for i in weight:
        score = {}
        for s, d in pairs + [(d, s) for s, d in pairs]:
            if d == i and s in weight:
                score[s] = score.get(s, 0) + weight[s]
        assert got[i] == (min(score, key=lambda x: (-score[x], x)) if score else i)


def test_group_stats_read_their_aggregate_once(spark):
    """The hot groups and the join share one aggregate."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"), "id")
        out = skew.attach_group_stats(df.join(spark.range(9000), "id"), ["k"], {"n": F.count("id"), "m": F.avg("id")}, hot_rows=500)
        rows = out.collect()
        assert out.columns == ["k", "id", "n", "m"] and len(rows) == 9000
        assert "ReusedExchange" in _plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r["n"] for r in rows if r["k"] == 0} == {3000} and {r["m"] for r in rows if r["k"] == 0} == {4498.5}


def test_labels_travel_as_numbers_in_the_order_of_the_ids(spark):
    """Label propagation runs on whole numbers, and the choice of a label is no sort of objects."""
    e = _edges(spark)
    v = _vertices(e).unionByName(spark.createDataFrame([(None, "T"), ("C_1", "C")], "id string, type string"))
    with Scratch() as scratch:
        numbers = number_ids(v.repartition(5), scratch)
        ids = sorted({r["id"] for r in v.collect() if r["id"] is not None})
        assert sorted((r["num"], r["id"], r["copies"]) for r in numbers.collect()) == [(k, i, 1 + (i == "C_1")) for k, i in enumerate(ids)]
        assert dict(community._numbered_adjacency(e, numbers).dtypes) == {"src": "bigint", "dst": "bigint", "w": "bigint"}
        empty = number_ids(v.limit(0), scratch)
        assert empty.count() == 0
    votes = spark.createDataFrame([(1, 7, 3), (1, 4, 3), (1, 2, 1), (2, 9, 5), (3, 0, 1), (3, 9, 1)], "id long, label long, score long")
    for weight, how in ((20, "HashAggregate"), (1 << 61, "SortAggregate")):
        best = community._most_voted(votes, 10, weight)
        assert sorted(map(tuple, best.collect())) == [(1, 4), (2, 9), (3, 0)]
        assert how in _plan(best) and ("SortAggregate" in _plan(best)) == (how == "SortAggregate")


def test_labels_without_vertices_or_edges(spark):
    e = _edges(spark, 12)
    none = spark.createDataFrame([], "id string, type string")
    assert community.label_propagation(none, e, 2).count() == 0
    alone = spark.createDataFrame([("C_9", "C"), (None, "C"), ("C_9", "C")], "id string, type string")
    got = community.label_propagation(alone, e.limit(0), 2)
    assert sorted(map(str, got.collect())) == sorted(map(str, alone.withColumn("label", F.col("id")).collect()))


def test_graph_of_the_communities_is_joined_once(spark):
    """Vertices, edges and the transactions of mapping C read one written table, not a join each."""
    tx, g = q_graph.graph_c_once(spark, SF001, "TX_FRAUD")
    assert not any("Join" in _plan(df) for df in (tx, g.vertices, g.edges))
    whole = q_graph.graph_c(spark, SF001)
    assert g.vertices.exceptAll(whole.vertices).count() == 0 == whole.vertices.exceptAll(g.vertices).count()
    want = whole.edges.select("src", "dst", "TX_FRAUD")
    assert g.edges.count() == want.count() > 0 and g.edges.select(*want.columns).exceptAll(want).count() == 0


def test_monthly_features_are_written_as_their_last_shuffle_deals_them(spark, tmp_path):
    """two shuffles of the rows, none of an aggregate of all groups, none for the writer; hot groups, large months and NULLs as before."""
    rows = [(i, None if i % 50 == 0 else dt.datetime(2024, 1 + (i % 7) // 6, 3, i % 24), None if i % 41 == 0 else i % 23 if i % 3 else 1,
             None if i % 37 == 0 else i % 5, None if i % 4 == 0 or i % 23 == 2 else i / 8, i, 0, i % 2, 0) for i in range(3000)]
    tx = spark.createDataFrame(rows, "TRANSACTION_ID long, TX_DATETIME timestamp, CUSTOMER_ID long, TERMINAL_ID long, TX_AMOUNT double, "
                                     "TX_TIME_SECONDS long, TX_TIME_DAYS int, TX_FRAUD int, TX_FRAUD_SCENARIO int")
    tx = tx.unionByName(tx.limit(40))
    want = sorted(map(str, add_features(tx).collect()))
    for hot_rows in (60, 2_000_000):
        out = add_features(tx, hot_rows=hot_rows, by_month=True)
        assert sorted(map(str, out.collect())) == want
    plan = _plan(out).split("Initial Plan")[-1]
    assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin" not in plan and sinks._layout(out, laid_out=True) is out
    path = str(tmp_path / "b")
    sinks.write_parquet(out, path, laid_out=True)
    files = [p for p in (tmp_path / "b").rglob("*.parquet")]
    assert len(files) == len({p.parent for p in files}) == 3            # one file a month while a month is one slice
    assert sorted(map(str, spark.read.schema(out.schema).parquet(path).select(*out.columns).collect())) == want
    stats = {"n": F.count("TRANSACTION_ID"), "m": F.avg("TX_AMOUNT")}
    keyed = tx.select(F.coalesce("TERMINAL_ID", F.lit(-1)).alias("t"), F.pmod("TRANSACTION_ID", F.lit(3)).alias("g"), "TRANSACTION_ID", "TX_AMOUNT")
    plain = keyed.join(keyed.groupBy("g", "t").agg(*[e.alias(n) for n, e in stats.items()]), ["g", "t"]).select("t", "g", "TRANSACTION_ID", "TX_AMOUNT", "n", "m")
    for slice_rows in (30, 500_000):
        got = skew.window_group_stats(keyed, ["g", "t"], stats, 100, within="g", slice_rows=slice_rows)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        # slices of a large value go to different tasks
        assert (got.filter("g = 1").select(F.spark_partition_id()).distinct().count() > 1) <= (slice_rows == 30)


def test_components_contract_two_links_a_vertex(spark, monkeypatch):
    """rounds run on the links to smallest neighbours and on edges between their trees, not on all edges."""
    pairs = [(f"C_{i % 40 + 100 * k}", f"T_{(i * 7 + i // 40) % 50 + 100 * k}") for k in range(3) for i in range(1500)]
    pairs += [("C_1", "T_101"), ("C_9", "C_9"), ("T_777", "C_778"), ("C_778", "C_779"), (None, "T_1"), ("C_5", None)]
    e = spark.createDataFrame(pairs, "src string, dst string")
    v = e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    v = v.unionByName(spark.createDataFrame([("A_alone",), (None,), ("C_1",)], "id string"))
    contract, asked = community._contracted, []

    def watched(links, scratch, log=None):
        asked.append(links.count())
        return contract(links, scratch, log)

    monkeypatch.setattr(community, "_contracted", watched)
    got = community.connected_components(v, e).collect()
    assert len(got) == v.count() and asked[0] <= 2 * v.count() and sum(asked) < 1000 < e.distinct().count()
    label = {r["id"]: r["id"] for r in got}
    while True:
        low = dict(label)
        for a, b in pairs:
            if a is not None and b is not None:
                low[a] = low[b] = min(low[a], low[b])
        if low == label:
            break
        label = low
    assert {r["id"]: r["component"] for r in got} == label
    _, g = q_graph.graph_c_once(spark, SF001)
    whole = q_graph.graph_c(spark, SF001)
    mine = community.connected_components(g.vertices, g.edges)
    assert mine.select("id").exceptAll(whole.vertices.select("id")).count() == 0 and mine.count() == whole.vertices.count()


def test_edges_meet_their_vertices_by_whole_numbers(spark):
    """No text of an edge is shuffled, pairs are written once for both directions, and labels stay the same."""
    plain = _edges(spark)
    key = lambda c: F.substring(c, 3, 9).cast("bigint")
    e = plain.select("src", "dst", key("src").alias("CUSTOMER_ID"), key("dst").alias("TERMINAL_ID"))
    # ends that are no vertex, ids listed twice, ids that only look like a number, edges without an end
    more = [("C_99", "T_1", 99, 1), ("C_1", "T_98", 1, 98), (None, "T_1", None, 1), ("C_2", None, 2, None)]
    e = e.unionByName(spark.createDataFrame(more, e.schema))
    v = _vertices(plain).unionByName(spark.createDataFrame(
        [("C_1", "C"), (None, "T"), ("C_01", "C"), ("C_ 2", "C"), ("C_x", "C"), ("T_", "T"), ("A_3", "A")], "id string, type string"))
    for steps in (1, 3):
        want = community.label_propagation(v, e, steps).collect()
        got = community.label_propagation(v, e, steps, keys=build.TX_KEYS).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == v.count()
    texts = e.withColumn("CUSTOMER_ID", F.col("CUSTOMER_ID").cast("string"))
    got = community.label_propagation(v, texts, 3, keys=build.TX_KEYS).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    with Scratch() as scratch:
        numbers = number_ids(v, scratch)
        rows = community._numbered_adjacency(e, numbers, build.TX_KEYS)
        assert not re.search(r"hashpartitioning\((src|dst)#\d+,", _plan(rows))      # numbers end in L
        assert rows.exceptAll(community._numbered_adjacency(e, numbers)).count() == 0 < rows.count()
        stored = community._numbered_adjacency(e, numbers, build.TX_KEYS, scratch)
        assert "Join" not in _plan(stored) and rows.exceptAll(stored).count() == 0 == stored.exceptAll(rows).count()
