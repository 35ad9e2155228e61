"""Graph operators: motif rewrite equality, BFS, LPA, components, PageRank."""

import pytest
from pyspark.sql import functions as F

from support import SF001, rows
from txlens.operators.graph import build, community, degree, motif, traversal
from txlens.sources import adapters as ad

EDGE_SCHEMA = "src string, dst string, TRANSACTION_ID long, TX_AMOUNT double, TX_FRAUD int, TX_TIME_SECONDS long"


def graph(spark, edges):
    e = spark.createDataFrame(edges, EDGE_SCHEMA)
    v = (e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
          .select("id", F.when(F.col("id").startswith("C_"), "Customer").otherwise("Terminal").alias("type")))
    return v, e


CHAIN_EDGES = [
    ("C_1", "T_1", 1, 10.0, 1, 100),   # fraud of A on T1
    ("C_2", "T_1", 2, 10.0, 0, 200),   # B on T1 after
    ("C_2", "T_2", 3, 10.0, 0, 300),   # B on T2 after -> chain (C_1, T_1, C_2, T_2)
    ("C_3", "T_1", 4, 10.0, 0, 100),   # equal time to the fraud: not after (strict)
    ("C_3", "T_3", 5, 10.0, 0, 400),
    ("C_1", "T_1", 6, 10.0, 0, 500),   # A itself: A != B excluded
    ("C_1", "T_4", 7, 10.0, 0, 600),
    ("C_4", "T_1", 8, 10.0, 0, 150),   # B on T1 after, but only later tx is on T1 itself (T1 != T2)
    ("C_4", "T_1", 9, 10.0, 0, 160),
    ("C_2", "T_1", 10, 10.0, 0, 200),  # parallel edge
]


def test_infection_chain_rewrite_matches_naive_small(spark):
    v, e = graph(spark, CHAIN_EDGES)
    fast = rows(motif.infection_chains(e))
    naive = rows(motif.infection_chains_naive(v, e))
    assert fast == naive == [("C_1", "T_1", "C_2", "T_2")]


def test_infection_chain_rewrite_matches_naive_sf0001(spark):
    g = build.build_graph(ad.events_tx(spark, SF001))
    fast = motif.infection_chains(g.edges)
    naive = motif.infection_chains_naive(g.vertices, g.edges)
    assert fast.count() == naive.count() == 1031
    assert fast.exceptAll(naive).count() == 0


def test_find_motif_rejects_disconnected_terms(spark):
    v, e = graph(spark, CHAIN_EDGES)
    with pytest.raises(ValueError):
        motif.find_motif(v, e, [("a", "e1", "b"), ("c", "e2", "d")])


def test_bfs_shortest_paths_and_no_path(spark):
    edges = [("C_1", "T_1", 1, 1.0, 0, 1), ("C_2", "T_1", 2, 1.0, 0, 2), ("C_2", "T_2", 3, 1.0, 0, 3),
             ("C_3", "T_2", 4, 1.0, 0, 4), ("C_9", "T_9", 5, 1.0, 0, 5)]
    v, e = graph(spark, edges)
    paths = traversal.bfs_paths(v, e, "id = 'C_1'", "type = 'Customer' AND id != 'C_1'", 4)
    assert paths.columns == ["from", "v1", "to"]
    assert rows(paths) == [("C_1", "T_1", "C_2")]  # stops at the first level with a hit
    far = traversal.bfs_paths(v, e, "id = 'C_1'", "id = 'C_3'", 4)
    assert rows(far) == [("C_1", "T_1", "C_2", "T_2", "C_3")]
    none = traversal.bfs_paths(v, e, "id = 'C_1'", "id = 'C_9'", 4)
    assert none.count() == 0 and none.columns == ["from", "v1", "v2", "v3", "to"]


def test_hop_distance(spark):
    edges = [("C_1", "T_1", 1, 1.0, 0, 1), ("C_2", "T_1", 2, 1.0, 0, 2), ("C_2", "T_2", 3, 1.0, 0, 3)]
    v, e = graph(spark, edges)
    assert rows(traversal.hop_distance(v, e, "id = 'C_1'", 4)) == [("C_1", 0), ("C_2", 2), ("T_1", 1), ("T_2", 3)]


def test_lpa_ties_smallest_label_and_isolated_pair(spark):
    # isolated pair: the two vertices swap labels every synchronous step
    v, e = graph(spark, [("C_1", "T_1", 1, 1.0, 0, 1)])
    one = {r["id"]: r["label"] for r in community.label_propagation(v, e, 1).collect()}
    assert one == {"C_1": "T_1", "T_1": "C_1"}
    two = {r["id"]: r["label"] for r in community.label_propagation(v, e, 2).collect()}
    assert two == {"C_1": "C_1", "T_1": "T_1"}
    # parallel edges weigh more: C_1 has 2 edges to T_2, 1 to T_1
    v, e = graph(spark, [("C_1", "T_1", 1, 1.0, 0, 1), ("C_1", "T_2", 2, 1.0, 0, 2), ("C_1", "T_2", 3, 1.0, 0, 3)])
    lab = {r["id"]: r["label"] for r in community.label_propagation(v, e, 1).collect()}
    assert lab["C_1"] == "T_2"
    # tie between T_1 and T_2 -> smallest label
    v, e = graph(spark, [("C_1", "T_2", 1, 1.0, 0, 1), ("C_1", "T_1", 2, 1.0, 0, 2)])
    lab = {r["id"]: r["label"] for r in community.label_propagation(v, e, 1).collect()}
    assert lab["C_1"] == "T_1"


def test_connected_components_chain(spark):
    edges = [("C_5", "T_4", 1, 1.0, 0, 1), ("C_3", "T_4", 2, 1.0, 0, 2), ("C_3", "T_2", 3, 1.0, 0, 3),
             ("C_1", "T_2", 4, 1.0, 0, 4), ("C_9", "T_9", 5, 1.0, 0, 5)]
    v, e = graph(spark, edges)
    comp = {r["id"]: r["component"] for r in community.connected_components(v, e).collect()}
    assert {comp[x] for x in ("C_5", "T_4", "C_3", "T_2", "C_1")} == {"C_1"}
    assert comp["C_9"] == comp["T_9"] == "C_9"


def test_pagerank_sums_to_vertex_count(spark):
    v, e = graph(spark, CHAIN_EDGES)
    pr = community.pagerank(v, e, 0.15, 10)
    total = pr.agg(F.sum("pagerank")).first()[0]
    assert abs(total - v.count()) < 1e-6
    ranks = {r["id"]: r["pagerank"] for r in pr.collect()}
    assert ranks["T_1"] > ranks["T_3"]


def test_degree_outliers_and_risk(spark):
    v, e = graph(spark, CHAIN_EDGES)
    risk = {r["dst"]: r for r in degree.terminal_risk(e).collect()}
    assert risk["T_1"]["total_tx"] == 7 and risk["T_1"]["fraud_tx_count"] == 1
    assert risk["T_1"]["fraud_rate_pct"] == 14.29
    hr = degree.high_risk_terminals(e, 1, 50.0)
    assert [r["dst"] for r in hr.collect()] == ["T_1"]
    sub = degree.high_risk_subgraph_edges(e, 1, 50.0)
    assert sub.count() == 7


def test_community_edges_fallback(spark):
    v, e = graph(spark, [("C_1", "T_1", 1, 1.0, 0, 1), ("C_2", "T_2", 2, 1.0, 0, 2)])
    members = spark.createDataFrame([("C_1",)], "id string")
    assert rows(build.community_edges(e, members), "TRANSACTION_ID") == [(1,)]
    both = spark.createDataFrame([("C_2",), ("T_2",)], "id string")
    assert rows(build.community_edges(e, both), "TRANSACTION_ID") == [(2,)]


def test_victim_exposure_report(spark):
    paths = spark.createDataFrame([("C_1", "T_1", "C_2"), ("C_1", "T_2", "C_2"), ("C_1", "T_1", "C_3")],
                                  "`from` string, v1 string, `to` string")
    rep = {r["Victim_Customer"]: r for r in traversal.victim_exposure(paths).collect()}
    assert rep["C_2"]["Exposed_POS_Count"] == 2 and rep["C_2"]["Exposed_POS_List"] == "T_1, T_2"
