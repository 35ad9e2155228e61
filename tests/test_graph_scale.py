"""Graph algorithms that must not grow with hubs, long chains or settled vertices; the motif planner."""

import random

import pytest
from pyspark.sql import functions as F

from support import rows
from txlens.operators import skew
from txlens.operators.graph import community, motif, traversal
from txlens.operators.graph.layout import STATE_DB


def edges_of(spark, pairs):
    return spark.createDataFrame([(s, d, k, 1.0, int(k % 3 == 0), 10 * k) for k, (s, d) in enumerate(pairs)],
                                 "src string, dst string, TRANSACTION_ID long, TX_AMOUNT double, TX_FRAUD int, TX_TIME_SECONDS long")


def vertices_of(edges):
    ids = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()
    return ids.select("id", F.when(F.col("id").startswith("C_"), "Customer").otherwise("Terminal").alias("type"))


def test_components_of_a_long_chain_take_few_rounds(spark):
    chain = [(f"C_{i:04d}", f"C_{i + 1:04d}") for i in range(1200)]
    order = list(range(1201))
    random.Random(1).shuffle(order)
    mixed = [(f"X_{order[i]:04d}", f"X_{order[i + 1]:04d}") for i in range(1200)]
    e = edges_of(spark, chain + mixed + [("S_1", "S_1")])
    log = []
    got = dict(rows(community.connected_components(vertices_of(e).drop("type"), e, log=log)))
    assert {got[f"C_{i:04d}"] for i in range(1201)} == {"C_0000"} and {got[f"X_{i:04d}"] for i in range(1201)} == {"X_0000"}
    assert got["S_1"] == "S_1"
    assert len(log) <= 12 and log[-1] == 2400


def _votes(ids, pairs, steps):
    near = {i: [] for i in ids}
    for s, d in pairs:
        near[s].append(d)
        near[d].append(s)
    label = {i: i for i in ids}
    for _ in range(steps):
        new = {}
        for i in ids:
            score = {}
            for j in near[i]:
                score[label[j]] = score.get(label[j], 0) + 1
            new[i] = min(score, key=lambda x: (-score[x], x)) if score else label[i]
        label = new
    return label


def test_label_propagation_sends_changes_only(spark):
    rnd = random.Random(7)
    pairs = []
    for block in range(6):                                   # dense groups settle, a few vertices between go on
        names = [f"V_{block}_{k:02d}" for k in range(12)]
        pairs += [(a, b) for a in names for b in names if a < b and rnd.random() < 0.6]
    pairs += [(f"V_{b}_00", f"V_{(b + 1) % 6}_05") for b in range(6)]
    pairs += [(f"Z_{k}", f"Z_{k + 1}") for k in range(9)]
    e = edges_of(spark, pairs)
    v = vertices_of(e)
    ids = [r["id"] for r in v.collect()]
    for share in (0.0, 0.4, 1.1):                            # never, at some step, from the second step on
        log = []
        got = {r["id"]: r["label"] for r in community.label_propagation(v, e, 7, active_share=share, log=log).collect()}
        assert got == _votes(ids, pairs, 7)
        if share == 0.4:
            assert log[-1] < log[0] / 2 and min(log) == log[-1]


def test_pagerank_stops_when_no_rank_changes(spark):
    e = edges_of(spark, [(f"C_{k % 9}", f"T_{k % 7}") for k in range(80)])
    log = []
    ranks = {r["id"]: r["pagerank"] for r in community.pagerank(vertices_of(e), e, 0.15, 10, log=log).collect()}
    assert log[0] == 16 and log[-1] == 0 and len(log) <= 4   # customers have no way in: settled after two steps
    assert sum(ranks.values()) == pytest.approx(16)


def test_parallel_paths_are_no_frontier_rows(spark):
    wide = [("C_a", f"T_{k}") for k in range(300)] + [(f"C_hub{j}", f"T_{k}") for k in range(300) for j in range(2)]
    e = edges_of(spark, wide + [("C_hub0", "T_end"), ("C_hub1", "T_end"), ("C_far", "T_end"), ("C_side", "T_0")])
    v = vertices_of(e)
    log = []
    paths = traversal.bfs_paths(v, e, "id = 'C_a'", "id = 'C_far'", 4, log=log)
    assert paths.count() == 600 and paths.distinct().count() == 600
    assert paths.columns == ["from", "v1", "v2", "v3", "to"]
    assert log == [300, 3, 1, 1]
    counts = traversal.bfs_path_counts(v, e, "id = 'C_a'", "id = 'C_far'", 4)
    assert [(r.id, r.distance, int(r.n_paths)) for r in counts.collect()] == [("C_far", 4, 600)]
    assert traversal.bfs_path_counts(v, e, "id = 'C_a'", "id = 'nobody'", 4).count() == 0


def test_state_tables_are_dropped(spark):
    e = edges_of(spark, [("C_1", "T_1"), ("C_2", "T_1")])
    v = vertices_of(e)
    community.label_propagation(v, e, 2).collect()
    community.pagerank(v, e, max_iter=2).collect()
    traversal.hop_distance(v, e, "id = 'C_1'", 2).collect()
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {STATE_DB}").collect()]
    assert not [t for t in left if t.startswith(("lpa_", "pr_", "hop_", "bfs_"))]


# --- grid join and motifs ------------------------------------------------------------------------


def test_grid_join_spreads_a_key_heavy_on_both_sides(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("k"), F.col("id").alias("a"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40 + 1).alias("k"), F.col("id").alias("b"))
    grid = skew.grid_of(skew.key_counts(left, ["k"]), skew.key_counts(right, ["k"]), ["k"], 100)
    assert rows(grid) == [(0, 10, 3)]
    got = skew.grid_join(left, right, ["k"], cell_rows=100)
    want = left.join(right, "k")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    per_task = [r["count"] for r in got.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 6 and max(per_task) < 300_000 / 2


def _match(edge_rows, terms, keep):
    """All bindings of the terms by nested loops."""
    found = [{}]
    for s, e, d in terms:
        found = [b | {e: r, s: r[0], d: r[1]} for b in found for r in edge_rows
                 if b.get(s, r[0]) == r[0] and (b | {s: r[0]}).get(d, r[1]) == r[1]]
    return [b for b in found if keep(b)]


PATTERNS = [
    ("(a)-[e]->(t)", "e.TX_FRAUD = 1", [("a", "e", "t")], lambda b: b["e"][4] == 1),
    ("(a)-[e1]->(t); (b)-[e2]->(t)", "e1.TX_FRAUD = 1 AND a.id != b.id AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS",
     [("a", "e1", "t"), ("b", "e2", "t")], lambda b: b["e1"][4] == 1 and b["a"] != b["b"] and b["e2"][5] > b["e1"][5]),
    ("(a)-[e1]->(t1); (b)-[e2]->(t1); (b)-[e3]->(t2)",
     "e3.TX_FRAUD = 1 AND t1.id != t2.id AND (e1.TX_FRAUD = 0 OR e2.TX_FRAUD = 0) AND b.id < 'C_5'",
     [("a", "e1", "t1"), ("b", "e2", "t1"), ("b", "e3", "t2")],
     lambda b: b["e3"][4] == 1 and b["t1"] != b["t2"] and (b["e1"][4] == 0 or b["e2"][4] == 0) and b["b"] < "C_5"),
    ("(a)-[e1]->(b); (b)-[e2]->(a)", "e1.TRANSACTION_ID BETWEEN 3 AND 60", [("a", "e1", "b"), ("b", "e2", "a")],
     lambda b: 3 <= b["e1"][2] <= 60),
    ("(a)-[e1]->(a)", None, [("a", "e1", "a")], lambda b: True),
]


@pytest.mark.parametrize("k", range(len(PATTERNS)))
def test_motifs_equal_nested_loops(spark, k):
    rnd = random.Random(k)
    pairs = [(f"C_{rnd.randrange(9)}", f"T_{rnd.randrange(4)}") for _ in range(60)]
    pairs += [(f"C_{rnd.randrange(4)}", f"C_{rnd.randrange(4)}") for _ in range(30)]
    e = edges_of(spark, pairs)
    edge_rows = [tuple(r) for r in e.collect()]
    text, where, terms, keep = PATTERNS[k]
    found = motif.find_motif(vertices_of(e), e, text, where, cell_rows=10)
    names = list(dict.fromkeys(n for t in terms for n in t))
    assert found.columns == names
    ids = [F.col(f"{n}.TRANSACTION_ID" if n.startswith("e") else f"{n}.id").alias(n) for n in names]
    want = sorted(tuple(b[n][2] if n.startswith("e") else b[n] for n in names) for b in _match(edge_rows, terms, keep))
    assert sorted(tuple(r) for r in found.select(*ids).collect()) == want and want


def test_motif_text_with_hidden_names_and_negation(spark):
    e = edges_of(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("b", "d")])
    v = vertices_of(e)
    two = motif.find_motif(v, e, "(x)-[]->(y); (y)-[f]->(z); !(x)-[]->(z)")
    assert two.columns == ["x", "y", "f", "z"]
    assert rows(two.select("x.id", "y.id", "z.id")) == [("a", "b", "d")]
    assert rows(motif.find_motif(v, e, "(x)-[]->()").select("x.id")) == [("a",), ("a",), ("b",), ("b",)]
    for bad in ("(a)-(b)", "(a)-[e]->(b); (c)-[e]->(d)", "!(a)-[]->(b)", "(a)-[e]->(b); (c)-[f]->(d)"):
        with pytest.raises(ValueError):
            motif.find_motif(v, e, bad).collect()
    with pytest.raises(ValueError):
        motif.find_motif(v, e, "(a)-[e]->(b)", "q.id = 1")


def test_conditions_reach_the_scan_and_the_smallest_term_leads(spark):
    e = edges_of(spark, [(f"C_{k % 50}", f"T_{k % 20}") for k in range(2000)])
    terms = motif.parse_pattern("(a)-[e1]->(t1); (b)-[e2]->(t1); (b)-[e3]->(t2)")
    assert [t.edge for t in motif.plan_order({"e1": (900, 50, 20), "e2": (2000, 50, 20), "e3": (4, 4, 3)}, terms)] == ["e3", "e2", "e1"]
    parts = motif.split_condition(spark, "e1.x = 1 AND (e1.y > 2 OR e2.z = 'AND') AND a.id != b.id AND e1.q BETWEEN 1 AND 2")
    assert [n for _, n in parts] == [{("e1", "x")}, {("e1", "y"), ("e2", "z")}, {("a", "id"), ("b", "id")}, {("e1", "q")}]
    m = motif.find_motif(vertices_of(e), e, "(a)-[e1]->(t); (b)-[e2]->(t)", "e1.TRANSACTION_ID = 5 AND e2.TX_FRAUD = 1")
    from txlens.session import written
    stored = written(e, "t_motif_edges")
    m = motif.find_motif(vertices_of(stored), stored, "(a)-[e1]->(t); (b)-[e2]->(t)", "e1.TRANSACTION_ID = 5 AND e2.TX_FRAUD = 1")
    plan = m.select("a.id", "b.id")._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and not any("TX_AMOUNT" in line for line in scans)                       # only what is asked for is read
    assert any("EqualTo(TRANSACTION_ID,5)" in line for line in scans) and any("EqualTo(TX_FRAUD,1)" in line for line in scans)
