"""Registered queries: the customer-terminal graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from txlens.operators.graph import build, community, degree, motif, traversal
from txlens.plans.registry import query, r6
from txlens.plans.sql import R, R6, I64, with_
from txlens.session import written
from txlens.sources import adapters as ad

EDGE_COLS = ["TRANSACTION_ID", "TX_AMOUNT", "TX_FRAUD", "TX_TIME_SECONDS"]
# thresholds for mapping A at sf0.01 (the reference defaults 5 / 15 % select nothing there)
RISK_MIN_FRAUD, RISK_MIN_RATE = 3, 3.0


def graph_a(spark, sf):
    return build.build_graph(ad.events_tx(spark, sf))


def graph_c(spark, sf):
    return build.build_graph(ad.sparse_tx(spark, sf))


def graph_c_once(spark, sf, *columns):
    """Mapping C and its graph with the ends and ``columns`` alone, written once: vertices, edges and
    what else is read of the transactions take no join of their own."""
    tx = written(ad.sparse_tx(spark, sf).select("CUSTOMER_ID", "TERMINAL_ID", *columns), "graph_c")
    return tx, build.build_graph(tx)


def top_fraud_customer(tx) -> str:
    """The customer with most fraud rows (smallest id on ties) as a vertex id."""
    row = (tx.groupBy("CUSTOMER_ID").agg(F.sum("TX_FRAUD").alias("n"))
             .orderBy(F.desc("n"), F.asc("CUSTOMER_ID")).limit(1).collect())
    return f"C_{row[0]['CUSTOMER_ID']}"


# ---------------------------------------------------------------- structure
@query("graph_vertices", with_("vert_a") + "SELECT * FROM vert_a")
def q_vertices(spark, sf):
    """G1 vertices of mapping A."""
    return graph_a(spark, sf).vertices


@query("graph_edges", with_("edges_a") +
       "SELECT src, dst, TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_FRAUD, TX_TIME_SECONDS FROM edges_a")
def q_edges(spark, sf):
    """G1 edges of mapping A (attributes projected)."""
    return graph_a(spark, sf).edges.select("src", "dst", "TRANSACTION_ID", "CUSTOMER_ID", "TERMINAL_ID",
                                           "TX_AMOUNT", "TX_FRAUD", "TX_TIME_SECONDS")


@query("bidirectional_edges", with_("edges_c") +
       "SELECT src, dst, TRANSACTION_ID, TX_AMOUNT, TX_FRAUD, TX_TIME_SECONDS FROM edges_c UNION ALL "
       "SELECT dst, src, TRANSACTION_ID, TX_AMOUNT, TX_FRAUD, TX_TIME_SECONDS FROM edges_c")
def q_bidir(spark, sf):
    """G7 on mapping C."""
    return build.bidirectional_edges(graph_c(spark, sf).edges, EDGE_COLS)


@query("month_graph", with_("edges_m") + "SELECT src, dst, TRANSACTION_ID FROM edges_m")
def q_month_graph(spark, sf):
    """The 1998-04 graph of mapping B (terminal = part), month equality filter."""
    tx = ad.add_features(ad.transactions_from_lineitem(
        ad.read_table(spark, sf, "lineitem"), ad.read_table(spark, sf, "orders"), terminal="l_partkey"))
    return build.month_graph(tx, ad.SPARSE_MONTH).edges.select("src", "dst", "TRANSACTION_ID")


# ---------------------------------------------------------------- degrees / risk
@query("degree_in", with_("edges_a") + "SELECT dst AS id, count(*) AS inDegree FROM edges_a WHERE starts_with(dst, 'T_') GROUP BY dst")
def q_degree_in(spark, sf):
    """In-degree of every terminal."""
    return degree.in_degrees(graph_a(spark, sf).edges)


@query("top_terminals", with_("edges_a") +
       "SELECT dst AS id, count(*) AS inDegree FROM edges_a WHERE starts_with(dst, 'T_') GROUP BY dst "
       "ORDER BY inDegree DESC, id ASC LIMIT 10")
def q_top_terminals(spark, sf):
    """Top 10 terminals by in-degree."""
    return degree.top_in_degree(graph_a(spark, sf).edges, 10)


_CONN_SQL = (f"SELECT src, count(TRANSACTION_ID) AS total_transactions, count(DISTINCT dst) AS distinct_pos_count, "
             f"sum(TX_AMOUNT) AS total_amount, {I64('sum(TX_FRAUD)')} AS fraud_tx_count FROM edges_a "
             "WHERE starts_with(src, 'C_') GROUP BY src")


@query("customer_connections", with_("edges_a") +
       f"SELECT src, total_transactions, distinct_pos_count, {R6('total_amount')} AS total_amount, fraud_tx_count FROM ({_CONN_SQL}) c")
def q_connections(spark, sf):
    """Out-degree, distinct terminals, amount, frauds per customer."""
    return r6(degree.customer_connections(graph_a(spark, sf).edges), "total_amount")


@query("connection_stats", with_("edges_a") +
       f"SELECT {R6('avg(distinct_pos_count)')} AS avg_pos, {R6('stddev_samp(distinct_pos_count)')} AS std_pos, "
       f"{R6('avg(total_transactions)')} AS avg_tx, {R6('stddev_samp(total_transactions)')} AS std_tx FROM ({_CONN_SQL}) c")
def q_conn_stats(spark, sf):
    """One row of mean / stddev."""
    st = degree.connection_stats(degree.customer_connections(graph_a(spark, sf).edges))
    return r6(st, "avg_pos", "std_pos", "avg_tx", "std_tx")


@query("degree_outliers", with_("edges_a") + f"""SELECT src, total_transactions, distinct_pos_count,
  {R6('total_amount')} AS total_amount, fraud_tx_count,
  {R('(distinct_pos_count - s.avg_pos) / s.std_pos', 2)} AS z_score_pos
FROM ({_CONN_SQL}) c, (SELECT avg(distinct_pos_count) AS avg_pos, stddev_samp(distinct_pos_count) AS std_pos,
  avg(total_transactions) AS avg_tx, stddev_samp(total_transactions) AS std_tx FROM ({_CONN_SQL}) c2) s
WHERE distinct_pos_count > s.avg_pos + 3 * s.std_pos OR total_transactions > s.avg_tx + 3 * s.std_tx""")
def q_outliers(spark, sf):
    """3-sigma outliers on distinct terminals or transactions."""
    return r6(degree.degree_outliers(degree.customer_connections(graph_a(spark, sf).edges), 3.0), "total_amount")


_RISK_SQL = (f"SELECT dst, count(TRANSACTION_ID) AS total_tx, {I64('sum(TX_FRAUD)')} AS fraud_tx_count, "
             f"{R('sum(TX_FRAUD) / count(TRANSACTION_ID) * 100', 2)} AS fraud_rate_pct, "
             f"{R6('sum(TX_AMOUNT)')} AS total_amount, {R6('sum(TX_AMOUNT * TX_FRAUD)')} AS fraud_amount "
             "FROM edges_a WHERE starts_with(dst, 'T_') GROUP BY dst")


@query("terminal_risk", with_("edges_a") + _RISK_SQL)
def q_terminal_risk(spark, sf):
    """Risk metrics of every terminal (flagship)."""
    return r6(degree.terminal_risk(graph_a(spark, sf).edges), "total_amount", "fraud_amount")


@query("high_risk_terminals", with_("edges_a") +
       f"SELECT * FROM ({_RISK_SQL}) r WHERE fraud_tx_count >= {RISK_MIN_FRAUD} OR fraud_rate_pct > {RISK_MIN_RATE}")
def q_high_risk(spark, sf):
    """A15 with thresholds 3 frauds / 3 %."""
    return r6(degree.high_risk_terminals(graph_a(spark, sf).edges, RISK_MIN_FRAUD, RISK_MIN_RATE),
              "total_amount", "fraud_amount")


@query("high_risk_subgraph", with_("edges_a") +
       f"SELECT src, dst, TRANSACTION_ID FROM edges_a WHERE dst IN (SELECT dst FROM ({_RISK_SQL}) r "
       f"WHERE fraud_tx_count >= {RISK_MIN_FRAUD} OR fraud_rate_pct > {RISK_MIN_RATE})")
def q_high_risk_subgraph(spark, sf):
    """Edges into high-risk terminals (left-semi join)."""
    return degree.high_risk_subgraph_edges(graph_a(spark, sf).edges, RISK_MIN_FRAUD, RISK_MIN_RATE).select(
        "src", "dst", "TRANSACTION_ID")


# ---------------------------------------------------------------- motifs
_CHAINS_SQL = """SELECT DISTINCT e1.src AS Fraud_Customer_A, e1.dst AS Infected_POS_T1, e2.src AS Victim_Customer_B,
  e3.dst AS At_Risk_POS_T2
FROM edges_a e1 JOIN edges_a e2 ON e2.dst = e1.dst JOIN edges_a e3 ON e3.src = e2.src
WHERE e1.src <> e2.src AND e1.dst <> e3.dst AND e1.TX_FRAUD = 1 AND e2.TX_FRAUD = 0 AND e3.TX_FRAUD = 0
  AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS AND e3.TX_TIME_SECONDS > e2.TX_TIME_SECONDS"""


@query("infection_chains", with_("edges_a") + _CHAINS_SQL)
def q_chains(spark, sf):
    """Infection chains via the exact min/max reduction; oracle = naive triple join."""
    return motif.infection_chains(graph_a(spark, sf).edges)


@query("chain_edges", with_("edges_a") + f"""SELECT c.*, x.src, x.dst, x.role FROM ({_CHAINS_SQL}) c,
  LATERAL (SELECT Fraud_Customer_A AS src, Infected_POS_T1 AS dst, 'fraud' AS role
           UNION ALL SELECT Victim_Customer_B, Infected_POS_T1, 'infection'
           UNION ALL SELECT Victim_Customer_B, At_Risk_POS_T2, 'at_risk') x""")
def q_chain_edges(spark, sf):
    """Chains as role-labelled edge lists."""
    return motif.chain_edges(motif.infection_chains(graph_a(spark, sf).edges))


@query("motif_match", with_("edges_a") + """SELECT src AS a_id, dst AS t_id, TRANSACTION_ID AS e_id, TX_AMOUNT AS e_amount
FROM edges_a WHERE TX_FRAUD = 1 AND starts_with(src, 'C_') AND starts_with(dst, 'T_')""")
def q_motif_match(spark, sf):
    """The generic motif matcher with a one-edge pattern and struct-field predicates
    (fraud edges from customers to terminals)."""
    g = graph_a(spark, sf)
    m = motif.find_motif(g.vertices, g.edges.select("src", "dst", "TRANSACTION_ID", "TX_AMOUNT", "TX_FRAUD"),
                         [("a", "e", "t")], "e.TX_FRAUD = 1 AND a.type = 'Customer' AND t.type = 'Terminal'")
    return m.select(F.col("a.id").alias("a_id"), F.col("t.id").alias("t_id"),
                    F.col("e.TRANSACTION_ID").alias("e_id"), F.col("e.TX_AMOUNT").alias("e_amount"))


# pairs of frauds on one terminal within a day; a fraud's customer seen later at another terminal
_PAIRS_WHERE = ("e1.TX_FRAUD = 1 AND e2.TX_FRAUD = 1 AND a.id != b.id AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS "
                "AND e2.TX_TIME_SECONDS - e1.TX_TIME_SECONDS <= 86400 AND a.type = 'Customer'")


@query("motif_two_terms", with_("edges_a") + """SELECT e1.src AS a_id, e1.dst AS t_id, e2.src AS b_id,
  e1.TRANSACTION_ID AS e1_id, e2.TRANSACTION_ID AS e2_id, e2.TX_AMOUNT AS e2_amount
FROM edges_a e1 JOIN edges_a e2 ON e2.dst = e1.dst
WHERE e1.TX_FRAUD = 1 AND e2.TX_FRAUD = 1 AND e1.src <> e2.src AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS
  AND e2.TX_TIME_SECONDS - e1.TX_TIME_SECONDS <= 86400""")
def q_motif_two(spark, sf):
    """Two frauds of different customers on one terminal within a day."""
    g = graph_a(spark, sf)
    m = motif.find_motif(g.vertices, g.edges.select("src", "dst", *EDGE_COLS), "(a)-[e1]->(t); (b)-[e2]->(t)", _PAIRS_WHERE)
    return m.select(F.col("a.id").alias("a_id"), F.col("t.id").alias("t_id"), F.col("b.id").alias("b_id"),
                    F.col("e1.TRANSACTION_ID").alias("e1_id"), F.col("e2.TRANSACTION_ID").alias("e2_id"),
                    F.col("e2.TX_AMOUNT").alias("e2_amount"))


@query("motif_three_terms", with_("edges_a") + """SELECT e1.src AS a_id, e1.dst AS t1_id, e2.src AS b_id, e3.dst AS t2_id,
  e1.TRANSACTION_ID AS e1_id, e2.TRANSACTION_ID AS e2_id, e3.TRANSACTION_ID AS e3_id
FROM edges_a e1 JOIN edges_a e2 ON e2.dst = e1.dst JOIN edges_a e3 ON e3.src = e2.src
WHERE e1.src <> e2.src AND e1.dst <> e3.dst AND e1.TX_FRAUD = 1 AND e2.TX_FRAUD = 0 AND e3.TX_FRAUD = 1
  AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS AND e3.TX_TIME_SECONDS > e2.TX_TIME_SECONDS
  AND e3.TX_TIME_SECONDS - e1.TX_TIME_SECONDS <= 172800""")
def q_motif_three(spark, sf):
    """A fraud, then a clean visit of the same terminal, then a fraud of that visitor elsewhere, all in two days."""
    g = graph_a(spark, sf)
    m = motif.find_motif(
        g.vertices, g.edges.select("src", "dst", *EDGE_COLS), "(a)-[e1]->(t1); (b)-[e2]->(t1); (b)-[e3]->(t2)",
        "a.id != b.id AND t1.id != t2.id AND e1.TX_FRAUD = 1 AND e2.TX_FRAUD = 0 AND e3.TX_FRAUD = 1 "
        "AND e2.TX_TIME_SECONDS > e1.TX_TIME_SECONDS AND e3.TX_TIME_SECONDS > e2.TX_TIME_SECONDS "
        "AND e3.TX_TIME_SECONDS - e1.TX_TIME_SECONDS <= 172800 "
        # these two follow from the others: pairs out of reach are dropped before they meet the third term
        "AND e2.TX_TIME_SECONDS - e1.TX_TIME_SECONDS <= 172800 AND e3.TX_TIME_SECONDS - e2.TX_TIME_SECONDS <= 172800")
    return m.select(F.col("a.id").alias("a_id"), F.col("t1.id").alias("t1_id"), F.col("b.id").alias("b_id"), F.col("t2.id").alias("t2_id"),
                    *[F.col(f"{e}.TRANSACTION_ID").alias(f"{e}_id") for e in ("e1", "e2", "e3")])


# ---------------------------------------------------------------- traversals
_BFS_SQL = """SELECT r.id AS "from", e1.dst AS v1, e2.dst AS "to"
FROM root_a r JOIN und_a e1 ON e1.src = r.id JOIN und_a e2 ON e2.src = e1.dst
WHERE starts_with(e2.dst, 'C_') AND e2.dst <> r.id"""
# Customers sit two hops apart in this bipartite graph: if no 2-hop path
# exists no longer one does either, so levels 1 and 2 are the whole search.


def _bfs_a(spark, sf):
    tx = ad.events_tx(spark, sf)
    g = build.build_graph(tx)
    root = top_fraud_customer(tx)
    return traversal.bfs_paths(g.vertices, g.edges, f"id = '{root}'",
                               f"type = 'Customer' AND id != '{root}'", 4)


@query("bfs_paths", with_("root_a", "und_a") + _BFS_SQL)
def q_bfs(spark, sf):
    """All shortest paths from the top fraud customer to other customers (<= 4 hops)."""
    return _bfs_a(spark, sf)


@query("bfs_path_counts", with_("root_a", "und_a") + f"""SELECT "to" AS id, 2 AS distance, count(*)::DOUBLE AS n_paths
FROM ({_BFS_SQL}) p GROUP BY 1""")
def q_bfs_counts(spark, sf):
    """The number of shortest paths to every customer next to the top fraud customer, without listing them."""
    tx = ad.events_tx(spark, sf)
    g = build.build_graph(tx)
    root = top_fraud_customer(tx)
    found = traversal.bfs_path_counts(g.vertices, g.edges, f"id = '{root}'", f"type = 'Customer' AND id != '{root}'", 4)
    return found.withColumn("n_paths", F.col("n_paths").cast("double"))


@query("bfs_path_pairs", with_("root_a", "und_a") + f"""SELECT p.*, x.step, x.node_from, x.node_to FROM ({_BFS_SQL}) p,
  LATERAL (SELECT 0 AS step, p."from" AS node_from, p.v1 AS node_to UNION ALL SELECT 1, p.v1, p."to") x""")
def q_bfs_pairs(spark, sf):
    """BFS paths as consecutive node pairs."""
    paths = _bfs_a(spark, sf)
    return motif.path_pairs(paths, paths.columns)


@query("victim_exposure", with_("root_a", "und_a") + f"""SELECT "to" AS Victim_Customer, count(v1) AS Exposed_POS_Count,
  string_agg(DISTINCT v1, ', ' ORDER BY v1) AS Exposed_POS_List,
  'Hop 2' AS Exposure_Levels
FROM (SELECT DISTINCT "to", v1 FROM ({_BFS_SQL}) p) d GROUP BY "to\"""")
def q_victims(spark, sf):
    """Exposed customers with their shared terminals."""
    return traversal.victim_exposure(_bfs_a(spark, sf))


_HOP_EXTRA = {
    "h0": ("SELECT id, 0 AS hop FROM root_c", ["root_c"]),
    "f1": ("SELECT DISTINCT u.dst AS id FROM h0 JOIN und_c u ON u.src = h0.id WHERE u.dst NOT IN (SELECT id FROM h0)",
           ["h0", "und_c"]),
    "h1": ("SELECT id, hop FROM h0 UNION ALL SELECT id, 1 FROM f1", ["h0", "f1"]),
    "f2": ("SELECT DISTINCT u.dst AS id FROM f1 JOIN und_c u ON u.src = f1.id WHERE u.dst NOT IN (SELECT id FROM h1)",
           ["f1", "h1"]),
    "h2": ("SELECT id, hop FROM h1 UNION ALL SELECT id, 2 FROM f2", ["h1", "f2"]),
    "f3": ("SELECT DISTINCT u.dst AS id FROM f2 JOIN und_c u ON u.src = f2.id WHERE u.dst NOT IN (SELECT id FROM h2)",
           ["f2", "h2"]),
    "h3": ("SELECT id, hop FROM h2 UNION ALL SELECT id, 3 FROM f3", ["h2", "f3"]),
    "f4": ("SELECT DISTINCT u.dst AS id FROM f3 JOIN und_c u ON u.src = f3.id WHERE u.dst NOT IN (SELECT id FROM h3)",
           ["f3", "h3"]),
    "h4": ("SELECT id, hop FROM h3 UNION ALL SELECT id, 4 FROM f4", ["h3", "f4"]),
}


@query("hop_distance", with_("h4", extra=_HOP_EXTRA) + "SELECT id, hop FROM h4")
def q_hops(spark, sf):
    """Hop distance (<= 4) of every vertex from the top fraud customer of mapping C."""
    tx = ad.sparse_tx(spark, sf)
    g = build.build_graph(tx)
    return traversal.hop_distance(g.vertices, g.edges, f"id = '{top_fraud_customer(tx)}'", 4)


# ---------------------------------------------------------------- communities
def _labels_c(spark, sf, *columns):
    _, g = graph_c_once(spark, sf, *columns)
    return g, community.label_propagation(g.vertices, g.edges, 5, keys=build.TX_KEYS)


@query("label_propagation", with_("labels_c") + "SELECT id, type, label FROM labels_c")
def q_lpa(spark, sf):
    """5 synchronous LPA steps on mapping C (ties -> smallest label)."""
    return _labels_c(spark, sf)[1].select("id", "type", "label")


_IS_C = "CASE WHEN starts_with(id, 'C_') THEN 1 ELSE 0 END"
_IS_T = "CASE WHEN starts_with(id, 'T_') THEN 1 ELSE 0 END"
_SIZES_SQL = (f"SELECT label, count(id) AS Total_Nodes, {I64('sum(' + _IS_C + ')')} AS Customer_Count, "
              f"{I64('sum(' + _IS_T + ')')} AS POS_Count FROM labels_c GROUP BY label")


@query("community_sizes", with_("labels_c") + _SIZES_SQL)
def q_comm_sizes(spark, sf):
    """Size and make-up of every community."""
    return community.community_sizes(_labels_c(spark, sf)[1])


@query("community_count", with_("labels_c") + "SELECT count(DISTINCT label) AS num_communities FROM labels_c")
def q_comm_count(spark, sf):
    """Number of communities."""
    return community.community_count(_labels_c(spark, sf)[1])


@query("largest_community", with_("labels_c") +
       "SELECT label, count(*) AS size FROM labels_c GROUP BY label ORDER BY size DESC, label ASC LIMIT 1")
def q_largest(spark, sf):
    """The largest community."""
    return community.largest_community(_labels_c(spark, sf)[1])


_RING_SQL = (f"SELECT l.label AS community_label, count(e.TRANSACTION_ID) AS Total_Transactions, "
             f"{I64('sum(CASE WHEN e.TX_FRAUD = 1 THEN 1 ELSE 0 END)')} AS Fraud_Transactions, "
             "CAST(sum(CASE WHEN e.TX_FRAUD = 1 THEN CAST(e.TX_AMOUNT AS DECIMAL(28,10)) ELSE 0 END) AS DOUBLE) "
             "AS Total_Fraud_Amount, CAST(sum(CAST(e.TX_AMOUNT AS DECIMAL(28,10))) AS DOUBLE) AS Total_Transaction_Amount, "
             f"{R('sum(CASE WHEN e.TX_FRAUD = 1 THEN 1 ELSE 0 END) / count(e.TRANSACTION_ID) * 100', 2)} AS Fraud_Rate_Pct "
             "FROM edges_c e JOIN labels_c l ON e.src = l.id GROUP BY l.label")


@query("ring_metrics", with_("labels_c", "edges_c") +
       f"SELECT community_label, Total_Transactions, Fraud_Transactions, {R6('Total_Fraud_Amount')} AS Total_Fraud_Amount, "
       f"{R6('Total_Transaction_Amount')} AS Total_Transaction_Amount, Fraud_Rate_Pct FROM ({_RING_SQL}) m")
def q_rings_metrics(spark, sf):
    """Metrics per community of the source customer."""
    g, labels = _labels_c(spark, sf, "TRANSACTION_ID", "TX_FRAUD", "TX_AMOUNT")
    return r6(community.ring_metrics(g.edges, labels), "Total_Fraud_Amount", "Total_Transaction_Amount")


@query("fraud_rings", with_("labels_c", "edges_c") + f"""SELECT m.community_label AS Community_ID,
  s.Total_Nodes AS Total_Accounts, s.Customer_Count, s.POS_Count, m.Total_Transactions, m.Fraud_Transactions,
  m.Fraud_Rate_Pct, {R6('m.Total_Fraud_Amount')} AS Total_Fraud_Amount
FROM ({_RING_SQL}) m JOIN ({_SIZES_SQL}) s ON m.community_label = s.label
WHERE m.Fraud_Transactions >= 3 OR m.Fraud_Rate_Pct > 10.0""")
def q_fraud_rings(spark, sf):
    """High-risk rings (>= 3 frauds or > 10 %)."""
    g, labels = _labels_c(spark, sf, "TRANSACTION_ID", "TX_FRAUD", "TX_AMOUNT")
    return r6(community.fraud_rings(g.edges, labels, 3, 10.0), "Total_Fraud_Amount")


_TARGET_SQL = ("SELECT COALESCE((SELECT label FROM labels_c WHERE id = (SELECT id FROM root_c)), "
               "(SELECT label FROM labels_c GROUP BY label ORDER BY count(*) DESC, label ASC LIMIT 1)) AS label")


def _community_of_root(spark, sf):
    tx, g = graph_c_once(spark, sf, "TRANSACTION_ID", "TX_FRAUD")
    labels = community.label_propagation(g.vertices, g.edges, 5, keys=build.TX_KEYS)
    return g, labels, community.community_of(labels, top_fraud_customer(tx))


@query("community_of", with_("labels_c", "root_c") +
       f"SELECT id, type, label FROM labels_c WHERE label = ({_TARGET_SQL})")
def q_community_of(spark, sf):
    """The community of the top fraud customer (largest one if absent)."""
    return _community_of_root(spark, sf)[2].select("id", "type", "label")


@query("community_edges", with_("labels_c", "root_c", "edges_c") + f""", m AS (
  SELECT id FROM labels_c WHERE label = ({_TARGET_SQL})),
inside AS (SELECT src, dst, TRANSACTION_ID FROM edges_c WHERE src IN (SELECT id FROM m) AND dst IN (SELECT id FROM m))
SELECT * FROM inside
UNION ALL
SELECT src, dst, TRANSACTION_ID FROM edges_c
WHERE (src IN (SELECT id FROM m) OR dst IN (SELECT id FROM m)) AND NOT EXISTS (SELECT 1 FROM inside)""")
def q_community_edges(spark, sf):
    """Transactions inside that community."""
    g, _, members = _community_of_root(spark, sf)
    return build.community_edges(g.edges, members).select("src", "dst", "TRANSACTION_ID")


@query("community_report", with_("labels_c", "root_c", "edges_c") + f""", m AS (
  SELECT id, type FROM labels_c WHERE label = ({_TARGET_SQL}))
SELECT id, type, (SELECT count(*) FROM m WHERE id IN (SELECT src FROM edges_c WHERE TX_FRAUD = 1)) AS fraud_customers_in_community
FROM (SELECT id, type, row_number() OVER (PARTITION BY type ORDER BY id) AS rn FROM m) r WHERE rn <= 20""")
def q_community_report(spark, sf):
    """Up to 20 members per type and the number of fraud customers."""
    g, _, members = _community_of_root(spark, sf)
    return community.community_report(members, g.edges, 20)


def _components_sql(rounds: int = 24) -> str:
    """Smallest label of a vertex and its neighbours, round by round; more rounds than
    the longest shortest path of the graph give its components."""
    extra = {"cc_0": ("SELECT id, id AS label FROM vert_c", ["vert_c"])}
    for i in range(1, rounds + 1):
        extra[f"cc_{i}"] = (f"""SELECT v.id, least(v.label, coalesce(n.label, v.label)) AS label FROM cc_{i - 1} v
  LEFT JOIN (SELECT u.dst AS id, min(p.label) AS label FROM und_c u JOIN cc_{i - 1} p ON p.id = u.src GROUP BY u.dst) n
  ON n.id = v.id""", [f"cc_{i - 1}", "und_c"])
    return with_(f"cc_{rounds}", "vert_c", extra=extra) + (
        f"SELECT v.id, v.type, c.label AS component FROM vert_c v JOIN cc_{rounds} c ON v.id = c.id")


@query("connected_components", _components_sql())
def q_components(spark, sf):
    """Connected components (smallest member id) of mapping C."""
    _, g = graph_c_once(spark, sf)
    return community.connected_components(g.vertices, g.edges).select("id", "type", "component")


def _pagerank_sql(iters: int = 10) -> str:
    extra = {
        "pr_w": ("SELECT src, dst, count(*) AS w FROM edges_c GROUP BY src, dst", ["edges_c"]),
        "pr_links": ("SELECT w.src, w.dst, w.w / d.deg AS share FROM pr_w w JOIN "
                     "(SELECT src, sum(w) AS deg FROM pr_w GROUP BY src) d ON w.src = d.src", ["pr_w"]),
        "pr_0": ("SELECT id, CAST(1.0 AS DOUBLE) AS pr FROM vert_c", ["vert_c"]),
    }
    for i in range(1, iters + 1):
        extra[f"pr_{i}"] = (f"""SELECT v.id, 0.15 + 0.85 * COALESCE(c.c, 0.0) AS pr FROM vert_c v LEFT JOIN (
  SELECT l.dst AS id, sum(l.share * r.pr) AS c FROM pr_links l JOIN pr_{i - 1} r ON l.src = r.id GROUP BY l.dst) c
  ON v.id = c.id""", [f"pr_{i - 1}", "pr_links", "vert_c"])
    last = f"pr_{iters}"
    return with_(last, "vert_c", extra=extra) + (
        f"SELECT v.id, v.type, {R6(f'p.pr * (SELECT count(*) FROM vert_c) / (SELECT sum(pr) FROM {last})')} AS pagerank "
        f"FROM vert_c v JOIN {last} p ON v.id = p.id")


@query("pagerank", _pagerank_sql(10))
def q_pagerank(spark, sf):
    """10 PageRank iterations on mapping C."""
    g = graph_c(spark, sf)
    return r6(community.pagerank(g.vertices, g.edges, 0.15, 10).select("id", "type", "pagerank"), "pagerank")


@query("graph_features", with_("labels_c", "edges_c") + f"""SELECT e.TRANSACTION_ID, e.TX_FRAUD,
  o.customer_degree, i.terminal_degree, i.terminal_fraud_rate_pct, l.label AS customer_community
FROM edges_c e
JOIN (SELECT src, count(*) AS customer_degree FROM edges_c GROUP BY src) o ON e.src = o.src
JOIN (SELECT dst, count(*) AS terminal_degree, {R('sum(TX_FRAUD) / count(*) * 100', 2)} AS terminal_fraud_rate_pct
      FROM edges_c GROUP BY dst) i ON e.dst = i.dst
JOIN labels_c l ON e.src = l.id""")
def q_graph_features(spark, sf):
    """Graph features (degrees, terminal risk, community) on each transaction."""
    from txlens.operators.graph.features import graph_features
    g, labels = _labels_c(spark, sf, "TRANSACTION_ID", "TX_FRAUD")
    return graph_features(g.edges, labels).select(
        "TRANSACTION_ID", "TX_FRAUD", "customer_degree", "terminal_degree", "terminal_fraud_rate_pct",
        "customer_community")
