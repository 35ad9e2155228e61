"""Label propagation, connected components, PageRank and community reports.

G11 label_propagation, X4 connected_components, X3 pagerank,
A17 community_sizes, A18 ring_metrics, A19 fraud_rings, A25 community_count,
A26 largest_community, G14 community_of, G15 community_report.

Label propagation and PageRank build the adjacency once (parallel edges collapsed to a weight) and
write it bucketed by source vertex with hot vertices salted (``graph.layout``), so a step shuffles only per-vertex
state.  Both work on active sets: once few vertices still change, only these send messages, as changes to what
their neighbours have gathered.  Components contract stars: each round replaces the edges by fewer that
join the same vertices.  The state of every step is written to the shared folder, and what is no longer needed goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import money_sum, pct
from txlens.functions.stats import one_row
from txlens.operators.graph.build import is_whole
from txlens.operators.graph.layout import SaltedAdjacency, number_ids, partitions_for
from txlens.operators.skew import HOT_KEY_ROWS, attach_group_stats
from txlens.schema import CUSTOMER_PREFIX, CUSTOMER_TYPE, TERMINAL_PREFIX, TERMINAL_TYPE
from txlens.session import Scratch, written


ACTIVE_SHARE = 0.25        # of the adjacency: when fewer rows belong to changed vertices, only changes are sent


def label_propagation(vertices: DataFrame, edges: DataFrame, max_iter: int = 5, hot_rows: int = HOT_KEY_ROWS,
                      active_share: float = ACTIVE_SHARE, log: list | None = None,
                      keys: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Synchronous LPA on both edge directions, parallel edges counted.

    Start label = vertex id; each step a vertex takes the label with the
    largest total weight among its neighbours (ties -> smallest label); a
    vertex without neighbours keeps its label.  Returns (id, type?, label).

    While many labels change, a step sends every vertex's label.  Once the changed vertices own less than
    ``active_share`` of the adjacency, the votes (id, label, score) are kept and only changes are sent: minus the
    weight for the label left, plus for the label taken.  Weights are whole numbers, so both
    give the same votes.  Stops early when no label changes.  ``log`` gathers the messages of each step.

    The steps run on whole numbers in the order of the ids (``layout.number_ids``), so the smallest number is the
    smallest label; texts are read once at the start and put back at the end.  ``keys``: for ``src`` and ``dst`` the
    (prefix, column of ``edges``) that the end is made of, as ``build.TX_KEYS``; where both columns are whole numbers,
    the edges meet their vertices by these and no text of an edge is read.
    """
    vcols = [c for c in vertices.columns if c != "label"]
    if keys is not None and not all(is_whole(edges, column) for _, column in keys.values()):
        keys = None
    with Scratch() as scratch:
        vertices = scratch.written(vertices.select(*vcols), "lpa_vertices")
        numbers = number_ids(vertices, scratch)
        rows = _numbered_adjacency(edges, numbers, keys, scratch)
        degrees = scratch.written(rows.groupBy("src").agg(F.count(F.lit(1)).alias("_rows"), F.sum("w").alias("_w")), "lpa_degrees")
        with SaltedAdjacency(rows, hot_rows, "lpa_adj", degrees) as adj:
            labels = _propagate(adj, degrees, numbers, _one_way(keys), max_iter, active_share, log, scratch)
            named = labels.join(numbers.select(F.col("num").alias("label"), F.col("id").alias("_label")), "label")
            found = numbers.join(named.select(F.col("id").alias("num"), "_label"), "num").select("id", "_label")
            return written(vertices.join(found, "id", "left").select(*vcols, F.coalesce("_label", "id").alias("label")), "lpa_labels")


def _one_way(keys: dict[str, tuple[str, str]] | None) -> bool:
    """Can no vertex be a source and a destination, by the prefixes of their ids?"""
    if keys is None:
        return False
    a, b = keys["src"][0], keys["dst"][0]
    return not a.startswith(b) and not b.startswith(a)


def _numbered_adjacency(edges: DataFrame, numbers: DataFrame, keys: dict[str, tuple[str, str]] | None = None,
                        scratch: Scratch | None = None) -> DataFrame:
    """(src, dst, w) by number in both directions; ends that are no vertex neither send nor receive, and a
    vertex that is listed more than once sends as often.  With ``scratch`` the pairs are written, once for both directions."""
    ends = {end: F.col(keys[end][1]).cast("bigint") if keys else F.col(end) for end in ("src", "dst")}
    pairs = edges.groupBy(*[column.alias(end) for end, column in ends.items()]).agg(F.count(F.lit(1)).alias("w"))
    for end in ends:
        known = numbers if keys is None else _by_key(numbers, keys[end][0])
        key = "id" if keys is None else "key"
        pairs = pairs.join(known.select(F.col(key).alias(end), F.col("num").alias(f"_{end}"), F.col("copies").alias(f"_{end}_n")), end).drop(end)
    if scratch is not None:
        pairs = scratch.written(pairs, "lpa_pairs")
    sends = lambda a, b: pairs.select(F.col(a).alias("src"), F.col(b).alias("dst"), (F.col("w") * F.col(f"{a}_n")).alias("w"))
    return sends("_src", "_dst").unionByName(sends("_dst", "_src"))


def _by_key(numbers: DataFrame, prefix: str) -> DataFrame:
    """The numbers of ids that are the prefix and a whole number, with that number as ``key``."""
    key = F.substr("id", F.lit(len(prefix) + 1)).try_cast("bigint")
    return numbers.withColumn("key", key).filter(F.col("id") == F.concat(F.lit(prefix), F.col("key").cast("string")))


def _propagate(adj: SaltedAdjacency, degrees: DataFrame, numbers: DataFrame, one_way: bool, max_iter: int, active_share: float,
               log: list | None, scratch: Scratch) -> DataFrame:
    """(id, label) by number of every vertex with neighbours after the steps; ``one_way``: a pair of vertices has one row in each direction."""
    labels = degrees.select(F.col("src").alias("id"), F.col("_rows").alias("_deg"), F.col("src").alias("label"),
                            F.lit(None).cast("bigint").alias("_old"))
    total, weight = (x or 0 for x in one_row(degrees, F.sum("_rows"), F.sum("_w")))
    count, copies = one_row(numbers, F.count(F.lit(1)), F.max("copies"))
    # the adjacency holds both directions: if no vertex is listed twice, the first votes lie there already
    own = copies == 1
    votes, sent = None, total
    for step in range(max_iter):
        if votes is None:
            if step == 0 and own:
                asked = adj.table.select(F.col("src").alias("id"), "_salt", F.col("dst").alias("label"), F.col("w").alias("score"))
                if not one_way:
                    asked = asked.groupBy("id", "_salt", "label").agg(F.sum("score").alias("score"))
                asked = asked.drop("_salt")
            else:
                asked = _votes(adj.join(labels.select("id", "label")).select(F.col("dst").alias("id"), "label", F.col("w").alias("score")),
                               adj, total)
            messages = total
            if sent < active_share * total:
                votes = asked = scratch.written(asked, "lpa_votes")
        else:
            moved = labels.filter("_old IS NOT NULL").select("id", F.explode(F.array(
                F.struct(F.col("_old").alias("label"), F.lit(-1).alias("sign")),
                F.struct(F.col("label").alias("label"), F.lit(1).alias("sign")))).alias("v")).select("id", "v.*")
            change = adj.join(moved).select(F.col("dst").alias("id"), "label", (F.col("w") * F.col("sign")).alias("score"))
            change = scratch.written(_votes(change, adj, 2 * sent), "lpa_change")
            votes = scratch.written(votes.unionByName(change).groupBy("id", "label").agg(F.sum("score").alias("score"))
                                    .filter("score > 0"), "lpa_votes")
            # a vertex whose neighbours have all kept their labels keeps its own
            asked = votes.join(change.select("id").distinct(), "id", "left_semi")
            messages = 2 * sent
        new = F.coalesce("new_label", "label")
        labels = scratch.written(labels.join(_most_voted(asked, count, weight), "id", "left").select(
            "id", "_deg", new.alias("label"), F.when(new != F.col("label"), F.col("label")).alias("_old")), "lpa_state")
        sent = one_row(labels.filter("_old IS NOT NULL"), F.coalesce(F.sum("_deg"), F.lit(0)))[0]
        if log is not None:
            log.append(int(messages))
        if not sent:
            break
    return labels.select("id", "label")


def _most_voted(votes: DataFrame, count: int, weight: int) -> DataFrame:
    """(id, new_label): of labels below ``count`` the one of the largest score (``weight`` at most), ties -> smallest label.

    Score and label are one whole number, whose minimum takes neither a sort nor an object per vertex, unless it
    could pass 64 bits."""
    if (weight + 1) * count < 1 << 63:
        key = (F.lit(weight) - F.col("score")) * F.lit(count) + F.col("label")
        return votes.groupBy("id").agg(F.min(key).alias("k")).select("id", F.pmod("k", F.lit(count)).alias("new_label"))
    best = F.min(F.struct((-F.col("score")).alias("neg"), F.col("label").alias("lab"))).alias("b")
    return votes.groupBy("id").agg(best).select("id", F.col("b.lab").alias("new_label"))


def _votes(messages: DataFrame, adj: SaltedAdjacency, count: int) -> DataFrame:
    """(id, label, score) of ``count`` messages, together per vertex: sums and choice take one shuffle.
    Messages of hot vertices are summed before they travel, and by (id, label)."""
    hot = F.broadcast(adj.hot.select(F.col("src").alias("id")))
    total = F.sum("score").alias("score")
    plain = messages.join(hot, "id", "left_anti") if adj.any_hot else messages
    votes = plain.repartition(partitions_for(adj.spark, count), "id").groupBy("id", "label").agg(total)
    if not adj.any_hot:
        return votes
    return votes.unionByName(messages.join(hot, "id", "left_semi").groupBy("id", "label").agg(total))


def connected_components(vertices: DataFrame, edges: DataFrame, hot_rows: int = HOT_KEY_ROWS, log: list | None = None) -> DataFrame:
    """(id, component) with component = smallest vertex id of the component.

    Every vertex is linked to its smallest neighbour on either side first: at most two links a vertex, however many
    edges it has, whose components (trees) are found by star contraction.  Edges within a tree connect nothing more; those between trees, few where
    vertices have many edges, are contracted in the same way.  Edges of a hot
    vertex are a plain side of a join of written tables, which Spark's skew-join rule splits.  No
    iteration cap; ``hot_rows`` is accepted as by the other algorithms, but nothing is salted here; ``log`` gathers the
    edges after each round.
    """
    with Scratch() as scratch:
        pairs = scratch.written(edges.filter(F.col("src") != F.col("dst")).select("src", "dst"), "cc_pairs")
        nearest = [pairs.groupBy(F.col(a).alias("a")).agg(F.min(b).alias("b")) for a, b in (("src", "dst"), ("dst", "src"))]
        trees = _contracted(nearest[0].unionByName(nearest[1]), scratch, log)
        between = pairs
        for end in ("src", "dst"):
            tree = trees.select(F.col("id").alias(end), F.col("root").alias(f"_{end}"))
            between = between.join(tree, end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
        between = scratch.written(between.filter(F.col("src") != F.col("dst")).select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct(),
                                  "cc_between")
        root = trees
        if not between.isEmpty():
            more = _contracted(between, scratch, log)
            further = more.select(F.col("id").alias("root"), F.col("root").alias("_further"))
            root = trees.join(further, "root", "left").select("id", F.coalesce("_further", "root").alias("root")).unionByName(more)
        root = root.withColumnRenamed("root", "_root")
        vcols = [c for c in vertices.columns if c != "component"]
        return written(vertices.join(root, "id", "left").select(*vcols, F.coalesce("_root", "id").alias("component")), "cc_components")


def _contracted(links: DataFrame, scratch: Scratch, log: list | None = None) -> DataFrame:
    """(id, root) of every linked vertex that is not the smallest of its component, from links (a, b).

    Alternating star contraction: a link is kept as (hi, lo) with lo < hi.  A large star moves the lower end of every
    link to the smallest neighbour of that end; a small star links all lower neighbours of a vertex, and the vertex
    itself, to the smallest of them.  Both keep what is connected; links that become equal merge, so the set
    shrinks, until every vertex is linked to the smallest of its component alone."""
    now = scratch.written(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "cc_edges")
    known = None
    while True:
        low = scratch.written(now.groupBy("hi").agg(F.min("lo").alias("low")), "cc_low")
        # large star: (hi, lo) -> (hi, smallest neighbour of lo)
        near = low.select(F.col("hi").alias("lo"), F.col("low").alias("near"))
        large = scratch.written(now.join(near, "lo", "left").select("hi", F.coalesce("near", "lo").alias("lo")).distinct(), "cc_edges")
        # small star: (hi, lo) -> (lo, smallest lower neighbour of hi), and hi -> the same
        low = scratch.written(large.groupBy("hi").agg(F.min("lo").alias("low")), "cc_low")
        moved = large.join(low, "hi").filter(F.col("lo") != F.col("low")).select(F.col("lo").alias("hi"), F.col("low").alias("lo"))
        now = scratch.written(moved.unionByName(low.select("hi", F.col("low").alias("lo"))).distinct(), "cc_edges")
        sums = one_row(now, F.count(F.lit(1)), F.expr("bit_xor(xxhash64(hi, lo))"))
        if log is not None:
            log.append(sums[0])
        if known == tuple(sums):
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("root"))
        known = tuple(sums)


def pagerank(vertices: DataFrame, edges: DataFrame, reset_probability: float = 0.15, max_iter: int = 10,
             hot_rows: int = HOT_KEY_ROWS, tolerance: float = 0.0, log: list | None = None) -> DataFrame:
    """Static PageRank on the directed multigraph (parallel edges count),
    rank starts at 1.0, rank = reset + (1 - reset) * sum(in-contributions),
    final ranks rescaled to sum to the number of vertices.

    A vertex keeps the sum of its in-contributions; only vertices whose rank has changed by more than ``tolerance``
    send, and what they send is the change.  Without a change the iterations that are left change
    nothing.  ``log`` gathers the vertices that send in each step."""
    w = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    shares = attach_group_stats(w, ["src"], {"deg": F.sum("w")}, hot_rows).select("src", "dst", (F.col("w") / F.col("deg")).alias("share"))
    vcols = [c for c in vertices.columns if c != "pagerank"]
    with Scratch() as scratch, SaltedAdjacency(shares, hot_rows, "pr_links") as links:
        ranks = scratch.written(vertices.select(*vcols, F.lit(1.0).alias("pagerank"), F.lit(0.0).alias("_in"),
                                                F.lit(1.0).alias("_change")), "pr_state")
        for _ in range(max_iter):
            active = ranks.filter(F.abs("_change") > F.lit(tolerance)).select("id", "_change")
            n = active.count()
            if log is not None:
                log.append(n)
            if not n:
                break
            more = links.join(active).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("share") * F.col("_change")).alias("_more"))
            state = ranks.join(more, "id", "left").withColumn("_in", F.col("_in") + F.coalesce("_more", F.lit(0.0)))
            rank = F.lit(reset_probability) + F.lit(1.0 - reset_probability) * F.col("_in")
            # a change too small to be sent is kept for later
            held = F.when(F.abs("_change") > F.lit(tolerance), 0.0).otherwise(F.col("_change"))
            ranks = scratch.written(state.select(*vcols, rank.alias("pagerank"), "_in",
                                                 (held + rank - F.col("pagerank")).alias("_change")), "pr_state")
        st = one_row(ranks, F.count(F.lit(1)).alias("n"), F.sum("pagerank").alias("total"))
        return written(ranks.select(*vcols, (F.col("pagerank") * F.lit(float(st["n"])) / F.lit(st["total"])).alias("pagerank")), "pr_ranks")


def _make_up(labels: DataFrame, label_col: str, total: str) -> DataFrame:
    """Members per community, all and by the prefix of their id."""
    of = lambda prefix: F.count(F.when(F.col("id").startswith(prefix), 1))
    return labels.groupBy(label_col).agg(F.count("id").alias(total), of(CUSTOMER_PREFIX).alias("Customer_Count"),
                                         of(TERMINAL_PREFIX).alias("POS_Count"))


def community_sizes(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Nodes, customers, terminals per community, largest first."""
    return _make_up(labels, label_col, "Total_Nodes").orderBy(F.desc("Total_Nodes"), F.asc(label_col))


def community_count(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Number of distinct communities (one row)."""
    return labels.agg(F.count_distinct(label_col).alias("num_communities"))


def largest_community(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """The biggest community (smallest label on ties)."""
    return (labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("size"))
                  .orderBy(F.desc("size"), F.asc(label_col)).limit(1))


def ring_metrics(edges: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """Per community of the *source* customer: tx, frauds, amounts, rate %.

    Edges are summed per source first, so only one row per customer meets the
    labels, and the edges are shuffled once.  Amounts are summed in whole numbers, so
    the totals of a customer do not depend on the order of the partitions."""
    per_source = edges.groupBy(F.col("src").alias("id")).agg(
        F.count("TRANSACTION_ID").alias("tx"), F.count(F.when(F.col("TX_FRAUD") == 1, 1)).alias("frauds"),
        money_sum("TX_AMOUNT").alias("amount"),
        F.coalesce(money_sum(F.when(F.col("TX_FRAUD") == 1, F.col("TX_AMOUNT"))), F.lit(0.0)).alias("lost"))
    ring = (per_source.join(labels.select("id", F.col(label_col).alias("community_label")), "id")
            .groupBy("community_label")
            .agg(F.sum("tx").alias("Total_Transactions"), F.sum("frauds").alias("Fraud_Transactions"),
                 money_sum("lost").alias("Total_Fraud_Amount"), money_sum("amount").alias("Total_Transaction_Amount")))
    return ring.withColumn("Fraud_Rate_Pct", pct("Fraud_Transactions", "Total_Transactions", 2))


def fraud_rings(edges: DataFrame, labels: DataFrame, min_fraud: int = 3, min_rate: float = 10.0,
                label_col: str = "label") -> DataFrame:
    """High-risk rings with their make-up, most frauds first."""
    risky = (F.col("Fraud_Transactions") >= min_fraud) | (F.col("Fraud_Rate_Pct") > min_rate)
    rings = ring_metrics(edges, labels, label_col).filter(risky).withColumnRenamed("community_label", "Community_ID")
    members = _make_up(labels, label_col, "Total_Accounts").withColumnRenamed(label_col, "Community_ID")
    return (rings.join(members, "Community_ID")
            .select("Community_ID", "Total_Accounts", "Customer_Count", "POS_Count", "Total_Transactions",
                    "Fraud_Transactions", "Fraud_Rate_Pct", "Total_Fraud_Amount")
            .orderBy(F.desc("Fraud_Transactions"), F.desc("Total_Fraud_Amount"), F.asc("Community_ID")))


def community_of(labels: DataFrame, vertex: str, label_col: str = "label") -> DataFrame:
    """Members of the community holding ``vertex``, else of the largest one."""
    mine = labels.filter(F.col("id") == F.lit(vertex)).select(F.col(label_col).alias("_l"))
    if mine.isEmpty():
        mine = largest_community(labels, label_col).select(F.col(label_col).alias("_l"))
    return labels.join(mine, labels[label_col] == mine._l, "left_semi")


def community_report(members: DataFrame, edges: DataFrame, per_type: int = 20) -> DataFrame:
    """At most ``per_type`` members of each type (smallest ids first) and,
    on every row, the number of members that are sources of fraud edges."""
    # top-n per type as bounded TakeOrderedAndProject per (fixed, two-valued) type,
    # not a window that would sort a whole huge community in one task
    shown = None
    for t in (CUSTOMER_TYPE, TERMINAL_TYPE):
        part = members.filter(F.col("type") == F.lit(t)).select("id", "type").orderBy("id").limit(per_type)
        shown = part if shown is None else shown.unionByName(part)
    fraud_src = edges.filter(F.col("TX_FRAUD") == 1).select(F.col("src").alias("_s")).distinct()
    n_fraud = one_row(members.join(fraud_src, members.id == fraud_src._s, "left_semi"), F.count(F.lit(1)))[0]
    return shown.select("*", F.lit(n_fraud).cast("bigint").alias("fraud_customers_in_community"))
