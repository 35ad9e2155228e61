"""Customer -> terminal property graph on plain DataFrames.

Vertices (id, type) with ids ``C_<customer>`` / ``T_<terminal>``; edges
(src, dst, <transaction columns>) — a directed multigraph, one edge per
transaction.  No graph library: every operator is joins and aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.columns import vertex_id
from txlens.schema import CUSTOMER_PREFIX, CUSTOMER_TYPE, TERMINAL_PREFIX, TERMINAL_TYPE


WHOLE = ("tinyint", "smallint", "int", "bigint")

# the columns that the ends of the edges of ``graph_edges`` are made of, by prefix
TX_KEYS = {"src": (CUSTOMER_PREFIX, "CUSTOMER_ID"), "dst": (TERMINAL_PREFIX, "TERMINAL_ID")}


@dataclass(frozen=True)
class TxGraph:
    vertices: DataFrame
    edges: DataFrame


def is_whole(df: DataFrame, column: str) -> bool:
    """Is the column of whole numbers, whose texts are as distinct as they are?"""
    return dict(df.dtypes).get(column) in WHOLE


def _vertex_ids(tx: DataFrame, prefix: str, column: str) -> DataFrame:
    """Distinct vertex ids; whole numbers are made distinct as such and become texts afterwards."""
    if is_whole(tx, column):
        return tx.select(column).distinct().select(vertex_id(prefix, column).alias("id"))
    return tx.select(vertex_id(prefix, column).alias("id")).distinct()


def graph_vertices(tx: DataFrame) -> DataFrame:
    """G1: distinct customers and terminals as typed vertices (union of two distincts)."""
    cust = _vertex_ids(tx, CUSTOMER_PREFIX, "CUSTOMER_ID").select("id", F.lit(CUSTOMER_TYPE).alias("type"))
    term = _vertex_ids(tx, TERMINAL_PREFIX, "TERMINAL_ID").select("id", F.lit(TERMINAL_TYPE).alias("type"))
    return cust.union(term).filter(F.col("id").isNotNull())


def graph_edges(tx: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """G1: one edge per transaction, src = customer, dst = terminal, plus attributes.

    Pass ``columns`` to carry only what the analysis needs (column pruning
    happens anyway through Catalyst when a later select drops columns).
    """
    cols = columns if columns is not None else tx.columns
    return tx.select(vertex_id(CUSTOMER_PREFIX, "CUSTOMER_ID").alias("src"),
                     vertex_id(TERMINAL_PREFIX, "TERMINAL_ID").alias("dst"), *cols)


def build_graph(tx: DataFrame, columns: list[str] | None = None) -> TxGraph:
    return TxGraph(graph_vertices(tx), graph_edges(tx, columns))


def month_graph(tx: DataFrame, month: str) -> TxGraph:
    """The graph of one month; equality on the partition column prunes partitions."""
    return build_graph(tx.filter(F.col("tx_year_month") == F.lit(month)))


def bidirectional_edges(edges: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every edge plus its reverse (unionByName)."""
    cols = columns if columns is not None else [c for c in edges.columns if c not in ("src", "dst")]
    fwd = edges.select("src", "dst", *cols)
    rev = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *cols)
    return fwd.unionByName(rev)


def simple_undirected_edges(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) pairs of both directions (parallel edges collapsed)."""
    pairs = edges.select("src", "dst").distinct()
    return pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def weighted_undirected_edges(edges: DataFrame) -> DataFrame:
    """(src, dst, w) in both directions, w = number of parallel edges."""
    w = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    return w.unionByName(w.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def edges_into(edges: DataFrame, vertex_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges whose dst is in a vertex set (left-semi join, no driver list)."""
    ids = vertex_ids.select(F.col(id_col).alias("_vid"))
    return edges.join(ids, edges.dst == ids._vid, "left_semi")


def community_edges(edges: DataFrame, members: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges with both ends in the set; if there are none, edges touching it.

    Members are unique vertex ids, so the two left joins never duplicate an
    edge; no distinct is taken on them, which keeps each join's sides plain
    shuffles that AQE can split when one vertex holds many edges.
    """
    ids = members.select(F.col(id_col).alias("_vid"))
    tagged = (edges.join(ids.select(F.col("_vid").alias("_s")), edges.src == F.col("_s"), "left")
                   .join(ids.select(F.col("_vid").alias("_d")), F.col("dst") == F.col("_d"), "left"))
    inside = tagged.filter(F.col("_s").isNotNull() & F.col("_d").isNotNull()).drop("_s", "_d")
    if not inside.isEmpty():
        return inside
    return tagged.filter(F.col("_s").isNotNull() | F.col("_d").isNotNull()).drop("_s", "_d")
