"""Breadth-first traversals (G8 bfs_paths, bfs_path_counts, G9 victim_exposure, G10 hop_distance).

Level-synchronous frontier loops on DataFrames: each level is one join of
the frontier with the distinct undirected edge list (written once, bucketed
by source with hot vertices salted — see ``graph.layout`` — so levels
shuffle only the frontier) and one left-anti join against the visited set.

Shortest paths keep a predecessor graph instead of paths: a level holds, for every vertex reached first on
it, its parents of the level before, and the frontier holds each vertex once with its number of shortest
paths.  Only when a target is reached are the levels cut, backwards, to the vertices that lead to it, and unwound
to paths.  So a hub with many parallel paths costs one frontier row per vertex, and the path rows that are
written are those of the answer.  Every level is written to the shared folder, which cuts
lineage and survives executor loss, and goes at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.operators.graph.build import simple_undirected_edges
from txlens.operators.graph.layout import SaltedAdjacency
from txlens.operators.skew import HOT_KEY_ROWS
from txlens.session import Scratch, written


def _path_cols(hops: int) -> list[str]:
    return ["from"] + [f"v{i}" for i in range(1, hops)] + ["to"]


def predecessor_levels(scratch: Scratch, vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str,
                       max_path_length: int, undirected: bool, hot_rows: int, log: list | None = None
                       ) -> tuple[list[DataFrame], DataFrame | None]:
    """Levels of (child, parent) up to the first that reaches a target, and the targets reached
    (id, n_paths); None if there are none.  ``log`` gathers the frontier rows of each level."""
    pairs = simple_undirected_edges(edges) if undirected else edges.select("src", "dst").distinct()
    with SaltedAdjacency(pairs, hot_rows, "bfs_adj") as adj:
        targets = vertices.filter(to_expr).select("id")
        frontier = scratch.written(vertices.filter(from_expr).select("id", F.lit(1).cast("decimal(38,0)").alias("n_paths")), "bfs_level")
        visited, levels = frontier.select("id"), []
        for _ in range(max_path_length):
            step = adj.join(frontier.select("id", "n_paths")).select(F.col("dst").alias("id"), F.col("src").alias("parent"), "n_paths")
            step = scratch.written(step.join(visited, "id", "left_anti"), "bfs_edges")
            levels.append(step.select(F.col("id").alias("child"), "parent"))
            frontier = scratch.written(step.groupBy("id").agg(F.sum("n_paths").cast("decimal(38,0)").alias("n_paths")), "bfs_level")
            if log is not None:
                log.append(frontier.count())
            hits = frontier.join(targets, "id", "left_semi")
            if not hits.isEmpty():
                return levels, scratch.written(hits, "bfs_hits")
            if frontier.isEmpty():
                break
            visited = visited.unionByName(frontier.select("id"))       # the levels: lineage depth <= max_path_length
    return levels, None


def bfs_paths(vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str,
              max_path_length: int = 4, undirected: bool = True, hot_rows: int = HOT_KEY_ROWS,
              log: list | None = None) -> DataFrame:
    """All shortest paths (as vertex-id columns from, v1, ..., to) from any
    vertex matching ``from_expr`` to any matching ``to_expr``, at most
    ``max_path_length`` edges; stops at the first level with a hit.  No hit:
    an empty frame with the columns of a ``max_path_length`` path.
    """
    spark = vertices.sparkSession
    with Scratch() as scratch:
        levels, hits = predecessor_levels(scratch, vertices, edges, from_expr, to_expr, max_path_length, undirected, hot_rows, log)
        if hits is None:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in _path_cols(max_path_length)])
            return spark.createDataFrame([], schema)
        # backwards: only what leads to a target
        wanted, useful = hits.select(F.col("id").alias("child")), []
        for level in reversed(levels):
            kept = scratch.written(level.join(wanted, "child", "left_semi"), "bfs_useful")
            useful.append(kept)
            wanted = kept.select(F.col("parent").alias("child")).distinct()
        cols = _path_cols(len(levels))
        paths = None
        for name, before, level in zip(cols[1:], cols, reversed(useful)):
            edge = level.select(F.col("parent").alias(before), F.col("child").alias(name))
            paths = edge if paths is None else paths.join(edge, before)
        return written(paths.select(*cols), "bfs_paths")


def bfs_path_counts(vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str, max_path_length: int = 4,
                    undirected: bool = True, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """G8 without unwinding: id of every target on the first level with a hit, its distance and its number of
    shortest paths (a decimal, as the number may pass a long)."""
    spark = vertices.sparkSession
    with Scratch() as scratch:
        levels, hits = predecessor_levels(scratch, vertices, edges, from_expr, to_expr, max_path_length, undirected, hot_rows)
        if hits is None:
            return spark.createDataFrame([], "id string, distance int, n_paths decimal(38,0)")
        return written(hits.select("id", F.lit(len(levels)).alias("distance"), "n_paths"), "bfs_counts")


def hop_distance(vertices: DataFrame, edges: DataFrame, from_expr: str, max_hops: int = 4,
                 hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(id, hop) for every vertex within ``max_hops`` of the start set (start = hop 0)."""
    with Scratch() as scratch, SaltedAdjacency(simple_undirected_edges(edges), hot_rows, "hop_adj") as adj:
        reached = scratch.written(vertices.filter(from_expr).select("id", F.lit(0).alias("hop")).distinct(), "hop_level")
        frontier = reached.select("id")
        for hop in range(1, max_hops + 1):
            nxt = (adj.join(frontier).select(F.col("dst").alias("id")).distinct()
                      .join(reached, "id", "left_anti"))
            frontier = scratch.written(nxt, "hop_level")
            if frontier.isEmpty():
                break
            reached = reached.unionByName(frontier.select("id", F.lit(hop).alias("hop")))
        return written(reached, "hop_distance")


def victim_exposure(paths: DataFrame) -> DataFrame:
    """G9 + A16: customers on BFS paths with the terminals that expose them.

    On a customer-terminal graph every second vertex of a path is a customer,
    exposed through the terminal before it; the level is its hop number.  Lists
    hold a victim's distinct terminals, which its own edges bound."""
    cols = paths.columns
    hops = F.array(*[F.struct(F.col(cols[h]).alias("victim"), F.col(cols[h - 1]).alias("terminal"), F.lit(h).alias("hop"))
                     for h in range(2, len(cols), 2)]) if len(cols) > 2 else F.array(
        F.struct(F.col(cols[-1]).alias("victim"), F.col(cols[0]).alias("terminal"), F.lit(1).alias("hop")))
    exposed = (paths.select(F.explode(hops).alias("e")).select("e.*").filter(F.col("victim").isNotNull())
               .groupBy("victim", "terminal").agg(F.min("hop").alias("hop")))
    text = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ", ")
    return (exposed.groupBy(F.col("victim").alias("Victim_Customer"))
            .agg(F.count("terminal").alias("Exposed_POS_Count"), text("terminal").alias("Exposed_POS_List"),
                 text(F.concat(F.lit("Hop "), F.col("hop"))).alias("Exposure_Levels"))
            .orderBy(F.desc("Exposed_POS_Count"), F.asc("Victim_Customer")))
