"""Spatial operators: radius join (J6), its counts, and fraud rate by grid cell.

The radius join buckets terminals into square cells of side r; each
place of customers probes its own and the 8 neighbouring cells, so the equi-join on
the cell key only meets candidates within one cell of distance and the
exact distance filter finishes the job — no customers x terminals product.
The list of a place goes to its customers in one join.

Counts need no pairs: terminals lie in an adaptive quadtree over those cells (a
cell is quartered while it holds more than ``leaf_rows``), a leaf wholly inside
the radius adds its number of terminals, one wholly outside adds nothing, and
distances are taken only in leaves that the circle cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.operators.skew import grid_join, salted_lookup
from txlens.operators.trends import fraud_rate_by
from txlens.session import written

PLACE_ROWS = 50_000                       # customers of one place that get its list in one task
LEAF_ROWS, MAX_DEPTH = 256, 12            # terminals of a leaf that is not split; quarterings of a cell


def terminals_within_radius(customers: DataFrame, terminals: DataFrame, r: float) -> DataFrame:
    """For each customer, the sorted list and number of terminals at distance < r.

    customers(CUSTOMER_ID, x_customer_id, y_customer_id),
    terminals(TERMINAL_ID, x_terminal_id, y_terminal_id).
    Customers with no terminal in reach get an empty list and 0.
    """
    if r <= 0:
        raise ValueError("radius must be positive")
    cell = F.lit(float(r))
    t = terminals.select("TERMINAL_ID", "x_terminal_id", "y_terminal_id",
                         F.floor(F.col("x_terminal_id") / cell).alias("cx"),
                         F.floor(F.col("y_terminal_id") / cell).alias("cy"))
    # customers at the same place have the same terminals: the list is made once per place
    c = customers.select("CUSTOMER_ID", F.col("x_customer_id").alias("x"), F.col("y_customer_id").alias("y"))
    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                     for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    spots = c.filter("x IS NOT NULL AND y IS NOT NULL").select("x", "y").distinct()
    places = spots.select(
        "x", "y", F.floor(F.col("x") / cell).alias("_ccx"), F.floor(F.col("y") / cell).alias("_ccy"), F.explode(offs).alias("_o"))
    probes = places.select("x", "y", (F.col("_ccx") + F.col("_o.dx")).alias("cx"), (F.col("_ccy") + F.col("_o.dy")).alias("cy"))
    dist = F.sqrt(F.pow(F.col("x") - F.col("x_terminal_id"), 2) + F.pow(F.col("y") - F.col("y_terminal_id"), 2))
    pairs = grid_join(probes, t, ["cx", "cy"], condition=dist < cell)
    lists = spots.join(pairs.groupBy("x", "y").agg(F.sort_array(F.collect_list("TERMINAL_ID")).alias("_list")), ["x", "y"], "left")
    # a customer of one row takes its place's list; the rows of a customer that has several share one list of all their places
    once = c.filter("CUSTOMER_ID IS NOT NULL").groupBy("CUSTOMER_ID").agg(
        F.count(F.lit(1)).alias("_n"), F.first("x").alias("x"), F.first("y").alias("y"))
    # a grid join keeps its tasks although its sides are small: its rows are as long as the lists
    single = grid_join(once.filter("_n = 1 AND x IS NOT NULL AND y IS NOT NULL").select("CUSTOMER_ID", "x", "y"), lists, ["x", "y"],
                       cell_rows=PLACE_ROWS, spread=(["CUSTOMER_ID"], ["x", "y"])).select("CUSTOMER_ID", F.col("_list").alias("available_terminals"))
    several = once.filter("_n > 1").select("CUSTOMER_ID", "_n")
    union = (salted_lookup(c.join(several.select("CUSTOMER_ID"), "CUSTOMER_ID", "left_semi"), lists, ["x", "y"])
             .groupBy("CUSTOMER_ID").agg(F.sort_array(F.flatten(F.collect_list("_list"))).alias("_all"))
             .join(several, "CUSTOMER_ID").select("CUSTOMER_ID", F.explode(F.array_repeat("_all", F.col("_n").cast("int"))).alias("available_terminals")))
    nowhere = once.filter("_n = 1 AND (x IS NULL OR y IS NULL)").select("CUSTOMER_ID")
    nobody = c.filter("CUSTOMER_ID IS NULL").select("CUSTOMER_ID").unionByName(nowhere).select("CUSTOMER_ID", F.lit(None).cast("array<bigint>").alias("available_terminals"))
    terms = F.coalesce(F.col("available_terminals"), F.array().cast("array<bigint>"))
    return single.unionByName(union).unionByName(nobody).select(
        "CUSTOMER_ID", terms.alias("available_terminals"), F.size(terms).alias("nb_terminals"))


def quadtree(terminals: DataFrame, r: float, leaf_rows: int = LEAF_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """TERMINAL_ID and place of each located terminal with its cell of side ``r`` (cx, cy) and its leaf
    (depth, lx, ly), written to the shared folder.  One pass per depth, over the terminals of crowded cells only.
    A leaf of equal places, or of ``max_depth``, may hold more than ``leaf_rows``; the former is never cut by a circle."""
    side = F.lit(float(r))
    x, y = F.col("x_terminal_id").cast("double"), F.col("y_terminal_id").cast("double")
    rows = terminals.select("TERMINAL_ID", x.alias("tx"), y.alias("ty")).filter(
        F.col("tx").isNotNull() & F.col("ty").isNotNull() & ~F.isnan("tx") & ~F.isnan("ty"))
    rows = rows.select("*", F.floor(F.col("tx") / side).alias("cx"), F.floor(F.col("ty") / side).alias("cy"))
    leaves, key = None, ["cx", "cy", "lx", "ly"]
    for depth in range(max_depth + 1):
        parts = float(2 ** depth)
        at = [F.floor((F.col(t) / side - F.col(c)) * F.lit(parts)).alias(leaf)
              for t, c, leaf in (("tx", "cx", "lx"), ("ty", "cy", "ly"))]
        placed = rows.select("TERMINAL_ID", "tx", "ty", "cx", "cy", F.lit(depth).alias("depth"), *at)
        apart = (F.max("tx") > F.min("tx")) | (F.max("ty") > F.min("ty"))
        crowded = written(placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), apart.alias("apart")).filter(
            F.col("apart") & (F.col("n") > leaf_rows)).select(*key), "crowded")   # terminals / leaf_rows rows at most
        last = depth == max_depth or crowded.isEmpty()
        done = placed if last else placed.join(crowded, key, "left_anti")
        leaves = done if leaves is None else leaves.unionByName(done)
        if last:
            return written(leaves, "quadtree")
        rows = written(placed.join(crowded, key, "left_semi").drop("depth", "lx", "ly"), "dense")


def terminals_in_reach(customers: DataFrame, terminals: DataFrame, r: float, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """J6 as counts: CUSTOMER_ID and nb_terminals at distance < r; no list, no pair of a leaf wholly inside.

    A customer without a place, or with none in reach, has 0; terminals without a place are in nobody's
    reach; rows of the same customer are counted each by its own place."""
    if r <= 0:
        raise ValueError("radius must be positive")
    side = F.lit(float(r))
    tree = quadtree(terminals, r, leaf_rows)
    leaf = ["cx", "cy", "depth", "lx", "ly"]
    # bounds of what a leaf holds, not of the leaf: the tests below are then exact, rounding included
    boxes = tree.groupBy(*leaf).agg(
        F.count(F.lit(1)).alias("n"), F.min("tx").alias("x0"), F.max("tx").alias("x1"),
        F.min("ty").alias("y0"), F.max("ty").alias("y1"))
    # rows at the same place share their work, and the same customer's rows may differ in place
    located = customers.select(F.col("x_customer_id").cast("double").alias("x"), F.col("y_customer_id").cast("double").alias("y"))
    places = located.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")).distinct()
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    probes = places.select("x", "y", F.explode(steps).alias("o")).select(
        "x", "y", (F.floor(F.col("x") / side) + F.col("o.dx")).alias("cx"), (F.floor(F.col("y") / side) + F.col("o.dy")).alias("cy"))

    def distance(dx, dy):
        return F.sqrt(F.pow(dx, 2) + F.pow(dy, 2))

    x, y = F.col("x"), F.col("y")
    far = distance(F.greatest(F.abs(x - F.col("x0")), F.abs(x - F.col("x1"))),
                   F.greatest(F.abs(y - F.col("y0")), F.abs(y - F.col("y1"))))
    near = distance(F.greatest(F.col("x0") - x, x - F.col("x1"), F.lit(0.0)),
                    F.greatest(F.col("y0") - y, y - F.col("y1"), F.lit(0.0)))
    met = written(grid_join(probes, boxes, ["cx", "cy"], condition=near < side)
                  .select("x", "y", *leaf, "n", (far < side).alias("inside")), "leaves-met")
    whole = met.filter("inside").select("x", "y", "n")
    cut = grid_join(met.filter(~F.col("inside")).select("x", "y", *leaf), tree.select("tx", "ty", *leaf), leaf,
                    condition=distance(x - F.col("tx"), y - F.col("ty")) < side)
    counts = whole.unionByName(cut.select("x", "y", F.lit(1).cast("bigint").alias("n"))).groupBy("x", "y").agg(
        F.sum("n").alias("n"))
    who = customers.select("CUSTOMER_ID", F.col("x_customer_id").cast("double").alias("x"),
                           F.col("y_customer_id").cast("double").alias("y"))
    return who.join(counts, ["x", "y"], "left").select(
        "CUSTOMER_ID", F.coalesce("n", F.lit(0)).cast("bigint").alias("nb_terminals"))


def fraud_rate_by_cell(tx: DataFrame, terminals: DataFrame, cell_size: float = 10.0) -> DataFrame:
    """Fraud rate per grid cell of the terminal location."""
    t = terminals.select("TERMINAL_ID",
                         F.floor(F.col("x_terminal_id") / F.lit(cell_size)).cast("int").alias("cell_x"),
                         F.floor(F.col("y_terminal_id") / F.lit(cell_size)).cast("int").alias("cell_y"))
    j = tx.select("TERMINAL_ID", "TX_FRAUD", "TX_AMOUNT").join(t, "TERMINAL_ID")
    j = j.select("*", F.concat_ws("_", F.col("cell_x").cast("string"), F.col("cell_y").cast("string")).alias("cell"))
    return fraud_rate_by(j, "cell").orderBy("cell")
