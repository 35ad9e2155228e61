"""Per-group statistics joined back onto every row, with hot groups split.

Joining an aggregate back on its own grouping keys lets Spark reuse the
aggregate's shuffle for the join — efficient, but it also means AQE's
skew-join rule cannot split a hot key (the join child is not a plain
shuffle stage), so a key holding a third of the rows would be joined in one
task.  ``attach_group_stats`` therefore salts only the hot groups:

1. one aggregate per group, with its row count ``n`` (map-side partial
   aggregation, so the hot group costs one partial row per task);
2. the hot groups (``n > hot_rows``) with their statistics and their salt width
   ``ceil(n / hot_rows)`` — at most ``N / hot_rows`` rows, a proven bound —
   are broadcast onto the rows (no shuffle);
3. every row of a hot group has its statistics now, and gets a deterministic
   salt (hash of the row) so that the shuffle spreads the group;
4. the other rows meet the aggregate in one join: a (key, salt)
   slice has about ``hot_rows`` rows at most.

Keys must be NULL-free (callers map NULL to a sentinel), so the join is exact.

``window_group_stats`` does the same without the aggregate's shuffle: the rows of a group, or of a slice of a hot group, meet
in a window, and only hot groups are aggregated.  It suits groups so small that an aggregate is hardly shorter than the rows.

``grid_join`` is for keys that are heavy on *both* sides of a join, where salting one side
leaves a task with all rows of the other.  A heavy key's pairs form a rectangle that is cut into a grid: each side is
cut into fragments of about ``cell_rows`` rows, and each fragment travels once for every fragment of the
other side (fragment and replicate).  A key heavy on one side only has one fragment on the other.

Salts and fragments come from a hash of the row, never from ``rand``: a task that runs again after a lost
executor may meet its rows in another order, and must send each where it went before, or rows would be
lost or doubled.  In grid joins and lookups the number of the row's partition, which a second run does
not change, is hashed along, so that equal rows of different partitions are spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEY_ROWS = 2_000_000   # rows of one group handled by one task at most


def _dealt_to(columns: list[str], width: Column) -> Column:
    """The row's number in [0, ``width``), whatever the order of the rows; hashed only where there is a choice."""
    row = F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id())
    return F.when(width > 1, F.pmod(row, width).cast("int")).otherwise(F.lit(0))


def attach_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column],
                       hot_rows: int = HOT_KEY_ROWS, source: DataFrame | None = None) -> DataFrame:
    """df + one column per aggregate of ``stats`` ({name: aggregate}), computed per ``keys`` group.

    ``source`` holds the same rows for the aggregates, when ``df`` is costlier to read again."""
    names = list(stats)
    # a number in {0, 1} that belongs to the group: the aggregate is dealt by (keys, _salt) from the start and meets the
    # rows without a second shuffle; slices of hot groups are numbered from 2
    own = F.shiftrightunsigned(F.hash(*[F.col(k) for k in keys]), 31)
    # both readers below use every column of the aggregate, so it is computed once and its shuffle reused
    agg = (df if source is None else source).groupBy(*keys, own.alias("_salt")).agg(
        F.count(F.lit(1)).alias("_n"), *[e.alias(n) for n, e in stats.items()])
    width = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    hot = agg.filter(F.col("_n") > F.lit(hot_rows)).select(*keys, width.alias("_w"), F.struct(*names).alias("_hot"))
    rows = df.join(F.broadcast(hot), keys, "left")
    # hashed only for rows of a hot group
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.when(F.col("_w").isNull(), own).otherwise(F.lit(2) + F.pmod(row_hash, F.col("_w")).cast("int"))
    rows = rows.select(*df.columns, "_hot", salt.alias("_salt"))
    cold = agg.filter(F.col("_n") <= F.lit(hot_rows)).select(*keys, "_salt", *names)
    value = lambda n: F.when(F.col("_hot").isNotNull(), F.col("_hot")[n]).otherwise(F.col(n)).alias(n)
    others = [c for c in df.columns if c not in keys]
    return rows.join(cold, keys + ["_salt"], "left").select(*keys, *others, *[value(n) for n in names])


CROWD_PLACES = 1 << 16     # hashes of keys whose rows are counted to find hot groups
SLICE_ROWS = 500_000       # rows of a slice of ``within`` that meet in one task


def hot_groups(df: DataFrame, keys: list[str], stats: dict[str, Column], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """keys, _w, _hot: groups of more than ``hot_rows`` rows with their salt width and statistics, at most N / ``hot_rows``.

    Rows are counted per hash of the keys first (``CROWD_PLACES`` rows a task at most are shuffled); only groups of
    a hash with more than ``hot_rows`` rows can be hot, and these alone are aggregated."""
    place = F.pmod(F.xxhash64(*keys), F.lit(CROWD_PLACES))
    crowded = df.groupBy(place.alias("_place")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(hot_rows))
    few = df.withColumn("_place", place).join(F.broadcast(crowded.select("_place")), "_place", "left_semi")
    groups = few.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[e.alias(n) for n, e in stats.items()])
    width = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int")
    return groups.filter(F.col("_n") > F.lit(hot_rows)).select(*keys, width.alias("_w"), F.struct(*stats).alias("_hot"))


def window_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column], hot_rows: int = HOT_KEY_ROWS,
                       source: DataFrame | None = None, within: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``attach_group_stats`` by a window; statistics of hot groups are broadcast, and their rows are salted.

    ``within``: one of the keys; the rows come out dealt by its value, large values in slices of about ``slice_rows`` rows, so that
    what is written by that column afterwards needs no other shuffle."""
    source = df if source is None else source
    rows = df.join(F.broadcast(hot_groups(source, keys, stats, hot_rows)), keys, "left")
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.when(F.col("_w").isNull(), F.lit(0)).otherwise(F.pmod(row_hash, F.col("_w")).cast("int"))
    rows = rows.select(*df.columns, "_hot", salt.alias("_salt"))
    by = [*keys, "_salt"]
    if within is not None:
        slices = F.ceil(F.count(F.lit(1)) / F.lit(slice_rows)).alias("_slices")      # one row per value of ``within``
        others = [k for k in by if k != within]
        rows = rows.join(F.broadcast(source.groupBy(within).agg(slices)), within)
        rows = rows.withColumn("_slice", F.pmod(F.xxhash64(*others), F.col("_slices"))).repartition(within, "_slice")
        by = [within, "_slice", *others]
    group = Window.partitionBy(*by)
    value = lambda n, e: F.when(F.col("_hot").isNotNull(), F.col("_hot")[n]).otherwise(e.over(group)).alias(n)
    return rows.select(*df.columns, *[value(n, e) for n, e in stats.items()])


CELL_ROWS = 500_000        # rows of one side of a key that meet in one task of a grid join


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key (partially aggregated before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def grid_of(left_counts: DataFrame, right_counts: DataFrame, keys: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """keys, _rows, _cols: how many fragments each heavy key has on either side.

    Only keys of both sides that have more than ``cell_rows`` rows on one: at most (rows of both sides) / ``cell_rows`` rows.
    Counts may be upper bounds."""
    both = left_counts.select(*keys, F.col("_n").alias("_l")).join(right_counts.select(*keys, F.col("_n").alias("_r")), keys)
    heavy = both.filter(F.greatest("_l", "_r") > F.lit(cell_rows))
    return heavy.select(*keys, *[F.ceil(F.col(c) / F.lit(cell_rows)).cast("int").alias(n) for c, n in (("_l", "_rows"), ("_r", "_cols"))])


def _dealt(df: DataFrame, keys: list[str], grid: DataFrame, own: str, other: str, own_name: str, other_name: str,
           spread: list[str] | None = None) -> DataFrame:
    """``df`` with its own fragment number, repeated for every fragment of the other side."""
    one = F.coalesce(F.col(own), F.lit(1))
    numbers = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    mine = _dealt_to(spread or df.columns, one)
    # two steps: the fragment is found once per row, before the row is repeated
    drawn = df.join(F.broadcast(grid), keys, "left").select(*df.columns, mine.alias(own_name), numbers.alias("_numbers"))
    return drawn.select(*df.columns, own_name, F.explode("_numbers").alias(other_name))


def grid_join(left: DataFrame, right: DataFrame, keys: list[str], grid: DataFrame | None = None, condition: Column | None = None,
              cell_rows: int = CELL_ROWS, spread: tuple[list[str] | None, list[str] | None] = (None, None),
              widen: int = 1) -> DataFrame:
    """Inner equi-join on ``keys`` (other columns differ in name) whose heavy keys are spread over a grid of tasks.

    ``spread``: the columns of either side whose hash deals its rows, all unless named; they are read even if
    nothing else asks for them.
    The partitions are fixed at the session's shuffle width: a join that fans out keeps its
    parallelism although its inputs are small.  ``widen``: times that width, for a join whose time goes into the rows
    it makes; with more and smaller tasks the cells of one task weigh less."""
    if grid is None:
        grid = grid_of(key_counts(left, keys), key_counts(right, keys), keys, cell_rows)
    n = widen * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on = [*keys, "_i", "_j"]
    a = _dealt(left, keys, grid, "_rows", "_cols", "_i", "_j", spread[0]).repartition(n, *on)
    b = _dealt(right, keys, grid, "_cols", "_rows", "_j", "_i", spread[1]).repartition(n, *on)
    joined = a.join(b, on)
    return (joined.filter(condition) if condition is not None else joined).drop("_i", "_j")


def salted_lookup(df: DataFrame, table: DataFrame, keys: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Left join of rows with a table of one row per key; rows of a key with more than ``cell_rows`` of them
    are dealt over salts, and the table's row is repeated for each."""
    width = F.ceil(F.col("_n") / F.lit(cell_rows)).cast("int")
    hot = key_counts(df, keys).filter(F.col("_n") > F.lit(cell_rows)).select(*keys, width.alias("_w"))   # rows / cell_rows at most
    hot = F.broadcast(hot)
    width = F.coalesce(F.col("_w"), F.lit(1))
    rows = df.join(hot, keys, "left").select(*df.columns, _dealt_to(df.columns, width).alias("_salt"))
    others = [c for c in table.columns if c not in keys]
    copies = table.join(hot, keys, "left").select(*keys, *others, F.explode(F.sequence(F.lit(0), width - 1)).alias("_salt"))
    return rows.join(copies, [*keys, "_salt"], "left").drop("_salt")
