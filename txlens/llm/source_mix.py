"""Mix of sources to target weights by subset-sum budget fitting.

1. One scan counts the words of every document; rows of equal (source, size, id) become
   one row with a count.
2. Sources in code-point order (NULL last) take their weights in turn and share ``share`` times
   all words; a target stops at ``most`` times its source's words and the excess is reshared by
   weight until none is above (one aggregate over the source table a round).
3. Each source's target is whole passes over the source plus a budget of fewer words than one pass. The
   budget is fitted on the histogram of document sizes: all but a last window of it in
   proportion to the histogram, what the rounding leaves by the longest sizes that fit, and the rest
   by bounded-knapsack dynamic programming over sums of words, which ends at the reachable sum
   nearest to the budget (the lower one of two).
4. Of every (source, size) as many documents as planned are picked by a seeded hash of the
   id: documents are dealt by the hash over buckets of about ``BUCKET`` rows, whole buckets are
   taken in order, and only the bucket at the border is ranked, so a size with a third
   of all rows is never ordered in one task.

A source's histogram has at most as many rows as it has different sizes, d, where d * d / 2 is at most its
number of words; it is planned in one task.

Defined results: NULL text has size 0 and is taken 0 words; a source without words has target 0;
rows repeated with the same id are documents of their own (which of them is taken once more does not
show); rows without an id are treated alike; NULL is a source of its own, the last; extra columns are
ignored whatever their names; an empty table gives an empty result.  The same input and seed give the same result,
however the input is partitioned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import WS, ship_package, staged
from txlens.operators.ordering import with_global_index

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = 20_240
BUCKET = 4_096
WINDOW = 1 << 16                           # words that are left to the dynamic programme, at least
_CHUNK = 1 << 16                           # rows that one repeated row is unfolded to at a time


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), WS, " " * len(WS))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("bigint")


def knapsack(sizes: list[int], counts: list[int], goal: int) -> list[int]:
    """How many of each size (at most ``counts``) give the sum nearest to ``goal``, the lower of two.

    One array over the sums holds the piece that reached each first; a size's count is cut into pieces of
    1, 2, 4, ... documents, so a sum is unwound piece by piece."""
    width = goal + max(sizes, default=0)
    first = np.full(width + 1, -1, dtype=np.int32)
    reached = np.zeros(width + 1, dtype=bool)
    reached[0] = True
    high, pieces = 0, []
    for j, (size, count) in enumerate(zip(sizes, counts)):
        left, step = min(count, width // size), 1
        while left and not reached[goal]:
            some = min(step, left)
            value, left, step = some * size, left - some, step * 2
            top = min(width, high + value)
            new = np.flatnonzero(reached[:top - value + 1] & ~reached[value:top + 1]) + value
            first[new], reached[new], high = len(pieces), True, top
            pieces.append((j, some, value))
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    picked = [0] * len(sizes)
    while at:
        j, some, value = pieces[first[at]]
        picked[j] += some
        at -= value
    return picked


def fit_budget(sizes: list[int], counts: list[int], goal: int, window: int = WINDOW) -> list[int]:
    """How many documents of each size (ascending, all positive) to take for ``goal`` words in all."""
    total = sum(s * c for s, c in zip(sizes, counts))
    if goal <= 0 or not total:
        return [0] * len(sizes)
    window = max(window, sizes[-1])
    bulk = max(0, goal - window)
    picked = [c * bulk // total for c in counts]
    left = goal - sum(s * p for s, p in zip(sizes, picked))
    for j in range(len(sizes) - 1, -1, -1):
        more = min(counts[j] - picked[j], max(0, left - window) // sizes[j])
        picked[j] += more
        left -= more * sizes[j]
    rest = knapsack(sizes, [c - p for c, p in zip(counts, picked)], left)
    return [p + r for p, r in zip(picked, rest)]


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (key, words) and ``target``: shares by weight in the order of ``key``, none above ``most`` times its words."""
    placed = with_global_index(sources, ["key"], "place")
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod("place", F.lit(len(weights))).cast("int")]
    state = staged(placed.withColumn("weight", weight).drop("place"), "sources")
    cap = (F.col("words") * most).cast("double")
    budget, level, known = None, 0.0, -1
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        now = state.agg(F.sum("words").alias("words"), F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
                        F.count(F.when(full, 1)).alias("n")).first()
        budget = share * (now["words"] or 0)
        if now["n"] == known or not now["weight"]:
            break
        known, level = now["n"], (budget - now["capped"]) / now["weight"]
    return state.withColumn("target", F.least(cap, F.lit(level) * F.col("weight"))).drop("weight")


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram with ``base`` whole passes and ``extra`` documents of each size."""
    rows = rows.sort_values("size", ignore_index=True)
    words, target = int(rows["words"].iloc[0]), float(rows["target"].iloc[0])
    base = int(target // words) if words else 0
    goal = int(round(target - base * words))
    some = rows["size"] > 0
    extra = np.zeros(len(rows), dtype=np.int64)
    extra[some] = fit_budget([int(s) for s in rows["size"][some]], [int(n) for n in rows["n"][some]], goal)
    return rows.assign(base=np.int64(base), extra=extra)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source), taken (words, repeats counted)."""
    if not share <= most:
        raise ValueError("the share of all words cannot exceed what the caps allow")
    ship_package(docs.sparkSession)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("t"))          # NULL after every name
    rows = staged(docs.select(key.alias("key"), word_count(F.col(text_col)).alias("size"), F.col(id_col).alias("id"))
                  .groupBy("key", "size", "id").agg(F.count(F.lit(1)).alias("m")), "sizes")
    shapes = staged(rows.groupBy("key", "size").agg(F.sum("m").alias("n")), "histogram")
    sources = staged(shapes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("words")), "words")
    goal = targets(sources, weights, share, most)
    plan = staged(shapes.join(goal, "key").groupBy("key").applyInPandas(
        _plan, "key string, size bigint, n bigint, words bigint, target double, base bigint, extra bigint"), "plan")

    u = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 31))
    buckets = F.ceil(F.col("n") / F.lit(bucket)).cast("bigint")
    dealt = staged(rows.join(plan, ["key", "size"]).withColumn("u", u).withColumn(
        "bucket", F.shiftright(F.col("u") * buckets, 31)), "dealt")
    every = F.when(F.col("extra") == 0, 0).when(F.col("extra") == F.col("n"), F.col("m"))
    whole = dealt.withColumn("more", every.cast("bigint"))
    partly = whole.filter("more IS NULL")
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = staged(partly.groupBy("key", "size", "bucket").agg(F.sum("m").alias("here"))
                   .withColumn("done", F.coalesce(F.sum("here").over(before), F.lit(0))), "buckets")
    met = partly.join(heads, ["key", "size", "bucket"]).withColumn("room", F.col("extra") - F.col("done"))
    sure = met.filter("room <= 0 OR room >= here").withColumn(
        "more", F.when(F.col("room") <= 0, 0).otherwise(F.col("m")).cast("bigint"))
    order = Window.partitionBy("key", "size", "bucket").orderBy("u", "id").rowsBetween(Window.unboundedPreceding, -1)
    border = met.filter("room > 0 AND room < here").withColumn("ahead", F.coalesce(F.sum("m").over(order), F.lit(0)))
    border = border.withColumn("more", F.least(F.greatest(F.col("room") - F.col("ahead"), F.lit(0)), F.col("m")))
    keep = ["id", "size", "words", "target", "base", "m", "more"]
    found = whole.filter("more IS NOT NULL").select(*keep).unionByName(sure.select(*keep)).unionByName(border.select(*keep))

    # a row that stands for m equal ones is unfolded again, a chunk at a time
    kinds = F.explode(F.filter(F.array(
        F.struct(F.col("more").alias("n"), (F.col("base") + 1).alias("times")),
        F.struct((F.col("m") - F.col("more")).alias("n"), F.col("base").alias("times"))), lambda x: x["n"] > 0))
    one = found.withColumn("kind", kinds).withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("kind.n") - 1, F.lit(_CHUNK).cast("bigint"))))
    one = one.withColumn("copy", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least(F.col("kind.n") - F.col("start"), F.lit(_CHUNK).cast("bigint")))))
    return one.select(F.col("id").alias("doc_id"), "size", F.col("words").alias("source_size"), "target",
                      (F.col("size") * F.col("kind.times")).alias("taken"))
