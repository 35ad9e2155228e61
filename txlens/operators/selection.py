"""Selection by narrowing histograms: values at given ranks, exact quantiles, the first k rows per group.

To find the value at a rank, no order of all rows is needed.  A group's values lie in an interval [lo, hi]; one pass
counts them in ``BINS`` bins of equal width (partially aggregated before the shuffle) and notes each bin's
smallest and largest value.  The bin that holds the rank is the next interval.  Two or three passes
end at one value, or at an interval of at most ``SMALL`` values, which are sorted as a list.  Whatever the number
of rows, only histograms are shuffled, no row is moved, and a group that holds most rows is counted like any other.

Bins are computed on doubles, which keeps the order; comparisons are made in the column's own type.  NULLs take no part in
quantiles; NaN counts as the largest value, as in Spark's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.session import Scratch, written

BINS = 1_024
SMALL = 10_000             # values of one interval that are sorted as a list
MAX_PASSES = 24


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    x, a, b = (c.cast("double") * 0.5 for c in (v, lo, hi))
    near = F.try_subtract(v, lo).cast("int")                # neighbouring whole numbers beyond 2^53 share a double
    return F.when(b > a, F.least(F.floor((x - a) / (b - a) * BINS), F.lit(BINS - 1)).cast("int")).otherwise(near)


def values_at(values: DataFrame, wanted: DataFrame, small: int = SMALL) -> DataFrame:
    """g, qi, v, less: the value at each wanted rank and how many values are smaller.

    ``values`` has g and v (neither NULL nor NaN nor infinite), and is read once or twice per pass; ``wanted`` has g, qi, k
    (0-based rank in the group) and the group's lo, hi, n."""
    with Scratch() as scratch:
        open_ = scratch.written(wanted.select("g", "qi", "k", "lo", "hi", "n", F.lit(0).cast("bigint").alias("less")), "ranks")
        done = [open_.filter("lo = hi").select("g", "qi", F.col("lo").alias("v"), "less")]
        open_ = open_.filter("lo < hi")

        def inside() -> DataFrame:
            # the few intervals of a group as one list per group: read beside the rows, which stay in place when it is small
            slots = open_.groupBy("g").agg(F.collect_set(F.struct("lo", "hi")).alias("slots"))
            met = values.join(slots, "g").select("g", "v", F.explode(F.filter(
                "slots", lambda s: (s["lo"] <= F.col("v")) & (F.col("v") <= s["hi"]))).alias("s"))
            return met.select("g", "v", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi"))

        for _ in range(MAX_PASSES):
            most = open_.agg(F.max("n")).first()[0]
            if most is None or most <= small:
                break
            counts = (inside().withColumn("bin", _bin(F.col("v"), F.col("lo"), F.col("hi"))).groupBy("g", "lo", "hi", "bin")
                      .agg(F.count(F.lit(1)).alias("here"), F.min("v").alias("low"), F.max("v").alias("high")))
            upto = Window.partitionBy("g", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows at most
            counts = scratch.written(counts, "histogram").withColumn("before", F.coalesce(F.sum("here").over(upto), F.lit(0)))
            met = open_.join(counts, ["g", "lo", "hi"]).filter("before <= k AND k < before + here")
            open_ = scratch.written(met.select("g", "qi", (F.col("k") - F.col("before")).alias("k"), F.col("low").alias("lo"),
                                               F.col("high").alias("hi"), F.col("here").alias("n"),
                                               (F.col("less") + F.col("before")).alias("less")), "ranks")
            done.append(open_.filter("lo = hi").select("g", "qi", F.col("lo").alias("v"), "less"))
            open_ = open_.filter("lo < hi")
        if not open_.isEmpty():
            lists = inside().groupBy("g", "lo", "hi").agg(F.sort_array(F.collect_list("v")).alias("all"))
            at = open_.join(lists, ["g", "lo", "hi"]).withColumn("v", F.element_at("all", (F.col("k") + 1).cast("int")))
            done.append(at.select("g", "qi", "v", (F.col("less") + F.array_position("all", F.col("v")) - 1).alias("less")))
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return written(out, "selected")


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], group_col: str | None = None,
                    small: int = SMALL) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas/numpy 'linear', DuckDB quantile_cont), one row
    per group: (group?, q_0, q_1, ...).  NULL is a group like any other; groups without a value have no row."""
    keys = [group_col] if group_col else []
    name = [F.col(group_col).alias("k")] if group_col else [F.lit(0).alias("k")]
    with Scratch() as scratch:
        # the group as a struct: equal to itself also when it is NULL
        base = scratch.written(df.select(F.struct(*name).alias("g"), F.col(value_col).cast("double").alias("v"))
                               .filter("v IS NOT NULL"), "values")
        huge = float("inf")
        finite = ~F.isnan("v") & (F.abs("v") < huge)
        stats = base.groupBy("g").agg(
            F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("v") == -huge, 1)).alias("under"),
            F.count(F.when(finite, 1)).alias("n"), F.count(F.when(F.col("v") == huge, 1)).alias("over"),
            F.min(F.when(finite, F.col("v"))).alias("lo"), F.max(F.when(finite, F.col("v"))).alias("hi"))
        pos = F.array(*[F.struct(F.lit(i).alias("p"), (F.lit(p) * (F.col("all") - 1)).alias("pos")) for i, p in enumerate(probs)])
        at = stats.select("*", F.explode(pos).alias("t")).select("*", "t.p", "t.pos").select("*", F.posexplode(
            F.array(F.floor("pos"), F.ceil("pos"))).alias("side", "rank"))
        ranks = scratch.written(at.select("g", (F.col("p") * 2 + F.col("side")).alias("qi"), "pos", "rank", "under", "n", "over",
                                          "lo", "hi", (F.col("rank") - F.col("under")).alias("k")), "wanted")
        fits = (F.col("k") >= 0) & (F.col("k") < F.col("n"))
        known = values_at(base.filter(finite), ranks.filter(fits).select("g", "qi", "k", "lo", "hi", "n"), small)
        beyond = F.when(F.col("k") < 0, -huge).when(F.col("k") < F.col("n") + F.col("over"), huge).otherwise(float("nan"))
        both = ranks.join(known.select("g", "qi", F.col("v").alias("value")), ["g", "qi"], "left").withColumn(
            "value", F.when(fits, F.col("value")).otherwise(beyond))
        one = both.groupBy("g", F.floor(F.col("qi") / 2).alias("p")).agg(
            F.min_by("value", "qi").alias("a"), F.max_by("value", "qi").alias("b"), F.max(F.col("pos") - F.floor("pos")).alias("part"))
        q = F.when(F.col("part") == 0, F.col("a")).otherwise(F.col("a") + F.col("part") * (F.col("b") - F.col("a")))
        wide = one.groupBy("g").pivot("p", list(range(len(probs)))).agg(F.first(q))
        out = written(wide.select(*([F.col("g.k").alias(group_col)] if keys else []),
                                  *[F.col(str(i)).alias(f"q_{i}") for i in range(len(probs))]), "quantiles")
        if keys or not out.isEmpty():
            return out
        return df.sparkSession.createDataFrame([(None,) * len(probs)], ", ".join(f"q_{i} double" for i in range(len(probs))))


def first_rows(rows: DataFrame, key: str, order: list[str], take: Column, small: int = SMALL) -> DataFrame:
    """The first ``take`` rows of each ``key`` group by the numeric columns ``order`` (NULL last).

    ``take`` is a column over ``n``, the group's rows.  The value of the first order column at the border rank is
    found by ``values_at``; rows below it are in, and only rows that tie with it go on to the next column.  Rows
    equal in all columns are told apart by no rule."""
    types = dict(rows.dtypes)
    top = {"bigint": (1 << 63) - 1, "int": (1 << 31) - 1, "smallint": (1 << 15) - 1, "tinyint": 127}
    left = rows.withColumn("_g", F.struct(F.col(key).alias("k")))
    for c in order:
        end = F.lit(top.get(types[c], 1.7e308)).cast(types[c])
        left = left.withColumn(f"_{c}", F.least(F.coalesce(F.col(c), end), end))
    left = written(left, "to_select")
    need = left.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).select("_g", take.cast("bigint").alias("need"))
    out = None
    for c in order:
        sized = left.groupBy("_g").agg(F.min(f"_{c}").alias("lo"), F.max(f"_{c}").alias("hi"), F.count(F.lit(1)).alias("n"))
        asked = written(sized.join(need, "_g").filter("need > 0"), "need")
        whole = asked.filter("need >= n").select("_g", F.lit(True).alias("_all"))
        part = asked.filter("need < n").select(F.col("_g").alias("g"), F.lit(0).alias("qi"), (F.col("need") - 1).alias("k"), "lo", "hi", "n")
        border = values_at(left.select(F.col("_g").alias("g"), F.col(f"_{c}").alias("v")), part, small)
        border = border.select(F.col("g").alias("_g"), F.col("v").alias("_at"), F.col("less").alias("_less"))
        met = left.join(whole, "_g", "left").join(border, "_g", "left")
        taken = met.filter(F.col("_all") | (F.col(f"_{c}") < F.col("_at"))).select(*rows.columns)
        out = taken if out is None else out.unionByName(taken)
        need = written(asked.join(border, "_g").select("_g", (F.col("need") - F.col("_less")).alias("need")), "need")
        left = written(met.filter(F.col("_all").isNull() & (F.col(f"_{c}") == F.col("_at"))).select(*left.columns), "ties")
    alike = Window.partitionBy("_g").orderBy(*[f"_{c}" for c in order])
    rest = left.join(need, "_g").withColumn("_n", F.row_number().over(alike)).filter("_n <= need").select(*rows.columns)
    return out.unionByName(rest)
