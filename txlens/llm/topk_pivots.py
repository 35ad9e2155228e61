"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one more component that gives all of them the same length, so
the largest inner products are the smallest distances.  Every vector is
keyed by its nearest pivot and its distance to it; the vectors of a pivot, ordered by
distance, are cut into annuli, and an annulus into blocks of at most
``BLOCK_ROWS`` vectors, each stored as one matrix.

A query lies at a known distance from every pivot, so by the triangle
inequality an annulus [low, high] of a pivot at distance d holds no vector nearer
than max(0, d - high, low - d).  Each query visits its annuli by this
bound, in rounds of growing number, and stops once the bound of the next one
exceeds its k-th best distance: what is left cannot change the answer.

Queries travel in packs of at most ``PACK_ROWS`` rows: a round joins the visited
(block, pack) pairs with both matrices, multiplies them, and keeps k rows per query and
block; a window keeps the best k.  So nothing is a cross join of rows, and
no key holds more than one block or one pack.

Products of doubles are exact as long as both vectors' squared lengths are at most 2^53, since no partial
sum exceeds the product of the lengths.  Longer vectors stay out of the index: as queries they meet every
block, as candidates every query, in blocks of the same sizes; extended floats with an error bound leave a few
rows per query and block, whose scores are then computed in whole numbers.

Fitted on a bounded sample: ``pivots`` vectors, chosen farthest-first from at most ``sample``
vectors by the hash of their id.  The index holds every vector.

Defined results: vectors that are NULL or hold NULL, NaN or infinite
components, or components that scaling makes infinite, take no part, as queries or candidates;
a shorter vector counts as padded with zeros; equal scores go to the smaller id; a score beyond
a long is ranked by its exact value and reported as the nearest long; fewer than k candidates give fewer rows; of rows with the same id each
takes part (none is a candidate for its own id); extra columns are ignored whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import ship_package, staged

PIVOTS, SAMPLE = 32, 4_096
ANNULI = 32                                # of one pivot
BLOCK_ROWS, PACK_ROWS = 1_024, 256
FIRST_VISITS = 4                           # annuli in a query's first round; four times as many in each next one
EXACT = float(1 << 53)                     # squared length up to which products of doubles are exact
_HEX = 528                                 # digits of a whole score as text that sorts by value


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) per component; NULL if the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    y = F.transform(x, lambda v: v * F.lit(scale))
    bad = F.exists(y, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # from 2^53 on a double is whole, and floor() would give the nearest long
    whole = F.transform(y, lambda v: F.when(F.abs(v) < EXACT, F.floor(v).cast("double")).otherwise(v))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    values = np.asarray(lists.values, dtype=np.float64)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    out = np.zeros((len(lists), dim))
    row = np.repeat(np.arange(len(lists)), np.diff(offsets))
    out[row, np.arange(len(values)) - offsets[row]] = values
    return out


def _lifted(m: np.ndarray, top: float) -> np.ndarray:
    """Data vectors with the component that gives them all the length sqrt(top)."""
    return np.c_[m, np.sqrt(np.maximum(top - (m * m).sum(1), 0.0))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0.0))


def choose_pivots(m: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    if not len(m):
        return m
    picked = [0]
    near = _distances(m, m[:1])[:, 0]
    while len(picked) < min(n, len(m)):
        i = int(np.argmax(near))
        if near[i] == 0:
            break
        picked.append(i)
        near = np.minimum(near, _distances(m, m[i:i + 1])[:, 0])
    return m[picked]


def _sortable(score: int) -> str:
    return f"{score + (1 << (4 * _HEX)):0{_HEX + 1}x}"


def _exact_scores(data: DataFrame, is_query: Column, k: int, dim: int) -> DataFrame:
    """query_id, vec_id, score, sortable: of every pair with a long vector in it what may be among the query's k best."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)

    def packed(rows: DataFrame, per: int, name: str) -> DataFrame:
        """Rows as matrices of about ``per`` of them, long vectors apart: long, part, ids, m."""
        counts = {r["long"]: r["n"] for r in rows.groupBy("long").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = F.when(F.col("long"), -(-counts.get(True, 1) // per)).otherwise(-(-counts.get(False, 1) // per))

        def matrix(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("id", kind="stable")
            m = np.zeros((len(part), dim))
            for i, v in enumerate(part["v"]):
                m[i, :len(v)] = v
            return pd.DataFrame({"long": [part["long"].iloc[0]], "part": [part["part"].iloc[0]],
                                 "ids": [part["id"].to_numpy(np.int64).tobytes()], "m": [m.tobytes()]})

        dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", "v"), parts).cast("int"))
        return staged(dealt.groupBy("long", "part").applyInPandas(matrix, "long boolean, part int, ids binary, m binary"), name)

    rows = data.withColumn("long", square > EXACT)
    blocks = packed(rows, BLOCK_ROWS, "exact_blocks")
    packs = packed(rows.filter(is_query), PACK_ROWS, "exact_packs")
    numbers = {r["long"]: r["n"] for r in blocks.groupBy("long").agg(F.count(F.lit(1)).alias("n")).collect()}
    # long queries meet every block, the others the blocks of long vectors
    met = packs.select(F.col("long").alias("q_long"), F.col("ids").alias("q_ids"), F.col("m").alias("q"),
                       F.explode(F.when(F.col("long"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))
                       .alias("long"))
    last = F.when(F.col("long"), numbers.get(True, 0)).otherwise(numbers.get(False, 0)) - 1
    met = met.filter(last >= 0).withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    named = blocks.withColumn("part", (F.row_number().over(Window.partitionBy("long").orderBy("part")) - 1).cast("int"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                q_ids, ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                q, m = (np.frombuffer(r[c], np.float64).reshape(-1, dim) for c in ("q", "m"))
                wide_q, wide_m = q.astype(np.longdouble), m.astype(np.longdouble).T
                about = wide_q @ wide_m
                off = np.abs(wide_q) @ np.abs(wide_m) * (4 * (dim + 2) * np.finfo(np.longdouble).eps)
                other = q_ids[:, None] != ids[None]
                out = []
                for i in range(len(q_ids)):
                    at = np.flatnonzero(other[i])
                    low, high = about[i, at] - off[i, at], about[i, at] + off[i, at]
                    if len(at) > k:
                        at = at[high >= np.partition(low, len(at) - k)[len(at) - k]]
                    mine = [int(x) for x in q[i]]
                    exact = sorted((-sum(x * int(y) for x, y in zip(mine, m[j])), int(ids[j])) for j in at)[:k]
                    out += [(int(q_ids[i]), j, -s) for s, j in exact]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([max(-(1 << 63), min((1 << 63) - 1, o[2])) for o in out], pa.int64()),
                     pa.array([_sortable(o[2]) for o in out], pa.string())], names=["query_id", "vec_id", "score", "sortable"])

    return (met.join(named.withColumnRenamed("m", "block"), ["long", "part"]).select("q_ids", "q", "ids", F.col("block").alias("m"))
            .mapInArrow(score, "query_id bigint, vec_id bigint, score bigint, sortable string"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0, pivots: int = PIVOTS, annuli: int = ANNULI, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products with other ids.

    ``is_query`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    ship_package(spark)
    data = staged(vectors.select(F.col(id_col).cast("bigint").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
                  .filter(F.col("id").isNotNull() & F.col("v").isNotNull()), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = data.agg(F.max(F.size("v")).alias("dim"), F.max(F.when(square <= EXACT, square)).alias("top"),
                     F.count_if(square > EXACT).alias("long"), F.count(F.lit(1)).alias("n")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    extra = None
    if stats["long"]:
        extra = _exact_scores(data, is_query, k, int(stats["dim"]))
        data = data.filter(square <= EXACT)
    dim, top = int(stats["dim"]), float(stats["top"] or 0.0)
    some = data.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()      # bounded by ``sample``
    pivot = choose_pivots(_lifted(np.array([list(r["v"]) + [0.0] * (dim - len(r["v"])) for r in some])
                                  .reshape(len(some), dim), top), pivots)
    shared = spark.sparkContext.broadcast((pivot, dim, top))                              # ``pivots`` vectors

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, d, t = shared.value
        for b in batches:
            far = _distances(_lifted(_matrix(b.column(1), d), t), p)
            near = far.argmin(1) if len(far) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(far)), near])],
                names=["id", "v", "pivot", "d"])

    keyed = staged(data.mapInArrow(key, "id bigint, v array<double>, pivot int, d double"), "keyed")
    # cuts of a pivot's annuli: quantiles of its distances, a table of pivots x annuli rows
    cuts = {r["pivot"]: r["q"] for r in keyed.groupBy("pivot").agg(F.percentile_approx(
        "d", [i / annuli for i in range(1, annuli)], 1000).alias("q")).collect()}
    cut = F.lit(None).cast("array<double>")
    for p, q in cuts.items():
        cut = F.when(F.col("pivot") == p, F.array(*[F.lit(float(x)) for x in q])).otherwise(cut)
    ring = F.size(F.filter(cut, lambda x: x < F.col("d"))).cast("int")
    # an annulus is dealt over slices of about BLOCK_ROWS rows by the hash of the id
    ringed = keyed.withColumn("ring", ring)
    rings = staged(ringed.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
        .withColumn("slices", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")), "rings")
    # at most pivots x annuli rows
    sliced = ringed.join(F.broadcast(rings.select("pivot", "ring", "slices")), ["pivot", "ring"]).withColumn(
        "slice", F.pmod(F.xxhash64("id", "d"), F.col("slices")).cast("int"))

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        m = np.zeros((len(rows), dim))
        for i, v in enumerate(rows["v"]):
            m[i, :len(v)] = v
        first = rows.iloc[0]
        return pd.DataFrame({"pivot": [first["pivot"]], "ring": [first["ring"]], "slice": [first["slice"]],
                             "ids": [rows["id"].to_numpy(np.int64).tobytes()], "m": [m.astype(np.int32).tobytes()]})

    blocks = staged(sliced.groupBy("pivot", "ring", "slice").applyInPandas(
        block, "pivot int, ring int, slice int, ids binary, m binary"), "blocks")
    ring_rows = [(r["pivot"], r["ring"], r["low"], r["high"], r["slices"]) for r in rings.collect()]
    ring_table = spark.sparkContext.broadcast(ring_rows)                                  # pivots x annuli rows

    wanted = keyed.filter(is_query)
    n_packs = max(1, -(-wanted.count() // PACK_ROWS))
    packed = wanted.withColumn("pack", F.pmod(F.xxhash64("id", "pivot"), F.lit(n_packs)).cast("int"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros((len(rows), dim))
        for i, v in enumerate(rows["v"]):
            m[i, :len(v)] = v
        return pd.DataFrame({"pack": [rows.iloc[0]["pack"]], "q_ids": [rows["id"].to_numpy(np.int64).tobytes()],
                             "q": [m.astype(np.int32).tobytes()]})

    packs = staged(packed.groupBy("pack").applyInPandas(pack, "pack int, q_ids binary, q binary"), "packs")
    slack = 1e-6                           # of the bounds, against rounding: only ever visits more

    def plan(start: int, stop: int):
        """Visits of a pack's queries: their annuli number start..stop by bound, unless the k-th score rules them out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, d, t = shared.value
            rows = ring_table.value
            piv = np.array([r[0] for r in rows])
            low, high = (np.array([r[i] for r in rows], dtype=np.float64) for i in (2, 3))
            for b in batches:
                for r in b.to_pylist():
                    ids = np.frombuffer(r["q_ids"], np.int64)
                    q = np.frombuffer(r["q"], np.int32).reshape(len(ids), d).astype(np.float64)
                    best = dict(zip(r["b_ids"] or [], r["b_scores"] or []))
                    lifted = np.c_[q, np.zeros(len(q))]     # the extra component of a query is 0
                    far = _distances(lifted, p)[:, piv]
                    bound = np.maximum(np.maximum(far - high, low - far), 0.0)
                    # a score s means a squared distance |q|^2 + top - 2 s
                    limit = np.array([best.get(int(i), -np.inf) for i in ids])
                    reach = np.sqrt(np.maximum((q * q).sum(1) + t - 2 * limit, 0.0))
                    order = np.argsort(bound, axis=1, kind="stable")[:, start:stop]
                    size = np.sqrt((q * q).sum(1) + t)
                    near = np.take_along_axis(bound, order, 1) <= (reach * (1 + slack) + slack * (1 + size))[:, None]
                    visits: dict[int, list[int]] = {}
                    for i, j in zip(*np.nonzero(near)):
                        visits.setdefault(int(order[i, j]), []).append(int(i))
                    out = [(rows[j][0], rows[j][1], s, r["pack"], np.array(v, np.int32).tobytes())
                           for j, v in visits.items() for s in range(rows[j][4])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[i] for o in out], tp) for i, tp in
                         enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                        names=["pivot", "ring", "slice", "pack", "who"])

        return run

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                who = np.frombuffer(r["who"], np.int32)
                q_ids, ids = np.frombuffer(r["q_ids"], np.int64)[who], np.frombuffer(r["ids"], np.int64)
                q = np.frombuffer(r["q"], np.int32).reshape(-1, dim)[who].astype(np.float64)
                m = np.frombuffer(r["m"], np.int32).reshape(-1, dim).astype(np.float64)
                s = q @ m.T
                s[q_ids[:, None] == ids[None]] = -np.inf
                # rows are in order of id, so a stable sort gives ties to the smaller one
                order = np.argsort(-s, axis=1, kind="stable")[:, :k]
                got = np.take_along_axis(s, order, 1)
                ok = np.isfinite(got)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, ok.sum(1)), pa.int64()), pa.array(ids[order][ok], pa.int64()),
                     pa.array(got[ok].astype(np.int64), pa.int64())], names=["query_id", "vec_id", "score"])

    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, start, step = None, 0, FIRST_VISITS
    while start < len(ring_rows):
        known = packs.withColumn("b_ids", F.lit(None).cast("array<bigint>")).withColumn(
            "b_scores", F.lit(None).cast("array<bigint>"))
        if best is not None:
            kth = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
            of_pack = packed.select("id", "pack").join(kth, "id").groupBy("pack").agg(
                F.collect_list("id").alias("b_ids"), F.collect_list("score").alias("b_scores"))  # a pack's rows
            known = packs.join(of_pack, "pack", "left")
        visits = staged(known.mapInArrow(plan(start, start + step),
                                         "pivot int, ring int, slice int, pack int, who binary"), "visits")
        if not visits.isEmpty():
            work = visits.join(packs, "pack").join(blocks, ["pivot", "ring", "slice"])
            found = work.select("who", "q_ids", "q", "ids", "m").mapInArrow(
                score, "query_id bigint, vec_id bigint, score bigint")
            if best is not None:
                found = found.unionByName(best.select("query_id", "vec_id", "score"))
            best = staged(found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k), "best")
        elif best is not None:
            break
        start, step = start + step, step * 4
    if extra is None:
        return best.select("query_id", "rank", "vec_id", "score") if best is not None else spark.createDataFrame([], schema)
    if best is not None:
        text = F.lower(F.hex("score"))
        extra = extra.unionByName(best.select("query_id", "vec_id", "score", F.when(
            F.col("score") >= 0, F.concat(F.lit("1" + "0" * (_HEX - 16)), F.lpad(text, 16, "0"))).otherwise(
            F.concat(F.lit("0" + "f" * (_HEX - 16)), text)).alias("sortable")))
    by_value = Window.partitionBy("query_id").orderBy(F.desc("sortable"), "vec_id")
    return extra.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
