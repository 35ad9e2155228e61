"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Rows are dealt into blocks of about ``BLOCK_ROWS`` rows: a label with that many has blocks of its
own, smaller labels share them.  A block holds, for every dimension, its candidates sorted by that component.  For an anchor, each list with a non-zero
component of the anchor is read from the end where products are largest (from the top for a positive component,
from the bottom for a negative one): sorted access.  A candidate met for the first time is scored whole: random
access, by integer inner product.  The products of the anchor's components with the
values at the depth reached add up to the threshold: no candidate not yet met scores above it.

1. Positives: an anchor reads the blocks of its label and stops in a block once the threshold falls strictly
   below its k-th positive so far.
2. Negatives: each positive opens a window of scores; an anchor reads the blocks of other labels, keeps the best
   ``negatives`` of every window, and stops in a block once the threshold falls strictly below each window's k-th score so
   far (or below the window itself).

Anchors travel in packs of ``PACK_ROWS``.  A pack meets all blocks in lanes of ``LANE_BLOCKS`` blocks; a
lane is read as a stream with the pack's state carried from block to block, so a task holds one pack and one
block.  Each lane gives its best rows, a window over the (anchor, positive) ranks them.  No rows are joined all with all: the stated
queries meet the table in blocks.

Scores are exact: sums of products beyond 2^53 are computed in whole numbers of any length.

Defined results: rows without an id, with a NULL label, a NULL vector or a NULL or non-finite component take no
part; a shorter vector counts as padded with zeros; equal scores go to the smaller id; repeated rows each take part, also as
anchors, and a row is never its own positive; a score beyond a long becomes the nearest long in the result;
extra columns are ignored whatever their names; fewer positives or negatives give fewer rows, an empty table none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import ship_package, staged

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                         # per cent of the positive's score
BLOCK_ROWS, PACK_ROWS, LANE_BLOCKS = 4_096, 1_024, 4
FIRST_DEPTH = 1 / 64                       # share of a block's rows read from each list before the first stop is tried
_LONG = (1 << 63) - 1


def scaled(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) per component as whole doubles; NULL if the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double") * F.lit(scale))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # beyond 2^53 a double is whole as it stands (and would not fit the long that floor gives)
    whole = F.transform(x, lambda v: F.when(F.abs(v) < 2.0 ** 53, F.floor(F.when(F.abs(v) < 2.0 ** 53, v)).cast("double")).otherwise(v))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _exact(m: np.ndarray) -> np.ndarray:
    """The same whole numbers with unlimited length."""
    out = np.empty(m.shape, dtype=object)
    for at, v in np.ndenumerate(m):
        out[at] = int(v)
    return out


class Block:
    """Candidates with their sorted lists."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, order: np.ndarray):
        self.rows, self.ids, self.labels, self.m, self.down = rows, ids, labels, matrix, order
        self.up = order[:, ::-1]
        self.values = np.take_along_axis(matrix.T, order, 1)          # each list, largest first
        self.large = float(np.abs(matrix).max(initial=0.0))
        self.exact: Block | None = None

    def for_anchor(self, a: np.ndarray) -> tuple["Block", np.ndarray]:
        """Block and anchor in numbers whose sums of products are exact."""
        if self.large * float(np.abs(a).max(initial=0.0)) * len(a) < 2.0 ** 53:
            return self, a
        if self.exact is None:
            self.exact = Block.__new__(Block)
            self.exact.__dict__ |= self.__dict__ | {"m": _exact(self.m), "values": _exact(self.values)}
        return self.exact, _exact(a)

    def descend(self, a: np.ndarray, done: Callable[[object], bool], take: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """Sorted and random access for one anchor until ``done(threshold)`` or all candidates are met;
        ``take`` gets the places and scores of candidates met for the first time."""
        me, a = self.for_anchor(a)
        n = len(self.ids)
        plus, minus = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        if not len(plus) and not len(minus):
            take(np.arange(n), np.zeros(n, dtype=a.dtype))               # every candidate scores 0
            return
        ap, am = a[plus], a[minus]
        if done((ap * me.values[plus, 0]).sum() + (am * me.values[minus, n - 1]).sum()):
            return
        met = np.zeros(n, dtype=bool)
        depth, step = 0, max(1, int(n * FIRST_DEPTH))
        while depth < n:
            end = min(n, depth + step)
            new = np.zeros(n, dtype=bool)
            new[self.down[plus, depth:end].ravel()] = True
            new[self.up[minus, depth:end].ravel()] = True
            at = np.flatnonzero(new & ~met)
            if len(at):
                met[at] = True
                take(at, me.m[at] @ a)
            if met.all() or done((ap * me.values[plus, end - 1]).sum() + (am * me.values[minus, n - end]).sum()):
                return
            depth, step = end, end


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by (score descending, id ascending)."""
    if len(scores) > 4 * k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
    else:
        some = np.arange(len(scores))
    order = sorted(some.tolist(), key=lambda i: (-scores[i], ids[i])) if len(some) <= 64 or scores.dtype == object \
        else some[np.lexsort((ids[some], -scores[some]))].tolist()
    return np.array(order[:k], dtype=np.int64)


class Top:
    """The k best (score, id, row) so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.rows = k, np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self):
        """The k-th score, None while there are fewer."""
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        low = self.floor()
        if low is not None:
            some = np.flatnonzero(scores >= low)
            scores, ids, rows = scores[some], ids[some], rows[some]
        if len(scores):
            s, i, r = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.rows, rows])
            at = _best(s, i, self.k)
            self.scores, self.ids, self.rows = s[at], i[at], r[at]


class Positives:
    """An anchor's state in the first pass: its best candidates of the same label."""

    def __init__(self, k: int, row: int):
        self.top, self.row = Top(k), row

    def done(self, threshold) -> bool:
        low = self.top.floor()
        return low is not None and threshold < low

    def take(self, scores, ids, rows) -> None:
        other = rows != self.row
        self.top.add(scores[other], ids[other], rows[other])

    def found(self) -> Iterator[tuple]:
        for s, i, r in zip(self.top.scores, self.top.ids, self.top.rows):
            yield 0, int(i), int(r), int(s)


class Windows:
    """An anchor's state in the second pass: the best candidates of each positive's window."""

    def __init__(self, k: int, low: int, high: int, positives: list[int]):
        self.low, self.high, self.tops = low, high, [(p, Top(k)) for p in positives]

    def done(self, threshold) -> bool:
        for p, top in self.tops:
            kth = top.floor()
            if 100 * threshold >= self.low * p and (kth is None or threshold >= kth):
                return False
        return True

    def take(self, scores, ids, rows) -> None:
        for p, top in self.tops:
            some = np.flatnonzero((100 * scores >= self.low * p) & (100 * scores <= self.high * p))
            top.add(scores[some], ids[some], rows[some])

    def found(self) -> Iterator[tuple]:
        for n, (_, top) in enumerate(self.tops):
            for s, i, r in zip(top.scores, top.ids, top.rows):
                yield n, int(i), int(r), int(s)


def _padded(vectors: list, dim: int) -> np.ndarray:
    m = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def _pack_matrix(m: np.ndarray) -> bytes:
    """A matrix of whole doubles, in four bytes a number where they suffice."""
    return m.astype("<i4" if np.abs(m).max(initial=0.0) < 2.0 ** 31 else "<f8").tobytes()


def _unpack_matrix(data: pa.Scalar, n: int, dim: int) -> np.ndarray:
    buffer = data.as_buffer()
    return np.frombuffer(buffer, "<i4" if buffer.size == 4 * n * dim else "<f8").reshape(n, dim).astype(np.float64)


def blocks_of(data: DataFrame, dim: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of candidates (rows, ids, labels, m) with their sorted lists, named by (label, slice)."""
    sizes = staged(data.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "labels")
    small = sizes.filter(F.col("n") < block_rows).agg(F.sum("n")).first()[0] or 0
    shelves = max(1, -(-small // block_rows))
    large = F.col("n") >= block_rows
    # the row number spreads also rows that are equal in all columns
    sliced = data.join(sizes, "label").select(
        "row", "id", "label", "v", F.when(large, F.col("label")).alias("own"),
        F.when(large, F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / F.lit(block_rows)).cast("bigint")))
        .otherwise(F.pmod(F.xxhash64("label"), F.lit(shelves))).alias("slice"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        m = _padded(rows["v"].tolist(), dim)
        order = np.argsort(-m.T, axis=1, kind="stable").astype("<u2" if len(m) <= 1 << 16 else "<u4")
        number = {c: [rows[c].to_numpy(np.int64).tobytes()] for c in ("row", "id", "label")}
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "rows": number["row"], "ids": number["id"],
                             "labels": number["label"], "m": [_pack_matrix(m)], "lists": [order.tobytes()]})

    blocks = sliced.groupBy("own", "slice").applyInPandas(
        build, "slice bigint, rows binary, ids binary, labels binary, m binary, lists binary")
    return staged(blocks, "blocks")


def _packs(anchors: DataFrame, n_packs: int, dim: int) -> DataFrame:
    """pack and its anchors: rows, labels, vectors and the scores of their positives so far."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        known = [sorted(([] if p is None else [(int(x["place"]), x["score"]) for x in p])) for p in rows["positives"]]
        return pd.DataFrame({"pack": [rows["pack"].iloc[0]], "rows": [rows["row"].to_numpy(np.int64).tobytes()],
                             "labels": [rows["label"].to_numpy(np.int64).tobytes()],
                             "m": [_pack_matrix(_padded(rows["v"].tolist(), dim))],
                             "known": [[[s for _, s in p] for p in known]]})

    pack = F.pmod(F.xxhash64("row"), F.lit(n_packs))
    return staged(anchors.withColumn("pack", pack).groupBy("pack").applyInPandas(
        build, "pack bigint, rows binary, labels binary, m binary, known array<array<string>>"), "packs")


def _numbers(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))


def _meet(block: Block, fits: np.ndarray, anchor: np.ndarray, state) -> None:
    """One anchor descends into a block; only candidates that fit count."""
    def take(at: np.ndarray, scores: np.ndarray) -> None:
        some = fits[at]
        state.take(scores[some], block.ids[at[some]], block.rows[at[some]])

    block.descend(anchor, state.done, take)


def _visit(packs: DataFrame, blocks: DataFrame, n_packs: int, lanes: int, dim: int, same_label: bool,
           state: Callable[[int, list], object]) -> DataFrame:
    """row (of the anchor), place (of the window), id, other, score: the best rows of each lane."""
    none = F.lit(None).cast("binary")
    lane = F.pmod(F.xxhash64("rows"), F.lit(lanes))
    head = packs.select("pack", _numbers(lanes).alias("lane"),
                        F.lit(0).alias("kind"), "rows", "labels", "m", "known",
                        none.alias("ids"), none.alias("lists"))
    body = blocks.select(_numbers(n_packs).alias("pack"), lane.alias("lane"),
                         F.lit(1).alias("kind"), "rows", "labels", "m",
                         F.lit(None).cast("array<array<string>>").alias("known"), "ids", "lists")
    tasks = min(n_packs * lanes, 8 * int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = head.unionByName(body).repartition(max(1, tasks), "pack", "lane").sortWithinPartitions("pack", "lane", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report() -> pa.RecordBatch:
            out = [(int(r), *f) for r, s in zip(pack[0], pack[3]) for f in s.found()]
            return pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                 pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64()),
                 pa.array([str(o[4]) for o in out], pa.string())], names=["row", "place", "id", "other", "score"])

        pack = None
        for batch in batches:
            for i in range(batch.num_rows):
                get = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
                rows = np.frombuffer(get["rows"].as_buffer(), np.int64)
                labels = np.frombuffer(get["labels"].as_buffer(), np.int64)
                m = _unpack_matrix(get["m"], len(rows), dim)
                if get["kind"].as_py() == 0:
                    if pack is not None:
                        yield report()
                    known = get["known"].as_py()
                    pack = (rows.copy(), labels.copy(), m, [state(int(r), k) for r, k in zip(rows, known)])
                    continue
                lists = get["lists"].as_buffer()
                lists = np.frombuffer(lists, "<u2" if lists.size == 2 * dim * len(rows) else "<u4").reshape(dim, len(rows))
                block = Block(rows, np.frombuffer(get["ids"].as_buffer(), np.int64), labels, m, lists)
                for label in np.unique(pack[1]).tolist():
                    fits = (labels == label) == same_label
                    if fits.any():
                        for j in np.flatnonzero(pack[1] == label):
                            _meet(block, fits, pack[2][j], pack[3][j])
        if pack is not None:
            yield report()

    columns = ["kind", "rows", "labels", "m", "known", "ids", "lists"]
    return met.select(*columns).mapInArrow(run, "row bigint, place int, id bigint, other bigint, score string")


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: float = 256.0, block_rows: int = BLOCK_ROWS, pack_rows: int = PACK_ROWS,
         lane_blocks: int = LANE_BLOCKS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id``; ``label`` may give a label from ``id`` and ``label``."""
    spark = vectors.sparkSession
    ship_package(spark)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                          scaled(F.col(vector_col), scale).alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    if label is not None:
        rows = rows.withColumn("label", label.cast("bigint"))
    data = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    stats = data.agg(F.max(F.size("v")).alias("dim"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    if not stats["anchors"]:
        return spark.createDataFrame([], schema)
    dim, n_packs = max(1, int(stats["dim"])), -(-stats["anchors"] // pack_rows)
    blocks = blocks_of(data, dim, block_rows)
    lanes = max(1, -(-blocks.count() // lane_blocks))

    anchors = data.filter(is_anchor)
    first = _visit(_packs(anchors.withColumn("positives", F.lit(None).cast("array<struct<place:int,score:string>>")), n_packs, dim),
                   blocks, n_packs, lanes, dim, True, lambda row, known: Positives(positives, row))
    best = Window.partitionBy("row").orderBy(*_by_score("score"), "id", "other")
    pos = staged(first.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
                 .select("row", "place", "id", "score"), "positives")
    of_anchor = pos.groupBy("row").agg(F.collect_list(F.struct("place", "score")).alias("positives"))   # ``positives`` at most
    open_ = anchors.join(of_anchor, "row")
    second = _visit(_packs(open_, n_packs, dim), blocks, n_packs, lanes, dim, False,
                    lambda row, known: Windows(negatives, low, high, [int(s) for s in known]))
    hard = Window.partitionBy("row", "place").orderBy(*_by_score("score"), "id", "other")
    ranked = second.withColumn("place", F.col("place") + 1).withColumn("rank", F.row_number().over(hard)).filter(
        F.col("rank") <= negatives)
    wins = pos.select("row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = ranked.join(wins, ["row", "place"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                      _long("positive_score").alias("positive_score"), _long("score").alias("negative_score"))


def _by_score(name: str) -> list[Column]:
    """Order of whole numbers written as text, largest first."""
    minus = F.col(name).startswith("-")
    digits = F.length(name)
    return [minus.asc(), F.when(minus, -digits).otherwise(digits).desc(),
            F.when(minus, None).otherwise(F.col(name)).desc(), F.when(minus, F.col(name)).asc()]


def _long(name: str) -> Column:
    whole = F.col(name).try_cast("bigint")
    return F.coalesce(whole, F.when(F.col(name).startswith("-"), F.lit(-_LONG - 1)).otherwise(F.lit(_LONG)))
