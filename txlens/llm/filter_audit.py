"""Interaction audit of five document filters under all orders, with a counting-Bloom duplicate prepass.

1. One scan gives each document its part, a mask of the filters A to D that it
   fails and a 64-bit hash of its text: a narrow table, written once.
2. Every task counts the hashes it meets in a counting-Bloom sketch (``PROBES`` cells
   a text, counts saturating at 2) and sends it by stripes of cells; the sketches are merged
   stripe by stripe, each read as a stream.  Only cells reached at least twice are kept: one bit
   a cell, ``CELLS_PER_TEXT`` cells a text, at most ``MAX_CELLS``, which bounds the
   broadcast to ``MAX_CELLS / 8`` bytes whatever the input.  (Above that bound more texts count as
   possible repeats; the result is the same.)
3. A text with a cell below 2 is unique and never shuffles.  Only the texts of
   possible repeats are grouped, by the full text, for their smallest id.
4. A possible repeat meets that id by the hash of its text alone, unless different
   repeated texts share a hash: those few are joined by the full text.
5. Masks with their labels are added up to counts by (part, mask), at most 32 rows a part, from
   which all 600 (order, step) rows of a part follow by sums.

Defined results: NULL text is an empty text, NULL source the empty part; a
document without an id fails no E and has no labels; rows that share an id are documents of
their own, equal ids are not smaller than one another; a document is good (toxic) if
any of its label rows says 1; extra columns are ignored whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import WS, let, ship_package, staged

FILTERS = "ABCDE"
PROBES, CELLS_PER_TEXT = 4, 16
MAX_CELLS = 1 << 29                        # 64 MB of bits: the bound of what is broadcast
STRIPE_CELLS = 1 << 20
CHUNK = 1 << 18                            # hashes that a task sketches at a time
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_U = np.uint64


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text (not NULL) fails: A 1, B 2, C 4, D 8."""
    plain = F.translate(text, WS, " " * len(WS))

    def bits(words: Column) -> Column:
        n = F.size(words)
        capitals = F.char_length(text) - F.char_length(F.translate(text, _CAPITALS, ""))
        return (F.when(n < 50, 1).otherwise(0)
                + F.when(100 * F.size(F.array_distinct(words)) < 65 * n, 2).otherwise(0)
                + F.when(100 * capitals.cast("bigint") > 5 * F.char_length(text).cast("bigint"), 4).otherwise(0)
                + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0))

    return let(F.array_remove(F.split(plain, " "), ""), bits)


def cells_of(h: np.ndarray, cells: int) -> np.ndarray:
    """[PROBES, n] cell numbers of hashed texts; ``cells`` is a power of two."""
    x = h.astype(np.int64).view(np.uint64)
    step = ((x >> _U(33)) * _U(0x9E3779B97F4A7C15)) | _U(1)
    return np.stack([((x + _U(i) * step) ^ ((x + _U(i) * step) >> _U(29))) & _U(cells - 1) for i in range(PROBES)])


def repeated_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """(stripe, bits): the cells of the merged counting-Bloom sketch that were reached at least twice."""
    ship_package(hashes.sparkSession)
    width = min(cells, STRIPE_CELLS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            cell, n = np.unique(cells_of(np.concatenate(held), cells), return_counts=True)
            stripe = (cell // _U(width)).astype(np.int64)
            for a, b in zip(*_runs(stripe)):
                at, many = (cell[a:b] % _U(width)).astype(np.uint32), n[a:b] > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(stripe[a])], pa.int32()), pa.array([at[~many].tobytes()], pa.binary()),
                     pa.array([at[many].tobytes()], pa.binary())], names=["stripe", "once", "more"])

        held, size = [], 0
        for batch in batches:
            held.append(np.asarray(batch.column(0), dtype=np.int64))
            size += len(held[-1])
            if size >= CHUNK:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(stripe: int, count: np.ndarray) -> pa.RecordBatch:
            bits = np.packbits(count > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([stripe], pa.int32()), pa.array([bits], pa.binary())],
                                              names=["stripe", "bits"])

        now, count = None, None
        for batch in batches:
            for stripe, once, more in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if stripe != now:
                    if now is not None:
                        yield done(now, count)
                    now, count = stripe, np.zeros(width, dtype=np.uint8)
                at = np.frombuffer(once.as_buffer(), np.uint32)      # every cell once: a list has no repeats
                count[at] = np.minimum(count[at] + 1, 2)
                count[np.frombuffer(more.as_buffer(), np.uint32)] = 2
        if now is not None:
            yield done(now, count)

    parts = hashes.select("h").mapInArrow(sketch, "stripe int, once binary, more binary")
    return (parts.repartition("stripe").sortWithinPartitions("stripe")
            .mapInArrow(merge, "stripe int, bits binary"))


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    cut = np.flatnonzero(np.diff(sorted_values)) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(sorted_values)]])


def possible_repeat(hashes: DataFrame, n_texts: int, max_cells: int = MAX_CELLS):
    """A function from a hash column to whether its text may occur twice, by the sketch of ``hashes``."""
    spark = hashes.sparkSession
    cells = min(max_cells, 1 << max(10, (CELLS_PER_TEXT * n_texts - 1).bit_length()))
    width = min(cells, STRIPE_CELLS)
    bits = np.zeros(cells // 8, dtype=np.uint8)
    for r in repeated_cells(hashes, cells).toLocalIterator():          # at most max_cells / 8 bytes
        at = r["stripe"] * (width // 8)
        bits[at:at + width // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def probe(h):
        import pandas as pd
        at = cells_of(h.to_numpy(dtype=np.int64), cells)
        held = shared.value
        return pd.Series((((held[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1) > 0).all(0))

    return F.pandas_udf(probe, "boolean")


def smallest_ids(texts: DataFrame) -> DataFrame:
    """(h, text, least) of the texts that occur under two different ids; ``texts`` has h, text and id."""
    return (texts.filter(F.col("id").isNotNull()).groupBy("h", "text")
            .agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("h", "text", "least"))


def repeats(flags: DataFrame, texts: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``flags`` (with h and id) and ``repeated``: does a smaller id have the same text?
    ``texts`` gives the whole text for the same rows (h, id, text)."""
    maybe = possible_repeat(flags, flags.count(), max_cells)
    least = staged(smallest_ids(texts.filter(maybe("h"))), "smallest_ids")
    of_hash = least.groupBy("h").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("texts"))
    alone = staged(of_hash.filter("texts = 1").select("h", "least"), "by_hash")
    clear = flags.filter(~maybe("h")).withColumn("repeated", F.lit(False))
    open_ = flags.filter(maybe("h")).join(alone, "h", "left")
    later = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    out = clear.unionByName(open_.withColumn("repeated", later).drop("least"))
    clash = of_hash.filter("texts > 1").select("h")
    if clash.isEmpty():
        return out
    # different repeated texts under one hash: their documents are told apart by the full text
    clash = staged(clash, "clashes")
    by_text = texts.join(clash, "h", "left_semi").join(least, ["h", "text"]).filter(F.col("id") > F.col("least"))
    later_ids = staged(by_text.select("h", "id", "key").distinct(), "by_text").withColumn("clash", F.lit(True))
    return out.join(later_ids, ["h", "id", "key"], "left").withColumn(
        "repeated", F.coalesce("clash", "repeated")).drop("clash")


def mask_counts(docs: DataFrame, labels: DataFrame, max_cells: int = MAX_CELLS, hashed=None) -> DataFrame:
    """part, mask (bits of failed filters A 1 to E 16), n, good, toxic: additive counts of documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = hashed or (lambda t: F.xxhash64(t))
    base = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
                       text.alias("text"))
    # a second hash tells rows of one id apart where texts clash on the first
    texts = base.select("id", "part", "text", hashed(F.col("text")).alias("h"), F.crc32(F.col("text").cast("binary")).alias("key"))
    flags = staged(texts.select("id", "part", "h", "key", failures(F.col("text")).alias("mask")), "flags")
    audit = repeats(flags, texts.select("id", "text", "h", "key"), max_cells)
    audit = audit.select("id", "part", (F.col("mask") + F.when(F.col("repeated"), 16).otherwise(0)).alias("mask"))
    marks = staged(labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("bad")), "marks")
    one = audit.join(marks, "id", "left")
    return one.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("toxic"))


def _steps() -> str:
    """The 600 steps of all orders as JSON: name, step, own bit, bits before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for i, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            out.append({"o": "".join(order), "s": i + 1, "b": bit, "p": before})
            before |= bit
    return json.dumps(out)


def all_orders(counts: DataFrame) -> DataFrame:
    """Every part's 600 rows from its mask counts."""
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))  # 32 at most
    steps = F.from_json(F.lit(_steps()), "array<struct<o:string,s:int,b:int,p:int>>")
    rows = per_part.select("part", "c", F.explode(steps).alias("t"))
    own, before = F.col("t.b"), F.col("t.p")

    def total(field: str, keep) -> Column:
        return F.aggregate("c", F.lit(0).cast("bigint"),
                           lambda a, x: a + F.when(keep(x["mask"]), x[field]).otherwise(F.lit(0)))

    def removed(m: Column) -> Column:
        return (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)

    # a document is removed by its filter in 120 / (filters it fails) of the orders
    share = F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + F.when(
        x["mask"].bitwiseAND(own) != 0, (x["n"] * 120 / F.bit_count(x["mask"])).cast("bigint")).otherwise(F.lit(0)))
    return rows.select(
        "part", F.col("t.o").alias("filter_order"), F.col("t.s").alias("step"),
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        share.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per part, filter order and step, zeros included."""
    return all_orders(mask_counts(docs, labels, max_cells))
