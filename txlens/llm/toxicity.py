"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic
text.  A window of a text is compressed once with the ordinary dictionary and
once with the toxic text added to it; the bytes that the toxic dictionary
saves are the window's distance.  A text's windows give a few statistics
(largest, mean, shares above thresholds), and a logistic calibration on
labelled rows that trained no dictionary turns them into a score.

The toxic dictionary is trained on what is peculiar to toxic texts: words, or starts
of words, seen after more different words there than chance explains and hardly ever
in ordinary texts.  Counting neighbours, not occurrences, keeps out words that are
frequent only because a text has copies.  Its size grows with the number of such
starts: every one of them is in it whole, and none has to reach a share of the texts.

Fitting takes a bounded sample of labelled rows: at most ``sample_docs`` per class by the
hash of their id, whole and of any length, as long as they have at most ``sample_chars``
characters in all (a text beyond what is left of these is passed over).  The ordinary
dictionary is trained on the windows of two thirds of the ordinary sample; from
40,000 windows on it takes every second, third, ... of them, so 20,000 to 40,000
(``PLAIN_WINDOWS``).  No statistic is a count that grows with the text.  Scoring covers
every text, whole.

Defined results: a NULL or empty text is one empty window and gets a score;
without labelled rows of both classes every score is the share of toxic
ones (0 without any); repeated rows are scored each; extra columns are
ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import file_key, held_out, ship_package, text_slices, worker_once

WINDOW, OVERLAP = 256, 24                 # bytes
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 16_384   # the toxic one grows beyond it with its starts of words
SAMPLE_DOCS, SAMPLE_CHARS = 3_000, 12_000_000   # of each class; characters of all its texts
PLAIN_WINDOWS = 20_000
MIN_CONTEXTS, MIN_RATIO = 4, 10.0
CHANCE = 1.0                              # starts of words expected to look peculiar by chance alone
STEM = 4                                  # letters of the shortest start of a word that is looked at
KEEP = 0.6
_WORD = re.compile(r"\w+")
_START = re.compile(r"\b\w{1,3}")


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    centre: tuple
    scale: tuple
    weights: tuple                        # the first is the constant
    prior: float


def windows(text: bytes) -> Iterator[bytes]:
    at = 0
    while True:
        yield text[at:at + WINDOW]
        if at + WINDOW >= len(text):
            return
        at += WINDOW - OVERLAP


class Distance:
    """Bytes saved by the toxic dictionary, per window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard as zs
        reach = max(17, (len(ordinary) + len(toxic) + WINDOW).bit_length())
        params = zs.ZstdCompressionParameters(
            compression_level=9, min_match=5, strategy=1, window_log=reach, hash_log=17, chain_log=17, search_log=6,
            target_length=1, write_content_size=False, write_dict_id=False)
        made = []
        # the same layout on both sides, toxic text nearest: equal matches cost equal bytes
        for content in (ordinary + bytes(len(toxic)), ordinary + toxic):
            d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            made.append(zs.ZstdCompressor(dict_data=d, compression_params=params).compress)
        self.plain, self.toxic = made

    def statistics(self, text: str) -> list[float]:
        plain, toxic = self.plain, self.toxic
        g = np.array([len(plain(w)) - len(toxic(w)) for w in windows(normal(text).encode())], dtype=np.float64)
        top = np.sort(g)[::-1][:3]
        return [top[0], top.sum() / 3, g.mean(), (g >= 2).mean(), (g >= 3).mean(), (g >= 4).mean()]


def normal(text: str) -> str:
    """Lower-cased words, one space apart, the first three letters of each in capitals:
    what begins a word then never looks like what stands inside one."""
    return _START.sub(_capital, " ".join(_WORD.findall(text.lower())))


def _capital(m: re.Match) -> str:
    return m[0].upper()


def _contexts(texts: list[str], wanted: set[str] | None = None) -> dict[str, set[str]]:
    """Start of a word (``STEM`` letters or more, or a whole word) -> the different words before it."""
    seen: dict[str, set[str]] = defaultdict(set)
    for t in texts:
        last = ""
        for w in _WORD.findall(t.lower()):
            for n in range(min(STEM, len(w)), len(w) + 1):
                if wanted is None or w[:n] in wanted:
                    seen[w[:n]].add(last)
            last = w
    return seen


def _surprise(bad: int, good: int, share: float) -> float:
    """Chernoff bound: minus the log of the chance of so many of ``bad + good`` on the toxic
    side, if each falls there with probability ``share``."""
    n = bad + good
    q = bad / n
    if q <= share:
        return 0.0
    return bad * math.log(q / share) + (good * math.log((1 - q) / (1 - share)) if good else 0.0)


def _peculiar(toxic: list[str], ordinary: list[str]) -> dict[str, int]:
    """Starts of words with many different left neighbours in toxic texts and hardly any
    elsewhere -> the number of those neighbours.  The number must be beyond chance, given the
    words of both sides and how many starts are looked at; it follows no share of the texts."""
    every = _contexts(toxic)
    bad = {w: len(c) for w, c in every.items() if len(c) >= MIN_CONTEXTS}
    good = _contexts(ordinary, set(bad))
    n_bad, n_good = (max(1, sum(len(_WORD.findall(t)) for t in ts)) for ts in (toxic, ordinary))
    beyond = math.log(max(1, len(bad)) / CHANCE)
    return {w: n for w, n in bad.items()
            if n / n_bad > MIN_RATIO * (len(good.get(w, ())) + 0.5) / n_good
            and _surprise(n, len(good.get(w, ())), n_bad / (n_bad + n_good)) > beyond}


def _stems(text: str, peculiar: dict[str, int]) -> str:
    """Of every word with a peculiar start: that start, as long as it keeps most of its neighbours."""
    out = []
    for w in _WORD.findall(text.lower()):
        starts = [w[:n] for n in range(min(STEM, len(w)), len(w) + 1) if w[:n] in peculiar]
        if starts:
            out.append(max((x for x in starts if peculiar[x] >= KEEP * peculiar[starts[0]]), key=len))
    return " ".join(out)


def _toxic_dictionary(told: list[bytes]) -> bytes:
    """Trained on the occurrences of peculiar starts; those that the trainer cut or left out
    stand whole before it."""
    import zstandard as zs
    each = list(dict.fromkeys(told))
    room = max(TOXIC_BYTES, 512 + 8 * sum(len(x) - 7 for x in each))    # a segment for every place in them
    trained = zs.train_dictionary(room, told * max(1, -(-2_000 // max(1, len(told)))), k=8, d=8).as_bytes()
    return b"".join(x for x in each if x.rstrip() + b" " not in trained) + trained


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    a = np.c_[np.ones(len(x)), x]
    w = np.zeros(a.shape[1])
    pull = np.full(len(w), ridge)
    pull[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag(pull + 1e-9), a.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """The model from texts of both classes; ``share``: of toxic rows among the labelled."""
    import zstandard as zs
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    for_dict = [[t for i, t in enumerate(ts) if i % 3] or ts for ts in (toxic, ordinary)]
    for_line = [[t for i, t in enumerate(ts) if i % 3 == 0] for ts in (toxic, ordinary)]
    flat = Model(b"", b"", (), (), (), share)
    if min(map(len, (toxic, ordinary))) < 2:
        return flat
    words = _peculiar(*for_dict)
    # one sample per occurrence, so that no dictionary segment runs across two of them
    told = [f" {normal(x)} ".encode().ljust(8) for t in for_dict[0] for x in _stems(t, words).split()]
    plain = [w for t in for_dict[1] for w in windows(normal(t).encode()) if len(w) >= 8]
    plain = plain[::max(1, len(plain) // PLAIN_WINDOWS)]
    try:
        base = zs.train_dictionary(ORDINARY_BYTES, plain, k=64, d=8).as_bytes()
        extra = _toxic_dictionary(told)
    except zs.ZstdError:                  # too little text for a trained dictionary: the text itself
        base, extra = b"".join(plain)[:ORDINARY_BYTES], b"".join(dict.fromkeys(told))
    if not base or not extra:
        return flat
    distance = Distance(base, extra)
    x = np.array([distance.statistics(t) for ts in for_line for t in ts])
    y = np.r_[np.ones(len(for_line[0])), np.zeros(len(for_line[1]))]
    centre, scale = x.mean(0), x.std(0) + 1e-9
    w = _logistic((x - centre) / scale, y)
    # the sample holds the classes in its own proportion, the labelled rows in theirs
    have = len(for_line[0]) / len(y)
    if 0 < share < 1:
        w[0] += np.log(share / (1 - share)) - np.log(have / (1 - have))
    return Model(base, extra, tuple(centre), tuple(scale), tuple(w), share)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from labelled rows outside the held-out fold; an id with both labels counts as 0."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("i"))).groupBy("i").agg(F.min("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most sample_docs ids of each class: a proven bound for the broadcasts
    ids = known.filter(F.col("y") == 1).orderBy(F.xxhash64("i"), "i").limit(sample_docs).union(
        known.filter(F.col("y") == 0).orderBy(F.xxhash64("i"), "i").limit(sample_docs))
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(F.length("t") > 0)
    # of an id's rows the one with the smallest hash, the same in both passes
    sizes = (rows.join(F.broadcast(ids), "i").groupBy("i", "y")
             .agg(F.min(F.struct(F.xxhash64("t").alias("h"), F.length("t").alias("n"))).alias("m"))
             .select("i", "y", "m.h", "m.n", F.xxhash64("i").alias("o")).collect())
    left, taken = {1: sample_chars, 0: sample_chars}, []
    for r in sorted(sizes, key=lambda r: (r["o"], r["i"])):
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            taken.append((r["i"], r["y"], r["h"]))
    texts: dict[int, list[str]] = {1: [], 0: []}
    if taken:
        id_type = dict(docs.dtypes)[id_col]
        chosen = docs.sparkSession.createDataFrame(taken, f"i {id_type}, y int, h bigint")
        got = (rows.withColumn("h", F.xxhash64("t")).join(F.broadcast(chosen), ["i", "h"])
               .dropDuplicates(["i"]).select("i", "y", "t").collect())
        for r in sorted(got, key=lambda r: r["i"]):
            texts[r["y"]].append(r["t"])
    return train(texts[1], texts[0], counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted, and the largest distance of its windows."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)      # two dictionaries of fixed size
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        distance = m.weights and worker_once(("zstd", file_key(m.toxic + m.ordinary)),
                                             lambda: Distance(m.ordinary, m.toxic))
        w = np.array(m.weights)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for start, part in text_slices(texts):
                if distance:
                    x = np.array([distance.statistics(t) for t in part.to_pylist()])
                    z = w[0] + ((x - np.array(m.centre)) / np.array(m.scale)) @ w[1:]
                    p, far = 1 / (1 + np.exp(-np.clip(z, -500, 500))), x[:, 0].astype(np.int64)
                else:
                    p, far = np.full(len(part), m.prior), np.zeros(len(part), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                     pa.array(far)], names=["doc_id", "score", "predicted", "distance"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, f"doc_id {id_type}, score double, predicted int, distance bigint"))
