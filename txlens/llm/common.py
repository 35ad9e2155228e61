"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.session import written

# Whitespace of the quality contracts: \x20 and \x09-\x0D (fixed values).
WS = " \t\n\x0b\x0c\r"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that
    operators with Python parts also run where only the driver has it."""
    sc = spark.sparkContext
    if getattr(sc, "_txlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="txlens-zip-"), "txlens_pkg.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    sc.addPyFile(out)
    sc._txlens_shipped = True


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, survives lost executors, and is computed once."""
    return written(df, name)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the
    body names it (also inside lambdas)."""
    return F.transform(F.array(value), body)[0]


def computed(value: Column) -> Column:
    """``value`` computed in a step of its own (one row in, one row out): a filter on it is not
    pushed below, where its expressions would be repeated for every mention."""
    return F.explode(F.array(value))


def held_out(doc_id: Column) -> Column:
    """The fold of the classifiers' contract: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_slices(texts: pa.Array, max_bytes: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) over consecutive rows of about ``max_bytes`` of text
    (one row at least), so that a task's memory follows the slice, not the batch."""
    sizes = np.asarray(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    start = 0
    while start < len(texts):
        ends = np.cumsum(sizes[start:])
        n = max(1, int(np.searchsorted(ends, max_bytes, side="right")))
        yield start, texts.slice(start, n)
        start += n


class Memo:
    """unit -> value with a bounded memory: two generations, the older one is
    dropped when the younger is full.  Only speed depends on the bound."""

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 400_000):
        self.compute, self.limit = compute, limit
        self.young: dict = {}
        self.old: dict = {}

    def get(self, units: list[str]) -> list:
        young, old = self.young, self.old
        out = [young.get(u) for u in units]
        missing = [i for i, v in enumerate(out) if v is None]
        if missing:
            ask = []
            for i in missing:
                v = old.get(units[i])
                if v is None:
                    ask.append(i)
                else:
                    out[i] = young[units[i]] = v
            if ask:
                for i, v in zip(ask, self.compute([units[i] for i in ask])):
                    out[i] = young[units[i]] = v
            if len(young) > self.limit:
                self.old, self.young = young, {}
        return out


_WORKER: dict = {}


def worker_once(key: tuple, make: Callable):
    """``make()`` once per Python worker process and key.  One such object is kept at a
    time: a worker that goes on to another operator's tasks drops the last one's caches."""
    if key not in _WORKER:
        release_worker()
        _WORKER[key] = make()
    return _WORKER[key]


def release_worker() -> None:
    """Drop what an earlier operator has left in this Python worker."""
    _WORKER.clear()
    free_unused()


def free_unused() -> None:
    """Give memory that Arrow keeps for later arrays back to the system."""
    pa.default_memory_pool().release_unused()


def file_key(data: bytes) -> tuple[int, int]:
    return len(data), zlib.crc32(data)


def read_file(path: str) -> bytes:
    """A vocabulary file, read once by the driver (a few MB, whatever the data)."""
    with open(path, "rb") as f:
        return f.read()


def flat_units(lists: pa.ListArray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """A list<string> array as (row offsets, distinct units, code of each unit)."""
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    enc = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
    return offsets - offsets[0], enc.dictionary.to_pylist(), np.asarray(enc.indices, dtype=np.int64)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenate ``values[starts[c]:starts[c]+lengths[c]]`` over ``codes``."""
    n = lengths[codes]
    total = int(n.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(n)
    step = np.arange(total, dtype=np.int64) - np.repeat(ends - n, n)
    return values[np.repeat(starts[codes], n) + step]
