"""Best-fit packing of token pieces into sequences by exact complements.

Only the histogram of piece lengths is planned: at most ``capacity`` rows
per bucket, whatever the data.  For each length, longest first, the gap it
leaves is looked up among the sums of one, two and three available lengths
and such combinations are consumed as often as their counts allow; what
remains goes best-fit, longest first, into the smallest open gap, and each gap
that this leaves is again tried for an exact filling.  A plan row says: the
next ``n`` pieces of this length go to ``n`` consecutive sequences at this
offset.

The pieces then get their rank within (bucket, length) and meet the plan's
slots in an equi-join on (bucket, length, rank), which has one row per key
on both sides.  Ranks come from counts per (bucket, length, slice) and a
window within one slice, so a length that a third of all pieces share is
spread over the slices.  Buckets are packed independently of each other and hold
``BUCKET_PIECES`` pieces each, so the planning of one is bounded and all
of them together waste less than one sequence per bucket.

Defined results: a NULL or empty text is one piece that holds the end id
only; repeated rows are packed each; extra columns are ignored whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlens.llm.common import Memo, file_key, free_unused, gather, read_file, ship_package, staged, text_slices, worker_once

CAPACITY = 2048
END_ID = 0
BUCKET_PIECES = 4_000_000
SLICES = 256
SLICE_BYTES = 4_000_000      # of text that is encoded at once
REMEMBERED = 400_000, 500_000    # runs of letters and other units that a worker keeps, at most twice

# Letters that are one code point in every normal form, up to an ASCII character or the
# end of the text: a pre-token of its own.  Anything else is one unit up to the next space.
_UNIT = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[\x00-\x7f]|$)|[^ ]+")
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordTokenizer:
    """Ids of texts by the tokenizers library, asked once per distinct unit.

    The vocabulary's pre-tokenizer never joins text across white space, so a
    text's ids are those of its space-separated units in a row; a run of
    letters within a unit is handed to the library's model directly."""

    def __init__(self, data: bytes, remembered: tuple[int, int] = REMEMBERED):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_str(data.decode())
        self.lib.no_truncation()
        self.lib.no_padding()
        from tokenizers.pre_tokenizers import ByteLevel
        letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        probe = "Straße à vélo, the END"
        self.byte_char = {b: letters(chr(b))[0][0] if b < 128 else None for b in range(65, 128)}
        for c in map(chr, range(0xC0, 0x100)):
            for b, m in zip(c.encode(), letters(c)[0][0]):
                self.byte_char[b] = m
        self.letters = Memo(self._letters, limit=remembered[0])
        self.units = Memo(self._units, limit=remembered[1])
        want = self.lib.encode(probe, add_special_tokens=False).ids
        got = np.frombuffer(b"".join(self._units(probe.split(" "))), dtype=np.uint32).tolist()
        if got != want or self.lib.encode("ab cd x", add_special_tokens=False).ids != [
                i for w in ("ab", "cd", "x") for i in self.lib.encode(w, add_special_tokens=False).ids]:
            raise ValueError("a vocabulary whose pre-tokenizer drops white space is needed")

    def _letters(self, words: list[str]) -> list[bytes]:
        chars, run = self.byte_char, self.lib.model.tokenize
        out = []
        for w in words:
            w = w.lower()
            w = w if w.isascii() else "".join([chars[b] for b in w.encode()])
            out.append(array("I", [t.id for t in run(w)]).tobytes())
        return out

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as 4-byte integers: the parts of all units are looked up together."""
        parts = [_UNIT.findall(u) for u in units]
        letters = [p for ps in parts for p in ps if _LETTERS.fullmatch(p)]
        known = dict(zip(letters, self.letters.get(letters)))
        other = list({p for ps in parts for p in ps if p not in known})
        got = self.lib.encode_batch_fast(other, add_special_tokens=False) if other else []
        known.update((p, array("I", e.ids).tobytes()) for p, e in zip(other, got))
        return [known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for ps in parts]

    def _known(self, units: pa.Array) -> list[bytes]:
        """Ids of distinct units; those of letters alone are remembered as such, and not as units too."""
        plain = pc.match_substring_regex(units, f"^(?:{_LETTERS.pattern})$")
        out = np.empty(len(units), dtype=object)
        for memo, mine in ((self.letters, plain), (self.units, pc.invert(plain))):
            out[np.asarray(mine)] = memo.get(units.filter(mine).to_pylist())
        return out.tolist()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, count per text)."""
        parts = pc.split_pattern(texts, " ")
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        values = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        enc = values.dictionary_encode()
        codes, known = np.asarray(enc.indices, dtype=np.int64), self._known(enc.dictionary)
        lengths = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        flat = np.frombuffer(b"".join(known), dtype=np.uint32)
        ids = gather(flat, np.cumsum(lengths) - lengths, lengths, codes)
        ends = np.concatenate([[0], np.cumsum(lengths[codes])])
        return ids, ends[offsets[1:]] - ends[offsets[:-1]]


def token_pieces(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
                 slice_bytes: int = SLICE_BYTES, remembered: tuple[int, int] = REMEMBERED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids).  Smaller ``slice_bytes`` and
    ``remembered`` take less memory and more time."""
    spark = docs.sparkSession
    ship_package(spark)
    vocab = spark.sparkContext.broadcast(read_file(vocab_path))
    id_type = dict(docs.dtypes)[id_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = vocab.value
        tok = worker_once(("word", file_key(data), remembered), lambda: WordTokenizer(data, remembered))
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for first, part in text_slices(texts, slice_bytes):
                ids, counts = tok.encode(part)
                row, piece, start, length, crc, lists = [], [], [], [], [], []
                at = 0
                for r, n in enumerate(counts.tolist()):
                    whole = np.append(ids[at:at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for k, s in enumerate(range(0, n + 1, capacity)):
                        got = whole[s:s + capacity]
                        row.append(r)
                        piece.append(k)
                        start.append(s)
                        length.append(len(got))
                        crc.append(zlib.crc32(got.tobytes()))
                        if with_ids:
                            lists.append(got.tolist())
                cols = [batch.column(0).take(pa.array(row, pa.int64()) if first == 0 else
                                             pa.array(np.array(row, np.int64) + first)),
                        pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(lists, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
            batch = texts = part = ids = cols = None     # before the next batch is read
            free_unused()

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
                        + (", ids array<bigint>" if with_ids else "")))


class Planner:
    """Plan of one bucket: counts per length -> rows (length, rank, n, sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(capacity + 1, dtype=np.int64)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = {}        # gap -> [(first sequence, n)]

    def _put(self, length: int, sequence: int, n: int, offset: int) -> None:
        self.rows.append((length, int(self.used[length]), n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n

    def _exact(self, gap: int, most: int = 3) -> tuple[int, ...] | None:
        """Available lengths, at most ``most`` of them, that fill ``gap`` exactly; few and long ones first."""
        left = self.left
        if left[gap]:
            return (gap,)
        pair = self._pair(gap, gap - 1) if most > 1 else None
        if pair or most < 3:
            return pair
        for a in (np.nonzero(left[gap // 3 + (gap % 3 > 0):gap - 1])[0][::-1] + gap // 3 + (gap % 3 > 0)).tolist():
            left[a] -= 1
            pair = self._pair(gap - a, min(a, gap - a - 1))
            left[a] += 1
            if pair:
                return (a, *pair)
        return None

    def _pair(self, total: int, longest: int) -> tuple[int, int] | None:
        """Two available lengths of this sum, the longer one at most ``longest``."""
        low = (total + 1) // 2
        if longest < low:
            return None
        a = np.arange(longest, low - 1, -1)
        ok = (self.left[a] > 0) & (self.left[total - a] > 0) & ((a * 2 != total) | (self.left[a] > 1))
        hit = np.argmax(ok) if len(ok) else 0
        return (int(a[hit]), int(total - a[hit])) if len(ok) and ok[hit] else None

    def _fill(self, first: int, n: int, gap: int) -> None:
        """Fill ``n`` sequences with this gap exactly where lengths allow; the rest stay open."""
        while n and gap:
            combo = self._exact(gap)
            if combo is None:
                break
            times = min(int(self.left[x]) // combo.count(x) for x in combo)
            m = min(n, times)
            offset = self.capacity - gap
            for x in combo:
                self._put(x, first, m, offset)
                offset += x
            first, n = first + m, n - m
        if n and gap:
            self.open.setdefault(gap, []).append((first, n))

    def plan(self) -> list[tuple[int, int, int, int, int]]:
        cap = self.capacity
        if self.left[cap]:
            n = int(self.left[cap])
            self._put(cap, self.sequences, n, 0)
            self.sequences += n
        for length in range(cap - 1, 0, -1):              # exact complements
            while self.left[length]:
                self.left[length] -= 1
                combo = self._exact(cap - length)
                self.left[length] += 1
                if combo is None and 2 * length <= cap:
                    break
                if combo is None:
                    # two such pieces never share a sequence, so this one takes the longest
                    # that fits before shorter ones use it up among themselves
                    fits = np.nonzero(self.left[:cap - length + 1])[0]
                    combo = (int(fits[-1]),) if len(fits) else ()
                whole = (length, *combo)
                n = min(int(self.left[x]) // whole.count(x) for x in whole)
                first, offset = self.sequences, 0
                self.sequences += n
                for x in whole:
                    self._put(x, first, n, offset)
                    offset += x
                self._fill(first, n, cap - offset)
        for length in range(cap - 1, 0, -1):              # best fit of the residuals
            while self.left[length]:
                n = int(self.left[length])
                gap = min((g for g in self.open if g >= length), default=None)
                if gap is not None:
                    first, have = self.open[gap].pop()
                    if not self.open[gap]:
                        del self.open[gap]
                    m = min(n, have)
                    self._put(length, first, m, cap - gap)
                    if have > m:
                        self.open.setdefault(gap, []).append((first + m, have - m))
                    self._fill(first, m, gap - length)
                    continue
                each = min(cap // length, n)              # equal pieces would best-fit each other's sequences
                m = n // each
                for k in range(each):
                    self._put(length, self.sequences, m, k * length)
                self.sequences += m
                self._fill(self.sequences - m, m, cap - each * length)
        return self.rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) plus sequence_id and offset.

    ``pieces`` is written once to the shared folder, since it is read for the
    histogram and again for the placement."""
    table = staged(pieces, "pieces")
    n_buckets = max(1, -(-table.count() // bucket_pieces))
    mix = F.xxhash64("doc_id", "piece", "length")
    items = (table.withColumn("_bucket", F.pmod(mix, F.lit(n_buckets)).cast("int"))
             .withColumn("_slice", F.pmod(F.xxhash64(mix), F.lit(SLICES)).cast("int")))
    counts = items.groupBy("_bucket", "length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_bucket", "length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    histogram = counts.groupBy("_bucket", "length").agg(F.sum("_n").alias("n"))

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = Planner(dict(zip(rows["length"].tolist(), rows["n"].tolist())), capacity).plan()
        out = pd.DataFrame(made, columns=["length", "_from", "_many", "_first", "offset"], dtype="int64")
        return out.assign(_bucket=np.int32(key[0]))

    ship_package(pieces.sparkSession)
    # every bucket's histogram has at most ``capacity`` rows
    plans = histogram.groupBy("_bucket").applyInPandas(
        plan, "length bigint, _from bigint, _many bigint, _first bigint, offset bigint, _bucket int")
    step = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_many") - 1)).alias("_k")
    slots = plans.select("_bucket", "length", "_from", "_first", "offset", step).select(
        "_bucket", "length", (F.col("_from") + F.col("_k")).alias("_rank"),
        (F.col("_bucket").cast("bigint") * F.lit(1 << 40) + F.col("_first") + F.col("_k")).alias("sequence_id"),
        "offset")
    within = Window.partitionBy("_bucket", "length", "_slice").orderBy("doc_id", "piece")
    ranked = items.withColumn("_pos", F.row_number().over(within).cast("bigint") - 1)
    # both sides are laid out by these keys already; the counts grow with the buckets, so no broadcast
    ranked = ranked.join(offsets.hint("merge"), ["_bucket", "length", "_slice"]).withColumn("_rank", F.col("_before") + F.col("_pos"))
    # a slot per piece: never small, though the plan rows that it is made from are
    return (ranked.join(slots.hint("merge"), ["_bucket", "length", "_rank"])
            .select(*pieces.columns, "sequence_id", "offset"))
