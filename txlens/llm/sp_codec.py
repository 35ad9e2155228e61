"""SentencePiece encoding and decoding by a score-ordered agenda.

For merge-type (BPE) vocabularies: all adjacent symbol pairs that form a
piece are kept on an agenda ordered by score, then position; the best pair
is merged and its new neighbours are put on the agenda, until it is empty.
Symbols outside the vocabulary become byte pieces.

Texts reach Python as Arrow batches.  A text is cut in front of every space
mark that does not follow another one - no piece of the vocabulary crosses
such a place, which is checked when the model is loaded - so the agenda runs
once per distinct unit and the results are gathered per text.  Each unit that
the agenda has encoded is compared with the sentencepiece library in the
same batch; if they ever differed, the library's ids would be used and the
row would say so (``n_corrected``).

Defined results: NULL is an empty text; an empty text has only the end id;
repeated rows each get their own row; extra columns are ignored whatever
their names; an empty table gives an empty result.  Texts are whole: memory
follows the longest text, not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import Memo, file_key, gather, read_file, ship_package, text_slices, worker_once

MARK = "▁"
NEVER = np.iinfo(np.int32).max
LONG, TOGETHER = 48, 8_192   # characters of a unit, and units, that merge together
NEXT = "\x02"              # begins a unit that follows a line break, without a mark (texts that hold it take the slow way)


class Agenda:
    """The merge loop over one vocabulary."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.lib
        n = sp.get_piece_size()
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in usable}
        order = sorted({sp.get_score(i) for i in usable}, reverse=True)
        place = {s: k for k, s in enumerate(order)}
        self.rank = {p: place[sp.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        self.byte_fallback = all(sp.is_byte(i) for i in self.bytes)
        self.inner = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        # a cut in front of a mark is exact only if no piece holds "x" + mark
        self.cuttable = not any(b == MARK and a != MARK for a, b in self.inner)
        self.eos = sp.eos_id()
        self.spelled = range(n)
        self._tables()
        self.loose = {int(i): chr(c) for c, i in enumerate(self.of_char.tolist()) if i >= n}
        self.parts = Memo(lambda units: [self._merge(u) for u in units])
        probe = sp.encode("a  b")
        if sp.encode("") or probe != self.ids_of(MARK + "a" + MARK + MARK + "b"):
            raise ValueError("only vocabularies with a leading space mark and plain text are supported")

    def _merge(self, unit: str) -> list[int]:
        """Ids of ``unit`` (already with marks): the agenda itself."""
        rank, ids = self.rank, self.ids
        sym: list = list(unit)
        n = len(sym)
        if n > 1:
            nxt = list(range(1, n + 1))
            prev = list(range(-1, n - 1))
            agenda = [(r, i) for i in range(n - 1) if (r := rank.get(sym[i] + sym[i + 1])) is not None]
            heapify(agenda)
            while agenda:
                r, i = heappop(agenda)
                left = sym[i]
                if left is None:
                    continue
                j = nxt[i]
                if j >= n or rank.get(left + sym[j]) != r:
                    continue                       # one of the two has been merged meanwhile
                sym[i] = piece = left + sym[j]
                sym[j] = None
                k = nxt[i] = nxt[j]
                if k < n:
                    prev[k] = i
                    if (r := rank.get(piece + sym[k])) is not None:
                        heappush(agenda, (r, i))
                h = prev[i]
                if h >= 0 and (r := rank.get(sym[h] + piece)) is not None:
                    heappush(agenda, (r, h))
        out: list[int] = []
        for s in sym:
            if s is None:
                continue
            i = ids.get(s)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in s.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _tables(self) -> None:
        """Symbols (pieces, and characters that occur in pieces) as numbers, and the pairs that merge, by (left, right)."""
        symbols = dict(self.ids)
        for p in self.rank:
            for c in p:
                symbols.setdefault(c, self.lib.get_piece_size() + len(symbols))
        self.base = max(symbols.values()) + 1
        pairs = {}
        for p, r in self.rank.items():
            for i in range(1, len(p)):
                left, right = symbols.get(p[:i]), symbols.get(p[i:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (r, symbols[p])
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.pair_into = np.array([pairs[k][1] for k in self.pair_keys.tolist()], dtype=np.int32)
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NEVER`` if it does not merge) and the symbol it becomes."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], NEVER), self.pair_into[at]

    def merge_many(self, units: list[str]) -> list[list[int]]:
        """Ids of many units (with marks): the agendas of all of them, one merge each per round.

        A round takes each unit's pair of the least rank, the leftmost of equals, as its agenda would; only the two pairs beside a
        merge are looked up anew.  Units run together with others of like length; long ones take ``ids_of``."""
        if not self.byte_fallback or not len(self.pair_keys):
            return [self.ids_of(u) for u in units]
        length = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        out: list = [None] * len(units)
        order = np.argsort(length, kind="stable")
        order = order[:np.searchsorted(length[order], LONG, side="right")]
        for k in np.flatnonzero(length > LONG).tolist():
            out[k] = self.ids_of(units[k])
        for a in range(0, len(order), TOGETHER):
            some = order[a:a + TOGETHER]
            self._rounds([units[k] for k in some.tolist()], length[some], some, out)
        return out

    def _rounds(self, units: list[str], length: np.ndarray, places: np.ndarray, out: list) -> None:
        width = max(2, int(length[-1]))
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = self.of_char[points]
        code = np.where(code >= 0, code, -2 - points.astype(np.int64)).astype(np.int32)
        inside = np.arange(width) < length[:, None]
        sym = np.full(inside.shape, -1, dtype=np.int32)
        sym[inside] = code
        rank, into = self._look(sym[:, :-1], sym[:, 1:])
        rows, n = np.arange(len(units)), length.copy()
        column = np.arange(width)
        while True:
            at = rank.argmin(1)
            go = rank[np.arange(len(rank)), at] != NEVER
            for r in np.flatnonzero(~go).tolist():
                out[places[rows[r]]] = self._final(sym[r, :n[r]].tolist())
            if not go.any():
                return
            rows, sym, rank, into, at, n = rows[go], sym[go], rank[go], into[go], at[go], n[go] - 1
            line = np.arange(len(rows))
            sym[line, at] = into[line, at]
            # close the gap behind the merged symbol
            move = np.minimum(column + (column > at[:, None]), width - 1)
            sym = np.take_along_axis(sym, move, 1)
            sym[line, n] = -1
            rank, into = np.take_along_axis(rank, move[:, :-1].clip(max=width - 2), 1), np.take_along_axis(into, move[:, :-1].clip(max=width - 2), 1)
            rank[line, np.minimum(n - 1, width - 2)] = NEVER
            rank[line, np.minimum(n, width - 2)] = NEVER
            for beside in (at - 1, at):
                ok = (beside >= 0) & (beside < n - 1)
                w, b = line[ok], beside[ok]
                rank[w, b], into[w, b] = self._look(sym[w, b], sym[w, b + 1])

    def _final(self, symbols: list[int]) -> list[int]:
        if not symbols or min(symbols) >= 0 and max(symbols) < len(self.spelled):
            return symbols
        ids: list[int] = []
        for s in symbols:
            if 0 <= s < len(self.spelled):
                ids.append(s)
            else:
                ids += [self.bytes[b] for b in (chr(-2 - s) if s < 0 else self.loose[s]).encode()]
        return ids

    def ids_of(self, unit: str) -> list[int]:
        """Cut ``unit`` where two neighbours stand together in no piece, then merge each part."""
        if not self.byte_fallback:
            return self._merge(unit)
        inner, start, parts = self.inner, 0, []
        for i in range(1, len(unit)):
            if unit[i - 1:i + 1] not in inner:
                parts.append(unit[start:i])
                start = i
        parts.append(unit[start:])
        out: list[int] = []
        for ids in (self.parts.get(parts) if len(unit) < 100_000 else map(self._merge, parts)):
            out += ids
        return out


class Codec:
    """Unit -> (ids, corrected, decimal text, plain) for a worker process."""

    def __init__(self, model: bytes):
        self.agenda = Agenda(model)
        self.memo = Memo(self._encode, limit=300_000)
        lib = self.agenda.lib
        self.decimal = [str(i) for i in range(lib.get_piece_size())]
        agenda_bytes = {i: b for b, i in enumerate(self.agenda.bytes)} if self.agenda.byte_fallback else {}
        self.spell = [bytes([agenda_bytes[i]]) if i in agenda_bytes else b"" if lib.is_control(i) or lib.is_unknown(i)
                      else lib.id_to_piece(i).encode() for i in range(lib.get_piece_size())]
        # the library decodes a row of pieces to what they spell, without the first mark (checked once, for all pieces)
        usable = sorted(self.agenda.ids.values())
        start = self.agenda.ids.get(MARK)
        whole = b"".join([self.spell[i] for i in usable]).decode().replace(MARK, " ")
        self.spells = start is not None and lib.decode([start, *usable]) == whole
        # line breaks are in no piece: a text may be cut after each of them
        self.line_break = lib.encode("\n")
        self.lines = self.agenda.byte_fallback and not any("\n" in p for p in self.agenda.ids) and \
            self.line_break == self.agenda.ids_of(MARK + "\n")

    def _encode(self, units: list[str], lines: bool = True) -> list[tuple]:
        """units: texts without their leading mark, or (``lines``) what follows a line break after ``NEXT``."""
        agenda, lib, brk = self.agenda, self.agenda.lib, self.line_break
        after = [lines and u[:1] == NEXT for u in units]
        ours = agenda.merge_many([u[1:] if n else MARK + u.replace(" ", MARK) for u, n in zip(units, after)])
        # an empty unit (a space at the end) is a lone mark, which the library drops from an empty text
        library = lib.encode(["\n" + u[1:] if n else u for u, n in zip(units, after)], num_threads=1)
        library = [b[len(brk):] if n else b for b, n in zip(library, after)]
        final = [a if a == b or not u else b for u, a, b in zip(units, ours, library)]
        # a unit is plain if its pieces spell it: plain units in a row decode to the text they were cut from
        spell, decimal = self.spell, self.decimal
        plain = [bool(u) and b"".join([spell[i] for i in f]) == (u[1:] if n else MARK + u).encode()
                 for u, n, f in zip(units, after, final)]
        return [(np.array(f, dtype=np.int32), int(bool(u) and a != b), " ".join([decimal[i] for i in f]), p)
                for u, a, b, f, p in zip(units, ours, library, final, plain)]

    def units(self, text: str) -> list[str]:
        """The units of a text whose spaces are not all single."""
        out: list[str] = []
        for part in text.split(" "):
            if out and (not out[-1] or out[-1][-1] in (" ", MARK) or not self.agenda.cuttable):
                out[-1] += " " + part
            else:
                out.append(part)
        return out

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
        """(ids, corrected units) per text, without the end id."""
        parts = pc.split_pattern(texts, " ")
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        values = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        enc = values.dictionary_encode()
        codes, names = np.asarray(enc.indices, dtype=np.int64), enc.dictionary.to_pylist()
        odd = np.fromiter((u == "" or MARK in u or NEXT in u for u in names), dtype=bool, count=len(names))
        if not self.agenda.cuttable:
            odd[:] = True
        known = self.memo.get(names)
        lengths = np.fromiter((len(k[0]) for k in known), dtype=np.int64, count=len(known))
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate([k[0] for k in known]) if known else np.zeros(0, np.int32)
        fixed = np.fromiter((k[1] for k in known), dtype=np.int64, count=len(known))
        some_odd, some_fixed = odd.any(), fixed.any()
        for r in range(len(texts)):
            c = codes[offsets[r]:offsets[r + 1]]
            if len(c) == 1 and names[c[0]] == "":
                yield flat[:0], 0
            elif some_odd and odd[c].any():
                text = texts[r].as_py()
                got = self._encode(self.units(text), lines=False) if NEXT in text else self.memo.get(self.units(text))
                yield np.concatenate([g[0] for g in got]), sum(g[1] for g in got)
            else:
                yield gather(flat, starts, lengths, c), int(fixed[c].sum()) if some_fixed else 0

    def digests(self, texts: pa.Array) -> tuple[list[int], list[str], list[str], list[int]]:
        """Number of ids, hash of the ids, hash of the decoded text and corrected units per text, the end id included.

        A text of plain units alone is never unfolded to ids: the units' decimal texts are joined, and its decoding is the
        text itself.  Any other text is encoded and decoded as a whole."""
        cut = pc.replace_substring_regex(texts, "\n([^ ])", f"\n {NEXT}\\1") if self.lines else texts
        parts = pc.split_pattern(cut, " ")
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        enc = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).dictionary_encode()
        offsets = offsets - offsets[0]
        codes, names = np.asarray(enc.indices, dtype=np.int64), enc.dictionary.to_pylist()
        known = self.memo.get(names)
        plain = np.fromiter((k[3] and u != "" and MARK not in u for k, u in zip(known, names)), dtype=bool, count=len(names))
        if not self.agenda.cuttable or not self.spells:
            plain[:] = False
        starts = offsets[:-1]
        whole = np.logical_and.reduceat(plain[codes], starts) if len(texts) else np.zeros(0, bool)
        whole &= ~np.asarray(pc.match_substring(texts, NEXT), dtype=bool)
        length = np.fromiter((len(k[0]) for k in known), dtype=np.int64, count=len(known))
        n = np.add.reduceat(length[codes], starts) + 1 if len(texts) else np.zeros(0, np.int64)
        fixed = np.fromiter((k[1] for k in known), dtype=np.int64, count=len(known))
        n_fixed = np.add.reduceat(fixed[codes], starts) if len(texts) else n
        decimal = pa.array([k[2] for k in known], pa.large_string())
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), decimal.take(pa.array(codes))),
                                pa.scalar(" ", pa.large_string()))
        end = b" " + self.decimal[self.agenda.eos].encode()
        ids_hash, text_hash = [], []
        slow = iter(self._slow_digests(texts.filter(pa.array(~whole))))
        n, n_fixed = n.tolist(), n_fixed.tolist()
        for r, (line, text) in enumerate(zip(_pieces(joined), _pieces(texts.cast(pa.large_string())))):
            if whole[r]:
                h = hashlib.sha256(line)
                h.update(end)
                ids_hash.append(h.hexdigest())
                text_hash.append(hashlib.sha256(text).hexdigest())
            else:
                n[r], a, b, n_fixed[r] = next(slow)
                ids_hash.append(a)
                text_hash.append(b)
        return n, ids_hash, text_hash, n_fixed

    def _slow_digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str, int]]:
        rows = [(np.append(ids, np.int32(self.agenda.eos)).tolist(), n) for ids, n in self.encode(texts)]
        for (ids, n), text in zip(rows, self.agenda.lib.decode([ids for ids, _ in rows]) if rows else []):
            yield (len(ids), hashlib.sha256(" ".join([self.decimal[i] for i in ids]).encode()).hexdigest(),
                   hashlib.sha256(text.encode()).hexdigest(), n)


def _pieces(strings: pa.Array) -> Iterator[memoryview]:
    """The bytes of each string of a large_string array, without copies."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset:strings.offset + len(strings) + 1].tolist() if len(strings) else [0]
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(at, at[1:]):
        yield view[a:b]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests_only: bool = False) -> DataFrame:
    """One row per document: doc_id, ids (with the end id), decoded text, n_corrected;
    with ``digests_only`` their count and hashes instead of the two long columns."""
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(read_file(model_path))
    id_type = dict(docs.dtypes)[id_col]
    outputs = ("n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests_only
               else "ids array<int>, decoded string")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = model.value
        codec = worker_once(("sp", file_key(data)), lambda: Codec(data))
        end = codec.agenda.eos
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for start, part in text_slices(texts):
                if digests_only:
                    n, ids_hash, text_hash, fixed = codec.digests(part)
                    cols = [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    rows = [(np.append(ids, np.int32(end)), n) for ids, n in codec.encode(part)]
                    lists, fixed = [ids.tolist() for ids, _ in rows], [n for _, n in rows]
                    cols = [pa.array(lists, pa.list_(pa.int32())), pa.array(codec.agenda.lib.decode(lists), pa.string())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), *cols, pa.array(fixed, pa.int64())],
                    names=["doc_id", *names, "n_corrected"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(encode, f"doc_id {id_type}, {outputs}, n_corrected bigint"))
