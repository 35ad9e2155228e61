"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The last token of the encoding of every prefix is unique: it is the token
``t`` that ends there and may follow the last token of the prefix before it.
So a deterministic automaton that reads one symbol at a time needs only the
places where a vocabulary token could still be open, with the last token
and the count at each: that is a state, and a transition carries the tokens
it adds to the count (a merge can make that negative).  States and
transitions are compiled from the vocabulary's merges when first met.

Texts are counted in chunks.  A chunk's map from the state in which it
starts to the state in which it ends is (head, tokens, tail): what belongs
to the unit still open at its start, the tokens of the units within it, and
the unit open at its end; a chunk without an inner cut is all head.  These
maps compose associatively, and a parallel prefix scan over a text's
chunks gives the state and the count at each chunk's end.

Cuts are exact places: in front of a space that is followed by a symbol
that is no white space, the pre-tokenizer always starts a new piece.
Special strings inside a text are one token each, as in the library.

Defined results: NULL and empty texts have 0 tokens and 0 bytes; repeated
rows each get their own row; extra columns are ignored whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import Memo, file_key, read_file, ship_package, text_slices, worker_once

CHUNK_CHARS = 1 << 16
MAX_STATES = 300_000                       # compiled states kept in memory; more start a new table


class Transducer:
    """Symbols of one pre-token -> tokens, with lazily compiled states."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.rank = {p: i for i, p in enumerate(merges)}
        tokens = set(vocab)
        self.prefixes = {t[:i] for t in tokens for i in range(1, len(t))}
        self.tokens = tokens
        self.follows: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # a state: ((open text, last token before it, count before it minus the count now), ...)
        self.states = [(("", None, 0),)]
        self.index = {self.states[0]: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]

    def _merged(self, text: str) -> list[str]:
        s, rank = list(text), self.rank
        while len(s) > 1:
            best = min(range(len(s) - 1), key=lambda i: rank.get((s[i], s[i + 1]), 1 << 60))
            if (s[best], s[best + 1]) not in rank:
                break
            s[best:best + 2] = [s[best] + s[best + 1]]
        return s

    def _may_follow(self, last: str | None, token: str) -> bool:
        if last is None:
            ok = self.whole.get(token)
            if ok is None:
                ok = self.whole[token] = self._merged(token) == [token]
            return ok
        ok = self.follows.get((last, token))
        if ok is None:
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            ok = self.follows[last, token] = self._merged(last + token) == [last, token]
        return ok

    def _compile(self, state: int, symbol: str) -> tuple[int, int]:
        found = None
        kept = []
        for text, last, count in self.states[state]:
            grown = text + symbol
            if found is None and grown in self.tokens and self._may_follow(last, grown):
                found = (grown, count + 1)
            if grown in self.prefixes:
                kept.append((grown, last, count))
        if found is None:
            raise ValueError(f"symbol {symbol!r} is not in the vocabulary")
        token, added = found
        key = tuple([(t, last, c - added) for t, last, c in kept] + [("", token, 0)])
        to = self.index.get(key)
        if to is None:
            to = self.index[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        step = self.next[state][symbol] = (to, added)
        return step

    def count(self, symbols: str) -> int:
        if len(self.states) > MAX_STATES:
            self._reset()
        state = total = 0
        nxt = self.next
        for s in symbols:
            step = nxt[state].get(s) or self._compile(state, s)
            state, added = step
            total += added
        return total


class Counter:
    """Counts texts through chunk maps; one per worker process."""

    def __init__(self, data: bytes, chunk_chars: int = CHUNK_CHARS):
        from tokenizers import Tokenizer
        spec = json.loads(data)
        pre = spec["pre_tokenizer"] or {}
        if (spec["normalizer"] is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex")
                or pre.get("add_prefix_space")):
            raise ValueError("a byte-level vocabulary without normalizer is needed")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.transducer = Transducer(spec["model"]["vocab"], merges)
        self.pieces = Tokenizer.from_str(data.decode()).pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.chunk_chars = chunk_chars
        self.units = Memo(lambda us: [self._unit(u) for u in us], limit=500_000)
        self.words = Memo(lambda ws: [self.transducer.count(w) for w in ws], limit=300_000)

    def _unit(self, unit: str) -> int:
        total, parts = 0, [unit]
        if self.special and self.special.search(unit):
            total, parts = len(self.special.findall(unit)), self.special.split(unit)
        words = [w for p in parts if p for w, _ in self.pieces(p)]
        return total + sum(self.words.get(words))

    def count_unit(self, unit: str) -> int:
        return self.units.get([unit])[0] if unit else 0

    @staticmethod
    def cut(text: str) -> list[str]:
        """Units of ``text``: cut in front of each space followed by no white space."""
        out: list[str] = []
        for i, part in enumerate(text.split(" ")):
            if i and part and not part[0].isspace():
                out.append(" " + part)
            elif i:
                out[-1] += " " + part
            else:
                out.append(part)
        return out

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens, tail); tokens is None if the chunk has no inner cut."""
        units = self.cut(chunk)
        if len(units) == 1:
            return chunk, None, ""
        return units[0], sum(self.units.get(units[1:-1])), units[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks; associative."""
        if a[1] is None and b[1] is None:
            return self.chunk_map(a[0] + b[0])
        if b[1] is None:                                # b only lengthens a's open unit
            units = self.cut(a[2] + b[0])
            return a[0], a[1] + sum(self.units.get(units[:-1])), units[-1]
        if a[1] is None:
            units = self.cut(a[0] + b[0])
            if len(units) == 1:
                return units[0], b[1], b[2]
            return units[0], sum(self.units.get(units[1:])) + b[1], b[2]
        return a[0], a[1] + sum(self.units.get(self.cut(a[2] + b[0]))) + b[1], b[2]

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Prefix compositions by pairs, then by pairs of pairs (a parallel scan)."""
        if len(maps) < 2:
            return maps
        pairs = [self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
        up = self.scan(pairs)
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(up[i // 2] if i % 2 else self.compose(up[i // 2 - 1], maps[i]))
        return out

    def _finish(self, m: tuple) -> int:
        return sum(self.units.get(self.cut(m[0]))) * bool(m[0]) + (m[1] or 0) + self.count_unit(m[2])

    def count_long(self, text: str) -> int:
        n = self.chunk_chars
        return self._finish(self.scan([self.chunk_map(text[i:i + n]) for i in range(0, len(text), n)])[-1])

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; texts of one chunk are counted together, by distinct unit."""
        parts = pc.split_pattern(texts, " ")
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        values = parts.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        offsets = offsets - offsets[0]
        enc = values.dictionary_encode()
        codes, names = np.asarray(enc.indices, dtype=np.int64), enc.dictionary.to_pylist()
        odd = np.fromiter((u == "" or u[0].isspace() for u in names), dtype=bool, count=len(names))
        spaced = np.array(self.units.get([" " + u for u in names]), dtype=np.int64)
        each = spaced[codes]
        first = offsets[:-1]                            # split gives one part at least
        plain = self.units.get([names[c] for c in codes[first].tolist()])
        each[first] = [n if names[c] else 0 for n, c in zip(plain, codes[first].tolist())]
        total = np.add.reduceat(each, first) if len(first) else np.zeros(0, np.int64)
        strange = odd[codes]
        strange[first] &= np.diff(offsets) > 1          # an empty text is not strange
        slow = np.add.reduceat(strange.astype(np.int64), first) if len(first) else total
        long = np.asarray(pc.utf8_length(texts)) > self.chunk_chars
        for r in np.nonzero((slow > 0) | long)[0]:
            text = texts[int(r)].as_py()
            total[r] = self.count_long(text) if long[r] else sum(self.units.get(self.cut(text)))
        return total


def count_tokens(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    ship_package(spark)
    vocab = spark.sparkContext.broadcast(read_file(vocab_path))
    id_type = dict(docs.dtypes)[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = vocab.value
        counter = worker_once(("fst", file_key(data), chunk_chars), lambda: Counter(data, chunk_chars))
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for start, part in text_slices(texts):
                n = counter.count(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)),
                     pc.binary_length(part).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"))
