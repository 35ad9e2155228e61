"""Packing, SentencePiece and token counts against the tokenizer libraries."""

from __future__ import annotations

import bisect
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import EDGE_TEXTS, SF, documents

from txlens.llm import packing, queries, sp_codec, token_transducer

WORD, BYTES, PIECES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def fuzz(n=400):
    random.seed(11)
    parts = ["a", "th", "e ", "  ", " ", "\n", "\t", "é", "é", "漢", "▁", "1", "23", " the", "<|endoftext|>", "</s>",
             "<0x0A>", "'s", "it's", "!!", " ", "　", "\x00", "🙂", "İ", "ß", "Σ", "ÿ", "́"]
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(n)]


TEXTS = EDGE_TEXTS + fuzz()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_sentencepiece_equals_library(spark):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, TEXTS).repartition(3)
    got = by_id(sp_codec.encode_documents(docs, PIECES, digests_only=True))
    whole = by_id(sp_codec.encode_documents(docs, PIECES))
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "", add_eos=True)
        assert whole[i]["ids"] == ids and whole[i]["n_corrected"] == 0
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("chunk", [5, 1 << 16])
def test_token_counts_equal_library(spark, chunk):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTES)
    texts = TEXTS if chunk > 5 else [t for t in TEXTS if t is None or len(t) < 5_000]
    got = by_id(token_transducer.count_tokens(documents(spark, texts), BYTES, chunk_chars=chunk))
    for i, t in enumerate(texts):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 512)


def test_chunk_maps_compose_associatively():
    counter = token_transducer.Counter(open(BYTES, "rb").read(), 4)
    text = "The  quick brown\n fox <|endoftext|> jumps  over \t the lazy dog's back"
    maps = [counter.chunk_map(text[i:i + 4]) for i in range(0, len(text), 4)]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = counter.compose(m, right)
    assert counter._finish(left) == counter._finish(right) == counter._finish(counter.scan(maps)[-1])


def check_packing(rows, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for items in by_seq.values():
        at = 0
        for r in sorted(items, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq)


def test_packing_pieces_and_places(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORD)
    pieces = packing.token_pieces(documents(spark, TEXTS), WORD)
    rows = packing.pack(pieces).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r["doc_id"], {})[r["piece"]] = r
    for i, t in enumerate(TEXTS):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        cuts = [ids[k:k + 2048] for k in range(0, len(ids), 2048)]
        assert sorted(seen[i]) == list(range(len(cuts)))
        for k, c in enumerate(cuts):
            r = seen[i][k]
            assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * k, len(c), zlib.crc32(c.tobytes()))
    n = check_packing(rows, 2048)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1


def plain_best_fit(lengths, capacity):
    """Sequences that best fit, longest piece first, needs."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, length)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity
        if gap > length:
            bisect.insort(gaps, gap - length)
    return n


def planned(lengths, capacity):
    planner = packing.Planner(dict(Counter(lengths)), capacity)
    used = Counter()
    for length, _, n, first, offset in planner.plan():
        for k in range(n):
            used[first + k] += length
    assert sum(used.values()) == sum(lengths) and max(used.values(), default=0) <= capacity and len(used) == planner.sequences
    return planner.sequences


def test_planner_needs_no_more_than_plain_best_fit():
    random.seed(3)
    for capacity, lengths in ((64, [random.choice((3, 5, 8, 13, 20, 40, 64, 64, 64)) for _ in range(3_000)]),
                              (2048, [random.randint(1, 2048) for _ in range(2_000)]),
                              (2048, [random.choice((300, 450, 700, 900, 1100, 1300, 333)) for _ in range(3_000)]),
                              (10, [random.randint(1, 10) for _ in range(500)]), (10, [1] * 7), (10, [])):
        assert planned(lengths, capacity) <= plain_best_fit(lengths, capacity)


def test_packing_splits_buckets(spark):
    random.seed(3)
    lengths = [random.choice((3, 5, 8, 13, 20, 40, 64, 64, 64)) for _ in range(3_000)]
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    one = packing.pack(pieces, capacity=64).collect()
    assert len(one) == 3_000 and check_packing(one, 64) == planned(lengths, 64)
    several = packing.pack(pieces, capacity=64, bucket_pieces=500).collect()
    assert len(several) == 3_000 and check_packing(several, 64) <= plain_best_fit(lengths, 64) + 6


def test_planner_uses_singles_pairs_and_triples():
    rows = packing.Planner({60: 1, 40: 1, 50: 1, 30: 1, 20: 2, 70: 1, 10: 3}, 100).plan()
    used = {}
    for length, _, n, seq, _ in rows:
        for k in range(n):
            used[seq + k] = used.get(seq + k, 0) + length
    assert sorted(used.values(), reverse=True)[:3] == [100, 100, 100] and sum(used.values()) == 320


def test_word_tokenizer_remembers_units_once_and_few(spark):
    """Pipeline, best_fit_packing: units of letters alone are held once, the caches are bounded, and slices change no row."""
    from tokenizers import Tokenizer
    tok = packing.WordTokenizer(packing.read_file(WORD), (40, 30))
    plain = Tokenizer.from_file(WORD)
    words = ["Straße", "vélo", "x1", "a-b", "plain", "line\nbreak", "", "ЖЖ", "don't", "END.", "tail\n", "日本"]
    for k in range(40):
        texts = [" ".join(f"{w}{c}" for w in words for c in ("", chr(97 + k % 26), str(k))), "", " ", words[k % len(words)]]
        ids, counts = tok.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in plain.encode(t, add_special_tokens=False).ids]
        assert counts.tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
        assert not any(packing._LETTERS.fullmatch(u) for u in tok.units.young) and "x1" in tok.units.young | tok.units.old
    assert len(tok.letters.old) < 150 and len(tok.units.old) < 150
    docs = documents(spark, [" ".join(words) * (k % 5) for k in range(30)])
    whole, cut = (sorted(map(tuple, packing.token_pieces(docs, WORD, slice_bytes=n, remembered=k).collect()))
                  for n, k in ((4_000_000, (400_000, 500_000)), (90, (40, 30))))
    assert whole == cut and len(whole) == 30


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    assert packing.pack(packing.token_pieces(none, WORD)).count() == 0
    assert sp_codec.encode_documents(none, PIECES, digests_only=True).count() == 0
    assert token_transducer.count_tokens(none, BYTES).count() == 0


def test_queries_over_whole_table(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op5_sentencepiece", "op6_token_counts"):
        assert queries.queries()[name](spark, SF).count() == n
    rows = queries.queries()["op1_best_fit_packing"](spark, SF).collect()
    assert len({r["doc_id"] for r in rows}) == n
    check_packing(rows, 2048)
