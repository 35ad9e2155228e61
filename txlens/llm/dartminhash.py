"""Near-duplicate documents by DartMinHash signatures.

A document is a weighted set of hashed five-word shingles.  Every (element,
weight band) is a region over which darts arrive as a Poisson process: rank
by rank, from hashes alone, so equal elements receive equal darts in every
document.  A dart counts if it falls below the element's weight; each dart
names a coordinate, and a coordinate keeps the dart of least rank.  A document
needs about k ln k darts whatever its size, and two documents agree in a coordinate
with the probability of their weighted Jaccard similarity.  Classes are about
plain Jaccard: all weights are 1 there (``by_count`` is not used by them).  (If a
coordinate stays empty the rank bound is doubled for that document.)

Classes, without listing all pairs of a group:

1. documents with equal shingle sets are one representative (a grouped
   minimum of their fingerprint);
2. signatures are cut into bands; documents that share a band's key form a
   bucket;
3. a document's crowd is the sum of its buckets' sizes.  In each bucket the document with the largest crowd
   leads: an original shares more buckets with its copies than they do with one another, so one document leads
   most buckets of a group.  The leader is compared with the others by their exact shingle sets; pairs that
   reach the similarity are links, and connected links are classes;
4. in the buckets whose other members still differ in class, these are compared within tasks, block by block, on
   a longer signature (``FINE`` coordinates of one byte): a pair of different classes goes on to the
   exact comparison if enough coordinates agree (``SLACK`` standard deviations below the similarity), once, in the first
   band that it shares.
   So pairs that are clearly unlike are never rows, and every two documents that share a bucket end in one class or
   have been compared.

A bucket of s members whose classes differ after step 3 travels in (s / ``BLOCK``) ** 2 / 2 pairs of blocks.
Tables needed only on the way go to the shared folder and are deleted at the end.  Joins on bucket keys,
fingerprints and documents read such tables directly, so that Spark's
skew-join rule can split a key that holds a large part of the rows.

Defined results: a document without words (NULL or empty text) is a class of
its own; one of fewer than five words is one shingle; the class id is the
smallest id in it; repeated rows get the same class; rows that share an id but not
the text are documents of their own, in order of (id, hash of the text); extra columns are
ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import fresh, release_worker, ship_package, staged
from txlens.session import Scratch

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5                        # 0.8 ** 5 = 0.33 a band: one pair in 14,000 at 0.8 meets in none
MAX_ELEMENTS = 300_000                     # words hashed together in a task: bounds its memory
SIGN_DOCUMENTS = 512                       # documents signed together: each throws about k ln k darts, however short it is
FINE, SLACK = 480, 4.0                     # at similarity 0.8 a pair is passed over with probability 3e-5
FINE_DOCUMENTS = 256                       # documents signed together on ``FINE`` coordinates: bounds a task's memory
SPARSE, MOST_BITS = 16, 1 << 25              # bits for each id whose text is looked at again, and bits in all (4 MB)
BLOCK = 4_096                                # members of a bucket compared with as many others at a time
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-shift rounds)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _by_document_and_value(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """Order by (doc, h): one sort of packed integers; in the rare case that different values
    share their leading bits, and for very many documents, a sort by both columns."""
    if n_docs < 1 << 20:
        packed = (doc.astype(np.uint64) << _U(44)) | (h >> _U(20))
        order = np.argsort(packed)
        p, v = packed[order], h[order]
        if not ((p[1:] == p[:-1]) & (v[1:] != v[:-1])).any():
            return order
    return np.lexsort((h, doc))


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, element, count) of the distinct shingles of hashed words, by document and element."""
    words = words.view(np.uint64)
    n = np.diff(offsets)
    per_doc = np.where(n >= WORDS, n - WORDS + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), per_doc)
    first = np.repeat(offsets[:-1] - (np.cumsum(per_doc) - per_doc), per_doc) + np.arange(len(doc))
    end = offsets[1:][doc]
    h = np.full(len(doc), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for j in range(WORDS):
        at = first + j
        inside = at < end
        step = mix(h + words[np.minimum(at, len(words) - 1)]) if len(words) else h
        h = np.where(inside, step, h)
    order = _by_document_and_value(doc, h, len(n))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.nonzero(new)[0]
    return doc[at], h[at], np.diff(np.append(at, len(doc)))


def _throw(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, bound: np.ndarray, k: int) -> tuple:
    """Darts (document, coordinate, rank, id) of rank below each document's bound."""
    out: list[tuple] = []
    top = int(np.ceil(np.log2(max(weight.max(), 1.0)))) if len(weight) else 0
    for band in range(top + 1):
        low, height = (0.0, 1.0) if band == 0 else (2.0 ** (band - 1), 2.0 ** (band - 1))
        here = np.nonzero(weight > low)[0]
        region = mix(element[here] + _U((band + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        rank = np.zeros(len(here))
        arrival = 0
        while len(here):
            arrival += 1
            dart = mix(region + _U(arrival * 0xD1342543DE82EF95 & (2**64 - 1)))
            u = ((dart >> _U(11)).astype(np.float64) + 0.5) / 2.0**53
            rank = rank - np.log(u) / height
            alive = rank < bound[doc[here]]
            here, region, rank, dart = here[alive], region[alive], rank[alive], dart[alive]
            name = mix(dart ^ _U(0xA0761D6478BD642F))
            at = low + height * ((mix(name) >> _U(11)).astype(np.float64) / 2.0**53)
            hit = at < weight[here]
            out.append((doc[here[hit]], (name[hit] % _U(k)).astype(np.int64), rank[hit], name[hit]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """uint64 [n_docs, k]: the id of the dart of least rank per coordinate; 0 for empty documents."""
    sig = np.zeros((n_docs, k), dtype=np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    todo = total > 0
    bound = np.where(todo, k * (np.log(k) + 3) / np.maximum(total, 1e-300), 0.0)
    while todo.any():
        mine = todo[doc]
        d, j, rank, name = _throw(doc[mine], element[mine], weight[mine], bound, k)
        key = d * k + j
        least = np.full(n_docs * k, np.inf)
        np.minimum.at(least, key, rank)
        filled = np.isfinite(least).reshape(n_docs, k).all(1)
        hit = (rank == least[key]) & (todo & filled)[d]
        sig.reshape(-1)[key[hit]] = name[hit]
        todo &= ~filled
        bound = bound * 2
    return sig


def _parts(offsets: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of documents of about MAX_ELEMENTS words (one document at least, ``most`` at most)."""
    start = 0
    while start < len(offsets) - 1:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + MAX_ELEMENTS, side="right")) - 1)
        end = min(end, start + most) if most else end
        yield start, end
        start = end


def _word_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[ \\x09-\\x0D]+"), "")
    return docs.select(F.col(id_col).alias("doc_id"), F.transform(words, lambda w: F.xxhash64(w)).alias("w"))


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    col = batch.column(1)
    offsets = np.asarray(col.offsets, dtype=np.int64)
    values = np.asarray(col.values, dtype=np.int64)[offsets[0]:offsets[-1]]
    return values, offsets - offsets[0]


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS,
         by_count: bool = False) -> DataFrame:
    """One row per document: doc_id, n (distinct shingles), fp1, fp2 (fingerprint of
    the set, NULL without words) and one key per band.  ``by_count`` weighs a
    shingle by its number of occurrences instead of 1."""
    ship_package(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            values, offsets = _lists(batch)
            for a, b in _parts(offsets, SIGN_DOCUMENTS):
                doc, element, count = shingles(values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                weight = count.astype(np.float64) if by_count else np.ones(len(doc))
                sig = signatures(doc, element, weight, b - a, bands * rows)
                key = np.zeros((b - a, bands), dtype=np.uint64)
                for r in range(rows):
                    key = mix(key + sig[:, r::rows][:, :bands])
                key = mix(key + np.arange(1, bands + 1, dtype=np.uint64))
                n = np.bincount(doc, minlength=b - a)
                starts = np.cumsum(n) - n
                fp = []
                for salt in (0x51ED270B0A1F39C1, 0xC2B2AE3D27D4EB4F):
                    tag = mix(element ^ _U(salt)) * (count.astype(np.uint64) if by_count else _U(1))
                    sums = np.zeros(b - a, dtype=np.uint64)
                    if len(tag):
                        sums[n > 0] = np.add.reduceat(tag, starts[n > 0])
                    fp.append(pa.array(sums.view(np.int64), mask=n == 0))
                keys = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]), pa.int32()),
                    pa.array(key[n > 0].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), *fp, keys],
                    names=["doc_id", "n", "fp1", "fp2", "keys"])

    return _word_hashes(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, n bigint, fp1 bigint, fp2 bigint, keys array<bigint>")


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its distinct shingles (hashed), for exact comparisons."""
    ship_package(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker()
        for batch in batches:
            values, offsets = _lists(batch)
            for a, b in _parts(offsets):
                doc, element, _ = shingles(values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(element.view(np.int64)))],
                    names=["doc_id", "s"])

    return _word_hashes(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type}, s array<bigint>")


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    b = pairs.join(sets.select(F.col("doc").alias("b"), F.col("s").alias("sb")), "b")
    both = b.join(sets.select(F.col("doc").alias("a"), F.col("s").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("double")
    return both.filter(common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def components(links: DataFrame, staged=staged) -> DataFrame:
    """(doc, label) of every linked document: the smallest id connected to it.

    Labels travel along links and by pointer jumping; each round is written
    to the shared folder, and rounds go on until no label changes."""
    edges = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "edges")
    labels = staged(edges.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("m"))
                    .select("doc", F.least("doc", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("doc").alias("a"), "label"), "a")
                .groupBy(F.col("b").alias("doc")).agg(F.min("label").alias("near")))
        hop = labels.select(F.col("doc").alias("label"), F.col("label").alias("jump"))
        new = (labels.join(hop, "label").select("doc", "label", "jump").join(near, "doc")
               .select("doc", F.least("label", "jump", "near").alias("label"), F.col("label").alias("old")))
        new = staged(new, "labels")
        changed = not new.filter(F.col("label") != F.col("old")).isEmpty()
        labels = new.select("doc", "label")
        if not changed:
            return labels


def fine_signatures(sets: DataFrame) -> DataFrame:
    """doc and f, one byte for each of ``FINE`` coordinates, from shingle sets (doc, s)."""
    ship_package(sets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = _lists(batch)
            start = 0
            while start < len(offsets) - 1:
                end = int(np.searchsorted(offsets, offsets[start] + MAX_ELEMENTS, side="right")) - 1
                end = min(max(end, start + 1), start + FINE_DOCUMENTS)
                size = np.diff(offsets[start:end + 1])
                doc = np.repeat(np.arange(end - start), size)
                sig = signatures(doc, values[offsets[start]:offsets[end]].view(np.uint64), np.ones(len(doc)), end - start, FINE)
                f = (sig >> _U(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array([r.tobytes() for r in f], pa.binary())], names=["doc", "f"])
                start = end

    return sets.select("doc", "s").mapInArrow(run, f"doc {dict(sets.dtypes)['doc']}, f binary")


def _alike(n: np.ndarray, label: np.ndarray, f: np.ndarray, keys: np.ndarray, band: int, first: np.ndarray, second: np.ndarray,
           similarity: float, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs (of two blocks, or ``inside`` one) that may reach the similarity, differ in label
    and share no band before this one (there they share a bucket, so they are compared in it)."""
    least = (similarity - SLACK * np.sqrt(similarity * (1 - similarity) / FINE)) * FINE
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for k, i in enumerate(first):
        other = second[k + 1:] if inside else second
        other = other[(label[other] != label[i]) & (np.minimum(n[other], n[i]) >= similarity * np.maximum(n[other], n[i]))]
        other = other[~(keys[other, :band] == keys[i, :band]).any(1)]
        if len(other):
            hit = other[(f[other] == f[i]).sum(1) >= least]
            out.append((np.full(len(hit), i), hit))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _compare_blocks(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs that may reach the similarity, of members (key, size, doc, n, label, keys, f) of the same key."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    id_type = dict(members.dtypes)["doc"]
    placed = members.select("key", "doc", "n", F.xxhash64("label").alias("label"),
                            F.transform("keys", lambda k: F.shiftright(k, 32).cast("int")).alias("keys"), "f", blocks.alias("blocks"),
                            F.pmod(F.xxhash64("doc", "key"), blocks).cast("int").alias("mine"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("doc", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                         "n", "label", "keys", "f")
    met = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(table: pa.Table) -> pa.RecordBatch:
        key, i, j, mine, n, label = (table.column(c).to_numpy() for c in ("key", "i", "j", "mine", "n", "label"))
        f = np.frombuffer(b"".join(table.column("f").to_pylist()), np.uint8).reshape(len(key), FINE)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
        cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        found = [(np.zeros(0, np.int64),) * 2]
        for rows in np.split(np.arange(len(key)), cut):
            inside = i[rows[0]] == j[rows[0]]
            first = rows if inside else rows[mine[rows] == i[rows[0]]]
            second = rows if inside else rows[mine[rows] != i[rows[0]]]
            band = int(np.argmax(keys[rows[0]] == key[rows[0]] >> 32))
            found.append(_alike(n, label, f, keys, band, first, second, similarity, inside))
        doc = table.column("doc").combine_chunks()
        a, b = (pa.array(np.concatenate([x[c] for x in found]), pa.int64()) for c in (0, 1))
        return pa.RecordBatch.from_arrays([doc.take(a), doc.take(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            last = [held.column(c)[-1].as_py() for c in ("key", "i", "j")]
            same = np.logical_and.reduce([held.column(c).to_numpy() == v for c, v in zip(("key", "i", "j"), last)])
            start = int(np.argmax(same))                          # rows of the last pair of blocks wait for the rest of it
            if start:
                yield compare(held.slice(0, start))
                held = held.slice(start)
        if held is not None:
            yield compare(held)

    return met.mapInArrow(run, f"a {id_type}, b {id_type}")


def _ids_with_texts(docs: DataFrame, id_col: str, text_col: str) -> bool:
    """Does an id stand for different texts?  Texts are read only if ids are repeated."""
    ids = docs.select(F.col(id_col).alias("i")).filter(F.col("i").isNotNull())
    if ids.groupBy("i").count().filter("count > 1").isEmpty():
        return False
    h = docs.select(F.col(id_col).alias("i"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("h"))
    return not h.filter(F.col("i").isNotNull()).groupBy("i").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter(
        "lo < hi").isEmpty()


def _identity(id_col: str, text_col: str) -> Column:
    """(id, hash of the text), NULL without an id."""
    return F.when(F.col(id_col).isNotNull(), F.struct(
        F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("text")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id and class_id."""
    if not _ids_with_texts(docs, id_col, text_col):
        return _classes(docs, id_col, text_col, similarity, bands, rows)
    own = docs.select(_identity(id_col, text_col).alias("own"), F.col(text_col).alias("t"))
    found = _classes(own, "own", "t", similarity, bands, rows)
    return found.select(F.col("doc_id.id").alias("doc_id"), F.col("class_id.id").alias("class_id"))


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, bands: int, rows: int) -> DataFrame:
    sig = staged(sign(docs, id_col, text_col, bands, rows), "signatures")
    known = sig.filter(F.col("fp1").isNotNull() & F.col("doc_id").isNotNull())
    reps = staged(known.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("doc")), "representatives")
    with Scratch() as scratch:
        labels = _labels(docs, known, reps, id_col, text_col, similarity, scratch.written)
        reps = staged(reps.join(labels, "doc", "left").withColumn("label", F.coalesce("label", "doc")), "classes")
    members = sig.select("doc_id", "fp1", "fp2", "n").join(reps.drop("doc"), ["fp1", "fp2", "n"], "left")
    return members.select("doc_id", F.coalesce("label", "doc_id").alias("class_id"))


def _labels(docs: DataFrame, known: DataFrame, reps: DataFrame, id_col: str, text_col: str, similarity: float, staged) -> DataFrame:
    """(doc, label) of the representatives that are linked to others."""
    keys = known.select(F.col("doc_id").alias("doc"), "keys", F.col("n").alias("k"))
    first = reps.select("doc", "n").join(keys, "doc").filter(F.col("n") == F.col("k"))
    band = staged(first.select("doc", "n", F.explode("keys").alias("key")).distinct(), "bands")
    shared = staged(band.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "keys")
    bucket = staged(band.join(shared, "key"), "buckets")
    crowd = staged(bucket.groupBy("doc").agg(F.sum("size").alias("crowd")), "crowds")
    bucket = staged(bucket.join(crowd, "doc"), "buckets")
    lead = staged(bucket.groupBy("key").agg(F.min(F.struct((-F.col("crowd")).alias("c"), "doc", "n")).alias("f"))
                  .select("key", F.col("f.doc").alias("a"), F.col("f.n").alias("na")), "leaders")
    narrow = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("t"))
    sets = staged(shingle_sets(narrow.join(crowd.select("doc"), "doc", "left_semi"), "doc", "t")
                  .withColumnRenamed("doc_id", "doc").dropDuplicates(["doc"]), "sets")
    led = bucket.join(lead, "key").filter(F.col("doc") != F.col("a"))
    near = F.least("n", "na") >= similarity * F.greatest("n", "na")
    pairs = staged(led.filter(near).select("a", F.col("doc").alias("b")).distinct(), "pairs")
    links = staged(_links(pairs, sets, similarity), "links")
    labels = components(links, staged)

    # what is left: members of a bucket, its leader apart, of different classes
    rest = staged(led.select("key", "doc", "n").join(labels, "doc", "left").select(
        "key", "doc", "n", F.coalesce("label", "doc").alias("label")), "rest")
    open_ = staged(rest.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
                   .filter("low < high").select("key", "size"), "open")
    if open_.isEmpty():
        return labels
    members = staged(rest.join(open_, "key"), "members")
    unsettled = staged(members.select("doc").distinct(), "unsettled")
    fine = staged(fine_signatures(sets.join(unsettled, "doc", "left_semi"))
                  .join(first.select("doc", "keys").dropDuplicates(["doc"]), "doc"), "fine")
    maybe = _compare_blocks(members.join(fine, "doc"), similarity)
    maybe = staged(maybe.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    more = staged(_links(maybe, sets, similarity), "links")
    return labels if more.isEmpty() else components(links.unionByName(more), staged)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
             ) -> DataFrame:
    """The rows of ``docs`` whose id is their class's smallest, once each; columns unchanged.
    Rows without an id are kept.  If an id stands for different texts, a row is one of
    (id, text), so only rows with equal or similar texts go."""
    if _ids_with_texts(docs, id_col, text_col):
        name = fresh(docs, "own")
        own = docs.withColumn(name, _identity(id_col, text_col))
        return _keep_one(own, name, text_col, similarity).select(*docs.columns)
    return _keep_one(docs, id_col, text_col, similarity)


def _keep_one(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    found = staged(_classes(docs, id_col, text_col, similarity, BANDS, ROWS), "classes")
    dropped = found.filter(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias(id_col))
    # texts stay where they are, but for ids that go, or come more than once, and the few that share a bit with these
    touched = staged(dropped.unionByName(found.groupBy(F.col("doc_id").alias(id_col)).agg(F.count(F.lit(1)).alias("n"))
                                         .filter("n > 1").select(id_col)), "touched")
    hit = fresh(docs, "touched")
    marked = _mark(docs.filter(F.col(id_col).isNotNull()), id_col, touched, hit)
    exact = marked.filter(F.col(hit)).join(dropped, id_col, "left_anti").dropDuplicates([id_col])
    kept = marked.filter(~F.col(hit)).unionByName(exact.select(*marked.columns))
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull())).select(*docs.columns)


def _mark(docs: DataFrame, id_col: str, touched: DataFrame, name: str) -> DataFrame:
    """``docs`` with a boolean ``name``: true for every id in ``touched``, and for few others.

    Each touched id sets one of at least ``SPARSE`` times as many bits; the bitmap, ``MOST_BITS`` at most, is broadcast."""
    bits = min(MOST_BITS, 1 << max(15, (SPARSE * touched.count()).bit_length()))
    bit = F.pmod(F.xxhash64(id_col), F.lit(bits))
    number, place = fresh(docs, "bitmap_number"), fresh(docs, "bitmap")
    maps = touched.select(F.bitmap_bucket_number(bit).alias(number), F.bitmap_bit_position(bit).alias("at")).groupBy(number).agg(
        F.bitmap_construct_agg("at").alias(place))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col(place), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mine = docs.withColumn(number, F.bitmap_bucket_number(bit)).join(F.broadcast(maps), number, "left")
    return mine.select(*docs.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(name))
