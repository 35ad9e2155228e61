"""Near-duplicate classes in crowded buckets, against all pairs."""

import random

import numpy as np
from helpers import documents, near_classes, shingles
from pyspark.sql import functions as F

from txlens.llm import dartminhash
from txlens.session import Scratch


def _edited(rnd, w, k):
    w = list(w)
    for _ in range(k):
        w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**9)}"
    return w


def test_crowded_buckets_are_compared_whole_in_blocks(spark, monkeypatch):
    """Copies too far from their original form twins of their own: found although neither leads a bucket."""
    monkeypatch.setattr(dartminhash, "BLOCK", 8)
    rnd = random.Random(11)
    hub = [f"w{i}" for i in range(160)]
    texts = [" ".join(hub)]
    for _ in range(40):
        far = _edited(rnd, hub, 9)
        texts += [" ".join(far), " ".join(_edited(rnd, far, 2))]
    texts += [" ".join(_edited(rnd, hub, 1)) for _ in range(20)]
    texts = texts[1:] + texts[:1]
    want = near_classes(dict(enumerate(texts)))
    assert 30 < len(set(want.values())) < 60
    asked = []
    compare = dartminhash._compare_blocks

    def watched(members, similarity):
        out = compare(members, similarity)
        asked.append((members.count(), out.distinct().count()))
        return out

    monkeypatch.setattr(dartminhash, "_compare_blocks", watched)
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.classes(documents(spark, texts)).collect()}
    assert got == want
    members, pairs = asked[0]
    assert members > 200 and pairs < 150                     # unlike members of a bucket are no pairs


def test_fine_signatures_agree_as_often_as_sets(spark):
    rnd = random.Random(3)
    a = [f"w{i}" for i in range(300)]
    texts = [" ".join(a), " ".join(_edited(rnd, a, 8)), " ".join(_edited(rnd, a, 40)), "one two"]
    sets = dartminhash.shingle_sets(documents(spark, texts)).withColumnRenamed("doc_id", "doc")
    f = {r["doc"]: np.frombuffer(bytes(r["f"]), np.uint8) for r in dartminhash.fine_signatures(sets).collect()}
    for i in (1, 2):
        x, y = shingles(texts[0]), shingles(texts[i])
        assert abs((f[0] == f[i]).mean() - len(x & y) / len(x | y)) < 0.08
    assert len(f) == 4 and all(len(v) == dartminhash.FINE for v in f.values())


def test_scratch_tables_go(spark):
    with Scratch() as scratch:
        df = scratch.written(spark.range(5), "t")
        path = scratch.paths[0][1]
        assert df.agg(F.sum("id")).first()[0] == 10 and spark.read.parquet(path).count() == 5
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def test_texts_of_documents_that_stay_are_not_shuffled(spark, monkeypatch):
    """Only documents that go, or come more than once, meet others again; small bitmaps only let more rows meet."""
    rnd = random.Random(7)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(30)) for _ in range(300)]
    texts += [" ".join(_edited(rnd, (texts[i] + " " + texts[i]).split(), 0)) for i in range(20)] + texts[5:25] + ["", None, ""]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id % 50 = 0")).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    label = near_classes(dict(enumerate(texts)))
    want = sorted(i for i in label if label[i] == i)
    mark, asked = dartminhash._mark, []

    def watched(docs, id_col, touched, name):
        out = mark(docs, id_col, touched, name)
        ids = {r[0] for r in touched.collect()}
        rows = [(r[id_col], r[name]) for r in out.collect()]
        assert all(hit for i, hit in rows if i in ids)
        asked.append((len(ids), sum(hit for _, hit in rows), len(rows)))
        return out

    monkeypatch.setattr(dartminhash, "_mark", watched)
    for most in (1 << 25, 64):
        monkeypatch.setattr(dartminhash, "MOST_BITS", most)
        rows = dartminhash.keep_one(docs).collect()
        assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == want
        assert sum(r["doc_id"] is None for r in rows) == 3
        assert all(r["text"] == texts[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    (touched, hit, rows), (_, more, _) = asked
    assert 20 <= touched <= hit < 60 and rows == len(texts) + 7 and hit < more < rows


def test_documents_signed_together_are_bounded():
    """Short documents throw as many darts as long ones: their number is bounded, not only their words."""
    offsets = np.arange(0, 5 * 3001, 5)
    parts = list(dartminhash._parts(offsets, dartminhash.SIGN_DOCUMENTS))
    assert max(b - a for a, b in parts) <= dartminhash.SIGN_DOCUMENTS
    assert [a for a, _ in parts] + [3000] == [0] + [b for _, b in parts]
