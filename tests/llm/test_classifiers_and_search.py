"""Held-out accuracy of the classifiers; exact search and near-duplicates against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
from helpers import EDGE_TEXTS, documents, near_classes
from pyspark.sql import functions as F

from txlens.llm import dartminhash, quality_qda, topk_pivots, toxicity

COMMON = ["river", "stone", "green", "walk", "morning", "paper", "little", "under", "the", "and", "of", "house", "window"]
BAD = ["idiot", "pathetic", "worthless", "scum"]


def corpus(seed=1, n=400):
    rnd = random.Random(seed)
    texts, toxic, good = [], [], []
    for i in range(n):
        w = [rnd.choice(COMMON) + rnd.choice(["", "s", "ing", "ed", "ly"]) for _ in range(rnd.randint(40, 200))]
        t, q = i % 4 == 0, i % 5 != 0
        if t:
            for _ in range(6):
                w.insert(rnd.randrange(len(w)), rnd.choice(BAD))
        texts.append(" ".join(w) if q else " ".join(x + rnd.choice(["###", "$$$", "***"]) for x in w))
        toxic.append(int(t))
        good.append(int(q))
    return texts, toxic, good


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def accuracy(scores, truth):
    rows = [r for r in scores.collect() if held_out(r["doc_id"]) and r["doc_id"] < len(truth)]
    assert all(0 <= r["score"] <= 1 for r in scores.collect())
    return sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows)


def test_toxicity_held_out_and_edges(spark):
    texts, toxic, _ = corpus()
    docs = documents(spark, texts + EDGE_TEXTS)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert accuracy(toxicity.score(docs, model), toxic) > 0.9
    assert toxicity.score(docs, model).count() == docs.count()
    flat = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert toxicity.score(docs, flat).select("score").distinct().collect()[0][0] == 0.0
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0


def plain_toxicity(model, text):
    """The score by plain loops: every window compressed on its own, once per dictionary."""
    import zstandard as zs
    shown = " ".join(w[:3].upper() + w[3:] for w in re.findall(r"\w+", (text or "").lower())).encode()
    starts = [0]
    while starts[-1] + 256 < len(shown):
        starts.append(starts[-1] + 232)
    reach = max(17, (len(model.ordinary) + len(model.toxic) + 256).bit_length())
    params = zs.ZstdCompressionParameters(
        compression_level=9, min_match=5, strategy=1, window_log=reach, hash_log=17, chain_log=17, search_log=6,
        target_length=1, write_content_size=False, write_dict_id=False)

    def size(window, content):
        told = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        told.precompute_compress(compression_params=params)
        return len(zs.ZstdCompressor(dict_data=told, compression_params=params).compress(window))

    saved = [size(shown[a:a + 256], model.ordinary + b"\0" * len(model.toxic))
             - size(shown[a:a + 256], model.ordinary + model.toxic) for a in starts]
    n, best = len(saved), sorted(saved, reverse=True)
    told = [best[0], sum(best[:3]) / 3, sum(saved) / n, *[sum(g >= at for g in saved) / n for at in (2, 3, 4)]]
    z = model.weights[0] + sum(w * (x - c) / s for w, x, c, s in zip(model.weights[1:], told, model.centre, model.scale))
    return 1 / (1 + math.exp(-z)), best[0]


def test_toxicity_equals_a_plain_scorer(spark):
    texts, toxic, _ = corpus()
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, texts), labels)
    tried = texts[:40] + [t for t in EDGE_TEXTS if len(t or "") < 20_000] + ["ßIDIOT scum! " * 90, "1_x é漢 ﬁ idiot"]
    got = {r["doc_id"]: r for r in toxicity.score(documents(spark, tried), model).collect()}
    for i, t in enumerate(tried):
        p, far = plain_toxicity(model, t)
        assert abs(got[i]["score"] - p) < 1e-9 and got[i]["distance"] == far, t
        assert got[i]["predicted"] == int(p >= 0.5)


def test_toxicity_fits_on_long_texts_too(spark, monkeypatch):
    texts, toxic, _ = corpus()
    texts = [(t + " ") * (60 if i % 9 == 0 else 1) for i, t in enumerate(texts)]
    assert max(map(len, texts)) > 40_000
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda bad, good, share: seen.extend([*bad, *good]))
    toxicity.fit(docs, labels)
    assert sorted(seen) == sorted(t for i, t in enumerate(texts) if not held_out(i))
    seen.clear()
    toxicity.fit(docs, labels, sample_chars=200_000)
    assert 100_000 < sum(map(len, seen)) <= 400_000 and max(map(len, seen)) > 20_000


def test_toxicity_statistics_do_not_grow_with_length():
    distance = toxicity.Distance(b" RIVer WALk STOne " * 20, b" IDIot  SCUm   ")
    short = distance.statistics("river walk stone idiot " * 1_000)
    long = distance.statistics("river walk stone idiot " * 10_000)
    assert np.allclose(short, long, atol=0.5)


def test_toxicity_knows_a_wide_vocabulary():
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    bad, common = [word(7) for _ in range(300)], [word(rnd.randint(3, 8)) for _ in range(400)]
    plain = lambda: [rnd.choice(common) for _ in range(60)]
    toxic = []
    for i in range(900):                  # every bad word in about 12 of the 600 dictionary texts
        w = plain()
        for k in range(6):
            w.insert(rnd.randrange(len(w)), bad[(6 * i + k * 7) % len(bad)])
        toxic.append(" ".join(w))
    model = toxicity.train(toxic, [" ".join(plain()) for _ in range(2400)], 0.3)
    assert all(f" {toxicity.normal(b)} ".encode() in model.toxic for b in bad)
    distance = toxicity.Distance(model.ordinary, model.toxic)
    saved = []
    for b in bad:
        w = plain()
        w[30] = b
        saved.append(distance.statistics(" ".join(w))[0])
    assert np.mean(saved) >= 3 and np.mean(np.array(saved) >= 2) > 0.9
    assert np.mean([distance.statistics(" ".join(plain()))[0] for _ in range(100)]) < 2


def test_held_out_labels_teach_nothing(spark):
    texts, toxic, good = corpus()
    docs = documents(spark, texts)
    right = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(zip(good, toxic))],
                                  "doc_id long, quality int, toxic int")
    wrong = right.withColumn("quality", F.when(quality_qda.held_out(F.col("doc_id")), 1 - F.col("quality"))
                             .otherwise(F.col("quality"))).withColumn(
        "toxic", F.when(quality_qda.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, right) == toxicity.fit(docs, wrong)
    a, b = quality_qda.fit(docs, right), quality_qda.fit(docs, wrong)
    assert np.allclose(a.means, b.means) and np.allclose(a.line, b.line)


def test_quality_held_out_and_edges(spark):
    texts, _, good = corpus()
    docs = documents(spark, texts + EDGE_TEXTS)
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int")
    model = quality_qda.fit(docs, labels)
    assert accuracy(quality_qda.score(docs, model), good) > 0.97
    kept = quality_qda.keep(docs, model)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in quality_qda.score(docs, model).filter("predicted = 1").collect()}
    none = quality_qda.fit(docs.limit(0), labels.limit(0))
    assert quality_qda.score(docs.limit(0), none).count() == 0
    assert {r["score"] for r in quality_qda.score(docs, none).collect()} == {1.0}


def test_quality_density_is_gaussian(spark):
    texts, _, good = corpus(n=120)
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int")
    m = quality_qda.fit(docs, labels)
    x = np.array([r["x"] for r in quality_qda.statistics(docs, "x", "text").select("x").collect()])
    z = (x - m.centre) / m.scale
    logs = []
    for mean, factor, logdet in zip(m.means, m.factors, m.logdets):
        cov = np.linalg.inv(factor) @ np.linalg.inv(factor).T
        assert np.isclose(np.linalg.slogdet(cov)[1], logdet)
        d = z - mean
        logs.append(-0.5 * (np.einsum("ij,ij->i", d @ np.linalg.inv(cov), d) + logdet))
    r = logs[1] - logs[0]
    assert np.allclose(m.log_ratio(x), np.sign(r) * np.log1p(np.abs(r)))


def brute_top(rows, k, every):
    v = {i: np.floor(256 * np.array(x, dtype=np.float64)) for i, x in rows
         if x is not None and all(c is not None and np.isfinite(c) for c in x)}
    out = set()
    for q in v:
        if q % every == 0:
            best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:k]
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    return out


def test_top_k_equals_brute_force(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * rnd.normal(size=12)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]                      # one very common vector
    rows += [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11),
             (2004, [0.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = topk_pivots.top_k(df, F.col("id") % 10 == 0, pivots=5, annuli=6)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 5, 10)


def test_top_k_is_exact_for_large_values(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(120)]
    rows += [(200 + i, (rnd.normal(size=8) * 2.0 ** rnd.integers(18, 40)).tolist()) for i in range(60)]
    rows += [(300 + i, (rnd.normal(size=8) * 1e30).tolist()) for i in range(30)]
    rows += [(400, rows[125][1]), (405, rows[125][1]), (410, [1e300] * 8), (420, [-1e300] + [0.0] * 7), (430, [1e308] * 8),
             (440, [2.0 ** 45 + 1 / 256] * 8), (441, [2.0 ** 45] * 8), (500, [1e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = {i: [math.floor(256 * c) for c in x] + [0] * (8 - len(x)) for i, x in rows if i != 430}     # 256 * 1e308 is no double

    def best(q):
        scores = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:5]
        return {(q, r + 1, c, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, c) in enumerate(scores)}

    want = set().union(*(best(q) for q in v if q % 10 == 0))
    assert {tuple(r) for r in topk_pivots.top_k(df, F.col("id") % 10 == 0, pivots=4, annuli=4).collect()} == want
    only = df.filter("vec_id >= 300")                                          # nothing for the index
    ids = [q for q in v if q >= 300]
    v = {q: v[q] for q in ids}
    want = set().union(*(best(q) for q in v if q % 10 == 0))
    assert {tuple(r) for r in topk_pivots.top_k(only, F.col("id") % 10 == 0).collect()} == want


def test_top_k_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in topk_pivots.top_k(df, F.col("id") % 10 == 0).collect()} == brute_top(
        [(0, [1.0, 2.0]), (1, [0.5, 0.25])], 5, 10)
    assert topk_pivots.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(7)
    texts = list(EDGE_TEXTS)
    for _ in range(12):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(60, 200))]
        texts += [" ".join(base)] * 3 + [edited(rnd, base, k) for k in (1, 2, 3, 4, 6, 10)]
    hub = [f"h{rnd.randrange(3000)}" for _ in range(300)]
    texts += [edited(rnd, hub, 6) for _ in range(60)] + [" ".join(hub)]       # copies alike only through the base
    docs = documents(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in dartminhash.classes(docs).collect()}
    assert got == near_classes(dict(enumerate(texts)))
    kept = dartminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(set(got.values()))
    assert dartminhash.classes(docs.limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    rnd = np.random.default_rng(2)
    shared, a, b = (rnd.integers(1, 2**62, n).astype(np.uint64) for n in (300, 60, 40))
    element = np.concatenate([shared, a, shared, b])
    doc = np.repeat([0, 1], [360, 340])
    weight = np.concatenate([rnd.choice([0.5, 1.0, 3.5, 8.0], 360), rnd.choice([0.5, 1.0, 3.5, 8.0], 340)])
    x, y = (dict(zip(element[doc == d].tolist(), weight[doc == d])) for d in (0, 1))
    keys = set(x) | set(y)
    want = sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)
    sig = dartminhash.signatures(doc, element, weight, 2, 4000)
    assert (sig != 0).all() and abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_an_id_with_different_texts_is_several_documents(spark):
    rnd = random.Random(8)
    text = lambda: " ".join(rnd.choice(COMMON) + str(rnd.randrange(50)) for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    rows = [(3, a), (5, a), (5, b), (5, b), (7, c), (7, c + " end"), (9, b), (9, d), (8, None), (8, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    kept = sorted(((r["doc_id"], r["text"]) for r in dartminhash.keep_one(docs).collect()), key=str)
    sevens = [t for i, t in kept if i == 7]
    assert len(sevens) == 1 and sevens[0] in (c, c + " end")
    assert sorted((x for x in kept if x[0] != 7), key=str) == sorted(
        [(3, a), (5, b), (8, None), (8, ""), (9, d), (None, a)], key=str)
    found = sorted(((r["doc_id"], r["class_id"]) for r in dartminhash.classes(docs).collect()), key=str)
    assert found == sorted([(3, 3), (5, 3), (5, 5), (5, 5), (7, 7), (7, 7), (8, 8), (8, 8), (9, 5), (9, 9), (None, 3)],
                           key=str)
    assert dartminhash.classes(docs).columns == ["doc_id", "class_id"]
