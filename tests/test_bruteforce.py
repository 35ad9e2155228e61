"""Graph operators against plain-Python brute force on random small graphs."""

import random
from collections import defaultdict

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txlens.operators.graph import community, motif

EDGE_SCHEMA = "src string, dst string, TRANSACTION_ID long, TX_AMOUNT double, TX_FRAUD int, TX_TIME_SECONDS long"

edge_lists = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 4), st.integers(0, 1), st.integers(0, 6)),
    min_size=1, max_size=25)


def _frames(spark, raw):
    rows = [(f"C_{c}", f"T_{t}", i, 1.0, f, s) for i, (c, t, f, s) in enumerate(raw)]
    e = spark.createDataFrame(rows, EDGE_SCHEMA)
    ids = sorted({r[0] for r in rows} | {r[1] for r in rows})
    v = spark.createDataFrame([(i, "Customer" if i.startswith("C_") else "Terminal") for i in ids], "id string, type string")
    return rows, v, e


def _chains_brute(rows):
    out = set()
    for a, t1, _, _, f1, s1 in rows:
        if f1 != 1:
            continue
        for b, t1b, _, _, f2, s2 in rows:
            if t1b != t1 or b == a or f2 != 0 or not s2 > s1:
                continue
            for b3, t2, _, _, f3, s3 in rows:
                if b3 == b and t2 != t1 and f3 == 0 and s3 > s2:
                    out.add((a, t1, b, t2))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw=edge_lists)
def test_infection_chains_match_brute_force(spark, raw):
    rows, v, e = _frames(spark, raw)
    got = sorted(tuple(r) for r in motif.infection_chains(e).collect())
    assert got == _chains_brute(rows)


def _lpa_brute(ids, rows, steps):
    w = defaultdict(int)
    for s, d, *_ in rows:
        w[(s, d)] += 1
    nbrs = defaultdict(list)
    for (s, d), k in w.items():
        nbrs[s].append((d, k))
        nbrs[d].append((s, k))
    lab = {i: i for i in ids}
    for _ in range(steps):
        new = {}
        for i in ids:
            score = defaultdict(int)
            for j, k in nbrs[i]:
                score[lab[j]] += k
            new[i] = min(score, key=lambda l: (-score[l], l)) if score else lab[i]
        lab = new
    return lab


def _components_brute(ids, rows):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s, d, *_ in rows:
        a, b = find(s), find(d)
        if a != b:
            parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in ids:
        groups[find(i)].append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_lpa_components_pagerank_match_brute_force(spark):
    rnd = random.Random(11)
    raw = [(rnd.randrange(12), rnd.randrange(9), 0, rnd.randrange(50)) for _ in range(40)]
    rows, v, e = _frames(spark, raw)
    ids = [r["id"] for r in v.collect()]
    for steps in (1, 2, 3):
        got = {r["id"]: r["label"] for r in community.label_propagation(v, e, steps).collect()}
        assert got == _lpa_brute(ids, rows, steps)
    # hot vertices salted across buckets (tiny threshold) give the same labels
    salted = {r["id"]: r["label"] for r in community.label_propagation(v, e, 3, hot_rows=2).collect()}
    assert salted == _lpa_brute(ids, rows, 3)
    comp = {r["id"]: r["component"] for r in community.connected_components(v, e).collect()}
    assert comp == _components_brute(ids, rows)
    comp_salted = {r["id"]: r["component"] for r in community.connected_components(v, e, hot_rows=2).collect()}
    assert comp_salted == comp
    # PageRank: power iteration with numpy on the same multigraph
    idx = {i: k for k, i in enumerate(ids)}
    n = len(ids)
    out_deg = defaultdict(int)
    for s, *_ in rows:
        out_deg[s] += 1
    pr = np.ones(n)
    for _ in range(10):
        contrib = np.zeros(n)
        for s, d, *_ in rows:
            contrib[idx[d]] += pr[idx[s]] / out_deg[s]
        pr = 0.15 + 0.85 * contrib
    pr = pr * n / pr.sum()
    got = {r["id"]: r["pagerank"] for r in community.pagerank(v, e, 0.15, 10).collect()}
    assert np.allclose([got[i] for i in ids], pr)
    got = {r["id"]: r["pagerank"] for r in community.pagerank(v, e, 0.15, 10, hot_rows=2).collect()}
    assert np.allclose([got[i] for i in ids], pr)


def test_motif_matcher_naive_equals_rewrite_on_random_graph(spark):
    rnd = random.Random(5)
    raw = [(rnd.randrange(8), rnd.randrange(6), int(rnd.random() < 0.2), rnd.randrange(30)) for _ in range(60)]
    rows, v, e = _frames(spark, raw)
    fast = motif.infection_chains(e)
    naive = motif.infection_chains_naive(v, e)
    assert fast.exceptAll(naive).count() == 0 and naive.exceptAll(fast).count() == 0
    assert fast.count() == len(_chains_brute(rows))
    assert fast.select(F.countDistinct(*fast.columns)).first()[0] == fast.count()
