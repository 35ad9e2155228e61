"""Brute-force versions and fixtures for the operators' tests."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    """A documents table from texts (ids from 0), with a clashing extra column."""
    rows = [(i, t, "en", "s", len(t) if t is not None else None, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA + ", n_words string")


EDGE_TEXTS = [None, "", " ", "\n\t ", "one", "one two three four", "é漢🙂 ß", "same text here again " * 20,
              "same text here again " * 20, "x" * 70_000, "word " * 30_000, "a  b\r\n　c  d"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = (text or "").lower()
    w = [x for x in re.split(r"[ \x09-\x0D]+", w) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_classes(texts, similarity=0.8):
    """{id: smallest id of its class} by comparing all pairs; texts: {id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
