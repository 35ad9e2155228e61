"""Personal data, quality rules, revisits and the pipeline against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from helpers import EDGE_TEXTS, SF, documents, near_classes, words
from pyspark.sql import functions as F

from txlens.llm import oracle, pii, quality_qda, quality_rules, warc_revisit

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pat in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pat.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == "ip" and any(int(x) > 255 for x in m[0].split(".")))
                    or (kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)))
                    or (kind == "phone" and not 9 <= len(digits) <= 15)):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII_TEXTS = EDGE_TEXTS + [
    "mail me: a.b+c@d-e.co.uk, 🙂x@y.z_w@q.r.s a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 10.0.0.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 378282246310005", "tel +49 (30) 1234-5678. +1 2 +1234567890123456",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, GB82WEST12345698765433",
    "social security 123-45-6789; nothing 987-65-4321" + " pad" * 30 + " 111-22-3333", "x@" * 3000 + "y.z",
    "1.2.3.4 " * 700, "7" * 20_000, "a" * 30_000 + "@" + "b.c" * 1000, "+1" + " " * 3000, "@." * 500,
    "é" * 300 + " +44 20 7946 0958 漢 4111111111111111",
]


def test_spans_equal_brute_force(spark):
    random.seed(9)
    parts = ["@", ".", "-", " ", "+", "1", "22", "255", "256", "a", "b_", "4111111111111111", "é", "🙂", "(", ")", "x@y.zz"]
    texts = PII_TEXTS + ["".join(random.choice(parts) for _ in range(random.randint(1, 40))) for _ in range(300)]
    rows = {r["doc_id"]: r for r in pii.find(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        assert rows[i]["base"] == ",".join(want), t
        assert rows[i]["spans"].startswith(rows[i]["base"])
        for k in pii.BASE_KINDS:
            assert rows[i][f"n_{k}"] == sum(s.startswith(k + ":") for s in want)
    first = len(EDGE_TEXTS)
    assert (rows[first + 4]["n_iban"], rows[first + 5]["n_ssn"]) == (2, 2)
    assert [s["score"] for s in rows[first + 2]["found"]["card"]] == [100, 80]
    assert pii.find(documents(spark, []).limit(0)).count() == 0


# 15 to 29 characters, among them multiples of four, as printed and in one piece
IBANS = ["NO93 8601 1117 947", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00",
         "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "HU42 1177 3016 1111 1018 0000 0000",
         "PL61 1090 1014 0000 0712 1981 2874", "BR18 0036 0305 0000 1000 9795 493C 1"]


def test_ibans_end_at_their_own_length(spark):
    texts, want = [], []
    for x in IBANS + [x.replace(" ", "") for x in IBANS]:
        for before, after in (("pay ", " Please"), ("", " BIC"), ("é🙂:", " 12 AB34 CDEF"), ("IBAN", ""), ("AT99 ", "."),
                              (x + " ", " " + x)):
            t = before + x + after
            texts.append(t)
            want.append([(m.start(), m.start() + len(x)) for m in re.finditer(re.escape(x), t)])
    other = "ZZ65 1234 5678 9012"                  # no country with a known length: the longest end that holds
    texts += [other + " And", "X" + IBANS[1], IBANS[1] + "5", IBANS[1][:-1] + "5", "DE89 3704 0044 0532 0130"]
    want += [[(0, len(other))], [], [], [], []]
    rows = {r["doc_id"]: r["found"]["iban"] for r in pii.find(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [(s["start"], s["end"]) for s in rows[i]] == want[i], t
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(documents(spark, texts)).collect()}
    assert redacted[0] == "pay [iban] Please" and redacted[1] == "[iban] BIC"


def test_span_sql_agrees_on_ibans_and_odd_texts(spark):
    import duckdb
    import pandas as pd

    random.seed(12)
    parts = [*IBANS, *[x.replace(" ", "") for x in IBANS], "ZZ65 1234 5678 9012", "IBAN", "BIC", " ", " ", "A", "7", "é", "🙂",
             ".", "\n", "AT99", "bank "]
    texts = PII_TEXTS[:-7] + ["".join(random.choice(parts) for _ in range(random.randint(1, 6))) for _ in range(600)]
    documents_table = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents_table)
    want = dict(con.sql(f"SELECT doc_id, spans FROM ({oracle.ORACLES['op7_pii_spans']})").fetchall())
    got = {r["doc_id"]: r["spans"] for r in pii.find(documents(spark, texts)).collect()}
    assert [t for i, t in enumerate(texts) if got[i] != want[i]] == []
    assert sum("iban" in x for x in got.values()) > 100


def test_thousands_of_spans_in_one_text(spark):
    """Context and what is kept between spans come from the parts around them: 16 times the spans must
    not take 256 times as long."""
    import time

    def text(n):
        return "🙂 ".join(f"mail u{i}@ex{i % 7}.org or call +49 30 {1234567 + i} é" for i in range(n))

    def seconds(n):
        docs, t0 = documents(spark, [text(n)]), time.time()
        row = pii.find(docs).collect()[0]
        redacted = pii.redact(docs).collect()[0]["text"]
        took = time.time() - t0
        want = base_spans(text(n))
        assert row["base"] == ",".join(want) and len(want) == 2 * n
        assert {s["score"] for s in row["found"]["email"]} == {90} and {s["score"] for s in row["found"]["phone"]} == {70}
        assert redacted == "🙂 ".join(["mail [email] or call [phone] é"] * n)
        return took

    seconds(10)                                    # plans compiled
    few = seconds(500)
    assert seconds(8000) < 10 + 40 * few


def test_context_at_the_borders_of_parts(spark):
    """A span and its context word at every distance around the border between two parts."""
    texts = ["é" * pad + " visa" + " " * gap + "4111111111111111" + " " * 5 + tail
             for pad in range(195, 260, 3) for gap, tail in ((1, ""), (39, "x"), (41, "card"), (60, "." * 300))]
    for i, r in enumerate(pii.find(documents(spark, texts)).orderBy("doc_id").collect()):
        at = texts[i].index("4111")
        near = texts[i][max(at - 40, 0):at] + " " + texts[i][at + 16:at + 56]
        assert [s["score"] for s in r["found"]["card"]] == [80 + 20 * ("visa" in near or "card" in near)], texts[i]


def test_redaction_covers_every_span(spark):
    docs = documents(spark, PII_TEXTS)
    found = {r["doc_id"]: r["found"] for r in pii.find(docs).collect()}
    redacted = pii.redact(docs)
    assert redacted.columns == docs.columns
    for r in redacted.collect():
        text = PII_TEXTS[r["doc_id"]]
        if text is None:
            assert r["text"] is None and r["n_chars"] is None
            continue
        spans = sorted((s["start"], -s["end"], s["kind"]) for k in pii.KINDS for s in found[r["doc_id"]][k])
        out, at = "", 0
        for start, end, kind in spans:
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, -end)
        assert r["text"] == out + text[at:]
        assert r["n_chars"] == len(r["text"])


def rule_counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated)}


def test_rules_equal_brute_force(spark):
    random.seed(5)
    texts = EDGE_TEXTS + ["a a a", "a b c a b c", "a\nb\n\na\n \nb\n", "  the  The\x0bof\x0c#$%\x1c", "... \nx..."] + [
        "".join(random.choice(["a", "b", "the", " ", " ", "\n", "#", "é"]) for _ in range(random.randint(0, 300)))
        for _ in range(200)]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs).collect()}
    for i, t in enumerate(texts):
        want = rule_counts(t)
        assert {k: rows[i][k] for k in want} == want, t
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert rows[i]["base_failed"] == failed
        ok = all((low is None or 100 * rows[i][n] >= low * rows[i][d]) and (high is None or 100 * rows[i][n] <= high * rows[i][d])
                 for _, n, d, low, high in quality_rules.RULES)
        assert rows[i]["kept"] == (not failed and ok)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {i for i, r in rows.items() if r["kept"]}
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def test_rules_run_no_python(spark):
    from txlens.llm import queries
    for name in ("op7_pii_spans", "op8_quality_rules"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


CAPTURES = "record_id long, kind string, url string, time long, headers map<string,string>, digest string, target string"


def brute_revisits(rows):
    out = {}
    for r in rows:
        if r[1] != "revisit":
            continue
        target = canonical(r[2])
        known = [x for x in rows if x[1] == "response" and None not in (r[0], r[2], r[3], x[0], x[2], x[3])
                 and canonical(x[2]) == target and (x[3], x[0]) < (r[3], r[0])]
        if not known:
            out[r[0]] = ("no_response", None, None, None)
            continue
        x = max(known, key=lambda x: (x[3], x[0]))
        old, now = x[4] or {}, r[4] or {}
        status = "unverified"
        for k in ("etag", "last-modified"):
            if k in old and k in now:
                status = "resolved" if re.sub("^W/", "", old[k]) == re.sub("^W/", "", now[k]) else "validator_mismatch"
                break
        if status == "validator_mismatch":
            out[r[0]] = (status, None, None, None)
        else:
            merged = old | {k: v for k, v in now.items() if k not in warc_revisit.KEPT_HEADERS}
            out[r[0]] = (status, x[0], x[5], merged)
    return out


def canonical(url):
    if url is None:
        return None
    u = re.sub("#.*$", "", url.strip(" "))
    u = re.sub("^[A-Za-z][A-Za-z0-9+.-]*://", "", u)
    host = re.match("[^/?]*", u)[0]
    path, _, query = u[len(host):].partition("?")
    host = re.sub(":(80|443)$", "", re.sub(r"^www\.", "", host.lower()))
    kept = sorted(p for p in query.split("&") if p and not re.match(f"^{warc_revisit.TRACKING}(=|$)", p))
    return host + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def test_revisits_equal_brute_force(spark):
    rnd = random.Random(3)
    urls = ["http://A.com/x", "https://www.a.com/x/", "a.com:80/x#f", "http://a.com/x?utm_source=q", "http://b.org/?b=2&a=1",
            "http://b.org?a=1&b=2&ref=z", "http://c.net/", None, ""]
    rows = []
    for i in range(600):
        url = urls[0] if i % 3 else rnd.choice(urls)                          # one URL with most captures
        headers = rnd.choice([None, {}, {"etag": '"1"'}, {"etag": 'W/"1"', "date": "d", "content-length": "0"},
                              {"etag": '"2"', "content-type": "t"}, {"last-modified": "m"}, {"last-modified": "n"}])
        rows.append((i if i % 50 else None, rnd.choice(["response", "revisit", "revisit"]), url,
                     rnd.randrange(60) if i % 40 else None, headers, f"d{i}", "clash"))
    df = spark.createDataFrame(rows, CAPTURES)
    got = [r for r in warc_revisit.resolve(df, partitions=7).collect()]
    want = brute_revisits(rows)
    assert len(got) == sum(r[1] == "revisit" for r in rows)
    for r in got:
        if r["record_id"] is not None:
            assert (r["status"], r["refers_to"], r["digest"], r["headers"]) == want[r["record_id"]]
        else:
            assert r["status"] == "no_response"
    assert warc_revisit.resolve(df.limit(0)).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates",
                                                      "personal_data", "best_fit_packing"]
    one = stage["quality_classifier"](spark, docs, SF).cache()
    model = quality_qda.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r[0] for r in one.select("doc_id").collect()} == {
        r[0] for r in quality_qda.score(docs, model).filter("score >= 0.3").select("doc_id").collect()}
    two = stage["quality_rules"](spark, one, SF).cache()
    texts = {r["doc_id"]: r["text"] for r in two.collect()}
    assert all(rule_counts(t)["n_words"] >= 50 for t in texts.values())
    three = stage["near_duplicates"](spark, two, SF).cache()
    assert {r["doc_id"] for r in three.collect()} == set(near_classes(texts).values())
    four = stage["personal_data"](spark, three, SF).cache()
    assert four.columns == docs.columns and four.count() == three.count()
    assert not any(base_spans(r["text"]) for r in four.filter(~F.col("text").contains("]")).collect())
    rows = stage["best_fit_packing"](spark, four, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in four.collect()}
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, rows))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = documents(spark, EDGE_TEXTS).withColumn("doc_id", F.col("doc_id") + 10_000)
    for table, n in ((docs.limit(0), 0), (odd, len(EDGE_TEXTS))):
        out = table
        for name, f in corpus_pipeline.STAGES[:-1]:
            out = f(spark, out, SF)
            assert out.columns == table.columns
        assert out.count() <= n
