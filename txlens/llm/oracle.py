"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from txlens.llm import pii, quality_rules, warc_revisit


def _rules_sql() -> str:
    parts = []
    for _, num, den, low, high in quality_rules.RULES:
        if low is not None:
            parts.append(f"100 * {num} >= {low} * {den}")
        if high is not None:
            parts.append(f"100 * {num} <= {high} * {den}")
    return " AND ".join(parts)


_STOP = ", ".join(f"'{v}'" for w in quality_rules.STOP_WORDS for v in (w, w.capitalize()))

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
k AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM k),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY rid),
c AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(ls)::BIGINT AS n_lines,
        len(list_filter(ws, lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
        len(list_filter(ls, lambda x: suffix(x, '...')))::BIGINT AS n_ellipsis_lines
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, (n_words < {quality_rules.MIN_WORDS}
        OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words) AS base_failed FROM c)
SELECT *, (NOT base_failed AND {_rules_sql()}) AS kept FROM b
"""


# The contract's patterns as they stand (this engine needs no possessive loops).
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}",               # the first four characters: such places never overlap
    "ssn": pii.PATTERNS["ssn"],
}
_D = "regexp_replace(x.v, '[^0-9]', '', 'g')"
_CHECK = {
    "email": "true",
    "ip": "len(list_filter(string_split(x.v, '.'), lambda y: length(ltrim(y, '0')) > 3 "
          "OR coalesce(try_cast(nullif(ltrim(y, '0'), '') AS INT), 0) > 255)) = 0",
    "card": f"length({_D}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, length({_D})), lambda i: "
            f"CASE WHEN i % 2 = 0 THEN substr({_D}, length({_D}) - i, 1)::INT "
            f"ELSE (2 * substr({_D}, length({_D}) - i, 1)::INT) // 10 "
            f"+ (2 * substr({_D}, length({_D}) - i, 1)::INT) % 10 END)) % 10 = 0",
    "phone": f"length({_D}) BETWEEN 9 AND 15",
    "iban": "true",                           # see _ibans
    "ssn": "true",
}


def _grouped(n: int) -> str:
    """``n`` characters in fours, each four with or without a space before it."""
    return f"( ?[A-Z0-9]{{4}}){{{n // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")


def _ibans() -> str:
    """The list f_iban of places and values from f0_iban, the places of two letters and two digits.

    A place counts after no letter or digit, or after the letters IBAN.  A country with a known length is
    tried at that length, any other at 35 down to 12 characters; no letter or digit may follow; the first
    that is 1 modulo 97 counts."""
    ahead, end = "substr(t, x.s + 1, 44)", "([^A-Za-z0-9]|$)"
    known = "^(" + "|".join(c for cs in pii.IBAN_LENGTHS.values() for c in cs.split()) + ")"
    tries = [f"regexp_extract({ahead}, '^(({'|'.join(cs.split())})[0-9]{{2}}{_grouped(n - 4)}){end}', 1)"
             for n, cs in pii.IBAN_LENGTHS.items()]
    tries += [f"CASE WHEN regexp_matches({ahead}, '{known}') THEN '' "
              f"ELSE regexp_extract({ahead}, '^([A-Z]{{2}}[0-9]{{2}}{_grouped(n - 4)}){end}', 1) END"
              for n in range(35, 11, -1)]
    plain = "replace(v, ' ', '')"
    value = "CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END"
    rest = (f"list_reduce(list_transform(string_split(substr({plain}, 5) || substr({plain}, 1, 4), ''), lambda c: {value}), "
            "lambda a, d: (a * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) % 97")
    free = ("x.s = 0 OR NOT regexp_matches(substr(t, x.s, 1), '[A-Za-z0-9]') "
            "OR (x.s >= 4 AND substr(t, x.s - 3, 4) = 'IBAN')")
    first = f"list_filter(list_filter([{', '.join(tries)}], lambda v: v <> ''), lambda v: {rest} = 1)[1]"
    return (f"list_filter(list_transform(list_filter(f0_iban, lambda x: {free}), lambda x: {{'s': x.s, 'v': {first}}}), "
            "lambda x: x.v IS NOT NULL) AS f_iban")


def _spans_sql() -> str:
    cuts = ", ".join(f"regexp_extract_all(t, '{PLAIN[k]}') AS m_{k}, string_split_regex(t, '{PLAIN[k]}') AS p_{k}"
                     for k in pii.KINDS)
    at = ", ".join(
        f"list_transform(range(1, len(m_{k}) + 1), lambda i: {{'s': (coalesce(list_sum(list_transform("
        f"p_{k}[1:i], lambda y: length(y))), 0) + coalesce(list_sum(list_transform("
        f"m_{k}[1:i - 1], lambda y: length(y))), 0))::BIGINT, 'v': m_{k}[i]}}) AS {'f0' if k == 'iban' else 'f'}_{k}" for k in pii.KINDS)
    near = ("regexp_matches(substr(t, greatest(x.s - {n}, 0) + 1, x.s - greatest(x.s - {n}, 0)) || ' ' "
            "|| substr(t, x.s + length(x.v) + 1, {n}), '(?i)({w})')")
    scored = []
    for k in pii.KINDS:
        hit = near.format(n=pii.CONTEXT_CHARS, w=pii.CONTEXT[k])
        score = f"{pii.PRIOR[k] + pii.CHECK_BONUS[k]} + CASE WHEN {hit} THEN {pii.CONTEXT_BONUS} ELSE 0 END"
        least = pii.LEAST_SCORE if k in pii.ADDED_KINDS else 0
        scored.append(
            f"list_filter(list_transform(list_filter(f_{k}, lambda x: {_CHECK[k]}), lambda x: "
            f"{{'span': '{k}:' || x.s || ':' || (x.s + length(x.v)), 'score': {score}}}), "
            f"lambda z: z.score >= {least}) AS s_{k}")
    base = " || ".join(f"list_transform(s_{k}, lambda z: z.span)" for k in pii.BASE_KINDS)
    every = " || ".join(f"s_{k}" for k in pii.KINDS)
    counts = ", ".join(f"len(s_{k})::BIGINT AS n_{k}" for k in pii.KINDS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT doc_id, t, {cuts} FROM d),
f0 AS (SELECT doc_id, t, {at} FROM c),
f AS (SELECT *, {_ibans()} FROM f0),
s AS (SELECT doc_id, {", ".join(scored)} FROM f)
SELECT doc_id, {counts}, sha256(array_to_string({base}, ',')) AS base_sha256,
  array_to_string(list_transform({every}, lambda z: z.span), ',') AS spans,
  array_to_string(list_transform({every}, lambda z: z.score::VARCHAR), ',') AS scores
FROM s
"""



_KEPT = ", ".join(f"'{h}'" for h in warc_revisit.KEPT_HEADERS)

OP10 = rf"""
WITH p AS (SELECT page_id AS id, url AS u, md5(coalesce(html, '')) AS digest,
    strlen(coalesce(html, ''))::VARCHAR AS size FROM pages),
q AS (SELECT *, '"' || substr(digest, 1, 16) || '"' AS etag, 'day ' || (id % 365) AS modified FROM p),
f AS (SELECT id, u, digest,
    CASE WHEN id % 11 = 5 THEN [{{'k': 'content-type', 'v': 'text/html'}}, {{'k': 'last-modified', 'v': modified}},
                                {{'k': 'content-length', 'v': size}}]
      ELSE [{{'k': 'content-type', 'v': 'text/html'}}, {{'k': 'etag', 'v': etag}},
            {{'k': 'last-modified', 'v': modified}}, {{'k': 'content-length', 'v': size}},
            {{'k': 'cache-control', 'v': 'max-age=60'}}] END AS full_headers,
    CASE WHEN id % 13 = 6 THEN [{{'k': 'date', 'v': 'later'}}]
      WHEN id % 11 = 5 THEN [{{'k': 'last-modified', 'v': modified}}, {{'k': 'date', 'v': 'later'}}]
      ELSE [{{'k': 'etag', 'v': CASE WHEN id % 7 = 3 THEN '"changed"' WHEN id % 7 = 4 THEN 'W/' || etag ELSE etag END}},
            {{'k': 'cache-control', 'v': 'max-age=3600'}}, {{'k': 'content-length', 'v': '0'}},
            {{'k': 'date', 'v': 'later'}}] END AS short_headers FROM q),
c AS (
  SELECT id * 3 AS record_id, 'response' AS kind, u AS url, id * 10 AS tm, full_headers AS h, digest FROM f
  UNION ALL SELECT id * 3 + 1, 'revisit', u, CASE WHEN id % 17 = 2 THEN id * 10 - 1 ELSE id * 10 + 5 END,
    short_headers, NULL FROM f
  UNION ALL SELECT id * 3 + 2, 'revisit', CASE WHEN id % 2 = 0 THEN u || '#again' ELSE u || '/' END, id * 10 + 7,
    short_headers, NULL FROM f),
u1 AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS x FROM c),
u2 AS (SELECT *, lower(regexp_extract(x, '^[^/?]*')) AS host0, regexp_replace(x, '^[^/?]*', '') AS rest FROM u1),
u3 AS (SELECT *, regexp_replace(regexp_replace(host0, '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_replace(rest, '^[^?]*\??', ''), '&'),
      lambda y: y <> '' AND NOT regexp_matches(y, '^{warc_revisit.TRACKING}(=|$)'))) AS params FROM u2),
t AS (SELECT *, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
    AS target FROM u3),
w AS (SELECT *, last_value(CASE WHEN kind = 'response' THEN {{'r': record_id, 'h': h, 'd': digest}} END IGNORE NULLS)
    OVER (PARTITION BY target ORDER BY tm, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src FROM t),
v AS (SELECT *, list_filter(src.h, lambda y: y.k = 'etag')[1].v AS e0, list_filter(h, lambda y: y.k = 'etag')[1].v AS e1,
    list_filter(src.h, lambda y: y.k = 'last-modified')[1].v AS m0,
    list_filter(h, lambda y: y.k = 'last-modified')[1].v AS m1 FROM w WHERE kind = 'revisit'),
s AS (SELECT *, CASE WHEN src IS NULL THEN 'no_response'
    WHEN regexp_replace(e0, '^W/', '') = regexp_replace(e1, '^W/', '') THEN 'resolved'
    WHEN e0 IS NOT NULL AND e1 IS NOT NULL THEN 'validator_mismatch'
    WHEN m0 = m1 THEN 'resolved' WHEN m0 IS NOT NULL AND m1 IS NOT NULL THEN 'validator_mismatch'
    ELSE 'unverified' END AS status FROM v),
n AS (SELECT *, list_filter(h, lambda y: y.k NOT IN ({_KEPT})) AS allowed FROM s)
SELECT record_id, target, status,
  CASE WHEN status IN ('resolved', 'unverified') THEN src.r END AS refers_to,
  CASE WHEN status IN ('resolved', 'unverified') THEN src.d END AS digest,
  CASE WHEN status IN ('resolved', 'unverified') THEN array_to_string(list_sort(list_transform(
    list_filter(src.h, lambda y: NOT list_contains(list_transform(allowed, lambda z: z.k), y.k)) || allowed,
    lambda y: y.k || ': ' || y.v)), chr(10)) END AS headers
FROM n
"""

OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP11 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.rid AS a, a.vec_id AS anchor_id, o.rid AS o, o.vec_id, a.label = o.label AS same,
    list_dot_product(a.v, o.v)::BIGINT AS score FROM v a JOIN v o ON a.rid <> o.rid WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.a, p.o, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
    s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.o ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part,
        (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(k, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT concat(a.k, b.k, c.k, d.k, e.k) AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM x a, x b, x c, x d, x e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, range(1, 6) r(step)),
g AS (SELECT part, filter_order, step, own, before, mask, n, good, bad FROM s, c),
r AS (SELECT part, filter_order, step,
        sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost
      FROM g GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM r
"""


ORACLES: dict[str, str] = {"op4_topk_pivots": OP4, "op7_pii_spans": _spans_sql(), "op8_quality_rules": OP8, "op10_warc_revisit": OP10,
                           "op11_hard_negatives": OP11, "op13_filter_audit": OP13}
