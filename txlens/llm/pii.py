"""Personal data: patterns propose spans, checksums confirm them, nearby
context words adjust their score.  Built-in functions only.

Kinds ``email``, ``ip``, ``card`` and ``phone`` follow the contract's base
patterns (leftmost, non-overlapping per kind; a match that fails its check
is dropped without a retry).  The method adds ``iban`` (mod-97 must hold) and
``ssn`` (counted only with a context word nearby).  A base span is never
dropped by its score.

An ``iban`` begins and ends at a boundary and has its country's length; for a
country without a known length the longest end at a boundary whose checksum
holds counts.  Every possible start is tried, also inside a match that fails.

Positions come from splitting the text by the same pattern: the pieces
between matches and the matches themselves alternate, so a running sum of
their lengths gives every start, in code points.

A text with matches is also cut once into parts of equal length.  Context,
what follows the start of an IBAN and the text between redacted spans come
from the parts they lie in, never from a count from the start of the text:
the work grows with the text and with its spans, not with their product.

The patterns match what the plain patterns match, but are written so that
Java's backtracking engine stays linear: possessive loops, and a start that
is either the first character of a run or the end of the last match.

Defined results: a NULL or empty text has no spans (counts 0, empty
strings, the hash of the empty string); repeated rows each get their own
row; extra input columns are ignored whatever their names; an empty table
gives an empty result.  Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import fresh, let

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    # the shape; the search itself goes by IBAN_START and the lengths
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# A substring (or pattern) without which the pattern cannot match: most texts skip the search.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]{3}-[0-9]{2}-"}

# Characters of an IBAN by country (ISO 13616 registry, and countries that use the form beside it).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU",
}
_SHORTEST, _LONGEST = 12, 35              # characters, of a country without a known length


def _grouped(n: int) -> str:
    """``n`` characters after the first four, in fours with or without a space before each."""
    return r"(?: ?[A-Z0-9]{4}){%d}" % (n // 4) + (r" ?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "")


_END = "(?![A-Za-z0-9])"
_KNOWN = "|".join(c.replace(" ", "|") for c in IBAN_LENGTHS.values())
_OWN_LENGTH = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}{_grouped(n - 4)}" for n, c in IBAN_LENGTHS.items())
# the first four characters of whatever may be an IBAN; the rest is only looked at
IBAN_START = (r"(?:(?<![A-Za-z0-9])|(?<=IBAN))(?:(?=(?:%s)%s)|(?!%s)(?=[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2}))[A-Z]{2}[0-9]{2}"
              % (_OWN_LENGTH, _END, _KNOWN))
_IBAN_CHARS = _LONGEST + _LONGEST // 4    # with spaces

CONTEXT = {
    "email": "mail|contact|write to|address",
    "ip": "ip|host|server|login",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|tax",
}
CONTEXT_CHARS = 40
#: Score in percent: the pattern alone, a passed checksum or range check, a context word nearby.
PRIOR = {"email": 70, "ip": 40, "card": 30, "phone": 40, "iban": 30, "ssn": 30}
CHECK_BONUS = {"email": 0, "ip": 20, "card": 50, "phone": 10, "iban": 50, "ssn": 0}
CONTEXT_BONUS = 20
LEAST_SCORE = 50                          # of an added span

_BLOCK = 256
_PART = 256                               # code points of a part of a text


def _parts(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % _PART), F.lit(0))


def _cut(parts: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive) of the text in ``parts``."""
    first = (start / _PART).cast("int")
    held = F.slice(parts, first + 1, (end / _PART).cast("int") - first + 1)
    return F.substring(F.array_join(held, ""), start % _PART + 1, F.greatest(end - start, F.lit(0)))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]+", "")


def _mod97(s: Column) -> Column:
    """ISO 7064 mod 97-10 of an IBAN: first four characters moved to the end, A=10 .. Z=35."""
    plain = F.regexp_replace(s, " ", "")
    moved = F.concat(F.substring(plain, 5, 1000), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0),
                       lambda a, c: (F.when(c.rlike("[0-9]"), a * 10).otherwise(a * 100) + value(c)) % 97)


def _confirmed(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "ip":
        return F.forall(F.split(s, "\\."),
                        lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")).between(1, 3)
                        & (F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 3).cast("int") <= 255))
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(s))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _ibans(parts: Column, starts: Column) -> Column:
    """Spans of the IBANs that begin at ``starts``, checksum included."""
    def ends(s: Column, ahead: Column) -> Column:
        own = F.regexp_extract(ahead, f"^(?:{_OWN_LENGTH}){_END}", 0)
        tries = F.array(*[F.regexp_extract(ahead, f"^(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}{_grouped(n - 4)}{_END}", 0)
                          for n in range(_LONGEST, _SHORTEST - 1, -1)])
        good = F.filter(F.when(own != "", F.array(own)).otherwise(tries), lambda v: (v != "") & (_mod97(v) == 1))
        return F.transform(F.slice(good, 1, 1), lambda v: F.struct(
            s["kind"], s["start"], (s["start"] + F.length(v)).alias("end"), v.alias("value")))

    # one character more than the longest, for the boundary
    return F.flatten(F.transform(starts, lambda s: let(
        _cut(parts, s["start"], s["start"] + _IBAN_CHARS + 1), lambda ahead: ends(s, ahead))))


def _found(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, value>> of the pattern's matches, in order."""
    pattern = IBAN_START if kind == "iban" else PATTERNS[kind]
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def place(matches: Column) -> Column:
        parts = F.split(text, pattern, -1)
        steps = F.zip_with(F.slice(parts, 1, F.size(matches)), matches,
                           lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("n"), m.alias("value")))

        def positions(st: Column) -> Column:
            # running sums in blocks: appending to one array would be quadratic in the matches
            blocks = F.transform(F.sequence(F.lit(0), ((F.size(st) - 1) / _BLOCK).cast("int")),
                                 lambda b: F.slice(st, b * _BLOCK + 1, _BLOCK))

            def joined(bl: Column) -> Column:
                total = F.transform(bl, lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v["gap"] + v["n"]))
                offsets = F.aggregate(total, F.array(F.lit(0)),
                                      lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))
                empty = F.struct(F.lit(0).alias("at"), none.alias("out"))
                return F.flatten(F.zip_with(bl, F.slice(offsets, 1, F.size(bl)), lambda x, o: F.aggregate(
                    x, F.struct(o.alias("at"), empty["out"].alias("out")),
                    lambda a, v: F.struct(
                        (a["at"] + v["gap"] + v["n"]).alias("at"),
                        F.concat(a["out"], F.array(F.struct(
                            F.lit(kind).alias("kind"), (a["at"] + v["gap"]).alias("start"),
                            (a["at"] + v["gap"] + v["n"]).alias("end"), v["value"].alias("value")))).alias("out")),
                    lambda a: a["out"])))

            return let(blocks, joined)

        return F.when(F.size(matches) == 0, none).otherwise(let(steps, positions))

    search = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    need = F.contains(text, F.lit(NEEDS[kind])) if kind == "email" else text.rlike(NEEDS[kind])
    return F.when(need, search).otherwise(none)


def _scored(parts: Column, kind: str, found: Column) -> Column:
    """Confirmed spans with their score; added kinds need LEAST_SCORE."""
    sure = _ibans(parts, found) if kind == "iban" else F.filter(found, lambda s: _confirmed(kind, s["value"]))

    def score(s: Column) -> Column:
        before = _cut(parts, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
        after = _cut(parts, s["end"], s["end"] + CONTEXT_CHARS)
        near = F.concat(before, F.lit(" "), after).rlike(f"(?i)({CONTEXT[kind]})")
        return F.struct(s["kind"], s["start"], s["end"], s["value"], (
            F.lit(PRIOR[kind] + CHECK_BONUS[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0)).alias("score"))

    out = F.transform(sure, score)
    return F.filter(out, lambda s: s["score"] >= LEAST_SCORE) if kind in ADDED_KINDS else out


def _text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def with_spans(docs: DataFrame, out: str, text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """``docs`` plus ``out``: struct of one array of scored spans per kind; plus
    ``parts_col``, if named: the parts of a text in which a pattern matched."""
    text = _text_of(text_col)
    raw, parts = fresh(docs, f"{out}_raw"), parts_col or fresh(docs, f"{out}_parts")
    df = docs.withColumn(raw, F.struct(*[_found(text, k).alias(k) for k in KINDS]))
    some = F.greatest(*[F.size(F.col(raw)[k]) for k in KINDS]) > 0
    df = df.withColumn(parts, F.when(some, _parts(text)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(out, F.struct(*[_scored(F.col(parts), k, F.col(raw)[k]).alias(k) for k in KINDS]))
    return df.drop(raw) if parts_col else df.drop(raw, parts)


def _joined(spans: list[Column]) -> Column:
    return F.array_join(F.flatten(F.array(*[F.transform(s, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))) for s in spans])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the spans by kind, ``spans`` as text and counts."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    s = F.col("s")
    return with_spans(narrow, "s", "t").select(
        "doc_id", *[F.size(s[k]).cast("bigint").alias(f"n_{k}") for k in KINDS],
        _joined([s[k] for k in BASE_KINDS]).alias("base"), _joined([s[k] for k in KINDS]).alias("spans"),
        F.array_join(F.flatten(F.array(*[F.transform(s[k], lambda x: x["score"].cast("string")) for k in KINDS])), ",")
        .alias("scores"), s.alias("found"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of a text replaced by ``[kind]`` (overlapping
    spans by the first of them); columns unchanged.  ``length_col``, if the
    table has it, follows the new text; a NULL text stays NULL."""
    name, cuts, held = fresh(docs, "pii_spans"), fresh(docs, "pii_cuts"), fresh(docs, "pii_parts")
    text, parts = F.col(text_col), F.col(held)
    df = with_spans(docs, name, text_col, held)
    s = F.col(name)
    every = F.array_sort(F.flatten(F.array(*[F.transform(s[k], lambda x: F.struct(
        x["start"], (-x["end"]).alias("last"), x["kind"])) for k in KINDS])))
    df = df.withColumn(cuts, every)
    # a span is cut if it starts at or after the furthest end of the spans before it;
    # that end is the larger of the whole blocks' before it and that inside its block
    block = lambda b, n: F.transform(F.slice(F.col(cuts), b * _BLOCK + 1, n), lambda y: -y["last"])
    tops = F.transform(F.sequence(F.lit(0), ((F.size(cuts) - 1) / _BLOCK).cast("int")),
                       lambda b: F.array_max(block(b, F.lit(_BLOCK))))
    ahead = F.aggregate(tops, F.array(F.lit(0)),
                        lambda a, t: F.concat(a, F.array(F.greatest(F.element_at(a, -1), t))))
    reach = let(ahead, lambda h: F.transform(F.col(cuts), lambda x, i: F.struct(
        x["start"].alias("start"), (-x["last"]).alias("end"), x["kind"].alias("kind"),
        F.greatest(F.get(h, (i / _BLOCK).cast("int")),
                   F.coalesce(F.array_max(block((i / _BLOCK).cast("int"), i % _BLOCK)), F.lit(0))).alias("before"))))
    cut = let(reach, lambda r: F.concat(
        F.array_join(F.transform(r, lambda x: F.concat(
            F.when(x["start"] >= x["before"], F.concat(
                _cut(parts, x["before"], x["start"]), F.lit("["), x["kind"], F.lit("]")))
            .otherwise(F.lit("")))), ""),
        F.substring(text, F.coalesce(F.array_max(F.transform(r, lambda x: x["end"])), F.lit(0)) + 1, F.length(text))))
    df = df.withColumn(text_col, F.when(F.size(cuts) > 0, cut).otherwise(text))
    if length_col and length_col in docs.columns:
        df = df.withColumn(length_col, F.when(F.size(cuts) > 0, F.length(text_col).cast(
            docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return df.select(*docs.columns)
