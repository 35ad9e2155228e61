"""Quality rules: a table of thresholds compiled into one Spark projection.

``RULES`` names a numerator, a denominator and bounds in percent; ``verdict``
turns the table into one boolean expression over counts taken from the text
by built-in functions (no user functions, no shuffle: every count is a
function of the row).  ``n_capitals`` counts A-Z only.

Defined results: a NULL or empty text has no words, every count 0, fails the
base rule and is not kept; repeated rows each get their own result; extra
columns of the input, whatever their names, are ignored; an empty table
gives an empty result.  Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.common import computed, fresh, let

SYMBOLS = "#*$%&|<>"                     # fixed values of the contract
MIN_WORDS, MAX_REPEAT_PCT = 50, 50       # fixed values of the contract

# Frequent function words of the corpus' languages (English, German, French, Spanish).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "as", "with", "be",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "ist", "im", "dem", "nicht", "ein", "eine",
    "le", "la", "les", "de", "et", "un", "une", "du", "en", "que", "qui", "dans", "par", "pour", "est", "sur",
    "el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "su", "al", "es", "lo", "como",
)

# (rule, numerator, denominator, lowest percent or None, highest percent or None);
# a rule holds if denominator is 0 or lowest <= 100 * numerator / denominator <= highest.
RULES = (
    ("mean_word_length", "word_chars", "n_words", 150, 1500),
    ("symbols_per_word", "n_symbols", "n_words", None, 20),
    ("stop_words", "n_stop_words", "n_words", 2, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 40),
    ("capital_letters", "n_capitals", "word_chars", None, 40),
    ("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 50),
    ("repeated_words", "n_repeat_words", "n_words", None, 50),
)


WORD_SPLIT = "[ \\x09-\\x0D]+"
POSITION_BITS = 24                       # of a packed window: the rest is hash


def _with_words(df: DataFrame, text_col: str, w: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.withColumn(w, F.array_remove(F.split(text, WORD_SPLIT), ""))


def _with_repeats(df: DataFrame, w: str, out: str) -> DataFrame:
    """Add ``out``: the words inside 3-word windows that occur twice or more.

    Windows are hashed; only if a hash repeats are (hash prefix, position)
    pairs sorted as plain longs, equal neighbours give the candidate
    positions, these are compared by their whole 64-bit hash, and the union of
    [p, p + 3) over the repeated positions is counted.  Each step is a
    projection of its own, so that no array is computed twice."""
    n = F.size(w)
    h, s, c = (f"{out}_{x}" for x in "hsc")
    none = F.array().cast("array<bigint>")
    windows = let(F.transform(F.col(w), lambda x: F.xxhash64(x)), lambda hw: F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(hw, i), F.get(hw, i + 1), F.get(hw, i + 2))))
    df = df.withColumn(h, F.when(n >= 4, windows).otherwise(none))
    low = F.lit((1 << POSITION_BITS) - 1).cast("bigint")
    packed = F.transform(F.col(h), lambda x, i: F.shiftleft(F.shiftright(x, POSITION_BITS), POSITION_BITS)
                         .bitwiseOR(i.cast("bigint")))
    repeats = F.size(F.array_distinct(F.col(h))) < F.size(h)
    fits = n < (1 << POSITION_BITS)
    df = df.withColumn(s, F.when(repeats & fits, F.sort_array(packed)).otherwise(none))
    head = lambda x: F.shiftright(x, POSITION_BITS)
    beside = lambda col, key: (lambda v, i: F.coalesce(key(v) == key(F.get(F.col(col), i + 1)), F.lit(False))
                               | F.coalesce(key(v) == key(F.get(F.col(col), i - 1)), F.lit(False)))
    candidates = (F.when(repeats & ~fits, F.sequence(F.lit(0), n - 3))
                  .when(repeats, F.transform(F.filter(F.col(s), beside(s, head)),
                                             lambda v: v.bitwiseAND(low).cast("int")))
                  .otherwise(F.array().cast("array<int>")))
    df = df.withColumn(c, F.sort_array(F.transform(
        candidates, lambda i: F.struct(F.get(F.col(h), i).alias("h"), i.alias("i")))))
    exact = F.filter(F.col(c), beside(c, lambda v: v["h"]))
    covered = let(F.sort_array(F.transform(exact, lambda v: v["i"])), lambda pos: F.aggregate(
        F.zip_with(pos, F.slice(pos, 2, F.greatest(F.size(pos), F.lit(1))),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0).cast("bigint"), lambda acc, v: acc + v))
    return df.withColumn(out, F.when(F.size(c) > 1, covered).otherwise(F.lit(0).cast("bigint"))).drop(h, s, c)


def with_counts(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` plus the struct ``out`` of every count the rules use."""
    w, r, ln = (fresh(df, f"{out}_{x}") for x in ("words", "repeat", "lines"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = _with_repeats(_with_words(df, text_col, w), w, r)
    df = df.withColumn(ln, F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]")))
    stop = [v for x in STOP_WORDS for v in (x, x.capitalize())]
    only = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("bigint")
    return df.withColumn(out, computed(F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(F.col(w), "")).cast("bigint").alias("word_chars"),
        only(SYMBOLS).alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(F.col(ln)))).cast("bigint").alias("n_dup_lines"),
        F.col(r).alias("n_repeat_words"),
        F.size(ln).cast("bigint").alias("n_lines"),
        F.size(F.filter(F.col(w), lambda x: x.isin(stop))).cast("bigint").alias("n_stop_words"),
        only("A-Z").alias("n_capitals"),
        F.size(F.filter(F.col(ln), lambda x: x.endswith("..."))).cast("bigint").alias("n_ellipsis_lines"),
    ))).drop(w, r, ln)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PCT * c["n_words"])


def verdict(c: Column, rules=RULES) -> Column:
    """True if every rule of the table holds for the counts ``c``."""
    ok = F.lit(True)
    for _, num, den, low, high in rules:
        if low is not None:
            ok = ok & (100 * c[num] >= low * c[den])
        if high is not None:
            ok = ok & (100 * c[num] <= high * c[den])
    return ok


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``."""
    c = F.col("c")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    return with_counts(narrow, "t", "c").select(
        "doc_id", "c.*", base_failed(c).alias("base_failed"), (~base_failed(c) & verdict(c, rules)).alias("kept"))


def keep(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the table, columns unchanged."""
    name = fresh(docs, "rule_counts")
    c = F.col(name)
    return with_counts(docs, text_col, name).filter(~base_failed(c) & verdict(c, rules)).drop(name)
