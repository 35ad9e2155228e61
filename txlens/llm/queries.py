"""The queries ``opN_<name>`` of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm import (dartminhash, filter_audit, hard_negatives, packing, pii, quality_qda, quality_rules, source_mix, sp_codec,
                        token_transducer, topk_pivots, toxicity, warc_revisit)
from txlens.llm.common import held_out
from txlens.llm.oracle import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                              "predicted", "distance")


@query
def op3_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality_qda.fit(docs, table(spark, sf_dir, "labels"))
    return quality_qda.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                                 "predicted")


@query
def op4_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every query vector (id divisible by 50)."""
    return topk_pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every whole text and their decoding, as counts and hashes."""
    return sp_codec.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"),
                                     digests_only=True)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by the compiled transducer."""
    return token_transducer.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every whole text."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"),
                        "spans", "scores")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of the rule table for every whole text."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


@query
def op9_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return dartminhash.classes(table(spark, sf_dir, "documents"))


@query
def op10_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisit captures derived from all pages, resolved to full responses."""
    found = warc_revisit.resolve(warc_revisit.captures_of_pages(table(spark, sf_dir, "pages")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(
        ": ", e["key"], e["value"]))), "\n")
    return found.withColumn("headers", text)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 hardest different-label rows of every anchor's 5 positives."""
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


@query
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of every document."""
    return source_mix.mix(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in every order, by source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
