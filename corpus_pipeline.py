"""A corpus pipeline of five stages, from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the
last return the columns of ``documents``.  ``run`` writes every stage's
result as Parquet in the shared folder and reads it again for the next.

1. quality classifier: documents scored below 0.3 go (learnt from ``labels``
   outside the held-out fold);
2. quality rules: documents that fail the base rule or the table go;
3. near-duplicates: of each class the document with the smallest id stays;
4. personal data: every span is replaced by its kind, ``n_chars`` follows;
5. best-fit packing: token pieces with their sequence and offset.

SQL cannot express the classifier or the signatures, so ``ORACLE_SQL`` is None and
the tests hold every stage against a brute-force version.  Empty tables, NULL
texts and extra columns pass through as each operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txlens.llm import dartminhash, packing, pii, quality_qda, quality_rules
from txlens.llm.common import staged
from txlens.llm.queries import table, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_qda.keep(docs, quality_qda.fit(docs, table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the executors still hold what the stages before have taken, so the workers encode and keep little
    return packing.pack(packing.token_pieces(docs, vocabulary("word_bpe_49k.json"), slice_bytes=1_000_000,
                                             remembered=(200_000, 120_000)))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
