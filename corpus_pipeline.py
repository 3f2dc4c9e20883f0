"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

Toxic documents go, one document of each group of near copies stays, documents with benchmark text go, secrets are
masked, and what is left is encoded. Stages 1 to 4 return the columns of ``documents``; the last returns ids and decoded
texts. Each stage works on all its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varsift.llm import bpe_automaton, decontaminate, jaccard_join, secret_ledger, toxicity_gru
from varsift.llm.queries import tokenizer_file
from varsift.llm.storage import shared_path, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network calls toxic go."""
    return toxicity_gru.without_toxic(docs, toxicity_gru.fitted(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` is the new length. The documents stay."""
    clean = secret_ledger.without_secrets(docs, shared_path(spark, "ledger"))
    changed = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every document."""
    return bpe_automaton.encoded(docs, bpe_automaton.Vocabulary.read(tokenizer_file()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_text),
    ("secret_scans", secrets),
    ("bpe_encoding", tokens),
]

#: SQL cannot express a trained network or byte-pair encoding; tests/llm holds the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
