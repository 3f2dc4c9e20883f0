"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from varsift.llm import (bpe_automaton, decontaminate, filter_audit, jaccard_join, perplexity_rules, phrase_mining,
                         pii_offsets, secret_ledger, suffix_dedup, token_counts, toxicity_gru, url_rules, weak_quality)
from varsift.llm.storage import table


def tokenizer_file() -> str:
    """The vocabulary's path: VARSIFT_TOKENIZER, else the installed public vocabularies'."""
    if path := os.environ.get("VARSIFT_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by weak labels and a hashed linear scorer."""
    return weak_quality.contract(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte strings of 400 bytes that start twice anywhere, removed from every document."""
    return suffix_dedup.contract(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages."""
    return url_rules.contract(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe_automaton.contract(table(spark, sf_dir, "documents"), bpe_automaton.Vocabulary.read(tokenizer_file()))


def op5_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality rules and perplexity bands."""
    return perplexity_rules.contract(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity_gru.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by the Jaccard similarity of their 5-word shingles."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    return secret_ledger.contract(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in documents."""
    return decontaminate.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and disguised personal data of every document."""
    return pii_offsets.contract(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.contract(table(spark, sf_dir, "documents"), bpe_automaton.Vocabulary.read(tokenizer_file()))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language, over all documents."""
    return phrase_mining.contract(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How five filters act in all orders, for the documents of each language."""
    return filter_audit.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_weak_quality, op2_suffix_dedup, op3_url_rules, op4_bpe_automaton, op5_perplexity_rules, op6_toxicity,
    op7_jaccard_join, op8_secret_ledger, op9_decontaminate, op10_pii_offsets, op11_token_counts, op12_phrase_mining,
    op13_filter_audit)}

#: Operators that DuckDB can express over whole tables; the others are tested against brute force in tests/llm.
SQL: dict[str, str] = {"op7_jaccard_join": jaccard_join.SQL, "op9_decontaminate": decontaminate.SQL,
                       "op12_phrase_mining": phrase_mining.SQL, "op13_filter_audit": filter_audit.SQL}
