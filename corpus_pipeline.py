"""The corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanstore.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from spanstore.llm.common import delete, scratch, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules keep."""
    return quality_rules.filter_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many documents share."""
    return line_dedup.dedup_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all others."""
    return jaccard_join.dedup_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights, as documents again."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near),
    ("mixing", mixed),
    ("packing", packed),
]

# Learned rules and a subword tokenizer are outside SQL; tests hold every stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again, and its own tables are deleted."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = getattr(docs, "_stored_at", None)
        with scratch(spark) as keep:
            docs = keep(stored(stage(spark, docs, sf_dir)))
        if before:
            delete(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
