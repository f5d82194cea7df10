"""A training corpus in five stages, from documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import decontaminate, langid, near_dup, packing, quality
from lexloom.llm.registry import BYTE_BPE
from lexloom.llm.runtime import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep (null and empty texts go)."""
    scored, name = quality.with_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.where(f"{name}.kept").drop(name)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that was learnt; ``und`` goes, as do null
    texts.  A document that names no language gets the one that was found."""
    scored, name = langid.with_language(docs, langid.fit(docs, langid.held_out()))
    kept = scored.where(f"{name}.lang_pred <> '{langid.UNKNOWN}'")
    return kept.withColumn("lang", F.coalesce("lang", f"{name}.lang_pred")).drop(name)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of smallest doc_id.
    Texts without words and rows without a doc_id stay."""
    return near_dup.one_of_each(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item, re-parameterised or not;
    null and empty texts stay."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left as pieces in sequences of at most 1024 tokens; a null or
    empty text is the end token alone."""
    return packing.pack(docs, BYTE_BPE, capacity=1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trees, automata and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
