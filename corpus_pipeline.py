"""The corpus pipeline: quality rules, language identification, near-duplicate
removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; every stage but the last returns the columns of
``documents``. ``run`` writes each stage's result as Parquet into the shared
folder and reads it back, so a stage starts from a table, not from a lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm import common, decontam, langid, neardup, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that break a rule go."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, fitted on the labelled rows of its input outside the held-out
    third: documents that no language's centroids are near to go."""
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near duplicates stays."""
    return neardup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents with a benchmark window go."""
    return decontam.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the kept documents as pieces of packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", sequence_packing),
]

# Language centroids and token ids are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
