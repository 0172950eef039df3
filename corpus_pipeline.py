"""Corpus pipeline: quality rules, near-duplicate join, decontamination, PII redaction, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the
next one's docs; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontam, jaccard_join, packing, pii, quality_gbt
from cohortlens.session import cut_lineage
from cohortlens.sources.testdata import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the boosted trees (3); the trees learn from the labelled ones."""
    stats = cut_lineage(quality_gbt.statistics(docs), "docstats")
    return quality_gbt.keep_documents(docs, quality_gbt.train(stats, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join (10), that with the least id."""
    return jaccard_join.one_of_each(docs, jaccard_join.jaccard_join(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark (8)."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data (2) replaced by tags and ``n_chars`` of the new text."""
    return pii.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket and token-budget batch of every document that is left (6)."""
    return packing.pack(docs)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark_decontamination),
          ("PII", pii_redaction), ("packing", length_packing)]

#: The verdicts of fitted models decide which rows are left; SQL cannot express them. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
