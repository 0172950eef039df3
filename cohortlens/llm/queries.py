"""The registered queries of this subpackage: opN_<name> with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata import table
from . import bottom_k, decontam, jaccard_join, lexical_search, licenses, ngram_trie, packing, periodic_runs, pii, quality_fm, quality_gbt, suffix_dedup, warc


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical-digest license scan of every whole text and every whole line of ``documents``."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``: base spans and those that the boosted trees add."""
    return pii.detect(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and boosted-tree verdict of all ``documents``."""
    return quality_gbt.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram score of every whole text of ``documents`` by a model of all training documents."""
    return ngram_trie.score_corpus(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorisation-machine quality score of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return quality_fm.classify(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optimal length buckets and token-budget batches of all ``documents``."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of every byte of ``documents`` that a 100-byte string starting earlier covers."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of every whole text of ``documents`` within the edit budget of a ``benchmark`` passage."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as zstd WARC archives and read back with validation."""
    return warc.round_trip(table(spark, sf_dir, "pages"), payloads=False).drop("url")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingle Jaccard self-join of all ``documents`` at 0.8: class and number of links of each."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every whole text of ``documents``, after every tenth text was made to repeat itself."""
    return periodic_runs.digests(periodic_runs.find_runs(periodic_runs.plant_runs(table(spark, sf_dir, "documents"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each ``benchmark`` item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` whose sets of two-word shingles have Jaccard similarity 0.8 or more."""
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_license_scan": op1_license_scan, "op2_pii": op2_pii, "op3_quality_rules": op3_quality_rules,
           "op4_lm_scoring": op4_lm_scoring, "op5_quality_classifier": op5_quality_classifier, "op6_packing": op6_packing, "op7_suffix_dedup": op7_suffix_dedup, "op8_decontamination": op8_decontamination,
           "op9_warc": op9_warc, "op10_jaccard_join": op10_jaccard_join,
           "op11_periodic_runs": op11_periodic_runs, "op12_lexical_search": op12_lexical_search, "op13_minhash_neardup": op13_minhash_neardup}
ORACLES = {"op1_license_scan": licenses.oracle(), "op9_warc": warc.ORACLE, "op10_jaccard_join": jaccard_join.ORACLE,
           "op11_periodic_runs": periodic_runs.ORACLE, "op12_lexical_search": lexical_search.ORACLE, "op13_minhash_neardup": bottom_k.ORACLE}
