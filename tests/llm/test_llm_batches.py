"""Whole texts go to Python in batches of bounded bytes, whatever the session's default."""

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import decontam, jaccard_join, quality_gbt
from cohortlens.session import BATCH_CONFS, small_batches

BYTES, ROWS = BATCH_CONFS


@pytest.fixture
def default_batches(spark):
    old = {k: spark.conf.get(k) for k in BATCH_CONFS}
    for k in BATCH_CONFS:
        spark.conf.unset(k)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("step", ["statistics", "keep_documents", "jaccard_join", "drop_contaminated", "contamination"])
def test_no_batch_of_texts_is_large(spark, monkeypatch, default_batches, step):
    docs = spark.range(400, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" some words"), 4000)).alias("text"))
    benchmark = spark.createDataFrame([(1, "an item of the benchmark that none of the documents holds anywhere in its text")], "item_id long, text string")
    for module in (quality_gbt, jaccard_join, decontam):
        def checked(batches, column, most, slices=module.slices):
            for batch in batches:
                assert batch.nbytes < 4 << 20, f"{batch.nbytes} bytes in a batch"          # all 400 texts: 18 MB
                yield from slices([batch], column, most)
        monkeypatch.setattr(module, "slices", checked)
    out = {"statistics": lambda: quality_gbt.statistics(docs), "keep_documents": lambda: quality_gbt.keep_documents(docs, quality_gbt.Trees()),
           "jaccard_join": lambda: jaccard_join.jaccard_join(docs), "drop_contaminated": lambda: decontam.drop_contaminated(docs, benchmark),
           "contamination": lambda: decontam.contamination(docs, benchmark)}[step]()
    assert out.count() == (0 if step == "keep_documents" else 400)                          # repeated words fail the base rule


def test_smaller_settings_stay(spark, default_batches):
    small_batches(spark)
    assert {k: spark.conf.get(k) for k in BATCH_CONFS} == {k: str(v) for k, v in BATCH_CONFS.items()}
    spark.conf.set(BYTES, "64k")
    spark.conf.set(ROWS, "100")
    small_batches(spark)
    assert (spark.conf.get(BYTES), spark.conf.get(ROWS)) == ("64k", "100")
    spark.conf.set(BYTES, "8m")
    small_batches(spark)
    assert spark.conf.get(BYTES) == str(BATCH_CONFS[BYTES])
