"""Stream = batch for the stateless cleaning path (m01) and the idempotent append (m02)."""

import uuid

from pyspark.sql import functions as F

from cohortlens.operators import cleaning as cl
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources import testdata
from cohortlens.streaming import ingest

SF = "/root/testdata/sf0.001"


def _dir(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_stream_equals_batch(spark):
    raw = testdata.purchases(spark, SF)
    src = _dir(spark, "src")
    raw.repartition(3, "_row_id").write.parquet(src)
    schema = spark.read.parquet(src).schema
    sink = _dir(spark, "sink")
    ingest.stream_clean(spark, source=src, sink=sink, checkpoint=_dir(spark, "ck"), source_schema=schema, tz="UTC")
    streamed = spark.read.parquet(sink).select("_row_id", "route", "purchase_datetime")
    batch = ingest.row_routes(cl.prepare(raw, tz="UTC")).select("_row_id", "route", "purchase_datetime")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_foreach_batch_writer_is_idempotent(spark):
    path = _dir(spark, "fb")
    w = ingest.idempotent_batch_writer(path)
    df = spark.range(5)
    w(df, 0)
    w(df, 0)                    # a replayed batch replaces its output
    assert spark.read.parquet(path).count() == 5
