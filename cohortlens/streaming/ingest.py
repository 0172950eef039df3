"""Incremental ingestion with Structured Streaming (m01, m02).

The reference reads CSV in chunks and appends label rows in flushes; here a file-source stream
picks up new files (``maxFilesPerTrigger`` bounds a micro-batch), applies the same stateless
cleaning expressions as the batch path (p01-p18) and the row-local routes (audit / invalid /
valid), and writes with ``trigger(availableNow=True)``. Deduplication, p99 outliers and
quantile buckets need global state and stay in the batch path.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_SCHEMA, PurchaseSchema
from ..operators import cleaning as cl
from ..sources import sinks


def row_routes(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, route_col: str = "route") -> DataFrame:
    """The row-local part of the routing: audit, invalid, else valid."""
    return df.withColumn(route_col, F.when(cl.is_audit(schema), F.lit("audit"))
                         .when(~cl.is_valid(schema), F.lit("invalid")).otherwise(F.lit("valid")))


def stream_clean(spark: SparkSession, *, source: str, sink: str, checkpoint: str, source_schema=None,
                 fmt: str = "parquet", max_files_per_trigger: int = 1000, tz: str | None = config.DEFAULT_TZ,
                 schema: PurchaseSchema = DEFAULT_SCHEMA, sep: str = ",", encoding: str = "utf-8"):
    """m01: stream raw purchase files through the stateless cleaning into a parquet sink
    partitioned by route. Returns the finished ``StreamingQuery``.

    ``csv``: every file has its own header (``parse_lines``); a micro-batch replaces its own output when it is replayed.
    """
    if fmt == "csv":
        reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
        write = idempotent_batch_writer(sink, partition_by=["route"])

        def clean_batch(lines: DataFrame, batch_id: int) -> None:
            held = lines.withColumn("_line", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                parsed = parse_lines(held, sep=sep, schema=schema)
                if parsed is not None:
                    write(row_routes(cl.prepare(parsed, tz=tz, schema=schema), schema=schema), batch_id)
            finally:
                held.unpersist()
        w = sinks.csv_lines(reader, source, encoding=encoding).writeStream.foreachBatch(clean_batch)
    else:
        raw = (spark.readStream.format(fmt).schema(source_schema).option("maxFilesPerTrigger", max_files_per_trigger)
               .load(source))
        clean = row_routes(cl.prepare(raw, tz=tz, schema=schema), schema=schema)
        w = clean.writeStream.format("parquet").option("path", sink).partitionBy("route").outputMode("append")
    q = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def parse_lines(lines: DataFrame, *, sep: str = ",", schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame | None:
    """Purchases by column name from the raw lines of whole CSV files (line, _file, _block, _line); None without lines.

    The first line of each file is its header; files with equal headers are parsed together. Rows whose number of fields differs
    from their header keep their text in ``_corrupt_record``.
    """
    first = lines.where("_block = 0").groupBy("_file").agg(F.min(F.struct("_line", "line")).alias("h")).select("_file", "h.*").collect()   # a row per file
    headers: dict = {}
    for r in first:
        headers.setdefault(r["line"], []).append(r)
    parts = []
    for header, files in headers.items():
        names = sinks.header_schema(header, sep)
        mine = lines.where(F.col("_file").isin([r["_file"] for r in files]) & ~F.col("_line").isin([r["_line"] for r in files]))
        fields = F.from_csv("line", ", ".join(f"`{c}` string" for c in names.fieldNames()),
                            {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        row_id = F.struct(F.col("_file").alias("f"), F.col("_block").alias("b"), F.col("_line").alias("i")).alias(schema.row_id)
        parts.append(sinks.by_name(mine.select(fields.alias("r"), row_id).select("r.*", schema.row_id), schema=schema))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def idempotent_batch_writer(path: str, *, partition_by=None):
    """m02: a ``foreachBatch`` function that overwrites ``<path>/batch_id=<n>``, so a replayed
    micro-batch replaces its own output instead of appending it twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/batch_id={batch_id}")
    return write


def stream_append(spark: SparkSession, *, source: str, sink: str, checkpoint: str, source_schema,
                  transform=None, fmt: str = "parquet", max_files_per_trigger: int = 1000):
    """m02: stream files, transform each micro-batch's rows, append through ``foreachBatch``."""
    src = (spark.readStream.format(fmt).schema(source_schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .load(source))
    out = transform(src) if transform else src
    q = (out.writeStream.foreachBatch(idempotent_batch_writer(sink)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
