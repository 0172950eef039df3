"""Readers and writers (s01-s13, x01, x02, x04).

Writes go through Spark's commit protocol (no manual tmp -> rename); every writer is a plain
distributed ``DataFrame.write``, never a driver-side loop.
"""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_SCHEMA, PurchaseSchema
from ..operators.window import observe_times


# -- s01 ---------------------------------------------------------------------
def purchase_csv_schema(schema: PurchaseSchema = DEFAULT_SCHEMA) -> T.StructType:
    """Purchase columns as text, as a CSV file carries them."""
    s = schema
    fields = [T.StructField(c, T.StringType()) for c in
              [s.key, s.contact, s.date, s.time]]
    fields += [T.StructField(s.gmv, T.StringType()), T.StructField(s.tickets, T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in
               [s.origin_out, s.dest_out, s.origin_ret, s.dest_ret, s.company_out, s.company_ret]]
    return T.StructType(fields)


def with_row_id(df: DataFrame, *, fmt: str, row_id: str = "_row_id") -> DataFrame:
    """S1: a row identity in file order: (file path, position).

    Parquet exposes ``_metadata.row_index``; for text formats the split start plus the id
    inside the split keeps file order (ids grow within a split)."""
    if fmt == "parquet":
        rid = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    else:
        rid = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                       F.monotonically_increasing_id().alias("i"))
    return df.withColumn(row_id, rid)


NULL_LITERALS = ("", "NA", "N/A", "NULL", "null", "None", "NaN", "nan", "<NA>")


def read_purchases(spark: SparkSession, path: str, *, fmt: str = "csv", sep: str = ",", encoding: str = "utf-8",
                   columns=None, limit: int | None = None, schema: PurchaseSchema = DEFAULT_SCHEMA,
                   null_literals=NULL_LITERALS) -> DataFrame:
    """Raw purchases by column *name*, placeholder literals as NULL, and a ``_row_id``.

    CSV columns are found by the header of each file, whatever their order; files under one path may have different
    headers. The order key may have any of its aliases, optional columns that are absent become NULL, extra ones are kept as
    text, and a missing required column is an error. gmv is a double (unparsable: NULL), everything else text. A row with more
    or fewer fields than its header is kept with its raw text in ``_corrupt_record`` (NULL for sound rows).
    ``columns`` keeps a subset (Catalyst prunes the scan); ``limit`` mirrors ``nrows``.
    """
    if fmt == "csv":
        parts = []
        reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
        headers = header_files(csv_lines(spark.read, path, encoding=encoding))
        for line, files in headers.items():
            part = reader.schema(header_schema(line, sep)).option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)
            part = with_row_id(part, fmt=fmt, row_id=schema.row_id)
            if len(headers) > 1:                         # constant metadata: files of other headers are not opened
                part = part.where(F.col("_metadata.file_path").isin(files))
            parts.append(by_name(part, schema=schema, null_literals=null_literals, where=path))
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else \
            spark.createDataFrame([], T.StructType([*purchase_csv_schema(schema).fields, T.StructField(schema.row_id, T.LongType())]))
    else:
        df = by_name(with_row_id(spark.read.format(fmt).load(path), fmt=fmt, row_id=schema.row_id), schema=schema, null_literals=null_literals, where=path)
    if columns is not None:
        df = df.select(*[c for c in columns if c in df.columns], schema.row_id)
    if limit is not None:
        df = df.orderBy(schema.row_id).limit(limit)
    return df


def csv_lines(reader, path: str, *, encoding: str = "utf-8") -> DataFrame:
    """Raw lines of the CSV files under ``path`` (``reader`` of a batch or a stream): line, _file, _block (start of the split)."""
    lines = reader.schema("line string").option("sep", "\x00").option("quote", "").option("encoding", encoding).csv(path)
    return lines.select("line", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def header_files(lines: DataFrame) -> dict:
    """Header line -> files that begin with it: one partial aggregate over the first splits, one row per file comes back."""
    first = F.min(F.struct("_line", "line")).alias("h")
    out: dict = {}
    for r in lines.withColumn("_line", F.monotonically_increasing_id()).where("_block = 0").groupBy("_file").agg(first).orderBy("_file").collect():
        out.setdefault(r["h"]["line"], []).append(r["_file"])
    return out


def header_schema(line: str, sep: str) -> T.StructType:
    names = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))
    return T.StructType([T.StructField(c, T.StringType()) for c in names] + [T.StructField("_corrupt_record", T.StringType())])


def by_name(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, null_literals=NULL_LITERALS, where: str = "the source") -> DataFrame:
    """Declared columns first (absent optional ones NULL), then extra ones and the row id; placeholder literals NULL, gmv a double."""
    declared = purchase_csv_schema(schema).fieldNames()
    alias = next((a for a in schema.key_aliases if a in df.columns), None)
    if schema.key not in df.columns and alias:
        df = df.withColumnRenamed(alias, schema.key)
    missing = [c for c in (schema.key, *schema.required) if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing in {where}: {missing}")
    df = df.withColumns({c: F.lit(None).cast("string") for c in declared if c not in df.columns})
    extra = [c for c in df.columns if c not in declared and c != schema.row_id]
    df = df.select(*declared, *extra, schema.row_id)
    # S20: the many spellings of "missing" (plain text columns only)
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != "_corrupt_record"]
    df = df.withColumns({c: F.when(~F.trim(F.col(c)).isin(list(null_literals)), F.col(c)) for c in text_cols})
    return df.withColumn(schema.gmv, F.col(schema.gmv).try_cast("double")) if schema.gmv in df.columns else df


# -- s04 ---------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the cluster's file system (object stores included)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # noqa: BLE001 - no JVM handle (Spark Connect): ask the reader
        try:
            spark.read.format("binaryFile").load(path).limit(1).collect()
            return True
        except Exception:  # noqa: BLE001
            return False


def first_existing(spark: SparkSession, paths):
    """s04: first path that exists (Hadoop file system, works for object stores too)."""
    for p in paths:
        if p and path_exists(spark, p):
            return p
    return None


# -- s05 ---------------------------------------------------------------------
#: What a stored clustering run consists of: table name -> columns with their types (others as they are).
RUN_TABLES = {
    "centroids_z": {"cluster_id": "int"},
    "assignments": {"fk_contact": "string", "cluster_id": "int"},
    "centroids_unstd": {"cluster_id": "int"},
    "metrics": {"k": "int"},
}


def read_table(spark: SparkSession, path: str, types: dict | None = None) -> DataFrame:
    """CSV or Parquet by extension; ``types`` are declared, never inferred (an id like 007 stays text)."""
    csv = path.rstrip("/").endswith(".csv")
    df = spark.read.option("header", True).csv(path) if csv else spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast(t) for c, t in (types or {}).items() if c in df.columns})


def read_run(spark: SparkSession, paths: dict, *, features=(), suffix: str = "_z", tables: dict | None = None) -> dict:
    """s05: the tables of a stored run, ``paths`` by table name. Every declared column must be there, and
    the centroids need the scored columns of ``features``; anything missing is an error."""
    tables = RUN_TABLES if tables is None else tables
    out = {name: read_table(spark, path, tables.get(name)) for name, path in paths.items() if path}
    needed = {name: set(tables.get(name, ())) for name in out}
    needed.setdefault("centroids_z", set()).update(f + suffix for f in features)
    lacking = {name: sorted(cols - set(out[name].columns)) for name, cols in needed.items() if name in out}
    lacking = {name: cols for name, cols in lacking.items() if cols}
    if lacking:
        raise ValueError(f"stored run lacks columns: {lacking}")
    return out


# -- s06, s07 ----------------------------------------------------------------
def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", compression: str = "snappy") -> str:
    df.write.mode(mode).option("compression", compression).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", sep: str = ",", encoding: str = "utf-8") -> str:
    df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    return path


# -- s08, s09 ----------------------------------------------------------------
def with_partitions(df: DataFrame, *, ts: str = "purchase_datetime", date_fallback: str = "date_purchase",
                    partition_cols=("year",)) -> DataFrame:
    """f10 + partition columns from the datetime (or the date when the datetime is NULL)."""
    t = F.col(ts) if ts in df.columns else None
    d = F.col(date_fallback) if date_fallback in df.columns else None
    src = F.coalesce(t.cast("timestamp_ntz"), d.cast("timestamp_ntz")) if t is not None and d is not None \
        else (t if t is not None else d)
    if src is None:
        raise KeyError(f"neither {ts} nor {date_fallback} is a column")
    cols = {"year": F.year(src), "month": F.month(src)}
    return df.withColumns({c: cols[c] for c in partition_cols})


def write_partitioned(df: DataFrame, root: str, *, ts: str = "purchase_datetime", date_fallback: str = "date_purchase",
                      partition_cols=("year",), overwrite: bool = False, dynamic: bool = False,
                      compression: str = "snappy") -> str:
    """s08: Hive layout by year or year/month. ``overwrite`` replaces the whole dataset; with ``dynamic`` only the
    partitions that the new rows have.

    Rows are *rebalanced* by the partition columns (few files per partition value) and AQE splits
    a skewed value over several writer tasks, so a month with a third of the data is not written
    by one task (a plain ``repartition`` by the columns would do exactly that). Rows without a single known time are an
    error (f10), found by a metric of the write itself."""
    df, guard = observe_times(df, ts=ts, date_fallback=date_fallback)
    out = with_partitions(df, ts=ts, date_fallback=date_fallback, partition_cols=partition_cols)
    out = out.hint("rebalance", *partition_cols)
    w = out.write.mode("overwrite" if overwrite else "append").option("compression", compression)
    if overwrite and dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*partition_cols).parquet(root)
    guard.check()
    return root


def partition_counts(df: DataFrame, partition_cols, *, preview: int | None = None) -> DataFrame:
    """s09: rows per partition value, sorted; ``preview`` keeps the first ones only (a report)."""
    out = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(*partition_cols)
    return out.limit(preview) if preview else out


# -- s10 / x02 ---------------------------------------------------------------
def centroid_document(centroids_z: DataFrame, *, used_cols, model_name: str, suffix: str = "_z",
                      centroids_unstd: DataFrame | None = None, stats: DataFrame | None = None,
                      medians: DataFrame | None = None, scaler: DataFrame | None = None, run_date=None,
                      meta: dict | None = None) -> DataFrame:
    """x02: a one-row JSON document: model, run date, features, centroids (z and original), global means and standard
    deviations by feature (from the parameter table of the ``scaler``), stats, medians by cluster."""
    spark = centroids_z.sparkSession

    def by_feature(value):
        return scaler.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", value)))))).scalar()

    def records(df):
        return df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns))))).scalar()

    fields = [F.lit(model_name).alias("model"), F.to_json(F.array(*[F.lit(c) for c in used_cols])).alias("features"),
              records(centroids_z.select("cluster_id", *[f"{c}{suffix}" for c in used_cols])).alias("centroids_z")]
    if centroids_unstd is not None:
        fields.append(records(centroids_unstd).alias("centroids_original"))
    if stats is not None:
        fields.append(records(stats).alias("stats"))
    if medians is not None:
        fields.append(records(medians).alias("medians"))
    if scaler is not None:
        fields += [by_feature("mean").alias("global_means"), by_feature("scale").alias("global_stds")]
    if run_date is not None:
        fields.append(F.lit(str(run_date)[:10]).alias("run_date"))
    for k, v in (meta or {}).items():
        fields.append(F.lit(v).alias(k))
    doc = spark.range(1).select(*fields)          # each part is a k-row table folded into one value
    json_cols = ("features", "centroids_z", "centroids_original", "stats", "medians", "global_means", "global_stds")
    return doc.select(F.to_json(F.struct(*[F.parse_json(F.col(c)).alias(c) if c in json_cols else F.col(c)
                                           for c in doc.columns])).alias("value"))


def write_json_doc(doc: DataFrame, path: str) -> str:
    """s10: write the one-row document as a text file."""
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


# -- s11 ---------------------------------------------------------------------
def append_rows(df: DataFrame, path: str, *, fmt: str = "csv") -> str:
    """s11: append label rows (a distributed append; no driver-side flush loop)."""
    w = df.write.mode("append")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path


# -- s13 ---------------------------------------------------------------------
def write_bundle(tables: dict, root: str, *, fmt: str = "parquet") -> dict:
    """s13: one table per name under ``root``; returns name -> path."""
    out = {}
    for name, df in tables.items():
        if df is None:
            continue
        p = os.path.join(root, name)
        (write_parquet(df, p) if fmt == "parquet" else write_csv(df, p))
        out[name] = p
    return out


MANIFEST = "manifest"


def publish_run(tables: dict, root: str, *, run_id: str | None = None, fmt: str = "parquet", meta: dict | None = None) -> str:
    """s13: a run of named tables under ``<root>/<run_id>``, visible to readers as a whole.

    The tables are written first, the manifest (table, path, format, columns, metadata) last; ``read_published`` looks for
    manifests only, so a run that was cut short is never seen. Returns the run id; one that is published already is an error.
    """
    spark = next(df for df in tables.values() if df is not None).sparkSession
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    base = f"{root.rstrip('/')}/{run_id}"
    if path_exists(spark, f"{base}/{MANIFEST}"):
        raise ValueError(f"run {run_id} is published already")
    paths = write_bundle(tables, base, fmt=fmt)
    rows = [(run_id, name, path, fmt, tables[name].schema.json(), json.dumps(meta or {}, default=str, sort_keys=True)) for name, path in sorted(paths.items())]
    manifest = spark.createDataFrame(rows, "run_id string, name string, path string, format string, columns string, meta string")
    manifest.coalesce(1).write.mode("error").json(f"{base}/{MANIFEST}")
    return run_id


def read_published(spark: SparkSession, root: str, *, run_id: str | None = None) -> tuple[dict, dict]:
    """(tables, metadata) of a published run, the one of the greatest id by default; names, types and order of columns as written."""
    path = f"{root.rstrip('/')}/{run_id or '*'}/{MANIFEST}"
    try:
        rows = spark.read.schema("run_id string, name string, path string, format string, columns string, meta string").json(path)
        newest = rows.agg(F.max("run_id")).first()[0]
        found = rows.where(F.col("run_id") == newest).collect()           # a row per table
    except Exception as e:  # noqa: BLE001 - Spark's error for a path without files
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = []
    if not found:
        raise FileNotFoundError(f"no published run under {root}" + (f" with id {run_id}" if run_id else ""))
    out = {}
    for r in found:
        schema = T.StructType.fromJson(json.loads(r["columns"]))
        df = spark.read.parquet(r["path"]) if r["format"] == "parquet" else spark.read.option("header", True).schema(schema).csv(r["path"])
        out[r["name"]] = df.select(*schema.names)
    return out, json.loads(found[0]["meta"])


# -- x01 ---------------------------------------------------------------------
def assignment_export(assignments: DataFrame, *, k: int, algorithm: str, build_date, model_version: str,
                      run_date, id_col: str = "fk_contact", cluster_col: str = "cluster_id") -> DataFrame:
    """x01: id as text, cluster as long, plus k / algorithm / build date / version / run date."""
    return assignments.select(
        F.col(id_col).cast("string").alias(id_col), F.col(cluster_col).cast("long").alias(cluster_col),
        F.lit(int(k)).alias("k"), F.lit(algorithm).alias("algorithm"),
        F.lit(str(build_date)[:10]).cast("date").alias("build_date"), F.lit(model_version).alias("model_version"),
        F.lit(str(run_date)[:10]).cast("date").alias("run_date"))


# -- x04 ---------------------------------------------------------------------
def append_run(spark: SparkSession, path: str, *, params: dict, paths: dict | None = None,
               timing_s: dict | None = None, run_id: str | None = None) -> DataFrame:
    """x04: one manifest row appended to the ``runs`` table (parameters, outputs, timings as JSON)."""
    row = [(run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S"),
            json.dumps(params, default=str, sort_keys=True), json.dumps(paths or {}, sort_keys=True),
            json.dumps(timing_s or {}, sort_keys=True))]
    df = spark.createDataFrame(row, "run_id string, params string, paths string, timing_s string")
    df.write.mode("append").parquet(path)
    return df
