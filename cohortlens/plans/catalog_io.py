"""Registered queries, part 3: readers/writers round trips, streaming, small operators.

Files are written under the session's shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local temp folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from .. import config
from ..operators import cleaning as cl
from ..operators import features as ft
from ..operators import standardize as zs
from ..operators.window import observation_window, observe_rows, warn_if_small
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import sinks, testdata
from ..streaming import ingest
from . import oracle_sql as O
from .catalog import BUILD_DATE, _EASTER, customer_features_raw, prep, register, rounded, routed, window36
from .catalog_models import R, segments, z_wide

# Fixed cluster names of the source project's notebook (cluster id -> name).
NOTEBOOK_CLUSTER_NAMES = {
    0: "Frequente e diversificado • Pouca lealdade",
    1: "Pouca frequência • Ticket alto • Alta lealdade",
    2: "Pouca frequência • Ticket baixo • Alta lealdade",
    3: "Frequência média • Lealdade baixa",
    4: "Extrema frequência • Altíssima diversidade • Pouca lealdade",
}


#: Fractional columns of the feature table; columns of the window table that are compared in full.
_MONEY = ("monetary_gmv_12m", "avg_ticket_value", "avg_price_per_ticket")
FLOATS = {c: 2 if c in _MONEY else 6 for c in O.NUM_FEATURES if c not in ("frequency_12m", "recency_days", "n_unique_routes_out", "total_tickets_12m")}
_WIN_TEXT = ["fk_contact", "nk_ota_localizer_id", "route_out", "route_return", "time_purchase", "place_origin_departure", "place_destination_departure",
             "place_origin_return", "place_destination_return", "fk_departure_ota_bus_company", "fk_return_ota_bus_company"]
_WIN_INT = ["day_of_week", "is_weekend", "hour_of_day", "has_return"]
_WIN_FLOAT = {"gmv_success": 2, "avg_price_per_ticket": 6, "log_gmv_success": 6}
WIN_SQL = ", ".join(["_row_id", *_WIN_TEXT, *_WIN_INT, "total_tickets_quantity_success", "CAST(date_purchase AS DATE) AS date_purchase", "purchase_datetime",
                     *(f"{R(c, d)} AS {c}" for c, d in _WIN_FLOAT.items())])


def _win_columns(df):
    return rounded(df.select("_row_id", *_WIN_TEXT, *[F.col(c).cast("int").alias(c) for c in _WIN_INT], "total_tickets_quantity_success", "date_purchase",
                             "purchase_datetime", *_WIN_FLOAT), _WIN_FLOAT)


def scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# == sources / sinks ===========================================================
@register("s01_read_csv", O.q(
    f"SELECT nk_ota_localizer_id, fk_contact, date_purchase, time_purchase, {R('gmv_success', 2)} AS gmv_success, total_tickets_quantity_success, "
    "place_origin_departure, place_destination_departure, fk_departure_ota_bus_company, CASE WHEN _row_id % 2 = 0 THEN 'web' END AS channel FROM "
    "(SELECT * REPLACE (nullif(time_purchase, '') AS time_purchase) FROM raw)"))
def s01(spark, sf):
    """Files with two headers under one path: other orders of the columns, one more than declared, the key under its alias."""
    path = scratch(spark, "raw-csv")
    _csv_files(testdata.purchases(spark, sf), path)
    df = sinks.read_purchases(spark, path, fmt="csv")
    return rounded(df.select("nk_ota_localizer_id", "fk_contact", "date_purchase", "time_purchase", "gmv_success",
                             F.col("total_tickets_quantity_success").try_cast("bigint").alias("total_tickets_quantity_success"),
                             "place_origin_departure", "place_destination_departure", "fk_departure_ota_bus_company", "channel"), {"gmv_success": 2})


def _csv_files(raw, path, keep_line=False):
    """Even rows with the columns in reverse order, the key's alias and an extra column; odd rows in order, without a header in common."""
    line = raw["_row_id"].cast("string")
    even, odd = (raw.where(raw["_row_id"] % 2 == r).withColumn("line_no", line).drop("_row_id") for r in (0, 1))
    if not keep_line:
        even, odd = even.drop("line_no"), odd.drop("line_no")
    even = even.select(*sorted(even.columns, reverse=True)).withColumnRenamed("nk_ota_localizer_id", "nk_order_id").withColumn("channel", F.lit("web"))
    sinks.write_csv(even, path)
    sinks.write_csv(odd, path, mode="append")


@register("s03_read_std_features", O.q(f"SELECT fk_contact, feature, {R('z', 6)} AS z FROM zlong"))
def s03(spark, sf):
    """The standardised table written and read again: every z value by the features that its columns name."""
    sc, z, _ = z_wide(spark, sf)
    path = scratch(spark, "std")
    sinks.write_parquet(z, path)
    return rounded(zs.read_standardized(spark, path, suffix=sc.suffix)[0], {"z": 6})


@register("s04_first_existing")
def s04(spark, sf):
    p = sinks.first_existing(spark, [f"{sf}/missing.parquet", f"{sf}/orders.parquet", f"{sf}/lineitem.parquet"])
    return spark.read.parquet(p).select("o_orderkey")


@register("s05_load_artifacts")
def s05(spark, sf):
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    cz = z.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in zcols])
    root = scratch(spark, "artifacts")
    sinks.write_parquet(cz, f"{root}/centroids_z")
    sinks.write_csv(seg, f"{root}/assignments.csv")          # read back with declared types
    run = sinks.read_run(spark, {"centroids_z": f"{root}/centroids_z", "assignments": f"{root}/assignments.csv"},
                         features=sc.used_cols, suffix=sc.suffix)
    return run["assignments"]


@register("s06_write_parquet", O.q(f"SELECT {WIN_SQL} FROM win"))
def s06(spark, sf):
    """The window table written and read again, every column."""
    path = scratch(spark, "window")
    sinks.write_parquet(window36(spark, sf), path)
    return _win_columns(spark.read.parquet(path))


@register("s07_write_csv", O.q(f"SELECT fk_contact, CAST(frequency_12m AS BIGINT) AS frequency_12m, recency_days, CAST(last_purchase AS TIMESTAMP) AS last_purchase, "
                               f"n_unique_routes_out, top_route_out, top_company_out, total_tickets_12m, {', '.join(f'{R(c, d)} AS {c}' for c, d in FLOATS.items())} FROM feat"))
def s07(spark, sf):
    """The feature table written as CSV and read again with declared types, every column."""
    path = scratch(spark, "features-csv")
    f = customer_features_raw(spark, sf).drop("build_date", "model_version")
    sinks.write_csv(f, path)
    back = spark.read.option("header", True).schema(f.schema).csv(path)
    return rounded(back.select(*[c for c in f.columns]), FLOATS)


@register("s08_write_partitioned", O.q(
    "SELECT CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS n_rows, "
    f"{R('sum(gmv_success)', 2)} AS gmv FROM (SELECT gmv_success, "
    "coalesce(purchase_datetime, CAST(date_purchase AS TIMESTAMP)) AS t FROM clean) GROUP BY 1, 2"))
def s08(spark, sf):
    root = scratch(spark, "by-year-month")
    sinks.write_partitioned(routed(spark, sf, n_buckets=None).clean, root, partition_cols=("year", "month"),
                            overwrite=True)
    back = spark.read.parquet(root)                      # all partitions
    return rounded(back.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
                   .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("gmv_success").alias("gmv")), {"gmv": 2})


@register("s09_partition_counts", O.q(
    "SELECT CAST(year(coalesce(purchase_datetime, CAST(date_purchase AS TIMESTAMP))) AS INTEGER) AS year, "
    "CAST(count(*) AS BIGINT) AS n_rows FROM clean GROUP BY 1"))
def s09(spark, sf):
    clean = routed(spark, sf, n_buckets=None).clean
    return sinks.partition_counts(sinks.with_partitions(clean, partition_cols=("year",)), ["year"])


_DOC = "centroids_z array<map<string, double>>, centroids_original array<map<string, double>>, stats array<struct<feature: string, mean: double, scale: double>>"


def _doc_rows(doc, field):
    """(cluster_id, feature, value) of a centroid table inside the written document."""
    rows = doc.select(F.explode(F.from_json("value", _DOC)[field]).alias("m")).select(F.col("m")["cluster_id"].cast("int").alias("cluster_id"), "m")
    return rows.select("cluster_id", F.explode("m").alias("feature", "value")).where("feature <> 'cluster_id'")


@register("s10_write_json_doc", O.q(f"SELECT cluster_id, feature || '_z' AS feature, {R('z', 6)} AS value FROM segz"))
def s10(spark, sf, field="centroids_z"):
    """The document written as text, read again and parsed back to rows."""
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    # the document reads the centroids twice: the join and its means run once
    cz = cut_lineage(z.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in zcols]), "centroids")
    doc = sinks.centroid_document(cz, used_cols=sc.used_cols, model_name="segment",
                                  centroids_unstd=sc.inverse(cz).select("cluster_id", *sc.used_cols),
                                  stats=sc.to_df(spark), meta={"build_date": BUILD_DATE, "model_version": "v1"})
    path = scratch(spark, "centroids-json")
    sinks.write_json_doc(doc, path)
    return rounded(_doc_rows(spark.read.text(path), field), {"value": 6})


@register("s11_append_batches")
def s11(spark, sf):
    from .catalog_models import purchase_days
    from ..operators import labels as lb
    path = scratch(spark, "labels-append")
    labels = lb.repurchase_labels(purchase_days(spark, sf), min_history_days=7, horizons=(3, 7))
    sinks.append_rows(labels.where("ref_date < '2024-01-20'"), path, fmt="parquet")
    sinks.append_rows(labels.where("ref_date >= '2024-01-20'"), path, fmt="parquet")
    return spark.read.parquet(path)


@register("s12_save_model", O.q(f"SELECT feature, {R('m', 6)} AS mean, {R('CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END', 6)} AS scale, "
                                f"is_log AS log1p, CAST({config.DEFAULT_FILL} AS DOUBLE) AS fill, '{config.Z_SUFFIX}' AS suffix FROM st WHERE v > 1e-12"))
def s12(spark, sf):
    sc, _, _ = z_wide(spark, sf)
    path = scratch(spark, "scaler")
    sinks.write_parquet(sc.to_df(spark), path)
    back = zs.Scaler.from_df(spark.read.parquet(path))
    return rounded(back.to_df(spark).drop("position"), {"mean": 6, "scale": 6})


_RUN_LONG = {"rfm": ["frequency_12m", "monetary_gmv_12m", "recency_days", "avg_ticket_value"], "intensity": ["total_tickets_12m", "avg_price_per_ticket"],
             "shares": ["pct_q1", "pct_q2", "pct_q3", "pct_q4", "pct_verao", "pct_outono", "pct_inverno", "pct_primavera", "pct_weekend", "pct_holiday"]}


@register("s13_artifact_sets", O.q(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", fk_contact, '{c}' AS name, {R(f'CAST({c} AS DOUBLE)', 2 if c in _MONEY else 6)} AS value FROM feat" for t, cols in _RUN_LONG.items() for c in cols)))
def s13(spark, sf):
    """A published run of three tables, read again through its manifest, every value."""
    win = window36(spark, sf)
    root = scratch(spark, "runs")
    sinks.publish_run({"rfm": ft.rfm(win, build_date=BUILD_DATE), "intensity": ft.intensity(win), "shares": ft.seasonality(win)}, root, meta={"build_date": BUILD_DATE})
    run, _ = sinks.read_published(spark, root)
    parts = [run[t].select(F.lit(t).alias("table"), "fk_contact", F.expr(f"stack({len(cols)}, {', '.join(f'{chr(39)}{c}{chr(39)}, CAST({c} AS DOUBLE)' for c in cols)}) AS (name, value)"))
             for t, cols in _RUN_LONG.items()]
    both = reduce(lambda a, b: a.unionByName(b), parts)
    money = F.col("name").isin(*_MONEY)
    return rounded(both.withColumns({"v2": F.when(money, F.col("value")), "v6": F.when(~money, F.col("value"))}), {"v2": 2, "v6": 6}).select(
        "table", "fk_contact", "name", F.coalesce("v2", "v6").alias("value"))


@register("x02_centroid_document", O.q(f"""
SELECT 'original' AS part, CAST(cluster_id AS INTEGER) AS cluster_id, feature, {R('z * (CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END) + m', 6)} AS value, '{BUILD_DATE}' AS run_date
FROM segz JOIN st USING (feature)
UNION ALL SELECT 'mean', NULL, feature, {R('m', 6)}, '{BUILD_DATE}' FROM st WHERE v > 1e-12
UNION ALL SELECT 'std', NULL, feature, {R('CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END', 6)}, '{BUILD_DATE}' FROM st WHERE v > 1e-12
UNION ALL SELECT 'median', CAST(cluster_id AS INTEGER), feature, {R('median(x)', 6)}, '{BUILD_DATE}' FROM flong JOIN seg USING (fk_contact)
  WHERE feature IN ('frequency_12m', 'monetary_gmv_12m', 'recency_days') GROUP BY cluster_id, feature"""))
def x02(spark, sf):
    """The document with run date, centroids in original units, global means and standard deviations, and medians, written and parsed back."""
    from ..operators import reports as rp
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    cz = z.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in zcols])
    some = ["frequency_12m", "monetary_gmv_12m", "recency_days"]
    medians = rp.group_medians(f.join(seg, "fk_contact"), by="cluster_id", cols=some)
    doc = sinks.centroid_document(cz, used_cols=sc.used_cols, model_name="segment", centroids_unstd=sc.inverse(cz).select("cluster_id", *sc.used_cols),
                                  medians=medians, scaler=sc.to_df(spark), run_date=BUILD_DATE, meta={"build_date": BUILD_DATE, "model_version": "v1"})
    path = scratch(spark, "centroids-json")
    sinks.write_json_doc(doc, path)
    shape = "run_date string, centroids_original array<map<string, double>>, medians array<map<string, double>>, global_means map<string, double>, global_stds map<string, double>"
    d = spark.read.text(path).select(F.from_json("value", shape).alias("d")).select("d.*")
    parts = []
    for field, part in (("centroids_original", "original"), ("medians", "median")):
        m = d.select("run_date", F.explode(field).alias("m")).select("run_date", F.col("m")["cluster_id"].cast("int").alias("cluster_id"), F.explode("m").alias("feature", "value"))
        parts.append(m.where("feature <> 'cluster_id'").withColumn("part", F.lit(part)))
    for field, part in (("global_means", "mean"), ("global_stds", "std")):
        parts.append(d.select("run_date", F.lit(None).cast("int").alias("cluster_id"), F.explode(field).alias("feature", "value")).withColumn("part", F.lit(part)))
    return rounded(reduce(lambda a, b: a.unionByName(b), parts), {"value": 6})


def _summary_tables(spark, sf):
    """Overview and top tables written as one table per former workbook sheet; name -> path."""
    from ..operators import reports as rp
    win = window36(spark, sf)
    f = cut_lineage(ft.customer_features(win, build_date=BUILD_DATE), "features")
    seg = segments(spark, sf, f)
    j = win.join(seg, "fk_contact")
    own = f.select("fk_contact", "top_route_out").join(seg, "fk_contact")
    tables = {"overview": rp.cluster_overview(win, seg, name=None),
              "top_routes": rp.top_k_per_group(j, group="cluster_id", value="route_out", k=10, count="orders",
                                               key="nk_ota_localizer_id"),
              "top_companies": rp.top_k_string(j, group="cluster_id", value="fk_departure_ota_bus_company", k=15, out="top_companies"),
              "favourite_routes": rp.top_k_per_group(own, group="cluster_id", value="top_route_out", k=10)}
    return sinks.write_bundle(tables, scratch(spark, "summary"))


@register("x03_summary_tables")
def x03(spark, sf):
    """The overview table, written and read again."""
    return rounded(spark.read.parquet(_summary_tables(spark, sf)["overview"]), {"gmv": 2, "ticket_medio": 2, "freq_media": 6,
                                                                                "pct_clientes": 6, "pct_gmv": 6})


@register("x03b_summary_top_routes")
def x03b(spark, sf):
    """The ten routes of a cluster with most orders, written and read again."""
    out = spark.read.parquet(_summary_tables(spark, sf)["top_routes"])
    return out.withColumn("n", F.col("n").cast("long")).withColumn("rank", F.col("rank").cast("int"))


@register("x03c_summary_top_companies")
def x03c(spark, sf):
    """The fifteen companies of a cluster with most purchases as text, written and read again."""
    return spark.read.parquet(_summary_tables(spark, sf)["top_companies"])


@register("x03d_summary_favourite_routes", O.q("""
SELECT cluster_id, top_route_out, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, top_route_out) AS rank FROM (
    SELECT s.cluster_id, f.top_route_out, count(*) AS n FROM feat f JOIN seg s USING (fk_contact)
    WHERE f.top_route_out IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 10"""))
def x03d(spark, sf):
    """The routes that most customers of a cluster have as their own top route."""
    out = spark.read.parquet(_summary_tables(spark, sf)["favourite_routes"])
    return out.withColumn("n", F.col("n").cast("long")).withColumn("rank", F.col("rank").cast("int"))


def _stored_run(spark, sf):
    """A published clustering run (segments as clusters) and the artefacts made from it: (tables, used columns)."""
    from .segmentation import artifacts_from_run
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    cz = z.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in zcols])
    metrics = spark.createDataFrame([(5, 1.0, 0.5, "kmeans", 42, True)], "k int, inertia double, silhouette double, algorithm string, random_state int, is_final boolean")
    root = scratch(spark, "clustering-runs")
    sinks.publish_run({"centroids_z": cz, "assignments": seg, "metrics": metrics, "scaler": sc.to_df(spark),
                       "customer_features": f.select("fk_contact", "top_route_out", "top_company_out")}, root)
    out = scratch(spark, "artefacts")
    artifacts_from_run(spark, root, out, used_cols=sc.used_cols, build_date=BUILD_DATE, model_version="v1", run_date=BUILD_DATE)
    return sinks.read_published(spark, out)[0], sc


@register("x03e_summary_centroids")
def x03e(spark, sf):
    """From a stored run to its artefacts: centroids (z and original units) and labels of the written summary."""
    run, sc = _stored_run(spark, sf)
    z = run["labels"].select("cluster_id", "feature", "z", "label")
    cols = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in sc.used_cols)
    x = run["centroids_unstd"].select("cluster_id", F.expr(f"stack({len(sc.used_cols)}, {cols}) AS (feature, value)"))
    named = run["glossary"].select("feature", "alias")
    return rounded(z.join(x, ["cluster_id", "feature"]).join(named, "feature").select("cluster_id", "feature", "alias", "z", "label", "value"), {"z": 6, "value": 6})


@register("x03f_summary_assignments")
def x03f(spark, sf):
    """From a stored run to its artefacts: every customer's export row and cluster name as written."""
    run, _ = _stored_run(spark, sf)
    export = run["assignment_export"]
    return export.join(run["assignments"].select("fk_contact", "cluster_name"), "fk_contact").join(
        run["overview"].select(F.col("cluster_id").cast("bigint").alias("cluster_id"), "n_customers"), "cluster_id").select(
        "fk_contact", "cluster_id", "k", "algorithm", "build_date", "run_date", "model_version", "cluster_name", "n_customers")


@register("x05_silver_table", O.q(f"""
, sv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fk_contact, purchase_datetime ORDER BY gmv_success NULLS LAST, _row_id) AS r FROM prep) WHERE r = 1)
SELECT _row_id, fk_contact, purchase_datetime, trim(place_origin_departure) || '->' || trim(place_destination_departure) AS route_out,
  CAST(place_origin_return IS NOT NULL AND place_destination_return IS NOT NULL AS INTEGER) AS has_return,
  CAST(coalesce(place_origin_return IS NOT NULL AND place_destination_return IS NOT NULL AND total_tickets_quantity_success >= 2, false) AS INTEGER) AS has_return_strict,
  {R('gmv_success', 2)} AS gmv_success, {R('avg_price_per_ticket', 6)} AS avg_price_per_ticket,
  CAST(coalesce(avg_price_per_ticket > (SELECT quantile_cont(avg_price_per_ticket, 0.99) FROM sv), false) AS INTEGER) AS is_price_outlier_p99 FROM sv"""))
def x05(spark, sf):
    """The table that repurchase labels start from, out of raw purchases."""
    from .segmentation import silver_table
    out = silver_table(testdata.purchases(spark, sf), tz="UTC")
    return rounded(out.select("_row_id", "fk_contact", "purchase_datetime", "route_out", F.col("has_return").cast("int").alias("has_return"),
                              F.col("has_return_strict").cast("int").alias("has_return_strict"), "gmv_success", "avg_price_per_ticket", "is_price_outlier_p99"),
                   {"gmv_success": 2, "avg_price_per_ticket": 6})


# == streaming ===============================================================
def _raw_files(spark, sf, n_files: int = 4):
    path = scratch(spark, "raw-files")
    raw = testdata.purchases(spark, sf)
    raw.repartition(n_files, "_row_id").write.parquet(path)
    return path, spark.read.parquet(path).schema


_STREAMED = ["fk_contact", "nk_ota_localizer_id", "route_out", "route_return"]
_ROUTE3 = "CASE WHEN stage0 IN ('audit', 'invalid') THEN stage0 ELSE 'valid' END"


@register("m01_chunked_ingest", O.q(f"SELECT _row_id AS line_no, {', '.join(_STREAMED)}, purchase_datetime, {R('gmv_success', 2)} AS gmv_success, "
                                    f"{R('avg_price_per_ticket', 6)} AS avg_price_per_ticket, {_ROUTE3} AS route FROM stage"))
def m01(spark, sf):
    """CSV files with two headers, a few per micro-batch, cleaned and routed; every row compared."""
    src, sink = scratch(spark, "stream-csv"), scratch(spark, "stream-sink")
    _csv_files(testdata.purchases(spark, sf).repartition(4, "_row_id"), src, keep_line=True)
    ingest.stream_clean(spark, source=src, sink=sink, checkpoint=scratch(spark, "stream-ckpt"), fmt="csv", tz="UTC", max_files_per_trigger=3)
    back = spark.read.parquet(sink)
    return rounded(back.select(F.col("line_no").cast("bigint").alias("line_no"), *_STREAMED, "purchase_datetime", "gmv_success", "avg_price_per_ticket", "route"),
                   {"gmv_success": 2, "avg_price_per_ticket": 6})


@register("m02_append_sink", O.q(f"SELECT _row_id, {', '.join(_STREAMED)}, purchase_datetime, {R('gmv_success', 2)} AS gmv_success, total_tickets_quantity_success FROM prep"))
def m02(spark, sf):
    """Micro-batches appended by batch id; every row compared."""
    src, schema = _raw_files(spark, sf)
    sink = scratch(spark, "stream-append")
    cols = ["_row_id", *_STREAMED, "purchase_datetime", "gmv_success", "total_tickets_quantity_success"]
    ingest.stream_append(spark, source=src, sink=sink, checkpoint=scratch(spark, "stream-append-ckpt"), source_schema=schema,
                         transform=lambda d: cl.prepare(d, tz="UTC").select(*cols))
    return rounded(spark.read.parquet(sink).select(*cols), {"gmv_success": 2})


# == small operators ==========================================================
@register("f04_min_rows_warn", O.q("SELECT CAST(count(*) AS BIGINT) AS rows, count(*) < 10000 AS warned FROM win"))
def f04(spark, sf):
    win, obs = observe_rows(window36(spark, sf))
    win.write.format("noop").mode("overwrite").save()          # the metric rides on this action
    warned = warn_if_small(obs, 10000)
    return spark.createDataFrame([(int(obs.get["rows"]), warned)], "rows long, warned boolean")


@register("f10_datetime_fallback", O.q(
    "SELECT _row_id FROM clean WHERE date_purchase >= DATE '1998-07-01' AND date_purchase < DATE '2001-07-02'"))
def f10(spark, sf):
    clean = routed(spark, sf, n_buckets=None).clean.drop("purchase_datetime")
    return observation_window(clean, build_date=BUILD_DATE, months=36).select("_row_id")


@register("a14_pct_festive", O.q(", " + _EASTER.strip().replace("FROM prep", "FROM win") + f"""
, wf AS (SELECT w.fk_contact, CAST(strftime(f.d, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02',
       '11-15', '12-25') OR (strftime(f.d, '%m-%d') = '11-20' AND year(f.d) >= 2024) OR f.d = f.easter - 2
       OR (month(f.d) = 12 AND day(f.d) >= 20) OR (month(f.d) = 1 AND day(f.d) <= 5) OR month(f.d) = 6
       OR abs(date_diff('day', f.easter - 47, f.d)) <= 2 AS INTEGER) AS fest
       FROM win w JOIN fest f USING (_row_id))
SELECT fk_contact, {R('avg(fest)', 6)} AS pct_festive_period FROM wf GROUP BY fk_contact"""))
def a14(spark, sf):
    win = cl.with_festive_period(window36(spark, sf))
    return rounded(ft.mean_flag(win, by="fk_contact", flag="is_festive_period", name="pct_festive_period"),
                   {"pct_festive_period": 6})


_ZEROS = [c for c in O.NUM_FEATURES if c not in ft.AMOUNTS and c != "recency_days"]


@register("p20_type_fill", O.q(
    "SELECT CAST(c_custkey AS VARCHAR) AS fk_contact, top_route_out, top_company_out, recency_days, "
    + ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" if c in ft.ZERO_COUNTS else f"{R(f'coalesce({c}, 0)', 6)} AS {c}" for c in _ZEROS)
    + "".join(f", {R(c, 2)} AS {c}" for c in ft.AMOUNTS) + " FROM customer LEFT JOIN feat ON fk_contact = CAST(c_custkey AS VARCHAR)"))
def p20(spark, sf):
    """Features of every customer of ``customer``: those without a purchase in the window have no block and are filled."""
    everyone = testdata.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("fk_contact"))
    wide = everyone.join(customer_features_raw(spark, sf), "fk_contact", "left")
    out = ft.fill_and_type(wide).select("fk_contact", "top_route_out", "top_company_out", "recency_days", *_ZEROS, *ft.AMOUNTS)
    return rounded(out, {c: 6 for c in _ZEROS if c not in ft.ZERO_COUNTS} | {c: 2 for c in ft.AMOUNTS})


@register("p21_stamp_meta", O.q("SELECT fk_contact, build_date, model_version FROM feat"))
def p21(spark, sf):
    return customer_features_raw(spark, sf).select("fk_contact", "build_date", "model_version")


def _names_case():
    whens = " ".join("WHEN {} THEN '{}'".format(k, v) for k, v in NOTEBOOK_CLUSTER_NAMES.items())
    return f"CASE cluster_id {whens} END"


@register("p22_map_names", O.q(f"SELECT fk_contact, cluster_id, {_names_case()} AS cluster_name FROM seg"))
def p22(spark, sf):
    f = customer_features_raw(spark, sf)
    seg = segments(spark, sf, f)
    m = F.create_map(*[x for k, v in NOTEBOOK_CLUSTER_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return seg.withColumn("cluster_name", m[F.col("cluster_id")])


# == remaining inventory ids (j03, j08, r04, w01) ==================================
@register("j03_inner_total", O.q(
    f"SELECT fk_contact, route_out, CAST(n AS BIGINT) AS n, {R('n / sum(n) OVER (PARTITION BY fk_contact)', 6)} AS share "
    "FROM (SELECT fk_contact, route_out, count(DISTINCT nk_ota_localizer_id) AS n FROM win "
    "WHERE route_out IS NOT NULL AND nk_ota_localizer_id IS NOT NULL AND fk_contact IS NOT NULL GROUP BY 1, 2)"))
def j03(spark, sf):
    win = window36(spark, sf).where("route_out IS NOT NULL AND nk_ota_localizer_id IS NOT NULL "
                                    "AND fk_contact IS NOT NULL")
    counts = win.select("fk_contact", "route_out", "nk_ota_localizer_id").distinct() \
        .groupBy("fk_contact", "route_out").agg(F.count(F.lit(1)).alias("n"))
    return rounded(ft.share_of_group_total(counts, by="fk_contact", value="n"), {"share": 6})


@register("j08_asof_prev_next", O.q(""", days AS (SELECT trim(fk_contact) AS fk_contact, CAST(purchase_datetime AS DATE) AS d
  FROM pevents WHERE trim(fk_contact) IS NOT NULL AND purchase_datetime IS NOT NULL GROUP BY 1, 2),
firsts AS (SELECT fk_contact, min(d) AS first_d FROM days GROUP BY 1),
obs AS (SELECT max(d) AS obs_end FROM days),
grid AS (SELECT f.fk_contact, CAST(unnest(generate_series(CAST(f.first_d + 7 AS TIMESTAMP),
           CAST(o.obs_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ref_date
          FROM firsts f, obs o WHERE f.first_d + 7 <= o.obs_end)
SELECT g.fk_contact, g.ref_date,
  (SELECT max(d) FROM days x WHERE x.fk_contact = g.fk_contact AND x.d <= g.ref_date) AS last_purchase_dt,
  (SELECT min(d) FROM days x WHERE x.fk_contact = g.fk_contact AND x.d > g.ref_date) AS next_purchase_dt
FROM grid g"""))
def j08(spark, sf):
    from ..operators import labels as lb
    from .catalog_models import purchase_days
    return lb.asof_prev_next(purchase_days(spark, sf), min_history_days=7)


_FLAGS = ["A", "N", "R"]


@register("r04_crosstab_share", O.q(
    "SELECT CAST(o_custkey AS VARCHAR) AS fk_contact, "
    + ", ".join(f"{R(f'sum(CASE WHEN l_returnflag = {chr(39)}{v}{chr(39)} THEN 1 ELSE 0 END) / count(l_returnflag)', 6)}"
                f" AS pct_flag_{v}" for v in _FLAGS)
    + " FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"))
def r04(spark, sf):
    li = testdata.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    od = testdata.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                   F.col("o_custkey").cast("string").alias("fk_contact"))
    out = ft.category_share(li.join(od, "l_orderkey"), by="fk_contact", category="l_returnflag", values=_FLAGS,
                            names=[f"pct_flag_{v}" for v in _FLAGS])
    return rounded(out, {f"pct_flag_{v}": 6 for v in _FLAGS})


@register("w01_rank_per_group", O.q(
    "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1"))
def w01(spark, sf):
    """First row per group by priority (latest order, then largest total, then lowest key) via the
    map-side combined winner aggregate — no window over a possibly hot group."""
    od = testdata.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    first = cl.first_rows(od, key="o_custkey", order=[("o_orderdate", "desc"), ("o_totalprice", "desc")], row_id="o_orderkey")
    return first.select("o_custkey", "o_orderkey", "o_orderdate")


# == oracles for entries first registered rows-only =============================
def _add_oracles():
    from . import catalog
    from .catalog_models import _names_sql, _OVERVIEW, _labels_sql

    feats = O.NUM_FEATURES
    lab = ("CASE WHEN z IS NULL OR isnan(z) THEN 'Médio' WHEN z <= -0.5 THEN 'Baixo' WHEN z >= 0.5 THEN 'Alto' "
           "ELSE 'Médio' END")
    pivot_lab = ", ".join(f"max(CASE WHEN feature = '{f}' THEN {lab} END) AS label__{f}" for f in feats)
    pivot_z = ", ".join(f"max(CASE WHEN feature = '{f}' THEN {R('z', 6)} END) AS {f}_z" for f in feats)
    pivot_x = ", ".join(f"max(CASE WHEN feature = '{f}' THEN {R('z * (CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END) + m', 6)} END)"
                        f" AS {f}" for f in feats)
    extra = {
        "t06_head": "SELECT _row_id, fk_contact FROM clean ORDER BY _row_id LIMIT 10",
        "s04_first_existing": "SELECT o_orderkey FROM orders",
        "s05_load_artifacts": "SELECT fk_contact, cluster_id FROM seg",
        "r02_pivot_labels": f"SELECT cluster_id, {pivot_lab} FROM segz GROUP BY cluster_id",
        "r03_pivot_z": f"SELECT cluster_id, {pivot_z} FROM segz GROUP BY cluster_id",
        "l04_centroid_summary": (
            f", zw AS (SELECT cluster_id, {pivot_z}, {pivot_lab} FROM segz GROUP BY cluster_id), "
            f"xw AS (SELECT cluster_id, {pivot_x} FROM segz JOIN st USING (feature) GROUP BY cluster_id) "
            f"SELECT zw.*, xw.* EXCLUDE (cluster_id), '{BUILD_DATE}' AS build_date, 'v1' AS model_version "
            "FROM zw JOIN xw USING (cluster_id)"),
        "l08_run_labeling": _names_sql() + "SELECT fk_contact, cluster_id, cluster_name FROM seg "
                                           "LEFT JOIN names USING (cluster_id)",
        "x03_summary_tables": _OVERVIEW + "SELECT * FROM ovs",
        "x03e_summary_centroids": _names_sql() + f"SELECT CAST(cluster_id AS INTEGER) AS cluster_id, feature, alias, {R('z', 6)} AS z, {lab} AS label, "
                                  f"{R('z * (CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END) + m', 6)} AS value FROM segz JOIN st USING (feature) JOIN pr USING (feature)",
        "x03f_summary_assignments": _names_sql() + f"SELECT fk_contact, CAST(seg.cluster_id AS BIGINT) AS cluster_id, 5 AS k, 'kmeans' AS algorithm, DATE '{BUILD_DATE}' AS build_date, "
                                    f"DATE '{BUILD_DATE}' AS run_date, 'v1' AS model_version, cluster_name, n AS n_customers FROM seg LEFT JOIN names USING (cluster_id) "
                                    "JOIN (SELECT cluster_id, count(*) AS n FROM seg GROUP BY 1) USING (cluster_id)",
    }
    catalog.ORACLES["x03b_summary_top_routes"] = catalog.ORACLES["t02_topk_per_group"]
    catalog.ORACLES["x03c_summary_top_companies"] = catalog.ORACLES["t03_topk_string"]
    for k, body in extra.items():
        catalog.ORACLES[k] = O.q(body)
    catalog.ORACLES["s11_append_batches"] = _labels_sql(7, (3, 7), weekly=False)


_add_oracles()
