"""End-to-end flows: segmentation (clean -> window -> features -> z -> k-means -> names -> reports)
and repurchase labels. Each step is a library operator; the only driver barriers are the
scaler statistics, the k-means fits, the k choice and the writes.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_SCHEMA, PurchaseSchema
from ..functions import cleaning as fx
from ..operators import cleaning as cl
from ..operators import cluster as km
from ..operators import features as ft
from ..operators import labels as lb
from ..operators import naming as nm
from ..operators import reports as rp
from ..operators import standardize as zs
from ..operators.window import observation_window
from ..session import cut_lineage
from ..sources import sinks


def run_clustering(df_std: DataFrame, *, used_cols, id_col: str = "fk_contact", suffix: str = config.Z_SUFFIX,
                   ks=config.DEFAULT_K_VALUES, algorithm: str = "kmeans", seed: int = config.DEFAULT_SEED,
                   n_init: int = config.DEFAULT_N_INIT, max_iter: int = config.DEFAULT_MAX_ITER,
                   scaler: zs.Scaler | None = None) -> dict:
    """k11: evaluate k -> choose k -> final fit -> assignments, centroids (z and original), metrics."""
    zcols = [f"{c}{suffix}" for c in used_cols]
    vec = cut_lineage(km.assemble(df_std.select(id_col, *zcols), zcols).select(id_col, "features"), "vectors")
    metrics, fits, _ = km.evaluate_fits(vec, ks=ks, seed=seed, n_init=n_init, max_iter=max_iter, algorithm=algorithm)
    k = int(km.choose_k(metrics).collect()[0]["k"])
    fit = fits[k]
    pred = fit.model.transform(vec).select(id_col, "prediction")
    sizes = pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("_n")).collect()      # k rows
    order = sorted(sizes, key=lambda r: (-r["_n"], r["prediction"]))
    id_map = {r["prediction"]: i for i, r in enumerate(order)}
    id_map |= {c: len(id_map) + i for i, c in enumerate(c for c in range(len(fit.model.centers)) if c not in id_map)}   # centres without rows come last
    mapping = vec.sparkSession.createDataFrame(list(id_map.items()), "prediction int, cluster_id int")
    assignments = pred.join(F.broadcast(mapping), "prediction").select(id_col, "cluster_id")
    spark = vec.sparkSession
    cz = km.centers_table(fit.model, used_cols=used_cols, suffix=suffix, spark=spark, id_map=id_map)
    out = {"assignments": assignments, "centroids_z": cz, "k": k,
           "metrics": metrics.withColumns({"algorithm": F.lit(km.normalize_algorithm(algorithm)),
                                           "random_state": F.lit(seed), "is_final": F.col("k") == k})}
    if scaler is not None:
        out["centroids_unstd"] = scaler.inverse(cz).select("cluster_id", *used_cols)
    return out


def run_labeling(*, centroids_z: DataFrame, used_cols, assignments: DataFrame | None = None,
                 centroids_unstd: DataFrame | None = None, metrics: DataFrame | None = None,
                 id_col: str = "fk_contact", low: float = config.LOW_THRESHOLD, high: float = config.HIGH_THRESHOLD,
                 max_fragments: int = config.MAX_FRAGMENTS, aliases=None, priority=None, meta=None) -> dict:
    """l08: labels, names, centroid summary and named assignments."""
    labels = nm.centroid_labels(centroids_z, used_cols=used_cols, low=low, high=high)
    names = nm.cluster_names(labels, used_cols=used_cols, aliases=aliases, priority=priority,
                             max_fragments=max_fragments)
    meta = dict(meta or {})
    if metrics is not None:
        m = nm.metadata_from_metrics(metrics).collect()
        if m:
            meta.update({k: v for k, v in m[0].asDict().items() if v is not None})
    out = {"centroid_labels": labels, "cluster_names": names,
           "centroid_summary": nm.centroid_summary(centroids_z, labels, centroids_unstd=centroids_unstd, meta=meta,
                                                   features=used_cols)}
    if assignments is not None:
        out["assignments_named"] = nm.named_assignments(assignments, names, id_col=id_col)
    return out


def run_segmentation(raw: DataFrame, *, out_dir: str | None = None, build_date=config.DEFAULT_BUILD_DATE,
                     months: int = config.DEFAULT_WINDOW_MONTHS, tz: str | None = config.DEFAULT_TZ,
                     model_version: str = config.DEFAULT_MODEL_VERSION, cluster_vars=None,
                     ks=config.DEFAULT_K_VALUES, n_init: int = config.DEFAULT_N_INIT,
                     max_iter: int = config.DEFAULT_MAX_ITER, top_n: int = config.DEFAULT_TOP_N, full_calendar: bool = False) -> dict:
    """E1: the whole segmentation run; writes every table under ``out_dir`` when given.

    ``full_calendar``: the full feature table (month, weekday, week-of-month and festive shares too) and its correlations.
    """
    timing = {}
    t0 = time.time()
    routed = cl.route_rows(cl.prepare(raw, tz=tz))
    if out_dir:
        routed = routed.materialize(f"{out_dir}/cleaning")
    timing["cleaning"] = time.time() - t0
    win = observation_window(routed.clean, build_date=build_date, months=months)
    blocks = [ft.calendar_block] if full_calendar else []
    feats = cut_lineage(ft.customer_features(win, build_date=build_date, model_version=model_version, extra_blocks=blocks), "features")
    timing["features"] = time.time() - t0
    cols = cluster_vars or zs.numeric_feature_columns(feats)
    scaler = zs.fit_scaler(feats, cols=cols)
    std = scaler.transform(feats)
    clus = run_clustering(std, used_cols=scaler.used_cols, ks=ks, n_init=n_init, max_iter=max_iter, scaler=scaler)
    timing["clustering"] = time.time() - t0
    lab = run_labeling(centroids_z=clus["centroids_z"], used_cols=scaler.used_cols, assignments=clus["assignments"],
                       centroids_unstd=clus.get("centroids_unstd"), metrics=clus["metrics"],
                       meta={"build_date": str(build_date), "model_version": model_version})
    named = lab["assignments_named"]
    overview = rp.cluster_overview(win, named)
    top_routes = rp.top_k_per_group(win.join(named, "fk_contact"), group="cluster_name", value="route_out", k=10,
                                    count="orders", key="nk_ota_localizer_id")
    top_companies = rp.top_k_string(win.join(named, "fk_contact"), group="cluster_name",
                                    value="fk_departure_ota_bus_company", k=top_n)
    tables = {"customer_features": feats, "customer_features_standardized": std, "scaler": scaler.to_df(raw.sparkSession),
              "assignments": clus["assignments"], "centroids_z": clus["centroids_z"],
              "centroids_unstd": clus.get("centroids_unstd"), "metrics": clus["metrics"], **lab,
              "correlations": rp.correlation_long(feats, zs.numeric_feature_columns(feats)),
              "overview": overview, "top_routes": top_routes, "top_companies": top_companies}
    if out_dir:
        sinks.write_bundle(tables, out_dir)
        timing["total"] = time.time() - t0
        sinks.append_run(raw.sparkSession, f"{out_dir}/runs", params={"build_date": build_date, "months": months,
                                                                       "ks": list(ks), "k": clus["k"]},
                         timing_s=timing)
    tables["k"] = clus["k"]
    tables["timing"] = timing
    return tables


def run_repurchase(purchases: DataFrame, *, contact: str = "fk_contact", ts: str = "purchase_datetime",
                   freq: str = "D", min_history_days: int = config.DEFAULT_MIN_HISTORY_DAYS,
                   horizons=config.DEFAULT_HORIZONS, out_path: str | None = None) -> DataFrame:
    """E3: purchase days -> label grid; written partitioned by reference month when a path is given."""
    days = lb.purchase_days(purchases, contact=contact, ts=ts)
    labels = lb.repurchase_labels(days, contact=contact, freq=freq, min_history_days=min_history_days,
                                  horizons=horizons)
    if out_path:
        labels.withColumn("ref_month", F.date_format("ref_date", "yyyy-MM")).hint("rebalance", "ref_month") \
            .write.mode("overwrite").partitionBy("ref_month").parquet(out_path)
    return labels


def silver_table(raw: DataFrame, *, tz: str | None = config.DEFAULT_TZ, p: float = 0.99, accuracy: int | None = None,
                 schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    """E3, first half: raw purchases -> the table that repurchase labels start from.

    Wall-clock times that the zone does not have or has twice are NULL; ``has_return`` needs both return ends
    (``has_return_strict`` also two tickets); the route is ``origin->destination`` of trimmed names; of each (contact, datetime)
    the row of lowest gmv stays; prices above the quantile ``p`` of all kept rows are flagged, not removed.
    """
    s = schema
    rows = cl.prepare(raw, schema=s, tz=tz, gap="null", overlap="null", strict=False)
    rows = rows.withColumns({
        "has_return_relaxed": F.col(s.has_return),
        "has_return_strict": fx.has_return(s.origin_ret, s.dest_ret, s.tickets, strict=True),
        s.route_out: fx.route(s.origin_out, s.dest_out, sep="->", trim=True)})
    kept = cut_lineage(cl.distinct_contact_time(rows, schema=s), "silver")       # read twice: threshold and flag
    return cl.p99_flag(kept, col=s.avg_price, p=p, accuracy=accuracy)


def artifacts_from_run(spark, run_root: str, out_root: str, *, used_cols, run_id: str | None = None, model_name: str = "kmeans",
                       build_date=config.DEFAULT_BUILD_DATE, model_version: str = config.DEFAULT_MODEL_VERSION, run_date=None,
                       top_n: int = config.DEFAULT_TOP_N) -> str:
    """E4: one call from a published clustering run to all of its artefacts, published in turn; returns the new run id.

    Reads ``centroids_z`` and, where the run has them, ``centroids_unstd``, ``assignments``, ``metrics``, ``scaler`` and
    ``customer_features``; labels and names the clusters again; writes the centroid document, the assignment export and the
    tables of the summary (overview, centroids, labels, names, named assignments, top values, glossary). Centroids in original units are
    computed from the scaler's parameters if the run lacks them. A run without ``centroids_z`` is an error.
    """
    run, meta = sinks.read_published(spark, run_root, run_id=run_id)
    if "centroids_z" not in run:
        raise ValueError("the stored run has no centroids_z")
    unstd, scaler = run.get("centroids_unstd"), run.get("scaler")
    if unstd is None and scaler is not None:
        unstd = zs.Scaler.from_df(scaler).inverse(run["centroids_z"]).select("cluster_id", *used_cols)
    lab = run_labeling(centroids_z=run["centroids_z"], used_cols=used_cols, assignments=run.get("assignments"), centroids_unstd=unstd,
                       metrics=run.get("metrics"), meta={"build_date": str(build_date), "model_version": model_version})
    facts = lab["centroid_summary"].limit(1).collect()[0].asDict() if run.get("metrics") is not None else {}
    stats = {c: facts[c] for c in ("k", "algorithm", "random_state") if facts.get(c) is not None}
    doc = sinks.centroid_document(run["centroids_z"], used_cols=used_cols, model_name=model_name, centroids_unstd=unstd, scaler=scaler,
                                  run_date=run_date, meta={**stats, "build_date": str(build_date), "model_version": model_version})
    tables = {"centroid_document": doc, "centroids_z": run["centroids_z"], "centroids_unstd": unstd, "labels": lab["centroid_labels"],
              "cluster_names": lab["cluster_names"], "centroid_summary": lab["centroid_summary"], "metrics": run.get("metrics"),
              "glossary": nm.glossary(spark, used_cols)}
    if run.get("assignments") is not None:
        named = lab["assignments_named"]
        tables["assignments"] = named
        tables["overview"] = rp.count_by_key(named, "cluster_id", name="n_customers")
        tables["assignment_export"] = sinks.assignment_export(
            run["assignments"], k=int(stats.get("k", 0)), algorithm=str(stats.get("algorithm", "")), build_date=build_date,
            model_version=model_version, run_date=run_date or build_date)
        if run.get("customer_features") is not None:
            own = run["customer_features"].join(named.select("fk_contact", "cluster_id"), "fk_contact")
            tops = [rp.top_k_string(own, group="cluster_id", value=c, k=top_n, out="top").withColumn("metric", F.lit(c))
                    for c in ("top_route_out", "top_company_out") if c in own.columns]
            if tops:
                tables["top"] = reduce(lambda a, b: a.unionByName(b), tops)
    return sinks.publish_run(tables, out_root, meta={**meta, "source_run": run_root})
