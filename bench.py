"""Headline-query benchmark: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is executed in full through a ``noop`` write (no collect); timings include the
driver-side barriers a query has (scaler statistics, percentile materialisation, k-means fits).
at the target scale; each query reports its median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cohortlens.operators import cleaning as cl  # noqa: E402
from cohortlens.operators import cluster as km  # noqa: E402
from cohortlens.operators import features as ft  # noqa: E402
from cohortlens.operators import labels as lb  # noqa: E402
from cohortlens.operators import reports as rp  # noqa: E402
from cohortlens.operators import standardize as zs  # noqa: E402
from cohortlens.operators.window import observation_window  # noqa: E402
from cohortlens.plans import oracle_sql as O  # noqa: E402
from cohortlens.plans.catalog_models import segments  # noqa: E402
from cohortlens.session import cut_lineage, local_session  # noqa: E402
from cohortlens.sources import testdata  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df):
    df.write.format("noop").mode("overwrite").save()


def run_all(spark, sf_dir):
    """One pass over the headline queries; returns {query: seconds}."""
    times = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = time.time() - t0
        return out

    raw = testdata.purchases(spark, sf_dir)
    root = spark.conf.get("spark.checkpoint.dir")

    def clean_route():
        r = cl.route_rows(cl.prepare(raw, tz="UTC"))
        r = r.materialize(f"{root}/bench-routed-{time.time_ns()}")
        run(r.counts())
        return r

    routed = timed("clean_route", clean_route)
    win = observation_window(routed.clean, build_date=O.BUILD_DATE, months=36)

    feats = timed("customer_features", lambda: cut_lineage(
        ft.customer_features(win, build_date=O.BUILD_DATE), "bench-features"))

    def labels():
        days = lb.purchase_days(testdata.purchase_events(spark, sf_dir))
        run(lb.repurchase_labels(days, freq="D", min_history_days=7, horizons=(3, 7)))

    timed("repurchase_labels", labels)

    def zscore():
        sc = zs.fit_scaler(feats, cols=O.NUM_FEATURES)
        z = cut_lineage(sc.transform(feats), "bench-z")
        return sc, z

    sc, z = timed("zscore_fit_apply", zscore)

    def kmeans_eval():
        zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
        vec = cut_lineage(km.assemble(z.select("fk_contact", *zcols), zcols).select("fk_contact", "features"),
                          "bench-vec")
        m = km.evaluate_k(vec, ks=list(range(2, 11)), n_init=1, max_iter=50)
        return km.choose_k(m).collect()

    timed("kmeans_k2_10", kmeans_eval)

    def topk():
        seg = segments(spark, sf_dir, feats)
        j = win.join(seg, "fk_contact")
        run(rp.top_k_per_group(j, group="cluster_id", value="route_out", k=10, count="orders",
                               key="nk_ota_localizer_id"))

    timed("top10_per_cluster", topk)
    return times


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2)
    # warm-up pass on the smallest scale (JIT, codegen caches, parquet footers) - not timed
    run_all(spark, os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001"))
    runs = [run_all(spark, SF_DIR) for _ in range(int(os.environ.get("BENCH_REPEATS", "3")))]
    times = {q: round(statistics.median(r[q] for r in runs), 3) for q in runs[0]}
    total = round(sum(times.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_of_%d" % len(runs), "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
