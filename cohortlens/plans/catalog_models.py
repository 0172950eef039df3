"""Registered queries, part 2: repurchase labels, standardisation, clustering, naming, reports.

Report and naming oracles need clusters that SQL can reproduce, so those queries take the
customers' market segment (from the ``customer`` table) as the cluster assignment; the k-means
queries themselves (k01, k02, k05, k09-k11) return facts of the fit that SQL can state.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config
from ..operators import cleaning as cl
from ..operators import cluster as km
from ..operators import features as ft
from ..operators import labels as lb
from ..operators import lloyd
from ..operators import naming as nm
from ..operators import reports as rp
from ..operators import standardize as zs
from ..session import cut_lineage
from ..sources import testdata
from . import oracle_sql as O
from .catalog import _EASTER, BUILD_DATE, FESTIVE_SQL, _share_sql, customer_features_raw, prep, register, rnd, rounded, routed, window36

NUM = O.NUM_FEATURES
CLUSTER_VARS = ["frequency_12m", "n_unique_routes_out", "avg_price_per_ticket", "top_route_out_share",
                "top_company_out_share"]


def R(expr: str, d: int) -> str:
    """SQL twin of ``catalog.rnd``."""
    return f"(floor(({expr}) * 1e{d} + 0.5 + 1e-6) / 1e{d})"


# -- shared inputs -----------------------------------------------------------
def feats(spark, sf):
    """Customer features, computed once: fits, scoring and joins read the written table."""
    return cut_lineage(customer_features_raw(spark, sf), "features")


def scaler_and_feats(spark, sf):
    f = feats(spark, sf)
    return zs.fit_scaler(f, cols=NUM), f


def segments(spark, sf, f):
    """Cluster stand-in: the customer's market segment, numbered 0.. in name order."""
    cust = testdata.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("fk_contact"), "c_mktsegment")
    segs = cust.select("c_mktsegment").distinct()
    segs = segs.withColumn("cluster_id", (F.dense_rank().over(Window.orderBy("c_mktsegment")) - 1).cast("int"))
    return f.select("fk_contact").join(cust, "fk_contact").join(F.broadcast(segs), "c_mktsegment") \
        .select("fk_contact", "cluster_id")


def z_wide(spark, sf):
    sc, f = scaler_and_feats(spark, sf)
    return sc, sc.transform(f, keep=True), f


def segment_centroids_z(spark, sf):
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    cz = z.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in zcols])
    return sc, cz, seg, z


def purchase_days(spark, sf):
    return lb.purchase_days(testdata.purchase_events(spark, sf), contact="fk_contact", ts="purchase_datetime")


# == repurchase labels (a23, w02-w07) =========================================
_DAYS = ("days AS (SELECT trim(fk_contact) AS fk_contact, CAST(purchase_datetime AS DATE) AS d, count(*) AS c "
         "FROM pevents WHERE trim(fk_contact) IS NOT NULL AND purchase_datetime IS NOT NULL GROUP BY 1, 2)")


@register("a23_purchase_days", O.q(f", {_DAYS} SELECT fk_contact, d AS purchase_dt, CAST(c AS BIGINT) AS cnt_day "
                                   "FROM days"))
def a23(spark, sf):
    return purchase_days(spark, sf)


@register("w02_cumulative_count", O.q(
    f", {_DAYS} SELECT fk_contact, d AS purchase_dt, CAST(sum(c) OVER (PARTITION BY fk_contact ORDER BY d ROWS "
    "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_purchases_life FROM days"))
def w02(spark, sf):
    return lb.with_day_links(purchase_days(spark, sf)).select("fk_contact", "purchase_dt", "n_purchases_life")


@register("w03_next_prev_purchase", O.q(
    f", {_DAYS} SELECT fk_contact, d AS purchase_dt, lag(d) OVER (PARTITION BY fk_contact ORDER BY d) AS "
    "prev_purchase_dt, lead(d) OVER (PARTITION BY fk_contact ORDER BY d) AS next_purchase_dt FROM days"))
def w03(spark, sf):
    return lb.with_day_links(purchase_days(spark, sf)).select(
        "fk_contact", "purchase_dt", "prev_purchase_dt", "next_purchase_dt")


def _labels_sql(min_hist: int, horizons, weekly: bool) -> str:
    mon = " AND isodow(t) = 1" if weekly else ""
    ys = ", ".join(
        f"CAST(coalesce(date_diff('day', ref_date, next_dt) > 0 AND date_diff('day', ref_date, next_dt) <= {h}, "
        f"false) AS BIGINT) AS y_buy_{h}d" for h in horizons)
    return O.q(f""", {_DAYS},
firsts AS (SELECT fk_contact, min(d) AS first_d FROM days GROUP BY 1),
obs AS (SELECT max(d) AS obs_end FROM days),
grid0 AS (SELECT f.fk_contact, CAST(unnest(generate_series(CAST(f.first_d + {min_hist} AS TIMESTAMP),
           CAST(o.obs_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS t
          FROM firsts f, obs o WHERE f.first_d + {min_hist} <= o.obs_end),
grid AS (SELECT fk_contact, t AS ref_date FROM grid0 WHERE true{mon}),
lab AS (SELECT g.fk_contact, g.ref_date,
  (SELECT max(d) FROM days x WHERE x.fk_contact = g.fk_contact AND x.d <= g.ref_date) AS last_purchase_dt,
  (SELECT min(d) FROM days x WHERE x.fk_contact = g.fk_contact AND x.d > g.ref_date) AS next_dt,
  (SELECT sum(c) FROM days x WHERE x.fk_contact = g.fk_contact AND x.d <= g.ref_date) AS n_life
  FROM grid g)
SELECT fk_contact, ref_date, {ys + ', ' if ys else ''}date_diff('day', ref_date, next_dt) AS days_until_next,
  CAST(next_dt IS NULL AS BIGINT) AS censored, last_purchase_dt,
  date_diff('day', last_purchase_dt, ref_date) AS recency_days, CAST(n_life AS BIGINT) AS n_purchases_life
FROM lab""")


@register("w04_reference_grid", O.q(f""", {_DAYS},
firsts AS (SELECT fk_contact, min(d) AS first_d FROM days GROUP BY 1),
obs AS (SELECT max(d) AS obs_end FROM days),
grid0 AS (SELECT f.fk_contact, CAST(unnest(generate_series(CAST(f.first_d + 7 AS TIMESTAMP),
           CAST(o.obs_end AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS t
          FROM firsts f, obs o WHERE f.first_d + 7 <= o.obs_end)
SELECT fk_contact, t AS ref_date FROM grid0 WHERE isodow(t) = 1"""))
def w04(spark, sf):
    return lb.reference_grid(purchase_days(spark, sf), freq="W-MON", min_history_days=7)


@register("w05_repurchase_labels", _labels_sql(7, (3, 7), weekly=False))
def w05(spark, sf):
    return lb.repurchase_labels(purchase_days(spark, sf), freq="D", min_history_days=7, horizons=(3, 7))


@register("w06_horizon_labels", _labels_sql(7, (7, 30), weekly=True).replace(
    "AS n_purchases_life\nFROM lab", "AS n_purchases_life, CAST(ref_date + 7 <= obs_end AS BIGINT) AS observable_7d, "
    "CAST(ref_date + 30 <= obs_end AS BIGINT) AS observable_30d\nFROM lab, obs"))
def w06(spark, sf):
    days = purchase_days(spark, sf)
    return lb.observable(lb.repurchase_labels(days, freq="W-MON", min_history_days=7, horizons=(7, 30)), obs_end=days, horizons=(7, 30))


@register("w07_percent_of_total", O.q(
    f", {_DAYS}, per AS (SELECT fk_contact, sum(c) AS n FROM days GROUP BY 1) SELECT fk_contact, "
    f"CAST(n AS BIGINT) AS n_purchases, {R('n / greatest((SELECT sum(n) FROM per), 1)', 6)} AS pct_of_total FROM per"))
def w07(spark, sf):
    per = purchase_days(spark, sf).groupBy("fk_contact").agg(F.sum("cnt_day").cast("long").alias("n_purchases"))
    return rounded(lb.percent_of_total(per, value="n_purchases"), {"pct_of_total": 6})


# == standardisation (z01-z08, a22, a18) ======================================
_MONEY_FEATURES = ("monetary_gmv_12m", "avg_ticket_value", "avg_price_per_ticket")


@register("f09_numeric_feature_select", O.q(
    f"SELECT fk_contact, feature, CASE WHEN feature IN {_MONEY_FEATURES} THEN {R('x', 2)} ELSE {R('x', 6)} END AS x FROM (SELECT column_name AS feature FROM (DESCRIBE SELECT * FROM feat) WHERE column_type IN "
    "('BIGINT', 'INTEGER', 'DOUBLE') AND column_name <> 'fk_contact' AND column_name NOT LIKE '%\\_dt' ESCAPE '\\' "
    "AND column_name NOT LIKE '%\\_date' ESCAPE '\\') LEFT JOIN flong USING (feature)"))
def f09(spark, sf):
    """The values of the columns that the rule selects, long."""
    f = feats(spark, sf)
    cols = zs.numeric_feature_columns(f)
    rows = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    out = f.select("fk_contact", F.expr(f"stack({len(cols)}, {rows}) AS (feature, x)"))
    return out.withColumn("x", F.when(F.col("feature").isin(*_MONEY_FEATURES), rnd("x", 2)).otherwise(rnd("x", 6)))


@register("z01_skew_select", O.q(
    f"SELECT feature, CAST(n_positive AS BIGINT) AS n_positive, {R('skew', 6)} AS skew, "
    "coalesce(n_positive > 0 AND skew >= 1.0, false) AS log1p FROM sk"))
def z01(spark, sf):
    st = zs.skew_stats(feats(spark, sf), NUM)
    sel = F.coalesce((F.col("n_positive") > 0) & (F.col("skew") >= config.DEFAULT_SKEW_THRESHOLD), F.lit(False))
    return rounded(st.withColumn("n_positive", F.col("n_positive").cast("long")).withColumn("log1p", sel),
                   {"skew": 6})


@register("z02_log1p", O.q(
    f"SELECT fk_contact, {R('ln(1 + greatest(monetary_gmv_12m, 0))', 6)} AS log_monetary_gmv_12m, "
    f"{R('ln(1 + greatest(recency_days, 0))', 6)} AS log_recency_days FROM feat"))
def z02(spark, sf):
    f = feats(spark, sf)
    return rounded(f.select("fk_contact", zs.log1p_clip("monetary_gmv_12m").alias("log_monetary_gmv_12m"),
                            zs.log1p_clip("recency_days").alias("log_recency_days")),
                   {"log_monetary_gmv_12m": 6, "log_recency_days": 6})


@register("z03_impute_sanitise", O.q(
    f"SELECT fk_contact, {R('x2', 6)} AS x, feature FROM fs"))
def z03(spark, sf):
    sc, f = scaler_and_feats(spark, sf)
    cols = sc.used_cols + sc.removed_constant_cols
    wide = f.select("fk_contact", *[sc.prepared(c).alias(c) if c in sc.used_cols
                                    else zs.sanitize(F.col(c).cast("double"), sc.fill).alias(c) for c in cols])
    rows = ", ".join(f"'{c}', `{c}`" for c in cols)
    return rounded(wide.select("fk_contact", F.expr(f"stack({len(cols)}, {rows}) AS (feature, x)")), {"x": 6})


@register("z04_drop_constant", O.q("SELECT feature, v <= 1e-12 AS is_constant FROM st"))
def z04(spark, sf):
    f = feats(spark, sf)
    sc = zs.fit_scaler(f, cols=NUM)
    prep = {c: sc.prepared(c) if c in sc.used_cols else zs.sanitize(
        zs.log1p_clip(c) if c in sc.log1p_cols else F.col(c).cast("double"), sc.fill) for c in NUM}
    wide = f.agg(*[F.var_samp(prep[c]).alias(c) for c in NUM])
    rows = ", ".join(f"'{c}', `{c}`" for c in NUM)
    out = wide.select(F.expr(f"stack({len(NUM)}, {rows}) AS (feature, var_samp)"))
    return out.withColumn("is_constant", F.coalesce(F.col("var_samp") <= config.CONSTANT_EPS, F.lit(True))) \
        .drop("var_samp")


@register("z05_zscore_fit", O.q(
    f"SELECT feature, {R('m', 6)} AS mean, {R('CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END', 6)} AS scale, "
    "is_log AS log1p FROM st WHERE v > 1e-12"))
def z05(spark, sf):
    sc, _ = scaler_and_feats(spark, sf)
    return rounded(sc.to_df(spark).drop("position", "fill", "suffix"), {"mean": 6, "scale": 6})


@register("z06_zscore_apply", O.q(f"SELECT fk_contact, feature, {R('z', 6)} AS z FROM zlong"))
def z06(spark, sf):
    sc, f = scaler_and_feats(spark, sf)
    stored = zs.Scaler.from_df(sc.to_df(spark))          # scoring from the parameter table (s12)
    return rounded(zs.z_long(f, stored), {"z": 6})


@register("z07_inverse", O.q(f"SELECT fk_contact, feature, {R('x2', 6)} AS x FROM fs JOIN st USING (feature) "
                             "WHERE v > 1e-12"))
def z07(spark, sf):
    sc, z, _ = z_wide(spark, sf)
    inv = sc.inverse(z.select("fk_contact", *[f"{c}{sc.suffix}" for c in sc.used_cols]), suffix_out="__x")
    rows = ", ".join(f"'{c}', `{c}__x`" for c in sc.used_cols)
    return rounded(inv.select("fk_contact", F.expr(f"stack({len(sc.used_cols)}, {rows}) AS (feature, x)")), {"x": 6})


@register("z08_standardize_pipeline", O.q(f"SELECT fk_contact, feature, {R('z', 6)} AS z FROM zlong"))
def z08(spark, sf):
    sc, f = scaler_and_feats(spark, sf)
    return rounded(zs.z_long(f, sc), {"z": 6})


@register("a22_global_mean_std", O.q(
    f"SELECT feature, {R('avg(x)', 6)} AS mean, {R('stddev_samp(x)', 6)} AS std FROM flong GROUP BY feature"))
def a22(spark, sf):
    return rounded(rp.mean_std(feats(spark, sf), NUM), {"mean": 6, "std": 6})


def _raw_shares(cat, values, names):
    return ", ".join(f"coalesce(sum(CASE WHEN {cat} = {v} THEN 1 ELSE 0 END) / nullif(count({cat}), 0), 0) AS {n}" for v, n in zip(values, names))


_FULL = [*NUM, *ft.CALENDAR_COLUMNS]
_FULL_LONG = ", " + _EASTER.strip().replace("FROM prep", "FROM win") + f"""
, fb AS (SELECT w.fk_contact, avg(CAST({FESTIVE_SQL} AS INTEGER)) AS pct_festive_period FROM win w JOIN fest f USING (_row_id) GROUP BY 1),
cx AS (SELECT fk_contact, {_raw_shares("CAST(month(purchase_datetime) AS INTEGER)", range(1, 13), ft.MONTH_NAMES)},
  {_raw_shares("day_of_week", range(7), [f"pct_{d}" for d in config.WEEKDAY_NAMES])},
  {_raw_shares("CAST(floor((day(purchase_datetime) - 1) / 7) + 1 AS INTEGER)", range(1, 6), ft.WEEK_NAMES)} FROM win WHERE fk_contact IS NOT NULL GROUP BY 1),
wide AS (SELECT featd.*, cx.* EXCLUDE (fk_contact), coalesce(fb.pct_festive_period, 0) AS pct_festive_period
  FROM featd JOIN cx USING (fk_contact) LEFT JOIN fb USING (fk_contact)),
full_long AS (SELECT fk_contact, feature, CAST(x AS DOUBLE) AS x FROM (SELECT fk_contact, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _FULL)} FROM wide)
  UNPIVOT INCLUDE NULLS (x FOR feature IN ({', '.join(_FULL)})))
"""


@register("a18_correlation_matrix", O.q(_FULL_LONG + f"""SELECT a.feature AS feature_a, b.feature AS feature_b,
  CASE WHEN a.feature = b.feature THEN 1 WHEN var_pop(a.x) > 1e-20 AND var_pop(b.x) > 1e-20 THEN {R('corr(a.x, b.x)', 2)} END AS corr
FROM full_long a JOIN full_long b USING (fk_contact) GROUP BY 1, 2"""))
def a18(spark, sf):
    """Correlation of all 49 features of the full table."""
    full = ft.customer_features(window36(spark, sf), build_date=BUILD_DATE, extra_blocks=[ft.calendar_block])
    full = cut_lineage(full.select("fk_contact", *_FULL), "full-features")
    return rounded(rp.correlation_long(full, _FULL, digits=None), {"corr": 2})


# == clustering (k) =========================================================
def _emb(spark, sf):
    return testdata.table(spark, sf, "embeddings")


@register("k08_centroids", O.q(f"SELECT CAST(cluster_id AS INTEGER) AS cluster_id, CAST(d AS INTEGER) AS d, "
                               f"{R('cx', 6)} AS value FROM embc"))
def k08(spark, sf):
    c = km.centroids_from_labels(_emb(spark, sf), array_col="embedding", label="label")
    out = c.select(F.col("cluster_id").cast("int"), F.posexplode("centroid").alias("d", "value"))
    return rounded(out.withColumn("d", F.col("d").cast("int")), {"value": 6})


@register("k07_assign", O.q(
    "SELECT vec_id, CAST(arg_min(cluster_id, d2) AS INTEGER) AS cluster_id FROM (SELECT e.vec_id, c.cluster_id, "
    "sum((e.x - c.cx) * (e.x - c.cx)) AS d2 FROM emb e JOIN embc c USING (d) GROUP BY 1, 2) GROUP BY vec_id"))
def k07(spark, sf):
    emb = _emb(spark, sf)
    ids, mat = km.centroid_matrix(km.centroids_from_labels(emb, array_col="embedding", label="label"))
    return km.assign(emb, mat, array_col="embedding", ids=ids).select("vec_id", "cluster_id")


@register("k03_inertia", O.q(
    f"SELECT {R('sum((z.z - c.z) * (z.z - c.z))', 4)} AS inertia FROM zlong z JOIN seg s USING (fk_contact) "
    "JOIN segz c ON c.cluster_id = s.cluster_id AND c.feature = z.feature"))
def k03(spark, sf):
    sc, z, f = z_wide(spark, sf)
    seg = segments(spark, sf, f)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    arr = z.join(seg, "fk_contact").select("cluster_id", F.array(*zcols).alias("zv"))
    cents = km.centroids_from_labels(arr, array_col="zv", label="cluster_id")
    return rounded(km.inertia(arr, cents, array_col="zv"), {"inertia": 4})


_SIL_SQL = f"""
SELECT {R('avg(CASE WHEN n_own > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END)', 6)} AS silhouette,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT i, max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN s / (n - 1) END END) AS a,
             min(CASE WHEN own <> other THEN s / n END) AS b, max(CASE WHEN own = other THEN n END) AS n_own
      FROM (SELECT p.i, li.label AS own, lj.label AS other, sum(p.dist) AS s, count(*) AS n
            FROM (SELECT a.vec_id AS i, b.vec_id AS j, sum((a.x - b.x) * (a.x - b.x)) AS dist
                  FROM emb a JOIN emb b ON a.d = b.d GROUP BY 1, 2) p
            JOIN embeddings li ON li.vec_id = p.i JOIN embeddings lj ON lj.vec_id = p.j GROUP BY 1, 2, 3)
      GROUP BY i)
"""


@register("k04_silhouette", O.q(_SIL_SQL))
def k04(spark, sf):
    """Squared-euclidean silhouette of all rows under the given labels."""
    vec = km.assemble(_emb(spark, sf), array_col="embedding").withColumn("prediction", F.col("label").cast("double"))
    out = vec.agg(F.count(F.lit(1)).alias("n")).withColumn("silhouette", F.lit(km.silhouette_squared(vec)))
    return rounded(out, {"silhouette": 6})


_FIXED_SQL = """
, ks AS (SELECT unnest(range(2, 11)) AS k),
cen AS (SELECT ks.k, e.vec_id AS cid, e.d, e.x AS cx FROM emb e, ks WHERE e.vec_id < ks.k),
dist AS (SELECT c.k, e.vec_id, c.cid, sum((e.x - c.cx) * (e.x - c.cx)) AS d2 FROM emb e JOIN cen c USING (d)
         GROUP BY 1, 2, 3),
m AS (SELECT k, sum(d2) AS inertia FROM (SELECT k, vec_id, min(d2) AS d2 FROM dist GROUP BY 1, 2) GROUP BY k),
drops AS (SELECT k, (lag(inertia) OVER (ORDER BY k) - inertia) / greatest(lag(inertia) OVER (ORDER BY k), 1e-12) AS dr
          FROM m),
own AS (SELECT k, vec_id, arg_min(cid, d2) AS cid FROM dist GROUP BY 1, 2),
norms AS (SELECT vec_id, sum(x * x) AS q FROM emb GROUP BY 1),
part AS (SELECT k, cid, count(*) AS n, avg(q) AS q FROM own JOIN norms USING (vec_id) GROUP BY 1, 2),
mean AS (SELECT o.k, o.cid, e.d, avg(e.x) AS mx FROM own o JOIN emb e USING (vec_id) GROUP BY 1, 2, 3),
apart AS (SELECT m.k, m.cid, e.vec_id, sum(e.x * m.mx) AS dot FROM emb e JOIN mean m USING (d) GROUP BY 1, 2, 3),
to_ AS (SELECT a.k, a.vec_id, a.cid, w.q - 2 * a.dot + p.q AS d2, p.n, a.cid = o.cid AS mine
        FROM apart a JOIN norms w USING (vec_id) JOIN part p ON p.k = a.k AND p.cid = a.cid JOIN own o ON o.k = a.k AND o.vec_id = a.vec_id),
ab AS (SELECT k, vec_id, max(CASE WHEN mine THEN n END) AS n, max(CASE WHEN mine THEN d2 * n / greatest(n - 1, 1) END) AS a, min(CASE WHEN NOT mine THEN d2 END) AS b
       FROM to_ GROUP BY 1, 2),
sil AS (SELECT k, avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS s FROM ab GROUP BY k)
"""
_CHOOSE_SQL = _FIXED_SQL + "SELECT CAST(k AS INTEGER) AS k FROM drops WHERE dr IS NOT NULL ORDER BY dr DESC, k LIMIT 1"


@register("k06_choose_k", O.q(_FIXED_SQL + f"""
SELECT CAST(k AS INTEGER) AS k, {R('inertia', 4)} AS inertia, {R('s', 6)} AS silhouette, k = (SELECT arg_max(k, (s, -inertia, -k)) FROM sil JOIN m USING (k)) AS by_silhouette,
       k = (SELECT arg_max(k, (dr, -k)) FROM drops WHERE dr IS NOT NULL) AS by_drop FROM m JOIN sil USING (k)"""))
def k06(spark, sf):
    """Metrics of fixed centroid sets (the first k vectors, k = 2..10); k by the silhouette rule and, without silhouettes, by the inertia drop."""
    m = _fixed_metrics(spark, sf)
    by_silhouette, by_drop = (km.choose_k(t).collect()[0]["k"] for t in (m, m.withColumn("silhouette", F.lit(None).cast("double"))))
    return rounded(m.withColumns({"by_silhouette": F.col("k") == by_silhouette, "by_drop": F.col("k") == by_drop}), {"inertia": 4, "silhouette": 6})


def _zvectors(spark, sf):
    sc, z, f = z_wide(spark, sf)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    return sc, km.assemble(z.select("fk_contact", *zcols), zcols), zcols


_N = "(SELECT count(*) FROM feat)"
#: Sum of squares about the mean of all rows: inertia and what separates the cluster means must add up to it.
_TOTAL = f"(SELECT {R('sum(s)', 2)} FROM (SELECT sum(z * z) - count(*) * avg(z) * avg(z) AS s FROM zlong GROUP BY feature))"
_FIT_FACTS = f"SELECT CAST({_N} AS BIGINT) AS n_rows, CAST(4 AS BIGINT) AS n_clusters, {_TOTAL} AS total_ss, true AS sizes_fall"


def _total_ss(cost, centers, n, means):
    """Sum of squares about the mean of all rows from a fit's inertia, its centres, and the sizes and means of its clusters."""
    centers, n, means = np.asarray(centers, float), np.asarray(n, float), np.asarray(means, float)
    overall = (n[:, None] * means).sum(0) / n.sum()
    return float(cost - (n * ((means - centers) ** 2).sum(1)).sum() + (n * ((means - overall) ** 2).sum(1)).sum())


def _fit_facts(spark, vec, fit):
    """Rows, clusters, whether the renumbered sizes fall, and the total sum of squares, from the stored assignments."""
    stored = cut_lineage(fit.model.transform(vec).select("fk_contact", "prediction", vector_to_array("features").alias("x")), "assignments")
    parts = km.centroids_from_labels(stored, array_col="x", label="prediction").join(
        stored.groupBy(F.col("prediction").alias("cluster_id")).agg(F.count(F.lit(1)).alias("n")), "cluster_id").collect()       # k rows
    centers = fit.model.clusterCenters()
    total = _total_ss(fit.inertia, [centers[r["cluster_id"]] for r in parts], [r["n"] for r in parts], [r["centroid"] for r in parts])
    sizes = km.renumber_by_size(stored.select("fk_contact", "prediction")).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    rising = sizes.alias("a").join(sizes.alias("b"), F.col("b.cluster_id") == F.col("a.cluster_id") + 1).where("b.n > a.n")
    facts = stored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("prediction").alias("n_clusters"))
    return rounded(facts.withColumns({"total_ss": F.lit(total), "sizes_fall": F.lit(rising.count() == 0)}), {"total_ss": 2})


@register("k01_kmeans", O.q(_FIT_FACTS))
def k01(spark, sf):
    """k-means (k = 4, default restarts and iterations) on the standardised features; checkable facts of the fit."""
    sc, vec, _ = _zvectors(spark, sf)
    vec = cut_lineage(vec.select("fk_contact", "features"), "vectors")
    return _fit_facts(spark, vec, km.fit_kmeans(vec, k=4))


@register("k02_minibatch", O.q(_FIT_FACTS))
def k02(spark, sf):
    """Mini-batch k-means (k = 4) over batches of all rows; checkable facts of the fit."""
    sc, vec, _ = _zvectors(spark, sf)
    vec = cut_lineage(vec.select("fk_contact", "features"), "vectors")
    return _fit_facts(spark, vec, km.fit_kmeans(vec, k=4, algorithm="minibatch_kmeans"))


_KS = "(SELECT unnest(range(2, 11)) AS k)"


def _metric_facts(spark, vec):
    """Per k: rows, total sum of squares, does the inertia fall against the k before (to 5 %: restarts are local optima), is the silhouette in [-1, 1]?"""
    metrics, fits, held = km.evaluate_fits(vec)
    ks = sorted(fits)
    found = lloyd.moments(held.table, [fits[k].model.clusterCenters() for k in ks])
    rows = [(k, int(m.n.sum()), _total_ss(fits[k].inertia, fits[k].model.clusterCenters(), m.n, m.means)) for k, m in zip(ks, found)]
    before = metrics.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("_before"))
    facts = metrics.join(before, "k", "left").withColumns({"falls": F.coalesce(F.col("inertia") <= F.col("_before") * 1.05, F.lit(True)),
                                                           "in_range": F.coalesce(F.col("silhouette").between(-1, 1), F.lit(True))})
    return rounded(facts.join(spark.createDataFrame(rows, "k int, n_rows long, total_ss double"), "k"), {"total_ss": 2})


@register("k05_evaluate_k", O.q(f"SELECT CAST(k AS INTEGER) AS k, CAST({_N} AS BIGINT) AS n_rows, {_TOTAL} AS total_ss, true AS falls, true AS in_range FROM {_KS}"))
def k05(spark, sf):
    """Metrics for k = 2..10 with the linear squared-euclidean silhouette; checkable facts of each."""
    sc, vec, _ = _zvectors(spark, sf)
    return _metric_facts(spark, vec).select("k", "n_rows", "total_ss", "falls", "in_range")


@register("k09_metrics_table", O.q(f"SELECT CAST(k AS INTEGER) AS k, 'kmeans' AS algorithm, CAST(42 AS INTEGER) AS random_state, {_TOTAL} AS total_ss, "
                                   f"CAST(1 AS BIGINT) AS n_final, true AS final_is_best FROM {_KS}"))
def k09(spark, sf):
    """The metrics table with its final k: is exactly one k final, and is it the one of the best silhouette?"""
    sc, vec, _ = _zvectors(spark, sf)
    m = _metric_facts(spark, vec)
    k = km.choose_k(m).collect()[0]["k"]
    table = m.withColumns({"algorithm": F.lit("kmeans"), "random_state": F.lit(config.DEFAULT_SEED), "is_final": F.col("k") == k})
    best, n_final = table.agg(F.max("silhouette")).scalar(), table.agg(F.count_if("is_final")).scalar()
    return table.select("k", "algorithm", F.col("random_state").cast("int"), "total_ss", n_final.alias("n_final"),
                        (~F.col("is_final") | (F.col("silhouette") == best)).alias("final_is_best"))


@register("k10_pca2d", O.q(f"SELECT CAST({_N} AS BIGINT) AS n_rows, true AS uncorrelated, true AS ordered, true AS centred"))
def k10(spark, sf):
    """First two principal components of all rows: uncorrelated, ordered by variance, centred."""
    sc, vec, _ = _zvectors(spark, sf)
    p = km.pca2(vec)
    return p.agg(F.count(F.lit(1)).alias("n_rows"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
                 (F.var_pop("pc1") >= F.var_pop("pc2")).alias("ordered"),
                 ((F.abs(F.avg("pc1")) < 1e-6) & (F.abs(F.avg("pc2")) < 1e-6)).alias("centred"))


@register("k11_run_clustering", O.q(f"SELECT CAST({_N} AS BIGINT) AS n_rows, CAST({_N} AS BIGINT) AS n_customers, true AS clusters_are_k, "
                                    "true AS centres_are_means"))
def k11(spark, sf):
    """Whole flow on k = 2..10: every customer once, k clusters, each centre the mean of its rows."""
    from .segmentation import run_clustering
    sc, z, f = z_wide(spark, sf)
    out = run_clustering(z, used_cols=sc.used_cols, scaler=sc)
    zcols = [f"{c}{sc.suffix}" for c in sc.used_cols]
    means = z.join(out["assignments"], "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(f"m_{c}") for c in zcols])
    off = means.join(F.broadcast(out["centroids_z"]), "cluster_id").agg(F.max(F.greatest(*[F.abs(F.col(c) - F.col(f"m_{c}")) for c in zcols]))).scalar()
    return out["assignments"].agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("fk_contact").alias("n_customers"),
                                  (F.count_distinct("cluster_id") == out["k"]).alias("clusters_are_k")) \
        .withColumn("centres_are_means", off < 1e-2)


# == naming (r01-r03, l01-l08, t04) =============================================
def _labels(spark, sf):
    sc, cz, seg, z = segment_centroids_z(spark, sf)
    return sc, cz, seg, nm.centroid_labels(cz, used_cols=sc.used_cols)


_LABEL_SQL = ("CASE WHEN z IS NULL OR isnan(z) THEN 'Médio' WHEN z <= -0.5 THEN 'Baixo' WHEN z >= 0.5 THEN 'Alto' "
              "ELSE 'Médio' END")


@register("r01_melt", O.q(f"SELECT cluster_id, feature, {R('z', 6)} AS z FROM segz"))
def r01(spark, sf):
    sc, cz, seg, z = segment_centroids_z(spark, sf)
    return rounded(nm.melt_z(cz, used_cols=sc.used_cols), {"z": 6})


@register("l01_z_label", O.q(f"SELECT cluster_id, feature, {_LABEL_SQL} AS label FROM segz"))
def l01(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    return lab.select("cluster_id", "feature", "label")


@register("l02_centroid_labels", O.q(f"SELECT cluster_id, feature, {R('z', 6)} AS z, {_LABEL_SQL} AS label FROM segz"))
def l02(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    return rounded(lab, {"z": 6})


def _names_sql():
    prio = {v: i for i, v in enumerate(config.DEFAULT_PRIORITY)}
    vals = ", ".join(
        "('{}', {}, '{}')".format(f, prio.get(f, len(config.DEFAULT_PRIORITY)),
                                   config.DEFAULT_ALIASES.get(f, f).replace("'", "''")) for f in NUM)
    return f""", pr AS (SELECT * FROM (VALUES {vals}) t(feature, prio, alias)),
lab AS (SELECT cluster_id, feature, {_LABEL_SQL} AS label FROM segz),
pos AS (SELECT l.cluster_id, l.label || ' ' || p.alias AS frag,
               row_number() OVER (PARTITION BY l.cluster_id ORDER BY p.prio, l.feature) AS pos
        FROM lab l JOIN pr p USING (feature)),
names AS (SELECT CAST(cluster_id AS INTEGER) AS cluster_id, string_agg(frag, ' | ' ORDER BY pos) AS cluster_name
          FROM pos WHERE pos <= 3 GROUP BY cluster_id)
"""


@register("l03_cluster_names", O.q(_names_sql() + "SELECT cluster_id, cluster_name FROM names"))
def l03(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    return nm.cluster_names(lab, used_cols=sc.used_cols)


@register("l04_centroid_summary")
def l04(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    unstd = sc.inverse(cz).select("cluster_id", *sc.used_cols)
    out = nm.centroid_summary(cz, lab, centroids_unstd=unstd, meta={"build_date": BUILD_DATE, "model_version": "v1"},
                              features=sc.used_cols)
    return rounded(out, {c: 6 for c, t in out.dtypes if t == "double"})


@register("l05_diff_label", O.q("""
, cv AS (SELECT * FROM flong WHERE feature IN ('frequency_12m', 'n_unique_routes_out', 'avg_price_per_ticket',
         'top_route_out_share', 'top_company_out_share')),
g AS (SELECT feature, avg(x) AS mean, stddev_samp(x) AS std FROM cv GROUP BY 1),
c AS (SELECT s.cluster_id, cv.feature, avg(cv.x) AS value FROM cv JOIN seg s USING (fk_contact) GROUP BY 1, 2)
SELECT c.cluster_id, c.feature, CASE WHEN value - mean > std THEN 'Alto' WHEN value - mean < -std THEN 'Baixo'
       ELSE 'Médio' END AS label
FROM c JOIN g USING (feature)"""))
def l05(spark, sf):
    f = feats(spark, sf)
    seg = segments(spark, sf, f)
    cents = f.join(seg, "fk_contact").groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in CLUSTER_VARS])
    return nm.label_by_std(cents, rp.mean_std(f, CLUSTER_VARS), cols=CLUSTER_VARS)


def _fixed_metrics(spark, sf):
    """Metrics of fixed centroid sets (the first k vectors, k = 2..10): deterministic, SQL-checkable, two scans for all."""
    emb = _emb(spark, sf)
    first = emb.where(F.col("vec_id") < 10).select("vec_id", F.col("embedding").cast("array<double>").alias("c")).orderBy("vec_id").collect()   # 10 rows
    sets = [np.array([r["c"] for r in first if r["vec_id"] < k]) for k in range(2, 11)]
    rows = [(k, cost, sil) for k, (cost, sil) in zip(range(2, 11), km.inertias(emb, sets, array_col="embedding"))]
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


@register("l06_metadata_from_metrics", O.q(_CHOOSE_SQL.replace("SELECT CAST(k AS INTEGER) AS k FROM drops",
    "SELECT CAST(k AS INTEGER) AS k, 'fixed' AS algorithm, 42 AS random_state FROM drops")))
def l06(spark, sf):
    m = _fixed_metrics(spark, sf).withColumn("silhouette", F.lit(None).cast("double"))
    k = km.choose_k(m).collect()[0]["k"]
    m = m.withColumns({"algorithm": F.lit("fixed"), "random_state": F.lit(config.DEFAULT_SEED),
                       "is_final": F.col("k") == k})
    return nm.metadata_from_metrics(m)


@register("l07_named_assignments", O.q(_names_sql() + "SELECT fk_contact, cluster_id, cluster_name FROM seg "
                                       "LEFT JOIN names USING (cluster_id)"))
def l07(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    return nm.named_assignments(seg, nm.cluster_names(lab, used_cols=sc.used_cols))


@register("j05_names_join", O.q(_names_sql() + "SELECT fk_contact, cluster_id, cluster_name FROM seg "
                                "LEFT JOIN names USING (cluster_id)"))
def j05(spark, sf):
    """The names joined to all assignments: a row per customer."""
    sc, cz, seg, lab = _labels(spark, sf)
    return nm.named_assignments(seg, nm.cluster_names(lab, used_cols=sc.used_cols)).select("fk_contact", "cluster_id", "cluster_name")


@register("l08_run_labeling")
def l08(spark, sf):
    from .segmentation import run_labeling
    sc, cz, seg, z = segment_centroids_z(spark, sf)
    out = run_labeling(centroids_z=cz, used_cols=sc.used_cols, assignments=seg)
    return out["assignments_named"].select("fk_contact", "cluster_id", "cluster_name")


@register("r02_pivot_labels")
def r02(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    return nm.pivot_labels(lab, features=sc.used_cols)


@register("r03_pivot_z")
def r03(spark, sf):
    sc, cz, seg, z = segment_centroids_z(spark, sf)
    out = nm.pivot_z(nm.melt_z(cz, used_cols=sc.used_cols), features=sc.used_cols)
    return rounded(out, {c: 6 for c, t in out.dtypes if t == "double"})


@register("t04_top_abs_z", O.q(
    f"SELECT cluster_id, feature, {R('z', 6)} AS z, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY cluster_id ORDER BY abs(z) DESC, feature) AS rank FROM segz) WHERE rank <= 5"))
def t04(spark, sf):
    sc, cz, seg, z = segment_centroids_z(spark, sf)
    out = nm.top_abs_z(cz, used_cols=sc.used_cols, n=5)
    return rounded(out.withColumn("rank", F.col("rank").cast("int")), {"z": 6})


# == reports (a19-a25, t01-t05, j, u01, x01) ====================================
@register("a19_cluster_sizes", O.q("SELECT cluster_id, CAST(count(*) AS BIGINT) AS n_customers FROM seg GROUP BY 1"))
def a19(spark, sf):
    f = feats(spark, sf)
    return rp.count_by_key(segments(spark, sf, f), "cluster_id", name="n_customers")


@register("a20_cluster_medians", O.q(
    "SELECT cluster_id, " + ", ".join(f"{R(f'median({c})', 6)} AS {c}" for c in CLUSTER_VARS)
    + " FROM feat JOIN seg USING (fk_contact) GROUP BY cluster_id"))
def a20(spark, sf):
    f = feats(spark, sf)
    med = rp.group_medians(f.join(segments(spark, sf, f), "fk_contact"), by="cluster_id", cols=CLUSTER_VARS)
    return rounded(med, {c: 6 for c in CLUSTER_VARS})


_OVERVIEW = f"""
, pc AS (SELECT fk_contact, count(DISTINCT nk_ota_localizer_id) AS orders, sum(gmv_success) AS g,
                count(gmv_success) AS ng FROM win GROUP BY 1),
ov AS (SELECT cluster_id, CAST(count(*) AS BIGINT) AS clientes, coalesce(sum(g), 0) AS gmv, sum(g) / sum(ng) AS ticket_medio,
              avg(orders) AS freq_media FROM pc JOIN seg USING (fk_contact) GROUP BY 1),
ovs AS (SELECT cluster_id, clientes, {R('gmv', 2)} AS gmv, {R('ticket_medio', 2)} AS ticket_medio,
               {R('freq_media', 6)} AS freq_media,
               {R('clientes / greatest((SELECT sum(clientes) FROM ov), 1)', 6)} AS pct_clientes,
               {R('gmv / greatest((SELECT sum(gmv) FROM ov), 1)', 6)} AS pct_gmv FROM ov)
"""
_OV_ROUND = {"gmv": 2, "ticket_medio": 2, "freq_media": 6, "pct_clientes": 6, "pct_gmv": 6}


@register("a21_cluster_overview", O.q(_OVERVIEW + "SELECT * FROM ovs"))
def a21(spark, sf):
    win = window36(spark, sf)
    f = ft.customer_features(win, build_date=BUILD_DATE)
    return rounded(rp.cluster_overview(win, segments(spark, sf, f), name=None), _OV_ROUND)


@register("j07_overview_join", O.q(_names_sql().replace("names AS", "names AS", 1) + _OVERVIEW.replace(", pc AS", ", pc AS", 1)
                                   + "SELECT ovs.*, names.cluster_name FROM ovs LEFT JOIN names USING (cluster_id)"))
def j07(spark, sf):
    sc, cz, seg, lab = _labels(spark, sf)
    names = nm.cluster_names(lab, used_cols=sc.used_cols)
    ov = rounded(rp.cluster_overview(window36(spark, sf), seg, name=None), _OV_ROUND)
    return ov.join(F.broadcast(names), "cluster_id", "left")


@register("a24_count_by_key", O.q("SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1"))
def a24(spark, sf):
    return rp.count_by_key(testdata.table(spark, sf, "events"), "event_type")


@register("a25_distinct_values", O.q("SELECT DISTINCT route_out FROM win"))
def a25(spark, sf):
    return rp.distinct_values(window36(spark, sf), "route_out")


@register("t01_sort", O.q("SELECT _row_id, fk_contact, purchase_datetime FROM clean"))
def t01(spark, sf):
    return routed(spark, sf, n_buckets=None).clean.select("_row_id", "fk_contact", "purchase_datetime").orderBy(
        F.col("fk_contact"), F.col("purchase_datetime").desc_nulls_last(), F.col("_row_id"))


@register("t02_topk_per_group", O.q("""
SELECT cluster_id, route_out, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, route_out) AS rank FROM (
    SELECT s.cluster_id, w.route_out, count(DISTINCT w.nk_ota_localizer_id) AS n FROM win w JOIN seg s USING (fk_contact)
    WHERE w.route_out IS NOT NULL AND w.nk_ota_localizer_id IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 10"""))
def t02(spark, sf):
    win = window36(spark, sf)
    f = ft.customer_features(win, build_date=BUILD_DATE)
    j = win.join(segments(spark, sf, f), "fk_contact")
    out = rp.top_k_per_group(j, group="cluster_id", value="route_out", k=10, count="orders", key="nk_ota_localizer_id")
    return out.withColumn("n", F.col("n").cast("long")).withColumn("rank", F.col("rank").cast("int"))


@register("t03_topk_string", O.q("""
SELECT cluster_id, string_agg(v || ' (' || CAST(n AS VARCHAR) || ')', ' | ' ORDER BY rank) AS top_companies FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, v) AS rank FROM (
    SELECT s.cluster_id, w.fk_departure_ota_bus_company AS v, count(*) AS n FROM win w JOIN seg s USING (fk_contact)
    WHERE w.fk_departure_ota_bus_company IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 15 GROUP BY cluster_id"""))
def t03(spark, sf):
    win = window36(spark, sf)
    f = ft.customer_features(win, build_date=BUILD_DATE)
    j = win.join(segments(spark, sf, f), "fk_contact")
    return rp.top_k_string(j, group="cluster_id", value="fk_departure_ota_bus_company", k=15, out="top_companies")


@register("t05_sample_n", O.q(
    "SELECT fk_contact, frequency_12m FROM feat ORDER BY md5(fk_contact || '#42'), fk_contact LIMIT 100"))
def t05(spark, sf):
    return rp.sample_n(feats(spark, sf).select("fk_contact", "frequency_12m"), n=100, seed=42, id_col="fk_contact")


@register("t06_head")
def t06(spark, sf):
    return rp.head(routed(spark, sf, n_buckets=None).clean.select("_row_id", "fk_contact"), 10, order=["_row_id"])


@register("u01_union_all", O.q(
    f"SELECT _row_id, {R('gmv_success', 2)} AS gmv_success, NULL::BIGINT AS total_tickets_quantity_success "
    "FROM routed WHERE route = 'audit' UNION ALL SELECT _row_id, NULL::DOUBLE, total_tickets_quantity_success "
    "FROM routed WHERE route = 'invalid'"))
def u01(spark, sf):
    rows = prep(spark, sf)
    a = rounded(rows.where(cl.is_audit()).select("_row_id", "gmv_success"), {"gmv_success": 2})
    b = rows.where(~cl.is_audit() & ~cl.is_valid()).select("_row_id", "total_tickets_quantity_success")
    return a.unionByName(b, allowMissingColumns=True)


@register("j01_feature_left_join", O.q(
    f"SELECT fk_contact, frequency_12m, {R('monetary_gmv_12m', 2)} AS monetary_gmv_12m, recency_days, "
    f"n_unique_routes_out, top_route_out, {R('top_route_out_share', 6)} AS top_route_out_share, top_company_out, "
    f"{R('pct_q3', 6)} AS pct_q3, {R('pct_weekend', 6)} AS pct_weekend, total_tickets_12m FROM feat"))
def j01(spark, sf):
    win = window36(spark, sf)
    blocks = [ft.rfm(win, build_date=BUILD_DATE), ft.trip_structure(win), ft.company_pref(win), ft.seasonality(win),
              ft.intensity(win)]
    out = ft.join_blocks(blocks, on="fk_contact")
    return rounded(out.select("fk_contact", "frequency_12m", "monetary_gmv_12m", "recency_days",
                              "n_unique_routes_out", "top_route_out", "top_route_out_share", "top_company_out",
                              "pct_q3", "pct_weekend", "total_tickets_12m"),
                   {"monetary_gmv_12m": 2, "top_route_out_share": 6, "pct_q3": 6, "pct_weekend": 6})


_MONTHS = _share_sql("CAST(month(purchase_datetime) AS INTEGER)", range(1, 13), ft.MONTH_NAMES, src="win")
_DAYS_OF_WEEK = _share_sql("day_of_week", range(7), [f"pct_{d}" for d in config.WEEKDAY_NAMES], src="win")
_WEEKS = _share_sql("CAST(floor((day(purchase_datetime) - 1) / 7) + 1 AS INTEGER)", range(1, 6), ft.WEEK_NAMES, src="win")
_BASE_SHARES = [c for c in ft.FEATURE_COLUMNS if c.startswith("pct_") and c != "pct_round_trip"]
_ALL_SHARES = [*_BASE_SHARES, *ft.MONTH_NAMES, *[f"pct_{d}" for d in config.WEEKDAY_NAMES], *ft.WEEK_NAMES]
_SHARES_SQL = (f"SELECT fk_contact, {', '.join(f'{R(c, 6)} AS {c}' for c in _BASE_SHARES)}, m.* EXCLUDE (fk_contact), d.* EXCLUDE (fk_contact), "
               f"w.* EXCLUDE (fk_contact) FROM feat JOIN ({_MONTHS}) m USING (fk_contact) JOIN ({_DAYS_OF_WEEK}) d USING (fk_contact) "
               f"JOIN ({_WEEKS}) w USING (fk_contact)")


@register("j02_outer_join_fill", O.q(_SHARES_SQL))
def j02(spark, sf):
    """Outer join of the eight share tables of a customer, filled with 0."""
    win = cl.with_calendar(window36(spark, sf))
    families = [("quarter", range(1, 5), None), ("season_br", ft.SEASON_NAMES, None), ("daypart", ft.DAYPART_NAMES, None),
                ("month", range(1, 13), ft.MONTH_NAMES), ("day_of_week", range(7), [f"pct_{d}" for d in config.WEEKDAY_NAMES]),
                ("week_of_month", range(1, 6), ft.WEEK_NAMES)]
    blocks = [ft.category_share(win, by="fk_contact", category=c, values=list(v), names=n or [f"pct_q{x}" if c == "quarter" else f"pct_{x}" for x in v])
              for c, v, n in families]
    blocks += [ft.mean_flag(win, by="fk_contact", flag="is_weekend", name="pct_weekend"),
               ft.mean_flag(win, by="fk_contact", flag="is_holiday", name="pct_holiday")]
    out = ft.join_blocks(blocks, on="fk_contact", how="full", fill={c: 0.0 for c in _ALL_SHARES})
    return rounded(out, {c: 6 for c in _ALL_SHARES})


@register("j02b_share_table", O.q(_SHARES_SQL))
def j02b(spark, sf):
    """The same table by one aggregate, as the flows use it."""
    return rounded(ft.share_table(window36(spark, sf)), {c: 6 for c in _ALL_SHARES})


@register("j04_assign_to_purchases", O.q("SELECT w._row_id, s.cluster_id FROM win w LEFT JOIN seg s USING (fk_contact)"))
def j04(spark, sf):
    win = window36(spark, sf)
    f = ft.customer_features(win, build_date=BUILD_DATE)
    return win.join(segments(spark, sf, f), "fk_contact", "left").select("_row_id", "cluster_id")


@register("j06_centroid_summary_join", O.q(f"SELECT CAST(cluster_id AS INTEGER) AS cluster_id, feature, {R('z', 6)} AS z, {_LABEL_SQL} AS label, "
                                           f"{R('z * (CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END) + m', 6)} AS original FROM segz JOIN st USING (feature)"))
def j06(spark, sf):
    """The join behind the centroid summary, long: z, label and original value of every cluster and feature."""
    sc, cz, seg, lab = _labels(spark, sf)
    wide = sc.inverse(cz).select("cluster_id", *sc.used_cols)
    cols = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in sc.used_cols)
    original = wide.select("cluster_id", F.expr(f"stack({len(sc.used_cols)}, {cols}) AS (feature, original)"))
    return rounded(lab.select("cluster_id", "feature", "z", "label").join(original, ["cluster_id", "feature"]), {"z": 6, "original": 6})


@register("x01_assignment_export", O.q(
    f"SELECT fk_contact, CAST(cluster_id AS BIGINT) AS cluster_id, 5 AS k, 'segment' AS algorithm, "
    f"DATE '{BUILD_DATE}' AS build_date, 'v1' AS model_version, DATE '2001-07-02' AS run_date FROM seg"))
def x01(spark, sf):
    from ..sources.sinks import assignment_export
    f = feats(spark, sf)
    return assignment_export(segments(spark, sf, f), k=5, algorithm="segment", build_date=BUILD_DATE,
                             model_version="v1", run_date="2001-07-02")
