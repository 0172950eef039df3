"""Cluster labelling and naming (r01-r03, l01-l08, t04, w01).

Centroid tables are small (k rows); the operators are still plain DataFrame plans (unpivot,
``when`` chains, a broadcast priority table, ``row_number``) so they compose with the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def z_to_label(z, low: float = config.LOW_THRESHOLD, high: float = config.HIGH_THRESHOLD) -> Column:
    """l01: z <= low -> Baixo, z >= high -> Alto, else (and NULL/NaN) -> Médio."""
    zc = F.col(z) if isinstance(z, str) else z
    return (F.when(zc.isNull() | F.isnan(zc), F.lit(config.LABEL_MID))
            .when(zc <= low, F.lit(config.LABEL_LOW))
            .when(zc >= high, F.lit(config.LABEL_HIGH))
            .otherwise(F.lit(config.LABEL_MID)))


def melt_z(centroids_z: DataFrame, *, used_cols, cluster: str = "cluster_id",
           suffix: str = config.Z_SUFFIX) -> DataFrame:
    """r01: wide <feature><suffix> columns to long (cluster_id, feature, z)."""
    zcols = [f"{c}{suffix}" for c in used_cols]
    missing = [c for c in zcols if c not in centroids_z.columns]
    if missing:
        raise ValueError(f"z columns missing from centroids: {missing}")
    long = centroids_z.select(F.col(cluster).cast("int").alias(cluster), *zcols).unpivot(
        cluster, zcols, "feature_z", "z")
    return long.select(cluster, F.regexp_replace("feature_z", f"{suffix}$", "").alias("feature"),
                       F.col("z").cast("double").alias("z"))


def centroid_labels(centroids_z: DataFrame, *, used_cols, cluster: str = "cluster_id",
                    low: float = config.LOW_THRESHOLD, high: float = config.HIGH_THRESHOLD,
                    suffix: str = config.Z_SUFFIX) -> DataFrame:
    """l02: (cluster_id, feature, z, label)."""
    long = melt_z(centroids_z, used_cols=used_cols, cluster=cluster, suffix=suffix)
    return long.withColumn("label", z_to_label("z", low, high))


def _priority_table(spark, used_cols, priority, aliases) -> DataFrame:
    rank = {v: i for i, v in enumerate(priority)}
    rows = [(c, rank.get(c, len(priority)), aliases.get(c, c)) for c in dict.fromkeys(used_cols)]
    return spark.createDataFrame(rows, "feature string, prio int, alias string")


def cluster_names(labels: DataFrame, *, used_cols, cluster: str = "cluster_id", aliases: dict | None = None,
                  priority=None, max_fragments: int = config.MAX_FRAGMENTS) -> DataFrame:
    """l03 (+w01): 'Alto Frequência | Baixo Rotas | ...' from the first ``max_fragments`` used
    features by priority (unknown features last, then by name); no fragment -> 'Cluster'."""
    aliases = {**config.DEFAULT_ALIASES, **(aliases or {})}
    priority = list(priority or config.DEFAULT_PRIORITY)
    prio = _priority_table(labels.sparkSession, used_cols, priority, aliases)   # one row per used feature
    x = labels.join(F.broadcast(prio), "feature")
    w = Window.partitionBy(cluster, "feature").orderBy("prio")
    x = x.withColumn("_dup", F.row_number().over(w)).where("_dup = 1")
    w2 = Window.partitionBy(cluster).orderBy("prio", "feature")
    x = x.withColumn("_pos", F.row_number().over(w2)).where(F.col("_pos") <= max_fragments)
    frag = F.concat(F.col("label"), F.lit(" "), F.col("alias"))
    named = x.groupBy(cluster).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_pos", frag.alias("f")))), lambda s: s["f"]),
        config.NAME_SEPARATOR).alias("cluster_name"))
    clusters = labels.select(cluster).distinct()
    return clusters.join(named, cluster, "left").select(
        F.col(cluster).cast("int").alias(cluster),
        F.coalesce(F.col("cluster_name"), F.lit(config.DEFAULT_CLUSTER_NAME)).alias("cluster_name"))


def pivot_labels(labels: DataFrame, *, cluster: str = "cluster_id", features=None, prefix: str = "label__") -> DataFrame:
    """r02: long labels -> one ``label__<feature>`` column per feature (values known up front)."""
    feats = list(features) if features is not None else sorted(r[0] for r in labels.select("feature").distinct().collect())
    wide = labels.groupBy(cluster).pivot("feature", feats).agg(F.first("label"))
    return wide.select(cluster, *[F.col(f).alias(f"{prefix}{f}") for f in feats])


def pivot_z(long: DataFrame, *, cluster: str = "cluster_id", features, suffix: str = config.Z_SUFFIX) -> DataFrame:
    """r03: long (cluster, feature, z) back to wide z columns."""
    wide = long.groupBy(cluster).pivot("feature", list(features)).agg(F.first("z"))
    return wide.select(cluster, *[F.col(f).alias(f"{f}{suffix}") for f in features])


def centroid_summary(centroids_z: DataFrame, labels: DataFrame, *, cluster: str = "cluster_id",
                     centroids_unstd: DataFrame | None = None, meta: dict | None = None, features=None) -> DataFrame:
    """l04/j06: wide z + wide labels + original-scale centroids (``_orig`` on clashes) + metadata."""
    out = centroids_z.join(pivot_labels(labels, cluster=cluster, features=features), cluster, "left")
    if centroids_unstd is not None:
        ren = [F.col(c).alias(f"{c}_orig" if c in out.columns and c != cluster else c) for c in centroids_unstd.columns]
        out = out.join(centroids_unstd.select(*ren), cluster, "left")
    for k, v in (meta or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def label_by_std(centroids: DataFrame, stats: DataFrame, *, cluster: str = "cluster_id", cols) -> DataFrame:
    """l05: centroid vs global mean +/- sample std -> Alto / Baixo / Médio, long form.

    ``stats`` is the (feature, mean, std) table of ``reports.mean_std`` (one row per feature).
    """
    long = centroids.select(cluster, *cols).unpivot(cluster, list(cols), "feature", "value")
    j = long.join(F.broadcast(stats), "feature")
    diff = F.col("value") - F.col("mean")
    lab = (F.when(diff > F.col("std"), F.lit(config.LABEL_HIGH))
           .when(diff < -F.col("std"), F.lit(config.LABEL_LOW)).otherwise(F.lit(config.LABEL_MID)))
    return j.select(cluster, "feature", lab.alias("label"))


def metadata_from_metrics(metrics: DataFrame) -> DataFrame:
    """l06: algorithm, final k (else the most common k) and seed from a metrics table, 1 row."""
    has_final = "is_final" in metrics.columns
    src = metrics.where(F.col("is_final")) if has_final else metrics.limit(0)
    final = src.select("k", "algorithm", "random_state").orderBy("k").limit(1)
    modes = metrics.agg(F.mode("k", deterministic=True).alias("k"), F.first("algorithm", ignorenulls=True)
                        .alias("algorithm"), F.first("random_state", ignorenulls=True).alias("random_state"))
    if not has_final:
        return modes
    cols = ("k", "algorithm", "random_state")
    chosen = final.agg(F.first(F.struct(*cols))).scalar()          # NULL without a final k
    return modes.select(F.coalesce(chosen, F.struct(*cols)).alias("m")).select("m.*")


def named_assignments(assignments: DataFrame, names: DataFrame, *, cluster: str = "cluster_id",
                      id_col: str = "fk_contact") -> DataFrame:
    """l07/j05: assignments + cluster name (the name table has k rows: broadcast)."""
    return assignments.join(F.broadcast(names), cluster, "left").select(
        F.col(id_col).cast("string").alias(id_col), F.col(cluster).cast("int").alias(cluster), "cluster_name",
        *[c for c in assignments.columns if c not in (id_col, cluster)])


def top_abs_z(centroids_z: DataFrame, *, used_cols, n: int = 5, cluster: str = "cluster_id",
              suffix: str = config.Z_SUFFIX) -> DataFrame:
    """t04: per cluster the n features with the largest |z| (ties by feature name)."""
    long = melt_z(centroids_z, used_cols=used_cols, cluster=cluster, suffix=suffix)
    w = Window.partitionBy(cluster).orderBy(F.abs("z").desc(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def glossary(spark, features, *, aliases=None, priority=None, low: float = config.LOW_THRESHOLD, high: float = config.HIGH_THRESHOLD) -> DataFrame:
    """x03: one row per feature: its readable name, its rank in cluster names (NULL: last), and the label thresholds."""
    aliases = config.DEFAULT_ALIASES if aliases is None else aliases
    order = {f: i for i, f in enumerate(config.DEFAULT_PRIORITY if priority is None else priority)}
    rows = [(f, aliases.get(f, f), order.get(f), float(low), float(high)) for f in features]
    return spark.createDataFrame(rows, "feature string, alias string, priority int, low_at_most double, high_at_least double")
