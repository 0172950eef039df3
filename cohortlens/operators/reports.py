"""Report tables: profiles, group sizes, shares, top-k, correlations, samples (a18-a25, t01-t06, x03).

All grouped work is partial-aggregated; top-k per group ranks pre-aggregated rows (one row per
group and value), never raw rows; grand totals are 1-row aggregates used as scalar subqueries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import grouped_quantiles


def profile_minmax(df: DataFrame, *, date: str = "date_purchase", time: str = "time_purchase",
                   gmv: str = "gmv_success", tickets: str = "total_tickets_quantity_success") -> DataFrame:
    """f07: min/max of date, time, gmv and tickets in one aggregate."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                  F.min(time).alias("min_time"), F.max(time).alias("max_time"),
                  F.round(F.min(gmv), 2).alias("min_gmv"), F.round(F.max(gmv), 2).alias("max_gmv"),
                  F.min(tickets).alias("min_tickets"), F.max(tickets).alias("max_tickets"))


def count_by_key(df: DataFrame, *keys: str, name: str = "n_rows") -> DataFrame:
    """a24/a19: group sizes."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """a25: sorted distinct values of a column."""
    return df.select(col).distinct().orderBy(col)


def group_medians(df: DataFrame, *, by: str, cols, accuracy: int | None = None) -> DataFrame:
    """a20: per-group medians (numpy's linear interpolation), all columns in one pass.

    Exact by default through ``grouped_quantiles`` (a hot group is spread over many tasks, never
    held whole by one ``percentile`` buffer); ``accuracy`` switches to ``percentile_approx``.
    """
    if accuracy is not None:
        return df.groupBy(by).agg(*[F.percentile_approx(F.col(c), 0.5, accuracy).alias(c) for c in cols])
    groups = df.select(by).distinct()
    medians = grouped_quantiles(df, by, list(cols), [0.5])
    return groups.join(medians, groups[by].eqNullSafe(medians[by]), "left").select(groups[by], *cols)


def mean_std(df: DataFrame, cols) -> DataFrame:
    """a22: long table (feature, mean, std) with the sample standard deviation, one aggregate."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_samp(c).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    stack = F.expr("stack({n}, {args}) AS (feature, mean, std)".format(
        n=len(cols), args=", ".join(f"'{c}', `m__{c}`, `s__{c}`" for c in cols)))
    return wide.select(stack)


def gram(df: DataFrame, cols) -> DataFrame:
    """Sums over the rows where both columns are known, for every pair: (i, j, n, s, q, p) = places, rows, sums of column i,
    of its squares, and of the products, about column means that are subtracted first.

    One scan after one for the means: a task adds up its four d x d matrices by matrix products over Arrow batches, so its memory
    follows d * d and not the number of rows; d * d partial rows per task meet. NaN counts as unknown.
    """
    cols = list(cols)
    x = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    mean = np.array([v or 0.0 for v in x.agg(*[F.avg(c) for c in x.columns]).first()])
    d = len(cols)

    def work(batches):
        n, s, q, p = (np.zeros((d, d)) for _ in range(4))
        for batch in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - mean
            known = np.isfinite(v)
            v = np.where(known, v, 0.0)
            known = known.astype(float)
            n += known.T @ known
            s += v.T @ known
            q += (v * v).T @ known
            p += v.T @ v
        i, j = (a.ravel() for a in np.indices((d, d)))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (i, j, n.ravel(), s.ravel(), q.ravel(), p.ravel())], ["i", "j", "n", "s", "q", "p"])
    partial = x.mapInArrow(work, "i long, j long, n double, s double, q double, p double")
    return partial.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q", "p")])


def correlation_long(df: DataFrame, cols, *, digits: int | None = 2) -> DataFrame:
    """a18: Pearson correlation of every pair, long form (feature_a, feature_b, corr), from one Gram-matrix aggregate.

    Pairwise complete rows; NULL where a column does not vary over them, 1 on the diagonal.
    """
    cols = list(cols)
    g = gram(df, cols)                                          # d * d rows
    other = g.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    both = g.join(other, ["i", "j"])
    va, vb = F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.col("q2") - F.col("s2") * F.col("s2") / F.col("n")
    varies = (F.col("n") > 0) & (va > F.lit(1e-20)) & (vb > F.lit(1e-20))
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).when(varies, (F.col("p") - F.col("s") * F.col("s2") / F.col("n")) / F.sqrt(va * vb))
    if digits is not None:
        r = F.round(r, digits)
    names = F.array(*[F.lit(c) for c in cols])
    return both.select(F.get(names, F.col("i").cast("int")).alias("feature_a"), F.get(names, F.col("j").cast("int")).alias("feature_b"), r.alias("corr"))


def top_k_per_group(df: DataFrame, *, group: str, value: str, k: int = 10, count: str = "rows",
                    key: str | None = None, name: str = "n") -> DataFrame:
    """t02: top-k values per group by row count or by distinct ``key`` (ties: value asc).

    The ranking runs on the pre-aggregated (group, value) table; Spark plans a
    WindowGroupLimit so each partition keeps only k rows per group before the final rank.
    """
    src = df.where(F.col(value).isNotNull())
    if count == "orders":
        lvl = src.select(group, value, key).where(F.col(key).isNotNull()).distinct() \
            .groupBy(group, value).agg(F.count(F.lit(1)).alias(name))
    else:
        lvl = src.groupBy(group, value).agg(F.count(F.lit(1)).alias(name))
    w = Window.partitionBy(group).orderBy(F.col(name).desc(), F.col(value).asc())
    return lvl.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k_string(df: DataFrame, *, group: str, value: str, k: int = 15, sep: str = " | ",
                 out: str | None = None) -> DataFrame:
    """t03: per group, 'value (count)' of the k most frequent values joined by ``sep``."""
    out = out or f"top_{value}"
    top = top_k_per_group(df, group=group, value=value, k=k, name="_n")
    return top.groupBy(group).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", F.format_string("%s (%d)", F.col(value), F.col("_n")).alias("t")))),
        lambda s: s["t"]), sep).alias(out))


def sample_n(df: DataFrame, *, n: int, seed: int = 42, id_col: str) -> DataFrame:
    """t05: a repeatable fixed-size sample: the n smallest md5(id || seed).

    Spark plans ``orderBy + limit`` as TakeOrderedAndProject (a per-partition top-n, then a merge
    of n rows per partition), so only n rows per partition travel.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


def head(df: DataFrame, n: int = 10, order=None) -> DataFrame:
    """t06: first n rows (of a given order)."""
    return (df.orderBy(*order) if order else df).limit(n)


def cluster_overview(purchases: DataFrame, assignments: DataFrame, *, contact: str = "fk_contact",
                     cluster: str = "cluster_id", name: str | None = "cluster_name", key: str = "nk_ota_localizer_id",
                     gmv: str = "gmv_success") -> DataFrame:
    """a21: per cluster: customers, gmv, mean ticket, mean orders per customer, % customers, % gmv.

    Two-level aggregation: (customer) first — one row per customer, so a hot customer is
    combined map-side — then per cluster; shares use a 1-row grand total (scalar subquery).
    """
    gcols = [cluster] + ([name] if name and name in assignments.columns else [])
    per_cust = purchases.groupBy(contact).agg(
        F.countDistinct(key).alias("_orders"), F.sum(gmv).alias("_gmv"), F.count(gmv).alias("_n_gmv"))
    j = per_cust.join(assignments.select(contact, *gcols), contact, "inner")
    ov = j.groupBy(*gcols).agg(
        F.count(F.lit(1)).cast("long").alias("clientes"),
        F.coalesce(F.sum("_gmv"), F.lit(0.0)).alias("gmv"),
        (F.sum("_gmv") / F.sum("_n_gmv")).alias("ticket_medio"),
        F.avg("_orders").alias("freq_media"))
    tot = ov.agg(F.struct(F.sum("clientes").alias("c"), F.sum("gmv").alias("g"))).scalar()
    return ov.withColumns({
        "pct_clientes": F.col("clientes") / F.greatest(tot["c"], F.lit(1)),
        "pct_gmv": F.col("gmv") / F.greatest(tot["g"], F.lit(1)),
    })
