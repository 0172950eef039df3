"""Cleaning and exhaustive row routing of raw purchases.

``prepare`` turns raw rows into typed rows with derived columns in ONE projection.
``route_rows`` gives every row exactly one route: audit, invalid, duplicate, outlier or clean
(so raw = audit + invalid + duplicates + outliers + clean), as a ``route`` column on one
frame rather than N separately computed frames.

Scale notes
- Deduplication never puts a whole key group in one task: the kept row per key is chosen by
  a partial (map-side) ``min(struct(...))`` aggregate, and rows are flagged by a join on the
  unique ``_row_id`` (uniformly spread, no hot key).
- The p99 threshold (one number) and the n+1 bucket edges (bounded by the parameter) are
  computed once, collected and inlined as literals: no join, and no re-evaluation per action.
- The exact percentile is computed distributed (see ``quantiles``).
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_SCHEMA, PurchaseSchema
from ..functions import cleaning as fx
from ..session import cut_lineage
from .quantiles import quantile, quantiles

log = logging.getLogger(__name__)

ROUTES = ["audit", "invalid", "duplicate", "outlier", "clean"]


# -- f05 ---------------------------------------------------------------------
def require_columns(df: DataFrame, columns) -> None:
    """Raise when a required column is missing (schema check only, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


# -- p01-p03 -----------------------------------------------------------------
def normalize_types(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    """Date to DATE, time to 'HH:mm:ss' text, gmv to double, tickets to nullable long."""
    s = schema
    cols = {}
    if s.date in df.columns:
        cols[s.date] = fx.parse_date(s.date)
    if s.time in df.columns:
        cols[s.time] = fx.normalize_time(s.time)
    if s.gmv in df.columns:
        cols[s.gmv] = fx.to_double(s.gmv)
    if s.tickets in df.columns:
        cols[s.tickets] = fx.to_long(s.tickets)
    for c in s.string_columns:
        if c in df.columns:
            cols[c] = F.col(c).cast("string")
    return df.withColumns(cols)


# -- p04 ---------------------------------------------------------------------
def null_placeholders(df: DataFrame, *, mapping: dict | None = None,
                      schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    mapping = schema.artificial_nulls if mapping is None else mapping
    cols = {c: fx.null_if_placeholder(c, vals) for c, vals in mapping.items() if c in df.columns}
    return df.withColumns(cols)


# -- p05, p06 ----------------------------------------------------------------
def with_purchase_ts(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, tz: str | None = config.DEFAULT_TZ,
                     gap: str = "shift", overlap: str = "null") -> DataFrame:
    s = schema
    if s.date in df.columns:
        raw = fx.combine_date_time(s.date, s.time if s.time in df.columns else None)
        ts = fx.localize_wall_clock(raw, tz, gap=gap, overlap=overlap)
    else:
        ts = F.lit(None).cast("timestamp_ntz")
    out = df.withColumn(s.ts, ts)
    return out.withColumns({
        "day_of_week": fx.day_of_week(s.ts),
        "is_weekend": fx.is_weekend(s.ts),
        "hour_of_day": F.hour(s.ts),
    })


def with_daypart(df: DataFrame, *, time: str = "time_purchase", date: str = "date_purchase", out: str = "daypart") -> DataFrame:
    """p09 from the raw columns: the hour of the clock text, else of the date (midnight); NULL without both."""
    return df.withColumn(out, fx.daypart(fx.hour_with_fallback(time, date)))


def with_calendar(df: DataFrame, *, ts: str = "purchase_datetime") -> DataFrame:
    """p07-p10, p12: month, quarter, season, daypart, holiday window, week of month."""
    return df.withColumns({
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "season_br": fx.season_south(ts),
        "daypart": fx.daypart(F.hour(ts)),
        "is_holiday": F.when(F.col(ts).isNotNull(), fx.is_holiday_window(ts)),
        "week_of_month": fx.week_of_month(ts),
    })


def with_festive_period(df: DataFrame, *, ts: str = "purchase_datetime", date: str = "date_purchase") -> DataFrame:
    """p11: national holiday flag and festive-period flag (Carnival from Easter, per row).

    Both are facts of the day, so a row without a clock time takes them from its date; NULL without a date.
    """
    day = F.coalesce(*[F.to_date(c) for c in (ts, date) if c in df.columns])
    # columns of their own: inside the flags each mention of the day and of Easter would be computed again, in a method too big to compile
    known = df.withColumn("_day", day).withColumn("_easter", fx.easter_sunday(F.year("_day")))
    return known.withColumns({
        "is_national_holiday": F.when(F.col("_day").isNotNull(), fx.is_national_holiday("_day", "_easter")),
        "is_festive_period": F.when(F.col("_day").isNotNull(), fx.is_festive_period("_day", "_easter")),
    }).drop("_day", "_easter")


# -- p13, p14, p16 -----------------------------------------------------------
def with_trip_rules(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, strict: bool = True) -> DataFrame:
    s = schema
    cols = df.columns
    ro = fx.route(s.origin_out, s.dest_out) if s.origin_out in cols and s.dest_out in cols \
        else F.lit(None).cast("string")
    if s.origin_ret in cols and s.dest_ret in cols:
        hr = fx.has_return(s.origin_ret, s.dest_ret, s.tickets if s.tickets in cols else None, strict=strict)
    else:
        hr = F.lit(0)
    out = df.withColumns({s.route_out: ro, s.has_return: hr})
    rr = fx.route_return(s.origin_ret, s.dest_ret, s.has_return) if s.origin_ret in cols and s.dest_ret in cols \
        else F.lit(None).cast("string")
    return out.withColumns({"is_round_trip": F.col(s.has_return), s.route_ret: rr})


# -- p17, p18 ----------------------------------------------------------------
def with_prices(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    s = schema
    return df.withColumns({
        s.avg_price: fx.avg_price(s.gmv, s.tickets),
        "log_gmv_success": fx.log_gmv(s.gmv),
    })


def prepare(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, tz: str | None = config.DEFAULT_TZ,
            gap: str = "shift", overlap: str = "null", strict: bool = True) -> DataFrame:
    """p01-p06, p13-p18 in one lazy projection chain (Catalyst collapses it)."""
    require_columns(df, schema.required)
    out = normalize_types(df, schema=schema)
    out = null_placeholders(out, schema=schema)
    out = with_purchase_ts(out, schema=schema, tz=tz, gap=gap, overlap=overlap)
    out = with_trip_rules(out, schema=schema, strict=strict)
    return with_prices(out, schema=schema)


# -- f01, f02 ----------------------------------------------------------------
def is_audit(schema: PurchaseSchema = DEFAULT_SCHEMA) -> Column:
    return F.coalesce(F.col(schema.gmv) < 0, F.lit(False))


def is_valid(schema: PurchaseSchema = DEFAULT_SCHEMA) -> Column:
    """gmv > 0 and tickets > 0; unknown counts as not valid, so routing stays exhaustive."""
    return F.coalesce((F.col(schema.gmv) > 0) & (F.col(schema.tickets) > 0), F.lit(False))


# -- d01, d03, d04 -------------------------------------------------------------
def _neg(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.simpleString()
    col = F.col(c)
    if t.startswith("timestamp"):
        v = F.timestamp_diff("MICROSECOND", col.cast("timestamp_ntz"), F.lit("2999-12-31 00:00:00").cast("timestamp_ntz"))
    elif t == "date":
        v = F.datediff(F.lit("2999-12-31").cast("date"), col)
    else:
        v = -col
    return v


def _order(df: DataFrame, order, row_id: str) -> Column:
    """Struct that sorts rows by ``order`` ((column, "asc"|"desc") pairs; NULLs last either way), ties by the lowest row id."""
    fields = []
    for i, (c, direction) in enumerate(order):
        fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append((_neg(df, c) if direction == "desc" else F.col(c)).alias(f"v{i}"))
    return F.struct(*fields, F.col(row_id).alias("rid"))


def first_rows(df: DataFrame, *, key, order=(), row_id: str = "_row_id") -> DataFrame:
    """The first row per ``key`` (one column or several) under ``order``, whole: one partial aggregate that carries the row.

    A hot key is combined map-side: one row per task and key travels. No join, no window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = df.groupBy(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)]).agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), _order(df, list(order), row_id)).alias("_row"))
    return best.select("_row.*")


def repeated_winners(df: DataFrame, *, key: str, order, row_id: str = "_row_id") -> DataFrame:
    """(_key, _best) of the keys that occur more than once: the id of their first row under ``order``; a written table.

    Written, because a join with a plain table lets AQE split the rows of a hot key, and a join with the aggregate itself does not.
    """
    best = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min(_order(df, list(order), row_id)).alias("_best"))
    return cut_lineage(best.where("_n > 1").select("_key", F.col("_best.rid").alias("_best")), "repeated-keys")


def flag_first(df: DataFrame, *, key: str, order=(), row_id: str = "_row_id", flag: str = "_is_first") -> DataFrame:
    """Add ``flag`` = true on the first row per key: rows of unique keys by default, of repeated keys by the row id of their winner."""
    again = repeated_winners(df, key=key, order=order, row_id=row_id)
    out = df.join(again, df[key].eqNullSafe(again["_key"]), "left")
    return out.withColumn(flag, F.col("_best").isNull() | (F.col(row_id) == F.col("_best"))).drop("_key", "_best")


def mark_duplicates(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, keep: str = "first") -> DataFrame:
    """d01 (keep='first': file order) / d03 (keep='canonical'): ``is_duplicated`` 0/1."""
    order = _dedupe_order(schema, keep, df)
    out = flag_first(df, key=schema.key, order=order, row_id=schema.row_id, flag="_kept")
    return out.withColumn("is_duplicated", (~F.col("_kept")).cast("int")).drop("_kept")


def _dedupe_order(schema, keep, df):
    if keep == "first":
        return []
    if keep == "canonical":
        return [(c, "desc") for c in (schema.ts, schema.gmv) if c in df.columns]
    raise ValueError(f"keep must be 'first' or 'canonical', got {keep!r}")


def all_copies(df: DataFrame, *, key: str) -> DataFrame:
    """d02: every row whose key occurs more than once (keep=False)."""
    dup_keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    return df.join(dup_keys, df[key].eqNullSafe(dup_keys[key]), "left_semi")


def distinct_contact_time(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    """d04: one row per (contact, datetime), the lowest gmv kept (then first row)."""
    return first_rows(df, key=[schema.contact, schema.ts], order=[(schema.gmv, "asc")], row_id=schema.row_id)


def canonical_rows(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, keep: str = "canonical") -> DataFrame:
    """d03: the kept row of every order key, without the others (``mark_duplicates`` flags all rows)."""
    return first_rows(df, key=schema.key, order=_dedupe_order(schema, keep, df), row_id=schema.row_id)


# -- d05, d06 ----------------------------------------------------------------
def p99_flag(df: DataFrame, *, col: str = "avg_price_per_ticket", p: float = 0.99, positive_only: bool = False,
             accuracy: int | None = None, out: str = "is_price_outlier_p99") -> DataFrame:
    """d06: flag rows above the p-quantile (the 1-row threshold is a scalar subquery)."""
    where = F.col(col) > 0 if positive_only else None
    thr = quantile(df, col, p, accuracy=accuracy, name="_thr", where=where).scalar()
    return df.withColumn(out, F.coalesce(F.col(col) > thr, F.lit(False)).cast("int"))


# -- d07 ---------------------------------------------------------------------
def _round_frac(x: float, precision: int) -> float:
    """pandas' label rounding: ``precision`` decimals, or significant digits below 1 (numpy around)."""
    if not math.isfinite(x) or x == 0:
        return x
    frac, whole = math.modf(x)
    digits = -int(math.floor(math.log10(abs(frac)))) - 1 + precision if whole == 0 else precision
    return float(np.around(x, digits))


def interval_labels(edges, n: int) -> list:
    """Labels for the intervals of sorted distinct ``edges``: 'Q1'..'Qn' when all n+1 edges are
    distinct, else pandas' interval text '(lo, hi]' (precision inferred so the edges stay
    distinct; the first lower edge lowered by 10^-precision)."""
    if len(edges) == n + 1:
        return [f"Q{i}" for i in range(1, n + 1)]
    if len(edges) < 2:
        return []
    precision = next((p for p in range(3, 20) if len({_round_frac(b, p) for b in edges}) == len(edges)), 3)
    breaks = [_round_frac(b, precision) for b in edges]
    breaks[0] = breaks[0] - 10 ** (-precision)
    return [f"({breaks[i]}, {breaks[i + 1]}]" for i in range(len(breaks) - 1)]


def bucket_edges(df: DataFrame, *, col: str, n: int = config.DEFAULT_BUCKETS, accuracy: int | None = None,
                 where=None):
    """(sorted distinct quantile edges of ``col`` over rows with col > 0, interval labels).

    The edges are at most n+1 numbers (bounded by the parameter), collected as one row; the labels
    are built once on the driver."""
    cond = F.col(col) > 0 if where is None else (F.col(col) > 0) & where
    qs = [i / n for i in range(n + 1)]
    row = quantiles(df, col, qs, accuracy=accuracy, prefix="_e", where=cond).collect()[0]
    edges = sorted({row[f"_e{i}"] for i in range(n + 1) if row[f"_e{i}"] is not None})
    return edges, interval_labels(edges, n)


def bucket_label(x: Column, edges, labels) -> Column:
    """Label of value ``x``: interval j with e[j-1] < x <= e[j] (the lowest value in interval 1)."""
    if not labels:
        return F.lit(None).cast("string")
    below = None
    for e in edges:
        b = F.when(x > F.lit(float(e)), 1).otherwise(0)
        below = b if below is None else below + b
    j = F.least(F.greatest(below, F.lit(1)), F.lit(len(labels)))
    return F.when(x > 0, F.element_at(F.array(*[F.lit(v) for v in labels]), j))


def quantile_bucket(df: DataFrame, *, col: str, n: int = config.DEFAULT_BUCKETS, out: str = "gmv_bucket",
                    accuracy: int | None = None) -> DataFrame:
    """d07: quantile buckets on value edges; only rows with ``col > 0`` get a bucket."""
    edges, labels = bucket_edges(df, col=col, n=n, accuracy=accuracy)
    return df.withColumn(out, bucket_label(F.col(col), edges, labels))


# -- routing -----------------------------------------------------------------
@dataclass
class Routed:
    """Every input row once, with its ``route``; plus the 1-row p99 threshold."""

    rows: DataFrame
    threshold: DataFrame
    route_col: str = "route"

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col(self.route_col) == name).drop(self.route_col)

    @property
    def clean(self) -> DataFrame:
        return self.part("clean")

    @property
    def invalid(self) -> DataFrame:
        return self.part("invalid")

    @property
    def audit(self) -> DataFrame:
        return self.part("audit")

    @property
    def duplicates(self) -> DataFrame:
        return self.part("duplicate")

    @property
    def outliers(self) -> DataFrame:
        return self.part("outlier")

    def counts(self) -> DataFrame:
        return self.rows.groupBy(self.route_col).agg(F.count(F.lit(1)).alias("n_rows"))

    def materialize(self, path: str) -> "Routed":
        """Write once, partitioned by route (cuts lineage; later reads prune by route)."""
        self.rows.write.mode("overwrite").partitionBy(self.route_col).parquet(path + "/rows")
        self.threshold.write.mode("overwrite").parquet(path + "/threshold")
        spark = self.rows.sparkSession
        return Routed(spark.read.parquet(path + "/rows"), spark.read.parquet(path + "/threshold"), self.route_col)


def route_rows(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, keep: str = "canonical",
               p: float = 0.99, accuracy: int | None = None, n_buckets: int | None = config.DEFAULT_BUCKETS,
               route_col: str = "route", checkpoint: bool = True) -> Routed:
    """f01 + f02 + d01/d03 + d05 (+ d07 on clean rows) on prepared rows.

    Order of the rules: gmv < 0 -> audit; not (gmv > 0 and tickets > 0) -> invalid;
    not the kept row of its order key -> duplicate; avg price > p99 (p99 over the kept rows
    with a positive price) -> outlier; else clean.
    """
    s = schema
    stage0 = F.when(is_audit(s), F.lit("audit")).when(~is_valid(s), F.lit("invalid"))
    base = df.withColumn("_stage0", stage0)
    if checkpoint:
        # two consumers (winners, join): compute the upstream once; released after the cut below
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    valid = base.where(F.col("_stage0").isNull())
    order = _dedupe_order(s, keep, df)
    # only keys that occur twice or more (a few per cent) are joined back: unique rows are their own winners
    again = repeated_winners(valid, key=s.key, order=order, row_id=s.row_id)
    mine = base["_stage0"].isNull() & base[s.key].eqNullSafe(again["_key"])
    marked = base.join(again, mine, "left").withColumn(
        "_kept", F.col("_stage0").isNull() & (F.col("_best").isNull() | (F.col(s.row_id) == F.col("_best")))).drop("_key", "_best")
    if checkpoint:
        # three consumers (p99, bucket edges, final rows): materialise once in the shared folder
        marked = cut_lineage(marked, "dedup")
        base.unpersist()
    kept = marked.where(F.col("_kept"))
    p99_value = quantile(kept, s.avg_price, p, accuracy=accuracy, name="p99_avg_price_per_ticket",
                         where=F.col(s.avg_price) > 0).collect()[0][0]   # one number, computed once
    spark = df.sparkSession
    thr = spark.createDataFrame([(p99_value,)], "p99_avg_price_per_ticket double")
    p99 = F.lit(p99_value).cast("double")
    route = (F.when(F.col("_stage0").isNotNull(), F.col("_stage0"))
             .when(~F.col("_kept"), F.lit("duplicate"))
             .when(F.coalesce(F.col(s.avg_price) > p99, F.lit(False)), F.lit("outlier"))
             .otherwise(F.lit("clean")))
    rows = marked.withColumn(route_col, route).withColumn(
        "is_duplicated", (~F.col("_kept")).cast("int")).drop("_stage0", "_kept")
    if n_buckets:
        edges, labels = bucket_edges(rows, col=s.gmv, n=n_buckets, accuracy=accuracy,
                                     where=F.col(route_col) == "clean")
        rows = rows.withColumn(
            "gmv_bucket", F.when(F.col(route_col) == "clean", bucket_label(F.col(s.gmv), edges, labels)))
    return Routed(rows, thr, route_col)
