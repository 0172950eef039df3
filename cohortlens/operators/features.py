"""Per-customer features (a01-a17, j01, p20, p21).

Every block is a grouped aggregation with map-side partial aggregation, so a customer with a
third of all rows is combined per partition before the shuffle. "Top value + share" is two
levels of aggregation — (customer, value) counts, then ``min(struct(-count, value))`` per
customer — so ties are broken deterministically (count desc, value asc) without a window.

``customer_features`` computes the blocks as four partial aggregations, each from a scan pruned
to its own columns: all additive measures in one ``groupBy(customer)``, the (customer, route) and
(customer, company) counts for the top values, and a (customer, order key) distinct pass for the
exact order count. Every shuffle carries pre-aggregated rows; the four results are hash-partitioned
by customer and joined 1:1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import DEFAULT_SCHEMA, PurchaseSchema
from ..functions import cleaning as fx
from .cleaning import with_festive_period
from .window import coerce_date, time_column

QUARTERS = [1, 2, 3, 4]
SEASON_NAMES = list(config.SEASONS)
DAYPART_NAMES = list(config.DAYPARTS)


def _build_ts(build_date) -> Column:
    return F.lit(str(coerce_date(build_date)) + " 00:00:00").cast("timestamp_ntz")


def recency_days(last: Column, build_date) -> Column:
    """S9: floor of (build date - last purchase) in days; a purchase later that day gives -1."""
    return fx.days_between_floor(_build_ts(build_date), last)


# -- a01 ---------------------------------------------------------------------
def rfm(df: DataFrame, *, build_date, schema: PurchaseSchema = DEFAULT_SCHEMA, ts: str | None = None,
        approx_distinct: bool = False) -> DataFrame:
    s = schema
    t = ts or time_column(df, ts=s.ts, date_fallback=s.date)
    freq = F.approx_count_distinct(s.key) if approx_distinct else F.countDistinct(s.key)
    out = (df.where(F.col(s.contact).isNotNull())
           .groupBy(s.contact)
           .agg(F.max(t).alias("last_purchase"), freq.alias("frequency_12m"),
                F.coalesce(F.sum(s.gmv), F.lit(0.0)).alias("monetary_gmv_12m")))
    return out.withColumns({
        "recency_days": recency_days(F.col("last_purchase"), build_date),
        "avg_ticket_value": F.when(F.col("frequency_12m") > 0, F.col("monetary_gmv_12m") / F.col("frequency_12m")),
    })


# -- a02-a05 -----------------------------------------------------------------
def top_share(df: DataFrame, *, by: str, value: str, count: str = "rows", key: str | None = None,
              weight: str | None = None, top: str | None = None, share: str | None = None,
              n_distinct: str | None = None) -> DataFrame:
    """Most frequent non-null ``value`` per ``by`` and its share of the non-null total.

    count='rows' counts rows (or sums ``weight``); count='orders' counts distinct ``key``.
    Ties: larger count first, then the smaller value. Groups without a non-null value are absent.
    """
    top = top or f"top_{value}"
    share = share or f"{top}_share"
    src = df.where(F.col(by).isNotNull() & F.col(value).isNotNull())
    if count == "orders":
        if key is None:
            raise ValueError("count='orders' needs key")
        lvl = src.where(F.col(key).isNotNull()).select(by, value, key).distinct() \
            .groupBy(by, value).agg(F.count(F.lit(1)).alias("_c"))
    elif weight is not None:
        lvl = src.groupBy(by, value).agg(F.sum(weight).alias("_c"))
    else:
        lvl = src.groupBy(by, value).agg(F.count(F.lit(1)).alias("_c"))
    return _top_from_counts(lvl, by=by, value=value, top=top, share=share, n_distinct=n_distinct)


def _top_from_counts(lvl: DataFrame, *, by, value, top, share, n_distinct=None) -> DataFrame:
    best = F.min(F.struct((-F.col("_c")).alias("c"), F.col(value).cast("string").alias("v")))
    aggs = [best.alias("_best"), F.sum("_c").alias("_tot")]
    if n_distinct:
        aggs.append(F.count(F.lit(1)).alias(n_distinct))
    out = lvl.groupBy(by).agg(*aggs)
    cols = [by, F.col("_best.v").alias(top),
            F.coalesce(F.try_divide(-F.col("_best.c"), F.col("_tot")), F.lit(0.0)).cast("double").alias(share)]
    if n_distinct:
        cols.append(F.col(n_distinct).cast("long"))
    return out.select(*cols)


def trip_structure(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA) -> DataFrame:
    """a02: pct_round_trip, n_unique_routes_out, top_route_out + share (by rows)."""
    s = schema
    base = df.where(F.col(s.contact).isNotNull())
    pct = base.groupBy(s.contact).agg(
        F.avg(F.coalesce(F.col(s.has_return), F.lit(0))).cast("double").alias("pct_round_trip"),
        F.countDistinct(s.route_out).cast("long").alias("n_unique_routes_out"))
    top = top_share(base, by=s.contact, value=s.route_out, top="top_route_out")
    return pct.join(top, s.contact, "left").fillna({"top_route_out_share": 0.0})


def company_pref(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, count: str = "rows") -> DataFrame:
    """a04 (rows) / a05 (distinct orders): top_company_out + share."""
    s = schema
    base = df.where(F.col(s.contact).isNotNull())
    contacts = base.select(s.contact).distinct()
    top = top_share(base, by=s.contact, value=s.company_out, count=count, key=s.key, top="top_company_out")
    return contacts.join(top, s.contact, "left").fillna({"top_company_out_share": 0.0})


MONTH_NAMES = [f"pct_m{m:02d}" for m in range(1, 13)]
WEEK_NAMES = [f"pct_wom{w}" for w in range(1, 6)]


# -- a06-a14 -----------------------------------------------------------------
def share_aggs(category: Column, values, names) -> list:
    """Row-normalised crosstab columns: share of each category among non-null categories."""
    n = F.count(category)
    return [F.coalesce(F.try_divide(F.sum(F.when(category == v, 1).otherwise(0)), n), F.lit(0.0))
            .cast("double").alias(name) for v, name in zip(values, names)]


def category_share(df: DataFrame, *, by: str, category, values, prefix: str = "pct_", names=None) -> DataFrame:
    """a06-a11 (r04): per ``by``, the share of rows in each of a FIXED list of categories (0 when absent)."""
    cat = fx._c(category)
    names = names or [f"{prefix}{v}" for v in values]
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(*share_aggs(cat, values, names))


def mean_flag(df: DataFrame, *, by: str, flag, name: str) -> DataFrame:
    """a12-a14: mean of a 0/1 flag per group (NULL flags skipped)."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.coalesce(F.avg(fx._c(flag).cast("double")), F.lit(0.0)).alias(name))


def seasonality(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, ts: str | None = None) -> DataFrame:
    """Quarter, season, daypart shares, pct_weekend and pct_holiday in one aggregation."""
    s = schema
    t = ts or time_column(df, ts=s.ts, date_fallback=s.date)
    return df.where(F.col(s.contact).isNotNull()).groupBy(s.contact).agg(*_seasonality_aggs(t))


def _seasonality_aggs(t: str) -> list:
    tcol = F.col(t)
    wk = F.when(tcol.isNotNull(), fx.is_weekend(tcol))
    return (share_aggs(F.quarter(tcol), QUARTERS, [f"pct_q{q}" for q in QUARTERS])
            + share_aggs(fx.season_south(tcol), SEASON_NAMES, [f"pct_{v}" for v in SEASON_NAMES])
            + share_aggs(fx.daypart(F.hour(tcol)), DAYPART_NAMES, [f"pct_{v}" for v in DAYPART_NAMES])
            + [F.coalesce(F.avg(wk.cast("double")), F.lit(0.0)).alias("pct_weekend"),
               F.coalesce(F.avg(F.when(tcol.isNotNull(), fx.is_holiday_window(tcol)).cast("double")),
                          F.lit(0.0)).alias("pct_holiday")])


def share_table(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, ts: str | None = None) -> DataFrame:
    """Weekend, quarter, season, daypart, month, weekday, week-of-month and holiday shares per customer, 0 where absent.

    One aggregate instead of an outer join of eight tables: every family has a row for every customer.
    """
    s = schema
    t = ts or time_column(df, ts=s.ts, date_fallback=s.date)
    col = F.col(t)
    more = (share_aggs(F.month(col), range(1, 13), MONTH_NAMES) + share_aggs(fx.day_of_week(col), range(7), [f"pct_{d}" for d in config.WEEKDAY_NAMES])
            + share_aggs(fx.week_of_month(col), range(1, 6), WEEK_NAMES))
    return df.where(F.col(s.contact).isNotNull()).groupBy(s.contact).agg(*_seasonality_aggs(t), *more)


#: Columns of ``calendar_block``: what the full feature table has beyond ``FEATURE_COLUMNS``.
CALENDAR_COLUMNS = [*MONTH_NAMES, *[f"pct_{d}" for d in config.WEEKDAY_NAMES], *WEEK_NAMES, "pct_festive_period"]


def calendar_block(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, ts: str | None = None) -> DataFrame:
    """Month, weekday and week-of-month shares and the festive share per customer in one aggregate.

    A block for ``customer_features(extra_blocks=[calendar_block])``, which then gives the full table (49 numeric features).
    """
    s = schema
    t = ts or time_column(df, ts=s.ts, date_fallback=s.date)
    col, festive = F.col(t), F.col("is_festive_period").cast("double")
    shares = (share_aggs(F.month(col), range(1, 13), MONTH_NAMES) + share_aggs(fx.day_of_week(col), range(7), [f"pct_{d}" for d in config.WEEKDAY_NAMES])
              + share_aggs(fx.week_of_month(col), range(1, 6), WEEK_NAMES))
    known = with_festive_period(df.where(F.col(s.contact).isNotNull()), ts=t, date=s.date)
    return known.groupBy(s.contact).agg(*shares, F.coalesce(F.avg(festive), F.lit(0.0)).alias("pct_festive_period"))


# -- a15, a16 ----------------------------------------------------------------
def intensity(df: DataFrame, *, schema: PurchaseSchema = DEFAULT_SCHEMA, weighted: bool = False) -> DataFrame:
    """a15: tickets sum and the mean of unit prices; a16 (weighted): gmv sum / tickets sum."""
    s = schema
    g = df.where(F.col(s.contact).isNotNull()).groupBy(s.contact)
    tickets = F.coalesce(F.sum(s.tickets), F.lit(0)).cast("long").alias("total_tickets_12m")
    if weighted:
        price = F.try_divide(F.sum(s.gmv), F.sum(s.tickets)).alias("avg_price_per_ticket")
    else:
        price = F.avg(s.avg_price).cast("double").alias("avg_price_per_ticket")
    return g.agg(tickets, price)


# -- a17 ---------------------------------------------------------------------
FEATURE_COLUMNS = [
    "fk_contact", "last_purchase", "frequency_12m", "monetary_gmv_12m", "recency_days", "avg_ticket_value",
    "pct_round_trip", "n_unique_routes_out", "top_route_out", "top_route_out_share", "top_company_out",
    "top_company_out_share", "pct_q1", "pct_q2", "pct_q3", "pct_q4", "pct_verao", "pct_outono", "pct_inverno",
    "pct_primavera", "pct_madrugada", "pct_manha", "pct_tarde", "pct_noite", "pct_weekend", "pct_holiday",
    "total_tickets_12m", "avg_price_per_ticket", "build_date", "model_version",
]


def customer_features(df: DataFrame, *, build_date, model_version: str = config.DEFAULT_MODEL_VERSION,
                      schema: PurchaseSchema = DEFAULT_SCHEMA, ts: str | None = None, extra_blocks=(),
                      approx_distinct: bool = False) -> DataFrame:
    """One row per customer with RFM, trip structure, company, seasonality and intensity.

    ``extra_blocks``: callables ``DataFrame -> DataFrame`` keyed by the contact column, left-joined.
    """
    s = schema
    t = ts or time_column(df, ts=s.ts, date_fallback=s.date)
    base = df.where(F.col(s.contact).isNotNull())
    tcol = F.col(t)
    qcat, scat, dcat = F.quarter(tcol), fx.season_south(tcol), fx.daypart(F.hour(tcol))
    wk = F.when(tcol.isNotNull(), fx.is_weekend(tcol))
    hol = F.when(tcol.isNotNull(), fx.is_holiday_window(tcol))

    def share(cat, values, names):
        n = F.count(cat)
        return [F.coalesce(F.try_divide(F.sum(F.when(cat == v, 1).otherwise(0)), n), F.lit(0.0)).cast("double")
                .alias(name) for v, name in zip(values, names)]

    # One map-side combined aggregation per block, each straight from a column-pruned scan.
    totals = base.groupBy(s.contact).agg(
        F.max(tcol).alias("last_purchase"),
        F.coalesce(F.sum(s.gmv), F.lit(0.0)).alias("monetary_gmv_12m"),
        F.avg(F.coalesce(F.col(s.has_return), F.lit(0))).cast("double").alias("pct_round_trip"),
        *share(qcat, QUARTERS, [f"pct_q{q}" for q in QUARTERS]),
        *share(scat, SEASON_NAMES, [f"pct_{v}" for v in SEASON_NAMES]),
        *share(dcat, DAYPART_NAMES, [f"pct_{v}" for v in DAYPART_NAMES]),
        F.coalesce(F.avg(wk.cast("double")), F.lit(0.0)).alias("pct_weekend"),
        F.coalesce(F.avg(hol.cast("double")), F.lit(0.0)).alias("pct_holiday"),
        F.coalesce(F.sum(s.tickets), F.lit(0)).cast("long").alias("total_tickets_12m"),
        F.avg(s.avg_price).cast("double").alias("avg_price_per_ticket"),
    )
    routes = base.where(F.col(s.route_out).isNotNull()).groupBy(s.contact, s.route_out) \
        .agg(F.count(F.lit(1)).alias("_c"))
    route_top = _top_from_counts(routes, by=s.contact, value=s.route_out, top="top_route_out",
                                 share="top_route_out_share", n_distinct="n_unique_routes_out")
    comps = base.where(F.col(s.company_out).isNotNull()).groupBy(s.contact, s.company_out) \
        .agg(F.count(F.lit(1)).alias("_c"))
    comp_top = _top_from_counts(comps, by=s.contact, value=s.company_out, top="top_company_out",
                                share="top_company_out_share")
    if approx_distinct:
        freq = base.groupBy(s.contact).agg(F.approx_count_distinct(s.key).alias("frequency_12m"))
    else:
        freq = (base.where(F.col(s.key).isNotNull()).select(s.contact, s.key).distinct()
                .groupBy(s.contact).agg(F.count(F.lit(1)).alias("frequency_12m")))

    out = (totals.join(freq, s.contact, "left")
           .join(route_top, s.contact, "left")
           .join(comp_top, s.contact, "left"))
    for block in extra_blocks:
        out = out.join(block(df), s.contact, "left")
    out = out.fillna({"frequency_12m": 0, "n_unique_routes_out": 0, "top_route_out_share": 0.0,
                      "top_company_out_share": 0.0})
    out = out.withColumns({
        "frequency_12m": F.col("frequency_12m").cast("long"),
        "n_unique_routes_out": F.col("n_unique_routes_out").cast("long"),
        "recency_days": recency_days(F.col("last_purchase"), build_date),
        "avg_ticket_value": F.when(F.col("frequency_12m") > 0,
                                   F.col("monetary_gmv_12m") / F.col("frequency_12m")).cast("double"),
        "build_date": F.lit(str(coerce_date(build_date))).cast("date"),
        "model_version": F.lit(str(model_version)),
    })
    extra = [c for c in out.columns if c not in FEATURE_COLUMNS and c != s.contact]
    cols = [s.contact] + [c for c in FEATURE_COLUMNS[1:]] + extra
    return out.select(*cols)


# Columns that are 0 for a customer without rows in a block, and amounts that stay unknown.
ZERO_COUNTS = ("frequency_12m", "n_unique_routes_out", "total_tickets_12m")
ZERO_SHARES = ("top_route_out_share", "top_company_out_share")
AMOUNTS = ("monetary_gmv_12m", "avg_ticket_value", "avg_price_per_ticket")
TEXTS = ("top_route_out", "top_company_out")


def fill_and_type(df: DataFrame) -> DataFrame:
    """p20: a feature table with gaps (missing blocks, NaN, numbers kept as text) gets stable types.

    ``pct_*`` and top shares become doubles and counts longs, 0 where there is no number; amounts become doubles and stay NULL;
    top values become strings. Other columns are kept as they are. One projection, no shuffle.
    """
    def number(c):
        x = F.col(c).try_cast("double")
        return F.when(~F.isnan(x), x)

    typed = {}
    for c in df.columns:
        if c.startswith("pct_") or c in ZERO_SHARES:
            typed[c] = F.coalesce(number(c), F.lit(0.0))
        elif c in ZERO_COUNTS:
            typed[c] = F.coalesce(number(c).cast("long"), F.lit(0).cast("long"))
        elif c in AMOUNTS:
            typed[c] = number(c)
        elif c in TEXTS:
            typed[c] = F.col(c).cast("string")
    return df.withColumns(typed)


def share_of_group_total(df: DataFrame, *, by: str, value: str, out: str = "share") -> DataFrame:
    """j03: each row's share of its group's total (rows ⋈ per-group totals on ``by``).

    Meant for pre-aggregated rows (one per group and item): the per-group total is a partial
    aggregate, and the equi-join meets at most the group's item count per key.
    """
    tot = df.groupBy(by).agg(F.sum(value).alias("_tot"))
    return df.join(tot, by, "inner").withColumn(out, F.try_divide(F.col(value), F.col("_tot"))).drop("_tot")


def join_blocks(blocks, *, on: str = "fk_contact", how: str = "left", fill: dict | None = None) -> DataFrame:
    """j01/j02: join per-customer blocks on the customer key; optional zero fill."""
    out = reduce(lambda a, b: a.join(b, on, how), blocks)
    return out.fillna(fill) if fill else out
