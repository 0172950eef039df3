"""Repurchase labels on a customer x reference-date grid (a23, w02-w06).

For each customer with purchase days d1 < d2 < ... and each reference date t in
[d1 + min_history, obs_end] (daily, or Mondays): the last purchase day <= t, the count of
purchases up to it, and the next purchase day > t. Instead of an as-of/range join, each
purchase day *owns* the reference dates in [d_i, d_{i+1}) and emits them with
``explode(sequence(...))``: one shuffle (by customer, at day grain) and a linear output.

Scale: the window functions run on the (customer, day) grain, so a partition holds at most one
row per calendar day of the observation period for any customer, however hot. ``obs_end`` is a
1-row global aggregate used as a scalar subquery (never a global window, never a join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config


def purchase_days_input(df: DataFrame, *, contact: str = "fk_contact", ts: str = "purchase_datetime") -> DataFrame:
    """f08: trimmed customer id and purchase day, rows without either dropped."""
    return (df.select(F.trim(F.col(contact).cast("string")).alias(contact), F.to_date(F.col(ts)).alias("purchase_dt"))
            .dropna(subset=[contact, "purchase_dt"]))


def purchase_days(df: DataFrame, *, contact: str = "fk_contact", ts: str = "purchase_datetime") -> DataFrame:
    """a23: purchases per customer and day (``cnt_day``)."""
    return (purchase_days_input(df, contact=contact, ts=ts)
            .groupBy(contact, "purchase_dt").agg(F.count(F.lit(1)).alias("cnt_day")))


def with_day_links(days: DataFrame, *, contact: str = "fk_contact") -> DataFrame:
    """w02/w03: previous and next purchase day, first day and the running purchase count."""
    w = Window.partitionBy(contact).orderBy("purchase_dt")
    return days.withColumns({
        "prev_purchase_dt": F.lag("purchase_dt").over(w),
        "next_purchase_dt": F.lead("purchase_dt").over(w),
        "first_purchase_dt": F.min("purchase_dt").over(Window.partitionBy(contact)),
        "n_purchases_life": F.sum("cnt_day").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .cast("long"),
    })


def _first_on_or_after(d, freq: str):
    if freq == "D":
        return d
    if freq in ("W-MON", "W"):
        return F.next_day(F.date_sub(d, 1), "MON")
    raise ValueError("freq must be 'D' or 'W-MON'")


def reference_grid(days: DataFrame, *, contact: str = "fk_contact", freq: str = "D",
                   min_history_days: int = config.DEFAULT_MIN_HISTORY_DAYS, obs_end=None) -> DataFrame:
    """w04: (customer, ref_date) for ref dates from first purchase + history to the data end."""
    return repurchase_labels(days, contact=contact, freq=freq, min_history_days=min_history_days,
                             horizons=(), obs_end=obs_end).select(contact, "ref_date")


def asof_prev_next(days: DataFrame, *, contact: str = "fk_contact", freq: str = "D",
                   min_history_days: int = config.DEFAULT_MIN_HISTORY_DAYS, obs_end=None) -> DataFrame:
    """j08: for each reference date t, the last purchase day <= t and the next one > t.

    The as-of pairing needs no join: each purchase day owns the dates up to the next one.
    """
    return _grid(days, contact=contact, freq=freq, min_history_days=min_history_days, obs_end=obs_end).select(
        contact, "ref_date", F.col("purchase_dt").alias("last_purchase_dt"), "next_purchase_dt")


def _grid(days, *, contact, freq, min_history_days, obs_end):
    linked = with_day_links(days, contact=contact)
    if obs_end is None:
        end = days.agg(F.max("purchase_dt")).scalar()           # 1-row aggregate as a scalar subquery
    else:
        end = F.lit(str(obs_end)).cast("date")
    x = linked.withColumn("_obs_end", end)
    ref_start = F.date_add(F.col("first_purchase_dt"), min_history_days)
    lo = _first_on_or_after(F.greatest(F.col("purchase_dt"), ref_start), freq)
    hi = F.least(F.coalesce(F.date_sub(F.col("next_purchase_dt"), 1), F.col("_obs_end")), F.col("_obs_end"))
    step = F.expr("INTERVAL 1 DAY") if freq == "D" else F.expr("INTERVAL 7 DAYS")
    return x.where(lo <= hi).withColumn("ref_date", F.explode(F.sequence(lo, hi, step)))


def repurchase_labels(days: DataFrame, *, contact: str = "fk_contact", freq: str = "D",
                      min_history_days: int = config.DEFAULT_MIN_HISTORY_DAYS,
                      horizons=config.DEFAULT_HORIZONS, obs_end=None) -> DataFrame:
    """w05/w06: label rows ``fk_contact, ref_date, y_buy_<h>d..., days_until_next, censored,
    last_purchase_dt, recency_days, n_purchases_life``.

    ``days`` is the output of ``purchase_days``. ``obs_end`` defaults to the last purchase day
    in the data. y_h = 1 when the next purchase is within (t, t + h]; a horizon past the data
    end still counts as 0 (parity), see ``observable``.
    """
    x = _grid(days, contact=contact, freq=freq, min_history_days=min_history_days, obs_end=obs_end)
    until = F.datediff(F.col("next_purchase_dt"), F.col("ref_date")).cast("long")
    cols = [F.col(contact), F.col("ref_date")]
    for h in horizons:
        cols.append(F.coalesce((until > 0) & (until <= h), F.lit(False)).cast("long").alias(f"y_buy_{h}d"))
    cols += [
        until.alias("days_until_next"),
        F.col("next_purchase_dt").isNull().cast("long").alias("censored"),
        F.col("purchase_dt").alias("last_purchase_dt"),
        F.datediff(F.col("ref_date"), F.col("purchase_dt")).cast("long").alias("recency_days"),
        F.col("n_purchases_life"),
    ]
    return x.select(*cols)


def observable(labels: DataFrame, *, obs_end, horizons=config.DEFAULT_HORIZONS) -> DataFrame:
    """Add ``observable_<h>d``: 1 when t + h does not run past the data end.

    ``obs_end`` is the last day of the *data* (a date, or the purchase days, whose last day counts): the last reference date of a
    weekly grid is earlier.
    """
    end = obs_end.agg(F.max("purchase_dt")).scalar() if isinstance(obs_end, DataFrame) else F.lit(str(obs_end)).cast("date")
    out = labels
    for h in horizons:
        out = out.withColumn(f"observable_{h}d", (F.date_add("ref_date", h) <= end).cast("long"))
    return out


def percent_of_total(df: DataFrame, *, value: str, out: str = "pct_of_total") -> DataFrame:
    """w07: share of the grand total, guarded by max(total, 1); the total is a 1-row aggregate."""
    tot = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, F.col(value) / F.greatest(tot, F.lit(1)))
