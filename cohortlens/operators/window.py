"""Calendar observation window (f03, f04, f10)."""

from __future__ import annotations

import calendar
import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config

log = logging.getLogger(__name__)


def coerce_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def add_months(d: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic that clamps the day (2024-02-29 - 12 months = 2023-02-28)."""
    idx = d.year * 12 + (d.month - 1) + months
    y, m = divmod(idx, 12)
    m += 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def time_column(df: DataFrame, *, ts: str = "purchase_datetime", date_fallback: str | None = "date_purchase") -> str:
    """f10: the datetime column if present, else the date column, else an error."""
    if ts in df.columns:
        return ts
    if date_fallback and date_fallback in df.columns:
        return date_fallback
    raise KeyError(f"neither '{ts}' nor '{date_fallback}' is a column")


def observe_times(df: DataFrame, *, ts: str = "purchase_datetime", date_fallback: str | None = "date_purchase",
                  name: str | None = None) -> tuple[DataFrame, "TimeGuard"]:
    """f10: the frame with a metric on its time column, and a guard to call after the next action on the frame (no extra job).

    The metric counts rows and known times (the datetime, else the date); the guard raises ``ValueError`` if there are rows but no
    known time. An empty frame passes.
    """
    cols = [F.col(c).cast("timestamp_ntz") for c in (ts, date_fallback) if c and c in df.columns]
    if not cols:
        raise KeyError(f"neither '{ts}' nor '{date_fallback}' is a column")
    obs = Observation(name or f"times-{uuid.uuid4().hex}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.coalesce(*cols)).alias("known"))
    return out, TimeGuard(obs, ts if ts in df.columns else date_fallback)


class TimeGuard:
    def __init__(self, obs: Observation, column: str):
        self.obs, self.column = obs, column

    def check(self) -> int:
        """Known times that the action saw; an error if it saw rows without any."""
        got = self.obs.get
        if got.get("rows", 0) > 0 and got.get("known", 0) == 0:
            raise ValueError(f"'{self.column}' has no value in any of {got['rows']} rows")
        return got.get("known", 0)


def window_bounds(build_date, months: int):
    """(start, end_exclusive) as datetimes: [build_date - months, build_date + 1 day)."""
    if months <= 0:
        raise ValueError("months must be > 0")
    bd = coerce_date(build_date)
    start = add_months(bd, -months)
    end = bd + dt.timedelta(days=1)
    return dt.datetime.combine(start, dt.time()), dt.datetime.combine(end, dt.time())


def observation_window(df: DataFrame, *, build_date, months: int = config.DEFAULT_WINDOW_MONTHS,
                       ts: str = "purchase_datetime", date_fallback: str | None = "date_purchase",
                       post_filter_valid: bool = False, gmv: str = "gmv_success",
                       tickets: str = "total_tickets_quantity_success") -> DataFrame:
    """Rows with start <= t <= end of build day (both ends inclusive, calendar months back).

    Literal bounds are computed on the driver so the predicate reaches the Parquet scan. A Hive ``year``/``month`` layout is
    pruned to the months of the window by one range over both columns, a ``year`` layout to its years.
    """
    col = time_column(df, ts=ts, date_fallback=date_fallback)
    start, end = window_bounds(build_date, months)
    t = F.col(col).cast("timestamp_ntz")
    # string literals: parsed as NTZ, independent of the session and the Python process time zones
    lo = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    hi = F.lit(end.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    cond = (t >= lo) & (t < hi)
    last = end - dt.timedelta(microseconds=1)
    if "year" in df.columns and "month" in df.columns:
        cond = cond & (F.col("year") * 12 + F.col("month")).between(start.year * 12 + start.month, last.year * 12 + last.month)
    elif "year" in df.columns:
        cond = cond & F.col("year").between(start.year, last.year)
    out = df.where(cond)
    if post_filter_valid and gmv in df.columns and tickets in df.columns:
        out = out.where((F.col(gmv) > 0) & (F.col(tickets) > 0))
    return out


def observe_rows(df: DataFrame, name: str = "window_rows"):
    """f04: attach a row-count metric that is filled by the next action (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def warn_if_small(obs: Observation, min_rows: int | None = config.DEFAULT_MIN_ROWS) -> bool:
    """Log a warning when the observed window has fewer than ``min_rows`` rows."""
    rows = obs.get.get("rows", 0)
    if min_rows is not None and rows < min_rows:
        log.warning("observation window has few rows: %d < %d", rows, min_rows)
        return True
    return False
