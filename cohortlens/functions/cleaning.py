"""Column expressions for raw purchase rows (parse, placeholders, time zone, routes, prices).

Everything here returns ``Column`` objects built from ``pyspark.sql.functions`` so it stays
inside whole-stage codegen. No Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

DATE_RE = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})(?: 00:00:00(?:\.0+)?)?$"
TIME_RE = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"
DATETIME_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- p01 ---------------------------------------------------------------------
def parse_date(c) -> Column:
    """'yyyy-MM-dd' text, month and day with or without leading zero (or a date/timestamp), to DATE; else NULL."""
    text = F.trim(_c(c).cast("string"))
    return F.when(text.rlike(DATE_RE), F.try_to_date(F.regexp_extract(text, DATE_RE, 1), "yyyy-M-d"))


# -- p02 ---------------------------------------------------------------------
def normalize_time(c) -> Column:
    """Trim, keep at most 8 chars, 'H:mm' -> '0H:mm', 'HH:mm' -> 'HH:mm:00'; invalid clock text -> NULL.

    The result is 'HH:mm:ss' text (the Spark TIME type is off by default).
    """
    h = F.trim(_c(c).cast("string"))
    h = F.substring(F.when(h.rlike("^[0-9]:"), F.concat(F.lit("0"), h)).otherwise(h), 1, 8)
    h = F.when(F.length(h) == 5, F.concat(h, F.lit(":00"))).otherwise(h)
    return F.when(h.rlike(TIME_RE), h)


# -- p03 ---------------------------------------------------------------------
def to_double(c) -> Column:
    """Tolerant cast to double; NaN is normalised to NULL (Spark compares NaN as a value)."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def to_long(c) -> Column:
    """Tolerant cast to a nullable integer; fractional values become NULL."""
    x = to_double(c)
    return F.when(x == F.floor(x), x.try_cast("bigint"))


# -- p04 ---------------------------------------------------------------------
def null_if_placeholder(c, values) -> Column:
    """NULL when the value is one of the placeholder literals."""
    col = _c(c)
    return F.when(~col.isin(list(values)), col)


# -- p05 ---------------------------------------------------------------------
def combine_date_time(date_col, time_col=None) -> Column:
    """DATE + 'HH:mm:ss' text -> TIMESTAMP_NTZ. Missing/invalid time gives NULL, not midnight.

    Without a time column the date at 00:00 is used.
    """
    d = _c(date_col)
    if time_col is None:
        return d.cast("timestamp_ntz")
    s = F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" "), _c(time_col))
    return F.when(s.rlike(DATETIME_RE), s.try_cast("timestamp_ntz"))


def localize_wall_clock(ts, tz: str | None, *, gap: str = "shift", overlap: str = "null") -> Column:
    """Apply a time-zone policy to a local wall-clock TIMESTAMP_NTZ, result stays NTZ.

    - gap (the wall time does not exist): ``shift`` to the first valid instant, or ``null``;
    - overlap (the wall time occurs twice): ``null`` or ``keep``.
    Independent of the session time zone. Valid for one-hour transitions on the hour.
    """
    x = _c(ts)
    if not tz or tz.upper() in ("UTC", "GMT", "Z"):
        return x
    u = F.convert_timezone(F.lit(tz), F.lit("UTC"), x)
    y = F.convert_timezone(F.lit("UTC"), F.lit(tz), u)
    z = F.convert_timezone(F.lit("UTC"), F.lit(tz), u + F.expr("INTERVAL 1 HOUR"))
    shifted = y - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(y), F.second(y).cast("decimal(18,6)"))
    in_gap = y != x
    in_overlap = z == x
    out = F.when(in_gap, shifted if gap == "shift" else F.lit(None).cast("timestamp_ntz"))
    if overlap == "null":
        out = out.when(in_overlap, F.lit(None).cast("timestamp_ntz"))
    return out.otherwise(x)


# -- p06, p07, p12 -----------------------------------------------------------
def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def is_weekend(ts) -> Column:
    """1 on Saturday/Sunday, 0 otherwise (also 0 when the timestamp is NULL)."""
    return F.coalesce(F.weekday(_c(ts)).isin(5, 6), F.lit(False)).cast("int")


def week_of_month(ts) -> Column:
    return (F.floor((F.dayofmonth(_c(ts)) - 1) / 7) + 1).cast("int")


# -- p08 ---------------------------------------------------------------------
def season_south(ts_or_month, *, is_month: bool = False) -> Column:
    m = _c(ts_or_month) if is_month else F.month(_c(ts_or_month))
    out = None
    for name, months in config.SEASONS.items():
        cond = m.isin(*months)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


# -- p09 ---------------------------------------------------------------------
def daypart(hour) -> Column:
    h = _c(hour)
    out = None
    for name, (lo, hi) in config.DAYPARTS.items():
        cond = h.between(lo, hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def hour_with_fallback(time_col, date_col) -> Column:
    """Hour from the clock text, else from the date (midnight)."""
    t = F.when(_c(time_col).cast("string").rlike(TIME_RE), F.substring(_c(time_col).cast("string"), 1, 2).cast("int"))
    return F.coalesce(t, F.hour(_c(date_col).cast("timestamp_ntz")))


# -- p10 ---------------------------------------------------------------------
def is_holiday_window(ts) -> Column:
    """1 when the month-day falls in one of the fixed holiday windows."""
    mmdd = F.date_format(_c(ts), "MM-dd")
    cond = None
    for lo, hi in config.HOLIDAY_WINDOWS:
        c = (mmdd >= lo) | (mmdd <= hi) if lo > hi else mmdd.between(lo, hi)
        cond = c if cond is None else cond | c
    return F.coalesce(cond, F.lit(False)).cast("int")


# -- p11 ---------------------------------------------------------------------
def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian computus), as DATE."""
    y = _c(year)
    a = F.pmod(y, 19)
    b = F.floor(y / 100)
    c = F.pmod(y, 100)
    d = F.floor(b / 4)
    e = F.pmod(b, 4)
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, 30)
    i = F.floor(c / 4)
    k = F.pmod(c, 4)
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, 7)
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = F.pmod(h + l_ - 7 * m + 114, 31) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def is_national_holiday(ts, easter=None) -> Column:
    """Fixed-date national holidays plus Good Friday (Easter - 2); ``easter`` is Easter Sunday of the year if a column holds it."""
    d = F.to_date(_c(ts))
    fixed = F.date_format(d, "MM-dd").isin(*config.NATIONAL_HOLIDAYS)
    for day, first_year in config.NATIONAL_HOLIDAYS_SINCE.items():
        fixed = fixed | ((F.date_format(d, "MM-dd") == day) & (F.year(d) >= first_year))
    good_friday = F.date_sub(easter_sunday(F.year(d)) if easter is None else _c(easter), 2)
    return F.coalesce(fixed | (d == good_friday), F.lit(False)).cast("int")


def is_festive_period(ts, easter=None) -> Column:
    """National holiday, Christmas/New Year (12-20..01-05), June, or Carnival Tuesday +/- 2 days; ``easter`` as above."""
    d = F.to_date(_c(ts))
    xmas = ((F.month(d) == 12) & (F.dayofmonth(d) >= 20)) | ((F.month(d) == 1) & (F.dayofmonth(d) <= 5))
    june = F.month(d) == 6
    carnival = F.date_sub(easter_sunday(F.year(d)) if easter is None else _c(easter), 47)
    near_carnival = F.abs(F.datediff(d, carnival)) <= 2
    return F.coalesce((is_national_holiday(d, easter) == 1) | xmas | june | near_carnival, F.lit(False)).cast("int")


# -- p13 - p18 ---------------------------------------------------------------
def route(origin, dest, *, sep: str = "__", trim: bool = False) -> Column:
    """'origin<sep>dest'; NULL if either end is NULL."""
    o, d = _c(origin), _c(dest)
    if trim:
        o, d = F.trim(o), F.trim(d)
    return F.concat(o, F.lit(sep), d)


def has_return(origin_ret, dest_ret, tickets=None, *, strict: bool = True) -> Column:
    """1 when both return ends are present (strict: and at least 2 tickets)."""
    cond = _c(origin_ret).isNotNull() & _c(dest_ret).isNotNull()
    if strict and tickets is not None:
        cond = cond & (_c(tickets) >= 2)
    return F.coalesce(cond, F.lit(False)).cast("int")


def route_return(origin_ret, dest_ret, has_ret) -> Column:
    return F.when(_c(has_ret) == 1, route(origin_ret, dest_ret))


def avg_price(gmv, tickets) -> Column:
    return F.when(_c(tickets) > 0, _c(gmv) / _c(tickets))


def log_gmv(gmv) -> Column:
    g = _c(gmv)
    return F.when(g.isNotNull(), F.log1p(F.greatest(g, F.lit(0.0))))


def safe_ratio(num, den) -> Column:
    """num/den, 0 when den is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(num), F.nullif(_c(den), F.lit(0))), F.lit(0.0))


def days_between_floor(later, earlier) -> Column:
    """Whole days of ``later - earlier`` rounded down (negative for a later ``earlier``)."""
    secs = F.timestamp_diff("SECOND", _c(earlier).cast("timestamp_ntz"), _c(later).cast("timestamp_ntz"))
    return F.floor(secs / 86400).cast("int")
