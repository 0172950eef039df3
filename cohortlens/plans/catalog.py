"""Registered queries: one per operator of the inventory, each on the driver's test tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` built from the library's operators, and most
have an oracle in DuckDB SQL (``plans.oracle_sql``). Doubles are rounded on both sides (money 2
decimals, shares and z-scores 6) because distributed sums differ in the last bits; a unique key
is always part of the output so row hashes do not depend on order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as cl
from ..operators import features as ft
from ..operators.window import observation_window
from ..sources import testdata
from . import oracle_sql as O

BUILD_DATE = O.BUILD_DATE
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rnd(c, d: int):
    """Round half up on a shifted scale: floor(x * 10^d + 0.5 + 1e-6) / 10^d.

    Spark's ``round`` (exact decimal of the double) and DuckDB's disagree on values that sit
    on a half (sums of cents divided by a count); this form is the same IEEE arithmetic in both.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** d)
    return (F.floor(col * scale + 0.5 + 1e-6) / scale).cast("double")


def rounded(df: DataFrame, digits: dict) -> DataFrame:
    """Round the named double columns: ``{col: digits}``."""
    return df.withColumns({c: rnd(c, d) for c, d in digits.items()})


# -- shared inputs -----------------------------------------------------------
def raw(spark, sf):
    return testdata.purchases(spark, sf)


def prep(spark, sf):
    return cl.prepare(raw(spark, sf), tz="UTC")


def routed(spark, sf, **kw):
    return cl.route_rows(prep(spark, sf), **kw)


def window36(spark, sf):
    return observation_window(routed(spark, sf, n_buckets=None).clean, build_date=BUILD_DATE, months=36)


FEATURE_ROUND = {c: 6 for c in ft.FEATURE_COLUMNS if c.startswith("pct_") or c.endswith("_share")}
FEATURE_ROUND.update({"monetary_gmv_12m": 2, "avg_ticket_value": 2, "avg_price_per_ticket": 2})


def _feature_sql_cols():
    out = []
    for c in ft.FEATURE_COLUMNS:
        out.append(f"(floor(({c}) * 1e{FEATURE_ROUND[c]} + 0.5 + 1e-6) / 1e{FEATURE_ROUND[c]}) AS {c}" if c in FEATURE_ROUND else c)
    return ", ".join(out)


# == scans ===================================================================
@register("s02_read_parquet", O.q("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0"))
def s02_read_parquet(spark, sf):
    return testdata.table(spark, sf, "customer").select("c_custkey", "c_acctbal").where("c_acctbal > 0")


# == projections / casts (p01-p18) ============================================
@register("p01_cast_dates", O.q("SELECT _row_id, date_purchase FROM prep"))
def p01(spark, sf):
    return prep(spark, sf).select("_row_id", "date_purchase")


@register("p02_norm_time", O.q("SELECT _row_id, time_purchase FROM prep"))
def p02(spark, sf):
    return prep(spark, sf).select("_row_id", "time_purchase")


@register("p03_cast_numeric", O.q(
    "SELECT _row_id, (floor((gmv_success) * 1e2 + 0.5 + 1e-6) / 1e2) AS gmv_success, total_tickets_quantity_success FROM prep"))
def p03(spark, sf):
    return rounded(prep(spark, sf).select("_row_id", "gmv_success", "total_tickets_quantity_success"),
                   {"gmv_success": 2})


@register("p04_artificial_nulls", O.q(
    "SELECT _row_id, place_origin_return, place_destination_return, fk_return_ota_bus_company FROM prep"))
def p04(spark, sf):
    return prep(spark, sf).select("_row_id", "place_origin_return", "place_destination_return",
                                  "fk_return_ota_bus_company")


@register("p05_purchase_ts", O.q("SELECT _row_id, purchase_datetime FROM prep"))
def p05(spark, sf):
    return prep(spark, sf).select("_row_id", "purchase_datetime")


@register("p06_temporal_parts", O.q("SELECT _row_id, day_of_week, is_weekend, hour_of_day FROM prep"))
def p06(spark, sf):
    return prep(spark, sf).select("_row_id", "day_of_week", "is_weekend", "hour_of_day")


@register("p07_month_quarter", O.q("SELECT _row_id, month, quarter FROM cal"))
def p07(spark, sf):
    return cl.with_calendar(prep(spark, sf)).select("_row_id", "month", "quarter")


@register("p08_season_south", O.q("SELECT _row_id, season_br FROM cal"))
def p08(spark, sf):
    return cl.with_calendar(prep(spark, sf)).select("_row_id", "season_br")


@register("p09_daypart", O.q("SELECT _row_id, daypart FROM cal"))
def p09(spark, sf):
    return cl.with_calendar(prep(spark, sf)).select("_row_id", "daypart")


@register("p09b_daypart_fallback", O.q(
    "SELECT _row_id, CASE WHEN h < 6 THEN 'madrugada' WHEN h < 12 THEN 'manha' WHEN h < 18 THEN 'tarde' ELSE 'noite' END AS daypart "
    "FROM (SELECT _row_id, CASE WHEN time_purchase IS NOT NULL THEN CAST(left(CAST(time_purchase AS VARCHAR), 2) AS INTEGER) "
    "WHEN date_purchase IS NOT NULL THEN 0 END AS h FROM prep) WHERE h IS NOT NULL"))
def p09b(spark, sf):
    """Daypart of every row with a clock time or a date."""
    return cl.with_daypart(prep(spark, sf)).where("daypart IS NOT NULL").select("_row_id", "daypart")


@register("p10_is_holiday", O.q("SELECT _row_id, is_holiday FROM cal"))
def p10(spark, sf):
    return cl.with_calendar(prep(spark, sf)).select("_row_id", "is_holiday")


_EASTER = """
years AS (SELECT DISTINCT CAST(year(purchase_datetime) AS BIGINT) AS y FROM prep WHERE purchase_datetime IS NOT NULL),
ec AS (
  SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
ec2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM ec),
ec3 AS (SELECT *, (b - f + 1) // 3 AS g FROM ec2),
ec4 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM ec3),
ec5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM ec4),
ec6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM ec5),
easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, ((h + l - 7 * m + 114) % 31) + 1) AS easter FROM ec6),
fest AS (
  SELECT p._row_id, coalesce(CAST(p.purchase_datetime AS DATE), CAST(p.date_purchase AS DATE)) AS d, e.easter
  FROM prep p LEFT JOIN easter e ON e.y = year(coalesce(CAST(p.purchase_datetime AS DATE), CAST(p.date_purchase AS DATE))))
"""


#: Festive day of ``fest`` (d, easter) as SQL.
FESTIVE_SQL = ("strftime(f.d, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25') "
               "OR (strftime(f.d, '%m-%d') = '11-20' AND year(f.d) >= 2024) OR f.d = f.easter - 2 OR (month(f.d) = 12 AND day(f.d) >= 20) "
               "OR (month(f.d) = 1 AND day(f.d) <= 5) OR month(f.d) = 6 OR abs(date_diff('day', f.easter - 47, f.d)) <= 2")


@register("p11_festive_period", O.q(", " + _EASTER.strip() + """
SELECT _row_id,
  CASE WHEN d IS NOT NULL THEN CAST(strftime(d, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02',
       '11-15', '12-25') OR (strftime(d, '%m-%d') = '11-20' AND year(d) >= 2024) OR d = easter - 2 AS INTEGER) END AS is_national_holiday,
  CASE WHEN d IS NOT NULL THEN CAST(strftime(d, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02',
       '11-15', '12-25') OR (strftime(d, '%m-%d') = '11-20' AND year(d) >= 2024) OR d = easter - 2
       OR (month(d) = 12 AND day(d) >= 20) OR (month(d) = 1 AND day(d) <= 5) OR month(d) = 6
       OR abs(date_diff('day', easter - 47, d)) <= 2 AS INTEGER) END AS is_festive_period
FROM fest"""))
def p11(spark, sf):
    return cl.with_festive_period(prep(spark, sf)).select("_row_id", "is_national_holiday", "is_festive_period")


@register("p12_week_of_month", O.q("SELECT _row_id, week_of_month, day_of_week FROM cal"))
def p12(spark, sf):
    return cl.with_calendar(prep(spark, sf)).select("_row_id", "week_of_month", "day_of_week")


@register("p13_route", O.q(
    "SELECT _row_id, route_out, trim(place_origin_departure) || '->' || trim(place_destination_departure) AS route_arrow "
    "FROM prep"))
def p13(spark, sf):
    from ..functions.cleaning import route
    df = prep(spark, sf)
    return df.select("_row_id", "route_out",
                     route("place_origin_departure", "place_destination_departure", sep="->", trim=True)
                     .alias("route_arrow"))


@register("p14_has_return", O.q("SELECT _row_id, has_return FROM prep"))
def p14(spark, sf):
    return prep(spark, sf).select("_row_id", "has_return")


@register("p15_has_return_relaxed", O.q(
    "SELECT _row_id, CAST(coalesce(place_origin_return IS NOT NULL AND place_destination_return IS NOT NULL, false) "
    "AS INTEGER) AS has_return_relaxed FROM prep"))
def p15(spark, sf):
    from ..functions.cleaning import has_return
    return prep(spark, sf).select(
        "_row_id", has_return("place_origin_return", "place_destination_return", strict=False)
        .alias("has_return_relaxed"))


@register("p16_route_return", O.q("SELECT _row_id, route_return FROM prep"))
def p16(spark, sf):
    return prep(spark, sf).select("_row_id", "route_return")


@register("p17_avg_price", O.q("SELECT _row_id, (floor((avg_price_per_ticket) * 1e2 + 0.5 + 1e-6) / 1e2) AS avg_price_per_ticket FROM prep"))
def p17(spark, sf):
    return rounded(prep(spark, sf).select("_row_id", "avg_price_per_ticket"), {"avg_price_per_ticket": 2})


@register("p18_log_gmv", O.q("SELECT _row_id, (floor((log_gmv_success) * 1e6 + 0.5 + 1e-6) / 1e6) AS log_gmv_success FROM prep"))
def p18(spark, sf):
    return rounded(prep(spark, sf).select("_row_id", "log_gmv_success"), {"log_gmv_success": 6})


@register("p19_safe_ratio", O.q(
    "SELECT _row_id, (floor((coalesce(gmv_success / nullif(total_tickets_quantity_success, 0), 0)) * 1e2 + 0.5 + 1e-6) / 1e2) AS gmv_per_ticket "
    "FROM prep"))
def p19(spark, sf):
    from ..functions.cleaning import safe_ratio
    df = prep(spark, sf)
    return rounded(df.select("_row_id", safe_ratio("gmv_success", "total_tickets_quantity_success")
                             .alias("gmv_per_ticket")), {"gmv_per_ticket": 2})


# == filters / routing (f, d, u) =============================================
ROW_COLS = ["_row_id", "nk_ota_localizer_id", "fk_contact", "purchase_datetime", "gmv_success",
            "total_tickets_quantity_success"]
ROW_SQL = "_row_id, nk_ota_localizer_id, fk_contact, purchase_datetime, (floor((gmv_success) * 1e2 + 0.5 + 1e-6) / 1e2) AS gmv_success, " \
          "total_tickets_quantity_success"


def _rows(df):
    return rounded(df.select(*ROW_COLS), {"gmv_success": 2})


@register("f01_audit_split", O.q(f"SELECT {ROW_SQL} FROM routed WHERE route = 'audit'"))
def f01(spark, sf):
    return _rows(prep(spark, sf).where(cl.is_audit()))


@register("f02_valid_split", O.q(f"SELECT {ROW_SQL} FROM routed WHERE route = 'invalid'"))
def f02(spark, sf):
    return _rows(prep(spark, sf).where(~cl.is_audit() & ~cl.is_valid()))


@register("f03_observation_window", O.q(f"SELECT {ROW_SQL} FROM win"))
def f03(spark, sf):
    return _rows(window36(spark, sf))


@register("f06_rule_violations", O.q(
    "SELECT CAST(count(*) AS BIGINT) AS n_violations FROM prep WHERE place_origin_return IS NOT NULL "
    "AND place_destination_return IS NOT NULL AND total_tickets_quantity_success < 2"))
def f06(spark, sf):
    from ..functions.cleaning import has_return
    df = prep(spark, sf)
    relaxed = has_return("place_origin_return", "place_destination_return", strict=False)
    return df.where((relaxed == 1) & (F.col("total_tickets_quantity_success") < 2)) \
        .agg(F.count(F.lit(1)).alias("n_violations"))


@register("f07_profile_minmax", O.q(
    "SELECT min(date_purchase) AS min_date, max(date_purchase) AS max_date, min(time_purchase) AS min_time, "
    "max(time_purchase) AS max_time, (floor((min(gmv_success)) * 1e2 + 0.5 + 1e-6) / 1e2) AS min_gmv, (floor((max(gmv_success)) * 1e2 + 0.5 + 1e-6) / 1e2) AS max_gmv, "
    "min(total_tickets_quantity_success) AS min_tickets, max(total_tickets_quantity_success) AS max_tickets FROM prep"))
def f07(spark, sf):
    from ..operators.reports import profile_minmax
    return profile_minmax(prep(spark, sf))


@register("f08_drop_null_keys", O.q(
    "SELECT trim(fk_contact) AS fk_contact, CAST(purchase_datetime AS DATE) AS purchase_dt FROM pevents "
    "WHERE trim(fk_contact) IS NOT NULL AND purchase_datetime IS NOT NULL"))
def f08(spark, sf):
    from ..operators.labels import purchase_days_input
    return purchase_days_input(testdata.purchase_events(spark, sf), contact="fk_contact", ts="purchase_datetime")


@register("d01_mark_duplicates", O.q(
    "SELECT _row_id, CAST(rn_first > 1 AS INTEGER) AS is_duplicated FROM ranked WHERE stage0 IS NULL"))
def d01(spark, sf):
    df = prep(spark, sf).where(cl.is_valid())
    return cl.mark_duplicates(df, keep="first").select("_row_id", "is_duplicated")


@register("d02_all_copies", O.q(
    "SELECT _row_id, nk_ota_localizer_id FROM prep WHERE nk_ota_localizer_id IN "
    "(SELECT nk_ota_localizer_id FROM prep GROUP BY 1 HAVING count(*) > 1)"))
def d02(spark, sf):
    return cl.all_copies(prep(spark, sf), key="nk_ota_localizer_id").select("_row_id", "nk_ota_localizer_id")


@register("d03_canonical_resolve", O.q(f"SELECT {ROW_SQL} FROM ranked WHERE stage0 IS NULL AND rn = 1"))
def d03(spark, sf):
    df = prep(spark, sf).where(cl.is_valid())
    return _rows(cl.canonical_rows(df))


@register("d04_distinct_contact_time", O.q(
    "SELECT _row_id, fk_contact, purchase_datetime FROM (SELECT *, row_number() OVER (PARTITION BY fk_contact, "
    "purchase_datetime ORDER BY gmv_success NULLS LAST, _row_id) AS r FROM prep) WHERE r = 1"))
def d04(spark, sf):
    return cl.distinct_contact_time(prep(spark, sf)).select("_row_id", "fk_contact", "purchase_datetime")


@register("d05_p99_outliers", O.q(
    f"SELECT {ROW_SQL}, (floor((p99_avg_price_per_ticket) * 1e2 + 0.5 + 1e-6) / 1e2) AS p99 FROM routed WHERE route = 'outlier'"))
def d05(spark, sf):
    r = routed(spark, sf, n_buckets=None)
    thr = r.threshold.select(rnd("p99_avg_price_per_ticket", 2)).scalar()
    return _rows(r.outliers).withColumn("p99", thr)


@register("d06_p99_flag", O.q(
    "SELECT _row_id, CAST(coalesce(avg_price_per_ticket > (SELECT quantile_cont(avg_price_per_ticket, 0.99) FROM prep), "
    "false) AS INTEGER) AS is_price_outlier_p99 FROM prep"))
def d06(spark, sf):
    return cl.p99_flag(prep(spark, sf)).select("_row_id", "is_price_outlier_p99")


@register("d07_gmv_bucket", O.q("SELECT _row_id, gmv_bucket FROM clean"))
def d07(spark, sf):
    return routed(spark, sf).clean.select("_row_id", "gmv_bucket")


@register("u02_partition_check", O.q("SELECT route, CAST(count(*) AS BIGINT) AS n_rows FROM routed GROUP BY route"))
def u02(spark, sf):
    return routed(spark, sf, n_buckets=None).counts()


# == aggregations (a01-a17) ==================================================
@register("a01_rfm", O.q(
    "SELECT fk_contact, last_purchase, frequency_12m, (floor((monetary_gmv_12m) * 1e2 + 0.5 + 1e-6) / 1e2) AS monetary_gmv_12m, recency_days, "
    "(floor((avg_ticket_value) * 1e2 + 0.5 + 1e-6) / 1e2) AS avg_ticket_value FROM feat"))
def a01(spark, sf):
    return rounded(ft.rfm(window36(spark, sf), build_date=BUILD_DATE),
                   {"monetary_gmv_12m": 2, "avg_ticket_value": 2})


@register("a02_trip_structure", O.q(
    "SELECT fk_contact, (floor((pct_round_trip) * 1e6 + 0.5 + 1e-6) / 1e6) AS pct_round_trip, n_unique_routes_out, top_route_out, "
    "(floor((top_route_out_share) * 1e6 + 0.5 + 1e-6) / 1e6) AS top_route_out_share FROM feat"))
def a02(spark, sf):
    return rounded(ft.trip_structure(window36(spark, sf)), {"pct_round_trip": 6, "top_route_out_share": 6})


_ORDERS_TOP = """
SELECT fk_contact, v AS {top}, (floor((c / sum(c) OVER (PARTITION BY fk_contact)) * 1e6 + 0.5 + 1e-6) / 1e6) AS {top}_share
FROM (SELECT *, row_number() OVER (PARTITION BY fk_contact ORDER BY c DESC, v) AS rk,
      FROM (SELECT fk_contact, {col} AS v, count(DISTINCT nk_ota_localizer_id) AS c FROM win
            WHERE {col} IS NOT NULL AND nk_ota_localizer_id IS NOT NULL AND fk_contact IS NOT NULL GROUP BY 1, 2))
QUALIFY rk = 1
"""


@register("a03_top_route_by_orders", O.q(_ORDERS_TOP.format(top="top_route_out", col="route_out")))
def a03(spark, sf):
    out = ft.top_share(window36(spark, sf), by="fk_contact", value="route_out", count="orders",
                       key="nk_ota_localizer_id", top="top_route_out")
    return rounded(out, {"top_route_out_share": 6})


@register("a04_company_pref", O.q(
    "SELECT fk_contact, top_company_out, (floor((top_company_out_share) * 1e6 + 0.5 + 1e-6) / 1e6) AS top_company_out_share FROM feat"))
def a04(spark, sf):
    return rounded(ft.company_pref(window36(spark, sf)), {"top_company_out_share": 6})


@register("a05_company_pref_by_orders", O.q(
    _ORDERS_TOP.format(top="top_company_out", col="fk_departure_ota_bus_company")))
def a05(spark, sf):
    out = ft.top_share(window36(spark, sf), by="fk_contact", value="fk_departure_ota_bus_company", count="orders",
                       key="nk_ota_localizer_id", top="top_company_out")
    return rounded(out, {"top_company_out_share": 6})


def _share_sql(cat_expr, values, names, src="wcal"):
    parts = [f"(floor((coalesce(sum(CASE WHEN {cat_expr} = {v} THEN 1 ELSE 0 END) / nullif(count({cat_expr}), 0), 0)) * 1e6 + 0.5 + 1e-6) / 1e6)"
             f" AS {n}" for v, n in zip(values, names)]
    return f"SELECT fk_contact, {', '.join(parts)} FROM {src} WHERE fk_contact IS NOT NULL GROUP BY fk_contact"


def _share_query(cat, values, names):
    def fn(spark, sf):
        win = cl.with_calendar(window36(spark, sf))
        out = ft.category_share(win, by="fk_contact", category=cat, values=values, names=names)
        return rounded(out, {n: 6 for n in names})
    return fn


_Q = [1, 2, 3, 4]
register("a06_share_quarter", O.q(_share_sql("quarter", _Q, [f"pct_q{q}" for q in _Q])))(
    _share_query("quarter", _Q, [f"pct_q{q}" for q in _Q]))
_S = list(ft.SEASON_NAMES)
register("a07_share_season", O.q(_share_sql("season_br", [f"'{s}'" for s in _S], [f"pct_{s}" for s in _S])))(
    _share_query("season_br", _S, [f"pct_{s}" for s in _S]))
_D = list(ft.DAYPART_NAMES)
register("a08_share_daypart", O.q(_share_sql("daypart", [f"'{s}'" for s in _D], [f"pct_{s}" for s in _D])))(
    _share_query("daypart", _D, [f"pct_{s}" for s in _D]))
_M = list(range(1, 13))
register("a09_share_month", O.q(_share_sql("CAST(month(purchase_datetime) AS INTEGER)", _M,
                                           [f"pct_m{m:02d}" for m in _M], src="win")))(
    _share_query("month", _M, [f"pct_m{m:02d}" for m in _M]))
_W = list(range(7))
register("a10_share_weekday", O.q(_share_sql("day_of_week", _W, [f"pct_{n}" for n in
                                                                  ["seg", "ter", "qua", "qui", "sex", "sab", "dom"]],
                                             src="win")))(
    _share_query("day_of_week", _W, [f"pct_{n}" for n in ["seg", "ter", "qua", "qui", "sex", "sab", "dom"]]))
_WM = [1, 2, 3, 4, 5]
register("a11_share_week_of_month", O.q(_share_sql("CAST(floor((day(purchase_datetime) - 1) / 7) + 1 AS INTEGER)", _WM,
                                                   [f"pct_wom{w}" for w in _WM], src="win")))(
    _share_query("week_of_month", _WM, [f"pct_wom{w}" for w in _WM]))


@register("a12_pct_weekend", O.q("SELECT fk_contact, (floor((pct_weekend) * 1e6 + 0.5 + 1e-6) / 1e6) AS pct_weekend FROM feat"))
def a12(spark, sf):
    return rounded(ft.mean_flag(window36(spark, sf), by="fk_contact", flag="is_weekend", name="pct_weekend"),
                   {"pct_weekend": 6})


@register("a13_pct_holiday", O.q("SELECT fk_contact, (floor((pct_holiday) * 1e6 + 0.5 + 1e-6) / 1e6) AS pct_holiday FROM feat"))
def a13(spark, sf):
    win = cl.with_calendar(window36(spark, sf))
    return rounded(ft.mean_flag(win, by="fk_contact", flag="is_holiday", name="pct_holiday"), {"pct_holiday": 6})


@register("a15_intensity", O.q(
    "SELECT fk_contact, total_tickets_12m, (floor((avg_price_per_ticket) * 1e2 + 0.5 + 1e-6) / 1e2) AS avg_price_per_ticket FROM feat"))
def a15(spark, sf):
    return rounded(ft.intensity(window36(spark, sf)), {"avg_price_per_ticket": 2})


@register("a16_intensity_weighted", O.q(
    "SELECT fk_contact, CAST(coalesce(sum(total_tickets_quantity_success), 0) AS BIGINT) AS total_tickets_12m, "
    "(floor((sum(gmv_success) / nullif(sum(total_tickets_quantity_success), 0)) * 1e2 + 0.5 + 1e-6) / 1e2) AS avg_price_per_ticket "
    "FROM win WHERE fk_contact IS NOT NULL GROUP BY fk_contact"))
def a16(spark, sf):
    return rounded(ft.intensity(window36(spark, sf), weighted=True), {"avg_price_per_ticket": 2})


@register("a17_customer_features", O.q(f"SELECT {_feature_sql_cols()} FROM feat"))
def a17(spark, sf):
    feats = ft.customer_features(window36(spark, sf), build_date=BUILD_DATE, model_version="v1")
    return rounded(feats, FEATURE_ROUND)


def customer_features_raw(spark, sf):
    """Unrounded customer features (input of the standardisation and clustering queries)."""
    return ft.customer_features(window36(spark, sf), build_date=BUILD_DATE, model_version="v1")

