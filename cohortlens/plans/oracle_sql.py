"""Independent DuckDB SQL for the correctness gate (the same rules written as plain SQL).

``CHAIN`` is a CTE chain from the raw test tables to the routed and windowed purchases; an
oracle is ``CHAIN + 'SELECT ... FROM <cte>'``. DuckDB only evaluates the CTEs a query uses.
Time zone rules stay out of the oracles (tz = UTC on both sides); the DST rule is unit-tested.
"""

from __future__ import annotations

from ..sources.testdata import PURCHASE_EVENTS_SQL, PURCHASES_SQL

BUILD_DATE = "2001-07-01"
WINDOW_START = "1998-07-01 00:00:00"   # BUILD_DATE - 36 months
WINDOW_END = "2001-07-02 00:00:00"     # exclusive: end of the build day

_NULLS_RET = "('0', '', 'NA', 'None', 'null')"
_NULLS_COMP = "('1', '', 'NA', 'None', 'null')"

NUM_FEATURES = [
    "frequency_12m", "monetary_gmv_12m", "recency_days", "avg_ticket_value", "pct_round_trip", "n_unique_routes_out",
    "top_route_out_share", "top_company_out_share", "pct_q1", "pct_q2", "pct_q3", "pct_q4", "pct_verao", "pct_outono",
    "pct_inverno", "pct_primavera", "pct_madrugada", "pct_manha", "pct_tarde", "pct_noite", "pct_weekend",
    "pct_holiday", "total_tickets_12m", "avg_price_per_ticket"]
_NUM_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM_FEATURES)
_NUM_LIST = ", ".join(NUM_FEATURES)

CHAIN = f"""
WITH raw AS ({PURCHASES_SQL}),
prep0 AS (
  SELECT _row_id, nk_ota_localizer_id, fk_contact,
    CAST(try_strptime(date_purchase, '%Y-%m-%d') AS DATE) AS date_purchase,
    CASE WHEN length(substr(trim(time_purchase), 1, 8)) = 5 THEN substr(trim(time_purchase), 1, 8) || ':00'
         ELSE substr(trim(time_purchase), 1, 8) END AS t0,
    CASE WHEN isnan(gmv_success) THEN NULL ELSE gmv_success END AS gmv_success,
    total_tickets_quantity_success,
    place_origin_departure, place_destination_departure,
    CASE WHEN place_origin_return IN {_NULLS_RET} THEN NULL ELSE place_origin_return END AS place_origin_return,
    CASE WHEN place_destination_return IN {_NULLS_RET} THEN NULL ELSE place_destination_return END
      AS place_destination_return,
    fk_departure_ota_bus_company,
    CASE WHEN fk_return_ota_bus_company IN {_NULLS_COMP} THEN NULL ELSE fk_return_ota_bus_company END
      AS fk_return_ota_bus_company
  FROM raw),
prep1 AS (
  SELECT * EXCLUDE (t0),
    CASE WHEN regexp_full_match(t0, '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') THEN t0 END AS time_purchase
  FROM prep0),
prep2 AS (
  SELECT *, TRY_CAST(strftime(date_purchase, '%Y-%m-%d') || ' ' || time_purchase AS TIMESTAMP) AS purchase_datetime
  FROM prep1),
prep AS (
  SELECT *,
    CAST(isodow(purchase_datetime) - 1 AS INTEGER) AS day_of_week,
    CAST(coalesce(isodow(purchase_datetime) IN (6, 7), false) AS INTEGER) AS is_weekend,
    CAST(hour(purchase_datetime) AS INTEGER) AS hour_of_day,
    place_origin_departure || '__' || place_destination_departure AS route_out,
    CAST(coalesce(place_origin_return IS NOT NULL AND place_destination_return IS NOT NULL
                  AND total_tickets_quantity_success >= 2, false) AS INTEGER) AS has_return,
    CASE WHEN coalesce(place_origin_return IS NOT NULL AND place_destination_return IS NOT NULL
                  AND total_tickets_quantity_success >= 2, false)
         THEN place_origin_return || '__' || place_destination_return END AS route_return,
    CASE WHEN total_tickets_quantity_success > 0 THEN gmv_success / total_tickets_quantity_success END
      AS avg_price_per_ticket,
    CASE WHEN gmv_success IS NOT NULL THEN ln(1 + greatest(gmv_success, 0)) END AS log_gmv_success
  FROM prep2),
cal AS (
  SELECT *,
    CAST(month(purchase_datetime) AS INTEGER) AS month,
    CAST(quarter(purchase_datetime) AS INTEGER) AS quarter,
    CASE WHEN month(purchase_datetime) IN (12, 1, 2) THEN 'verao'
         WHEN month(purchase_datetime) IN (3, 4, 5) THEN 'outono'
         WHEN month(purchase_datetime) IN (6, 7, 8) THEN 'inverno'
         WHEN month(purchase_datetime) IN (9, 10, 11) THEN 'primavera' END AS season_br,
    CASE WHEN hour(purchase_datetime) BETWEEN 0 AND 5 THEN 'madrugada'
         WHEN hour(purchase_datetime) BETWEEN 6 AND 11 THEN 'manha'
         WHEN hour(purchase_datetime) BETWEEN 12 AND 17 THEN 'tarde'
         WHEN hour(purchase_datetime) BETWEEN 18 AND 23 THEN 'noite' END AS daypart,
    CASE WHEN purchase_datetime IS NOT NULL THEN CAST(
         strftime(purchase_datetime, '%m-%d') >= '12-20' OR strftime(purchase_datetime, '%m-%d') <= '01-05'
      OR strftime(purchase_datetime, '%m-%d') BETWEEN '02-01' AND '03-15'
      OR strftime(purchase_datetime, '%m-%d') BETWEEN '06-01' AND '06-30' AS INTEGER) END AS is_holiday,
    CAST(floor((day(purchase_datetime) - 1) / 7) + 1 AS INTEGER) AS week_of_month
  FROM prep),
stage AS (
  SELECT *, CASE WHEN coalesce(gmv_success < 0, false) THEN 'audit'
                 WHEN NOT coalesce(gmv_success > 0 AND total_tickets_quantity_success > 0, false) THEN 'invalid'
            END AS stage0
  FROM prep),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY nk_ota_localizer_id, stage0 IS NULL
                               ORDER BY purchase_datetime DESC NULLS LAST, gmv_success DESC NULLS LAST, _row_id) AS rn,
            row_number() OVER (PARTITION BY nk_ota_localizer_id, stage0 IS NULL ORDER BY _row_id) AS rn_first
  FROM stage),
thr AS (
  SELECT quantile_cont(avg_price_per_ticket, 0.99) AS p99_avg_price_per_ticket
  FROM ranked WHERE stage0 IS NULL AND rn = 1 AND avg_price_per_ticket > 0),
routed AS (
  SELECT ranked.*, thr.p99_avg_price_per_ticket,
    CASE WHEN stage0 IS NOT NULL THEN stage0 WHEN rn > 1 THEN 'duplicate'
         WHEN coalesce(avg_price_per_ticket > p99_avg_price_per_ticket, false) THEN 'outlier'
         ELSE 'clean' END AS route
  FROM ranked, thr),
edges AS (
  SELECT list_sort(list_distinct(quantile_cont(gmv_success, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e
  FROM routed WHERE route = 'clean' AND gmv_success > 0),
clean AS (
  SELECT routed.* EXCLUDE (stage0, rn, rn_first, p99_avg_price_per_ticket, route),
    CASE WHEN gmv_success > 0 AND len(e) = 6
         THEN 'Q' || CAST(greatest(len(list_filter(e, lambda x: x < gmv_success)), 1) AS VARCHAR) END AS gmv_bucket
  FROM routed, edges WHERE route = 'clean'),
win AS (
  SELECT * FROM clean
  WHERE purchase_datetime >= TIMESTAMP '{WINDOW_START}' AND purchase_datetime < TIMESTAMP '{WINDOW_END}'),
wcal AS (
  SELECT *,
    CAST(quarter(purchase_datetime) AS INTEGER) AS quarter,
    CASE WHEN month(purchase_datetime) IN (12, 1, 2) THEN 'verao'
         WHEN month(purchase_datetime) IN (3, 4, 5) THEN 'outono'
         WHEN month(purchase_datetime) IN (6, 7, 8) THEN 'inverno'
         WHEN month(purchase_datetime) IN (9, 10, 11) THEN 'primavera' END AS season_br,
    CASE WHEN hour(purchase_datetime) BETWEEN 0 AND 5 THEN 'madrugada'
         WHEN hour(purchase_datetime) BETWEEN 6 AND 11 THEN 'manha'
         WHEN hour(purchase_datetime) BETWEEN 12 AND 17 THEN 'tarde'
         WHEN hour(purchase_datetime) BETWEEN 18 AND 23 THEN 'noite' END AS daypart,
    CAST(strftime(purchase_datetime, '%m-%d') >= '12-20' OR strftime(purchase_datetime, '%m-%d') <= '01-05'
      OR strftime(purchase_datetime, '%m-%d') BETWEEN '02-01' AND '03-15'
      OR strftime(purchase_datetime, '%m-%d') BETWEEN '06-01' AND '06-30' AS INTEGER) AS is_holiday
  FROM win),
rtop AS (
  SELECT fk_contact, v AS top_route_out, c / sum(c) OVER (PARTITION BY fk_contact) AS top_route_out_share,
         count(*) OVER (PARTITION BY fk_contact) AS n_unique_routes_out,
         row_number() OVER (PARTITION BY fk_contact ORDER BY c DESC, v) AS rk
  FROM (SELECT fk_contact, route_out AS v, count(*) AS c FROM win WHERE route_out IS NOT NULL GROUP BY 1, 2)),
ctop AS (
  SELECT fk_contact, v AS top_company_out, c / sum(c) OVER (PARTITION BY fk_contact) AS top_company_out_share,
         row_number() OVER (PARTITION BY fk_contact ORDER BY c DESC, v) AS rk
  FROM (SELECT fk_contact, fk_departure_ota_bus_company AS v, count(*) AS c FROM win
        WHERE fk_departure_ota_bus_company IS NOT NULL GROUP BY 1, 2)),
feat0 AS (
  SELECT fk_contact,
    max(purchase_datetime) AS last_purchase,
    count(DISTINCT nk_ota_localizer_id) AS frequency_12m,
    coalesce(sum(gmv_success), 0) AS monetary_gmv_12m,
    avg(coalesce(has_return, 0)) AS pct_round_trip,
    coalesce(sum(CASE WHEN quarter = 1 THEN 1 ELSE 0 END) / nullif(count(quarter), 0), 0) AS pct_q1,
    coalesce(sum(CASE WHEN quarter = 2 THEN 1 ELSE 0 END) / nullif(count(quarter), 0), 0) AS pct_q2,
    coalesce(sum(CASE WHEN quarter = 3 THEN 1 ELSE 0 END) / nullif(count(quarter), 0), 0) AS pct_q3,
    coalesce(sum(CASE WHEN quarter = 4 THEN 1 ELSE 0 END) / nullif(count(quarter), 0), 0) AS pct_q4,
    coalesce(sum(CASE WHEN season_br = 'verao' THEN 1 ELSE 0 END) / nullif(count(season_br), 0), 0) AS pct_verao,
    coalesce(sum(CASE WHEN season_br = 'outono' THEN 1 ELSE 0 END) / nullif(count(season_br), 0), 0) AS pct_outono,
    coalesce(sum(CASE WHEN season_br = 'inverno' THEN 1 ELSE 0 END) / nullif(count(season_br), 0), 0) AS pct_inverno,
    coalesce(sum(CASE WHEN season_br = 'primavera' THEN 1 ELSE 0 END) / nullif(count(season_br), 0), 0)
      AS pct_primavera,
    coalesce(sum(CASE WHEN daypart = 'madrugada' THEN 1 ELSE 0 END) / nullif(count(daypart), 0), 0) AS pct_madrugada,
    coalesce(sum(CASE WHEN daypart = 'manha' THEN 1 ELSE 0 END) / nullif(count(daypart), 0), 0) AS pct_manha,
    coalesce(sum(CASE WHEN daypart = 'tarde' THEN 1 ELSE 0 END) / nullif(count(daypart), 0), 0) AS pct_tarde,
    coalesce(sum(CASE WHEN daypart = 'noite' THEN 1 ELSE 0 END) / nullif(count(daypart), 0), 0) AS pct_noite,
    coalesce(avg(is_weekend), 0) AS pct_weekend,
    coalesce(avg(is_holiday), 0) AS pct_holiday,
    CAST(coalesce(sum(total_tickets_quantity_success), 0) AS BIGINT) AS total_tickets_12m,
    avg(avg_price_per_ticket) AS avg_price_per_ticket
  FROM wcal WHERE fk_contact IS NOT NULL GROUP BY fk_contact),
feat AS (
  SELECT f.fk_contact, f.last_purchase, CAST(f.frequency_12m AS BIGINT) AS frequency_12m, f.monetary_gmv_12m,
    CAST(floor(date_diff('second', f.last_purchase, TIMESTAMP '{BUILD_DATE} 00:00:00') / 86400.0) AS INTEGER)
      AS recency_days,
    CASE WHEN f.frequency_12m > 0 THEN f.monetary_gmv_12m / f.frequency_12m END AS avg_ticket_value,
    f.pct_round_trip, CAST(coalesce(r.n_unique_routes_out, 0) AS BIGINT) AS n_unique_routes_out,
    r.top_route_out, coalesce(r.top_route_out_share, 0) AS top_route_out_share,
    c.top_company_out, coalesce(c.top_company_out_share, 0) AS top_company_out_share,
    f.pct_q1, f.pct_q2, f.pct_q3, f.pct_q4, f.pct_verao, f.pct_outono, f.pct_inverno, f.pct_primavera,
    f.pct_madrugada, f.pct_manha, f.pct_tarde, f.pct_noite, f.pct_weekend, f.pct_holiday,
    f.total_tickets_12m, f.avg_price_per_ticket,
    DATE '{BUILD_DATE}' AS build_date, 'v1' AS model_version
  FROM feat0 f
  LEFT JOIN (SELECT * FROM rtop WHERE rk = 1) r USING (fk_contact)
  LEFT JOIN (SELECT * FROM ctop WHERE rk = 1) c USING (fk_contact)),
pevents AS ({PURCHASE_EVENTS_SQL}),
featd AS (SELECT fk_contact, {_NUM_CAST} FROM feat),
flong AS (
  SELECT fk_contact, feature, x FROM featd UNPIVOT INCLUDE NULLS (x FOR feature IN ({_NUM_LIST}))),
sk AS (
  SELECT feature, sum(CASE WHEN x > 0 THEN 1 ELSE 0 END) AS n_positive, skewness(x) AS skew
  FROM flong GROUP BY feature),
fl AS (
  SELECT f.fk_contact, f.feature, coalesce(sk.n_positive > 0 AND sk.skew >= 1.0, false) AS is_log,
    CASE WHEN coalesce(sk.n_positive > 0 AND sk.skew >= 1.0, false)
         THEN CASE WHEN x IS NOT NULL THEN ln(1 + greatest(x, 0)) END ELSE x END AS x1
  FROM flong f JOIN sk USING (feature)),
fs AS (
  SELECT fk_contact, feature, is_log,
    CASE WHEN isnan(coalesce(x1, 0.0)) OR isinf(coalesce(x1, 0.0)) THEN 0.0 ELSE coalesce(x1, 0.0) END AS x2
  FROM fl),
st AS (
  SELECT feature, var_samp(x2) AS v, avg(x2) AS m, stddev_pop(x2) AS s, bool_or(is_log) AS is_log
  FROM fs GROUP BY feature),
zlong AS (
  SELECT fs.fk_contact, fs.feature, (x2 - m) / CASE WHEN s = 0 OR s IS NULL THEN 1 ELSE s END AS z
  FROM fs JOIN st USING (feature) WHERE v > 1e-12),
seg AS (
  SELECT f.fk_contact, CAST(dense_rank() OVER (ORDER BY c.c_mktsegment) - 1 AS INTEGER) AS cluster_id
  FROM feat f JOIN customer c ON c.c_custkey = CAST(f.fk_contact AS BIGINT)),
segz AS (
  SELECT seg.cluster_id, zlong.feature, avg(zlong.z) AS z
  FROM zlong JOIN seg USING (fk_contact) GROUP BY 1, 2),
emb AS (
  SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
embc AS (
  SELECT label AS cluster_id, d, avg(x) AS cx FROM emb GROUP BY 1, 2)
"""


def q(body: str) -> str:
    """An oracle statement: the shared CTE chain followed by ``body``."""
    return CHAIN + body
