"""The driver's parquet test tables and the purchase-shaped views built from them.

``PURCHASES_SQL`` is a single SQL text that runs unchanged in Spark SQL and DuckDB, so a
Spark query and its oracle start from identical input rows. It only reshapes the test
tables into the raw purchase schema (with some dirty values put in by key arithmetic);
it does none of the library's work. ``_row_id`` stands for the line number of the raw
export (orders key order), which is what "first occurrence" means for the raw file.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DEFAULT_SF_DIR = "/root/testdata/sf0.001"

PURCHASES_SQL = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n, min(l_suppkey) AS s_lo, max(l_suppkey) AS s_hi
  FROM lineitem GROUP BY l_orderkey)
SELECT
  o_orderkey AS _row_id,
  CAST(CASE WHEN o_orderkey % 50 = 7 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) AS nk_ota_localizer_id,
  CAST(o_custkey AS STRING) AS fk_contact,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_purchase,
  CASE WHEN o_orderkey % 401 = 13 THEN '' ELSE
    lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST((o_orderkey * 7) % 60 AS STRING), 2, '0') ||
    CASE WHEN o_orderkey % 10 = 3 THEN ''
         ELSE ':' || lpad(CAST((o_orderkey * 13) % 60 AS STRING), 2, '0') END END AS time_purchase,
  CASE WHEN o_orderkey % 97 = 5 THEN -o_totalprice
       WHEN o_orderkey % 89 = 4 THEN CAST(0 AS DOUBLE)
       WHEN o_orderkey % 211 = 9 THEN NULL
       ELSE o_totalprice END AS gmv_success,
  CAST(CASE WHEN o_orderkey % 61 = 2 THEN 0
            WHEN o_orderkey % 307 = 11 THEN NULL
            ELSE coalesce(n, 1) END AS BIGINT) AS total_tickets_quantity_success,
  'N' || CAST(c_nationkey AS STRING) AS place_origin_departure,
  'N' || CAST(s_nationkey AS STRING) AS place_destination_departure,
  CASE WHEN o_orderkey % 3 = 0 THEN 'N' || CAST(s_nationkey AS STRING) ELSE '0' END AS place_origin_return,
  CASE WHEN o_orderkey % 3 = 0 THEN 'N' || CAST(c_nationkey AS STRING) ELSE '0' END AS place_destination_return,
  CAST(s_lo AS STRING) AS fk_departure_ota_bus_company,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(s_hi AS STRING) ELSE '1' END AS fk_return_ota_bus_company
FROM orders
JOIN customer ON c_custkey = o_custkey
LEFT JOIN li ON l_orderkey = o_orderkey
LEFT JOIN supplier ON s_suppkey = s_lo
"""

# Purchase events for the repurchase labels: one row per purchase event.
PURCHASE_EVENTS_SQL = """
SELECT CAST(user_id AS STRING) AS fk_contact, ts AS purchase_datetime
FROM events WHERE event_type = 'purchase'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the test tables as temp views (lazy parquet scans)."""
    for name in names or TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            spark.read.parquet(path).createOrReplaceTempView(name)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw purchase rows (all strings/numbers as a CSV export would carry them)."""
    register_tables(spark, sf_dir, ["orders", "customer", "lineitem", "supplier"])
    return spark.sql(PURCHASES_SQL)


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, sf_dir, ["events"])
    return spark.sql(PURCHASE_EVENTS_SQL)
