"""Plan-shape checks: the scale properties the design relies on, read from the physical plans."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from cohortlens.operators import cleaning as cl
from cohortlens.operators import cluster as km
from cohortlens.operators import features as ft
from cohortlens.operators import labels as lb
from cohortlens.operators import quantiles as qt
from cohortlens.operators import reports as rp
from cohortlens.operators.window import observation_window
from cohortlens.session import ensure_checkpoint_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def purchases_table(spark):
    path = f"{ensure_checkpoint_dir(spark)}/plans-{uuid.uuid4().hex}"
    rows = [(f"c{i % 5}", f"k{i}", dt.datetime(2023, 1 + i % 12, 1 + i % 27, i % 24), 10.0 + i, 1 + i % 3,
             5.0 + i, i % 2, f"R{i % 4}", f"X{i % 3}") for i in range(200)]
    spark.createDataFrame(rows, "fk_contact string, nk_ota_localizer_id string, purchase_datetime timestamp_ntz, "
                                "gmv_success double, total_tickets_quantity_success long, avg_price_per_ticket double, "
                                "has_return int, route_out string, fk_departure_ota_bus_company string"
                          ).write.parquet(path)
    return spark.read.parquet(path)


def test_window_filter_reaches_parquet_scan(spark):
    df = observation_window(purchases_table(spark), build_date="2023-12-31", months=6)
    p = plan(df)
    assert "PushedFilters" in p and "purchase_datetime" in p.split("PushedFilters")[1][:400]


def test_features_never_shuffle_raw_rows_or_use_windows(spark):
    feats = ft.customer_features(purchases_table(spark), build_date="2024-01-01")
    p = plan(feats)
    assert "Window" not in p
    # every exchange on the customer key sits above a partial aggregate (map-side combine)
    for part in p.split("Exchange hashpartitioning(")[1:]:
        below = part.split("\n", 1)[1][:600]
        assert "Aggregate" in below


def test_top_k_uses_window_group_limit(spark):
    df = purchases_table(spark)
    out = rp.top_k_per_group(df, group="fk_contact", value="route_out", k=2)
    assert "WindowGroupLimit" in plan(out)


def test_assignment_is_a_projection(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [5.0, 5.0])], "id int, v array<double>")
    out = km.assign(df, [[0.0, 0.0], [5.0, 5.0]], array_col="v")
    p = plan(out)
    assert "Join" not in p and "Exchange" not in p
    assert [r["cluster_id"] for r in out.orderBy("id").collect()] == [0, 1]


def test_labels_have_no_range_join_and_partition_by_customer(spark):
    df = spark.createDataFrame([("c1", dt.datetime(2024, 1, 1)), ("c1", dt.datetime(2024, 1, 5))],
                               "fk_contact string, purchase_datetime timestamp_ntz")
    out = lb.repurchase_labels(lb.purchase_days(df), min_history_days=1, horizons=(3,))
    p = plan(out)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Generate explode" in p


def test_winning_rows_need_no_join_and_no_window(spark):
    out = cl.distinct_contact_time(purchases_table(spark).withColumn("_row_id", F.monotonically_increasing_id()))
    p = plan(out)
    assert "Join" not in p and "Window" not in p and p.count("Exchange") == 1
    assert out.count() == purchases_table(spark).select("fk_contact", "purchase_datetime").distinct().count()


def test_hot_order_key_is_split_and_flagged_by_row_id(spark):
    """A third of the rows share one order key: AQE splits its partition, and one row of it is kept."""
    n = 6000
    rows = spark.range(n).select(F.col("id").alias("_row_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("nk_ota_localizer_id"),
                                 F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("purchase_datetime"), (F.col("id") % 7).cast("double").alias("gmv_success"),
                                 F.repeat(F.md5(F.col("id").cast("string")), 4).alias("payload"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = f"{ensure_checkpoint_dir(spark)}/hot-{uuid.uuid4().hex}"
        rows.repartition(6).write.parquet(path)
        out = cl.mark_duplicates(spark.read.parquet(path), keep="canonical")
        kept = out.where("is_duplicated = 0").select("_row_id", "nk_ota_localizer_id").collect()
        out.collect()
        final = plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    hot = [r["_row_id"] for r in kept if r["nk_ota_localizer_id"] == "hot"]
    assert len(kept) == n - n // 3 + 1 and hot == [6]          # greatest gmv (6), then the first row


def test_quantiles_read_without_sort_or_table(spark, monkeypatch):
    """A third of the rows on one value: exact, and no range sort or written table; narrow brackets go in rounds."""
    import numpy as np
    x = np.where(np.arange(30_000) % 3 == 0, 7.25, np.random.default_rng(4).lognormal(2, 1, 30_000).round(2))
    df = spark.createDataFrame([(float(v), i % 5) for i, v in enumerate(x)], "x double, g int").repartition(4)
    qs = [0.0, 0.2, 0.5, 0.99, 1.0]
    monkeypatch.setattr(qt, "cut_lineage", lambda *a: (_ for _ in ()).throw(AssertionError("a table was written")))
    for most in (1 << 18, 200):
        monkeypatch.setattr(qt, "MOST", most)
        row = qt.quantiles(df, "x", qs).collect()[0]
        assert list(row)[:-1] == list(np.quantile(x, qs)) and row["n"] == 30_000
    monkeypatch.undo()
    keyed = df.select(F.struct(F.col("g").alias("_g")).alias("_g"), F.lit(0).alias("_f"), F.col("x").alias("_x"))
    for most in (1 << 18, 500):
        got = {r["_g"]["_g"]: r["m"] for r in qt._grouped(keyed, ["_g", "_f"], [0.5], ["m"], most=most).collect()}
        assert got == {g: float(np.median(x[np.arange(30_000) % 5 == g])) for g in range(5)}
