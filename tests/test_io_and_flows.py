"""Readers/writers and the end-to-end flows."""

import uuid

import pytest

from pyspark.sql import functions as F

from cohortlens.plans.segmentation import run_repurchase, run_segmentation
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.sources import sinks, testdata


def _dir(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_read_purchases_nulls_row_order_and_limit(spark):
    path = _dir(spark, "csv")
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write("nk_ota_localizer_id,fk_contact,date_purchase,time_purchase,gmv_success,"
                 "total_tickets_quantity_success,place_origin_departure,place_destination_departure,"
                 "place_origin_return,place_destination_return,fk_departure_ota_bus_company,"
                 "fk_return_ota_bus_company\n")
        fh.write("k3,c1,2024-01-02,10:00,12.5,1,A,B,0,0,X,1\n")
        fh.write("k1,NA,2024-01-03,,NaN,2,A,B,C,D,X,Y\n")
        fh.write("k2,c2,2024-01-04,11:00:00,abc,N/A,A,,0,0,X,1\n")
    df = sinks.read_purchases(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["_row_id"])
    assert [r["nk_ota_localizer_id"] for r in rows] == ["k3", "k1", "k2"]          # file order
    assert rows[1]["fk_contact"] is None and rows[1]["time_purchase"] is None
    assert rows[1]["gmv_success"] is None or rows[1]["gmv_success"] != rows[1]["gmv_success"]
    assert rows[2]["gmv_success"] is None and rows[2]["total_tickets_quantity_success"] is None
    first = sinks.read_purchases(spark, path, limit=2, columns=["nk_ota_localizer_id", "gmv_success"])
    assert sorted(r["nk_ota_localizer_id"] for r in first.collect()) == ["k1", "k3"]


def test_partitioned_write_dynamic_overwrite(spark):
    root = _dir(spark, "parts")
    df = spark.createDataFrame([("a", "2023-05-01 10:00:00"), ("b", "2024-01-02 00:00:00")], "k string, t string") \
        .withColumn("purchase_datetime", F.col("t").cast("timestamp_ntz")).drop("t")
    sinks.write_partitioned(df, root, partition_cols=("year", "month"), overwrite=True)
    again = spark.createDataFrame([("c", "2024-01-09 00:00:00")], "k string, t string") \
        .withColumn("purchase_datetime", F.col("t").cast("timestamp_ntz")).drop("t")
    sinks.write_partitioned(again, root, partition_cols=("year", "month"), overwrite=True, dynamic=True)
    back = spark.read.parquet(root)
    assert sorted(r["k"] for r in back.collect()) == ["a", "c"]          # 2023-05 kept, 2024-01 replaced
    counts = {(r["year"], r["month"]): r["n_rows"] for r in sinks.partition_counts(back, ["year", "month"]).collect()}
    assert counts == {(2023, 5): 1, (2024, 1): 1}
    sinks.write_partitioned(again, root, partition_cols=("year", "month"), overwrite=True)      # the whole dataset
    assert [r["k"] for r in spark.read.parquet(root).collect()] == ["c"]


def test_csv_columns_by_name(spark):
    path = _dir(spark, "csv")
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write("fk_contact,gmv_success,nk_order_id,extra,date_purchase,time_purchase,total_tickets_quantity_success\n")
        fh.write("c1,12.5,k1,e,2024-1-5,9:05:00,2\nc2,1,k2,e,2024-01-06,10:00:00,1,too,many\n")
    rows = {r["nk_ota_localizer_id"]: r for r in sinks.read_purchases(spark, path).collect()}
    assert rows["k1"]["fk_contact"] == "c1" and rows["k1"]["gmv_success"] == 12.5 and rows["k1"]["extra"] == "e"
    assert rows["k1"]["place_origin_departure"] is None and rows["k1"]["_corrupt_record"] is None
    assert rows["k2"]["_corrupt_record"].endswith("too,many")
    with open(f"{path}/part-0.csv", "w") as fh:
        fh.write("fk_contact,gmv_success\nc1,12.5\n")
    with pytest.raises(ValueError, match="required columns"):
        sinks.read_purchases(spark, path)


def test_unpadded_dates_and_times(spark):
    from cohortlens.functions import cleaning as fx
    df = spark.createDataFrame([("2024-1-5", "9:05:00"), ("2024-01-05", "09:05"), ("2024-13-01", "24:00:00"), ("x", "9:5"), (None, None)], "d string, t string")
    got = [(str(r.d) if r.d else None, r.t) for r in df.select(fx.parse_date("d").alias("d"), fx.normalize_time("t").alias("t")).collect()]
    assert got == [("2024-01-05", "09:05:00"), ("2024-01-05", "09:05:00"), (None, None), (None, None), (None, None)]


def test_scaler_table_keeps_fill_and_suffix(spark):
    from cohortlens.operators import standardize as zs
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (None,)], "a double")
    sc = zs.fit_scaler(df, cols=["a"], log1p_auto=False, fill=7.0, suffix="_s")
    back = zs.Scaler.from_df(sc.to_df(spark))
    assert [r["a_s"] for r in back.transform(df).collect()] == [r["a_s"] for r in sc.transform(df).collect()]
    assert zs.fit_scaler(df, cols=["a"], log1p_cols=["a"]).log1p_cols == ["a"]


def test_observable_uses_the_data_end(spark):
    import datetime as dt
    from cohortlens.operators import labels as lb
    p = spark.createDataFrame([("c", dt.datetime(2024, 1, 1)), ("c", dt.datetime(2024, 1, 31))], "fk_contact string, purchase_datetime timestamp_ntz")
    days = lb.purchase_days(p)
    rows = lb.observable(lb.repurchase_labels(days, freq="W-MON", min_history_days=0, horizons=(2,)), obs_end=days, horizons=(2, 9)).collect()
    last = max(rows, key=lambda r: r["ref_date"])
    assert last["ref_date"] == dt.date(2024, 1, 29) and last["observable_2d"] == 1 and last["observable_9d"] == 0


def test_required_columns_and_run_log(spark):
    from cohortlens.operators import cleaning as cl
    with pytest.raises(Exception, match="date_purchase"):
        cl.require_columns(spark.range(1), ["date_purchase"])
    path = _dir(spark, "runs")
    for k in (1, 2):
        sinks.append_run(spark, path, params={"k": k}, run_id=f"r{k}")
    assert sorted(r["run_id"] for r in spark.read.parquet(path).collect()) == ["r1", "r2"]


def test_shared_folder_is_required_on_a_cluster():
    from cohortlens import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Cluster:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_run_segmentation_end_to_end(spark):
    raw = testdata.purchases(spark, "/root/testdata/sf0.001")
    out_dir = _dir(spark, "run")
    res = run_segmentation(raw, out_dir=out_dir, build_date="2001-07-01", months=36, tz="UTC", ks=[2, 3],
                           n_init=1, max_iter=20)
    assert res["k"] in (2, 3)
    n_customers = res["customer_features"].count()
    assert res["assignments"].count() == n_customers
    names = res["cluster_names"].collect()
    assert len(names) == res["k"] and all(r["cluster_name"] for r in names)
    assert spark.read.parquet(f"{out_dir}/runs").count() == 1
    assert spark.read.parquet(f"{out_dir}/overview").count() == res["k"]


def test_run_repurchase_writes_by_month(spark):
    path = _dir(spark, "labels")
    labels = run_repurchase(testdata.purchase_events(spark, "/root/testdata/sf0.001"), min_history_days=7,
                            horizons=(3, 7), out_path=path)
    assert spark.read.parquet(path).count() == labels.count() > 0


# -- headers per file ----------------------------------------------------------------
HEAD_A = "fk_contact,nk_order_id,date_purchase,time_purchase,gmv_success,total_tickets_quantity_success,place_origin_departure,place_destination_departure"
HEAD_B = "gmv_success,channel,nk_ota_localizer_id,total_tickets_quantity_success,date_purchase,time_purchase,fk_contact,place_destination_departure,place_origin_departure"


def _two_headers(tmp_path):
    d = tmp_path / "csv in"
    d.mkdir()
    (d / "a.csv").write_text(HEAD_A + '\nc1,k1,2024-01-02,10:00,12.5,2,"São, Paulo",Rio\nc2,k2,2024-01-03,11:00,NaN,1,A\nc3,k3,2024-01-04,12:00,7,1,A,B,extra\n', encoding="utf-8")
    (d / "b.csv").write_text(HEAD_B + "\n5.0,web,k4,1,2024-01-05,13:00,c4,Y,X\n-3,app,k5,1,2024-01-06,,c5,Y,NA\n", encoding="utf-8")
    (d / "c.csv").write_text(HEAD_A + "\n", encoding="utf-8")
    return str(d)


WANT = [("k1", "c1", 12.5, "São, Paulo", "Rio", None, False), ("k2", "c2", None, "A", None, None, True), ("k3", "c3", 7.0, "A", "B", None, True),
        ("k4", "c4", 5.0, "X", "Y", "web", False), ("k5", "c5", -3.0, None, "Y", "app", False)]


def _five(df):
    return sorted((r["nk_ota_localizer_id"], r["fk_contact"], r["gmv_success"], r["place_origin_departure"], r["place_destination_departure"], r["channel"],
                   r["_corrupt_record"] is not None) for r in df.collect())


def test_files_with_different_headers_under_one_path(spark, tmp_path):
    src = _two_headers(tmp_path)
    assert _five(sinks.read_purchases(spark, src)) == WANT
    with pytest.raises(ValueError, match="required columns missing"):
        (tmp_path / "csv in" / "d.csv").write_text("nk_ota_localizer_id,fk_contact\nk9,c9\n")
        sinks.read_purchases(spark, src).collect()


def test_stream_of_csv_files_equals_the_batch(spark, tmp_path):
    from cohortlens.operators import cleaning as cl
    from cohortlens.streaming import ingest
    src = _two_headers(tmp_path)
    for per_trigger in (1, 10):
        sink = str(tmp_path / f"sink{per_trigger}")
        ingest.stream_clean(spark, source=src, sink=sink, checkpoint=str(tmp_path / f"ck{per_trigger}"), fmt="csv", tz="UTC", max_files_per_trigger=per_trigger)
        cols = ["nk_ota_localizer_id", "fk_contact", "gmv_success", "purchase_datetime", "route_out", "route", "channel", "_corrupt_record"]
        got = spark.read.option("mergeSchema", True).parquet(sink).select(*cols)
        want = ingest.row_routes(cl.prepare(sinks.read_purchases(spark, src), tz="UTC")).select(*cols)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# -- published runs --------------------------------------------------------------------
def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "runs")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, root)
    a = spark.createDataFrame([("007", 1.5), (None, None)], "id string, x double")
    sinks.publish_run({"a": a, "b": a.select("x"), "none": None}, root, run_id="r1", meta={"k": 3}, fmt="csv")
    sinks.write_bundle({"a": a.limit(1)}, f"{root}/r2")                    # cut short: tables, no manifest
    run, meta = sinks.read_published(spark, root)
    assert set(run) == {"a", "b"} and meta == {"k": 3}
    assert run["a"].schema == a.schema and sorted(map(str, run["a"].collect())) == sorted(map(str, a.collect()))
    sinks.publish_run({"a": a.limit(1)}, root, run_id="r3")
    assert set(sinks.read_published(spark, root)[0]) == {"a"} and set(sinks.read_published(spark, root, run_id="r1")[0]) == {"a", "b"}
    with pytest.raises(ValueError, match="already"):
        sinks.publish_run({"a": a}, root, run_id="r1")


def test_artifacts_from_a_stored_run_and_again(spark, tmp_path):
    """Reload, relabel and rewrite: every table of the second run equals that of the first."""
    import json
    from cohortlens.plans.segmentation import artifacts_from_run
    used = ["frequency_12m", "recency_days"]
    cz = spark.createDataFrame([(0, 1.0, -1.0), (1, -0.7, 0.2)], "cluster_id int, frequency_12m_z double, recency_days_z double")
    seg = spark.createDataFrame([("c1", 0), ("c2", 1), ("c3", 1)], "fk_contact string, cluster_id int")
    scaler = spark.createDataFrame([(0, "frequency_12m", 5.0, 2.0, False, 0.0, "_z"), (1, "recency_days", 30.0, 10.0, False, 0.0, "_z")],
                                   "position int, feature string, mean double, scale double, log1p boolean, fill double, suffix string")
    metrics = spark.createDataFrame([(2, 9.0, 0.4, "kmeans", 42, True), (3, 8.0, 0.3, "kmeans", 42, False)],
                                    "k int, inertia double, silhouette double, algorithm string, random_state int, is_final boolean")
    feats = spark.createDataFrame([("c1", "A__B", "x"), ("c2", "A__B", "y"), ("c3", "C__D", "y")], "fk_contact string, top_route_out string, top_company_out string")
    root = str(tmp_path / "runs")
    sinks.publish_run({"centroids_z": cz, "assignments": seg, "metrics": metrics, "scaler": scaler, "customer_features": feats}, root)
    tables = []
    for i in (1, 2):
        out = str(tmp_path / f"out{i}")
        artifacts_from_run(spark, root, out, used_cols=used, build_date="2024-01-01", run_date="2024-02-03")
        tables.append(sinks.read_published(spark, out)[0])
    first, second = tables
    assert set(first) == set(second) == {"centroid_document", "centroids_z", "centroids_unstd", "labels", "cluster_names", "centroid_summary", "metrics", "glossary",
                                         "assignments", "overview", "assignment_export", "top"}
    for name in first:
        assert sorted(map(str, first[name].collect())) == sorted(map(str, second[name].collect())), name
    doc = json.loads(first["centroid_document"].collect()[0]["value"])
    assert doc["run_date"] == "2024-02-03" and doc["global_means"] == {"frequency_12m": 5.0, "recency_days": 30.0} and doc["global_stds"]["recency_days"] == 10.0
    assert {r["cluster_id"]: (r["frequency_12m"], r["recency_days"]) for r in first["centroids_unstd"].collect()} == {0: (7.0, 20.0), 1: (3.6, 32.0)}
    assert {(r["cluster_id"], r["metric"]): r["top"] for r in first["top"].collect()}[1, "top_company_out"] == "y (2)"
    assert {r["k"] for r in first["assignment_export"].collect()} == {2}
    with pytest.raises(ValueError, match="centroids_z"):
        sinks.publish_run({"assignments": seg}, str(tmp_path / "bare"))
        artifacts_from_run(spark, str(tmp_path / "bare"), str(tmp_path / "no"), used_cols=used)


# -- time columns ------------------------------------------------------------------------
def test_window_prunes_months_and_all_null_times_are_an_error(spark, tmp_path):
    import datetime as dt
    from cohortlens.operators.window import observation_window, observe_times
    rows = [(i, dt.datetime(2022 + i // 12, 1 + i % 12, 5)) for i in range(36)]
    root = str(tmp_path / "by-month")
    sinks.write_partitioned(spark.createDataFrame(rows, "i long, purchase_datetime timestamp_ntz"), root, partition_cols=("year", "month"), overwrite=True)
    win = observation_window(spark.read.parquet(root), build_date="2023-02-28", months=4)
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan or "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r["i"] for r in win.collect()) == [10, 11, 12, 13]       # 28 October to 28 February
    kept = win.select("year", "month").distinct().count()
    assert kept == 4 and len({f for f in win.inputFiles()}) <= 36
    nulls = spark.createDataFrame([(1, None), (2, None)], "i long, purchase_datetime timestamp_ntz")
    with pytest.raises(ValueError, match="no value"):
        sinks.write_partitioned(nulls, str(tmp_path / "nulls"), overwrite=True)
    seen, guard = observe_times(nulls.limit(0))
    seen.count()
    assert guard.check() == 0
    with pytest.raises(KeyError):
        observe_times(nulls.select("i"))


def test_silver_table_rules(spark):
    from cohortlens.plans.segmentation import silver_table
    cols = ["_row_id", "nk_ota_localizer_id", "fk_contact", "date_purchase", "time_purchase", "gmv_success", "total_tickets_quantity_success", "place_origin_departure",
            "place_destination_departure", "place_origin_return", "place_destination_return", "fk_departure_ota_bus_company", "fk_return_ota_bus_company"]
    rows = [(1, "k1", "c1", "2024-01-10", "10:00:00", 90.0, 1, " A ", "B", "B", "A", "X", "X"), (2, "k2", "c1", "2024-01-10", "10:00:00", 80.0, 2, "A", "B", "0", "0", "X", "1"),
            (3, "k3", "c2", "2018-11-04", "00:30:00", 10.0, 1, "A", None, "B", "0", "X", "1"), (4, "k4", "c2", "2024-01-12", "10:00:00", None, None, "A", "C", "C", "A", "X", "X")]
    raw = spark.createDataFrame(rows, "_row_id long, nk_ota_localizer_id string, fk_contact string, date_purchase string, time_purchase string, gmv_success double, "
                                      "total_tickets_quantity_success long, " + ", ".join(f"{c} string" for c in cols[7:]))
    out = {r["_row_id"]: r for r in silver_table(raw, tz="America/Sao_Paulo").collect()}
    assert set(out) == {2, 3, 4}                                            # the lower gmv of equal contact and time
    assert out[3]["purchase_datetime"] is None                              # a clock time that the zone skipped
    assert (out[2]["route_out"], out[3]["route_out"], out[4]["route_out"]) == ("A->B", None, "A->C")
    assert (out[4]["has_return"], out[4]["has_return_strict"], out[2]["has_return"]) == (1, 0, 0)
    assert [out[i]["is_price_outlier_p99"] for i in (2, 3, 4)] == [1, 0, 0]


def test_gram_correlation_with_unknown_values_and_constants(spark):
    import numpy as np
    from cohortlens.operators import reports as rp
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 1.0, (300, 3))
    x[:, 1] += x[:, 0]
    rows = [(float(a), None if i % 3 == 0 else float(b), float("nan") if i % 5 == 0 else float(c), 4.25) for i, (a, b, c) in enumerate(x)]
    out = {(r["feature_a"], r["feature_b"]): r["corr"] for r in rp.correlation_long(spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3), ["a", "b", "c", "d"], digits=None).collect()}
    i = np.arange(300)
    assert len(out) == 16 and out["a", "a"] == 1.0 and out["a", "d"] is None and out["d", "b"] is None
    for key, u, v, keep in ((("a", "b"), 0, 1, i % 3 > 0), (("b", "c"), 1, 2, (i % 3 > 0) & (i % 5 > 0))):
        assert abs(out[key] - np.corrcoef(x[keep, u], x[keep, v])[0, 1]) < 1e-9 and out[key] == out[key[::-1]]


def test_fill_and_type_of_missing_blocks(spark):
    from cohortlens.operators import features as ft
    rows = [("c1", "3", None, float("nan"), "0.5", 7, None), ("c2", None, 2.0, 0.25, "x", None, "A__B"), ("c3", "nan", None, None, None, 1, None)]
    df = spark.createDataFrame(rows, "fk_contact string, frequency_12m string, total_tickets_12m double, pct_q1 double, top_route_out_share string, "
                                     "monetary_gmv_12m int, top_route_out string")
    out = ft.fill_and_type(df)
    assert [t for _, t in out.dtypes] == ["string", "bigint", "bigint", "double", "double", "double", "string"]
    assert sorted(map(tuple, out.collect())) == [("c1", 3, 0, 0.0, 0.5, 7.0, None), ("c2", 0, 2, 0.25, 0.0, None, "A__B"), ("c3", 0, 0, 0.0, 0.0, 1.0, None)]
    assert ft.fill_and_type(df.limit(0)).count() == 0


def test_read_standardized(spark, tmp_path):
    from cohortlens.operators import standardize as zs
    path = str(tmp_path / "std")
    spark.createDataFrame([("c1", 1.0, 2.0, "u"), ("c2", None, -1.0, "v")], "fk_contact string, a_z double, b_z float, note string").write.parquet(path)
    df, features = zs.read_standardized(spark, path)
    assert features == ["a", "b"] and df.columns == ["fk_contact", "feature", "z"]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, [("c1", "a", 1.0), ("c1", "b", 2.0), ("c2", "a", None), ("c2", "b", -1.0)]))
    assert "note" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert zs.read_standardized(spark, path, id_col="other")[0].columns == ["feature", "z"]
    with pytest.raises(ValueError, match="no column"):
        zs.read_standardized(spark, path, suffix="_s")
