
import math

from pyspark.sql import functions as F

from cohortlens.functions import cleaning as fx
from cohortlens.operators import cleaning as cl
from cohortlens.operators import features as ft
from cohortlens.operators import standardize as zs
from cohortlens.operators.window import add_months, observation_window
import datetime as dt

from conftest import RAW_COLS, raw_row


def routed_map(spark, rows, **kw):
    raw = spark.createDataFrame(rows, RAW_COLS)
    r = cl.route_rows(cl.prepare(raw, tz="UTC"), **kw)
    return {x["_row_id"]: x["route"] for x in r.rows.select("_row_id", "route").collect()}


def test_nan_and_null_money_route_to_invalid(spark):
    rows = [raw_row(1, "k1", gmv=float("nan")), raw_row(2, "k2", gmv=None), raw_row(3, "k3", tickets=None),
            raw_row(4, "k4", gmv=-5.0), raw_row(5, "k5", tickets=0), raw_row(6, "k6")]
    m = routed_map(spark, rows, n_buckets=None)
    assert m == {1: "invalid", 2: "invalid", 3: "invalid", 4: "audit", 5: "invalid", 6: "clean"}


def test_time_normalisation(spark):
    df = spark.createDataFrame([("10:05",), ("", ), ("25:00:00",), (" 09:01:02 ",), ("12:30:00.123",), (None,)], "t string")
    got = [r[0] for r in df.select(fx.normalize_time("t")).collect()]
    assert got == ["10:05:00", None, None, "09:01:02", "12:30:00", None]


def test_blank_time_gives_null_datetime_not_midnight(spark):
    df = spark.createDataFrame([("2024-01-10", None), ("2024-02-30", "10:00:00"), ("2024-01-10", "10:00:00")],
                               "d string, t string")
    out = df.select(fx.combine_date_time(fx.parse_date("d"), F.col("t")).alias("ts")).collect()
    assert out[0]["ts"] is None and out[1]["ts"] is None
    assert out[2]["ts"] == dt.datetime(2024, 1, 10, 10, 0, 0)


def test_placeholders_become_null(spark):
    raw = spark.createDataFrame([raw_row(1, "k1", orr="0", dr="NA", cr="1"), raw_row(2, "k2", orr="P", dr="Q", cr="7")],
                                RAW_COLS)
    out = {r["_row_id"]: r for r in cl.prepare(raw, tz="UTC").collect()}
    assert out[1]["place_origin_return"] is None and out[1]["place_destination_return"] is None
    assert out[1]["fk_return_ota_bus_company"] is None
    assert out[2]["fk_return_ota_bus_company"] == "7"


def test_route_null_end_is_null_and_has_return_strict(spark):
    raw = spark.createDataFrame([raw_row(1, "k1", oo=None), raw_row(2, "k2", orr="P", dr="Q", tickets=1),
                                 raw_row(3, "k3", orr="P", dr="Q", tickets=2)], RAW_COLS)
    out = {r["_row_id"]: r for r in cl.prepare(raw, tz="UTC").collect()}
    assert out[1]["route_out"] is None
    assert out[2]["has_return"] == 0 and out[2]["route_return"] is None
    assert out[3]["has_return"] == 1 and out[3]["route_return"] == "P__Q"


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 7, 5),)], "ts timestamp_ntz")
    got = df.select(fx.day_of_week("ts").alias("d"), fx.is_weekend("ts").alias("w")).collect()
    assert [(r.d, r.w) for r in got] == [(0, 0), (6, 1)]


def test_canonical_dedupe_latest_then_max_gmv_then_first(spark):
    rows = [raw_row(1, "k", time="10:00:00", gmv=5.0), raw_row(2, "k", time="11:00:00", gmv=1.0),
            raw_row(3, "k", time="11:00:00", gmv=3.0), raw_row(4, "k", time="11:00:00", gmv=3.0),
            raw_row(5, None, gmv=2.0), raw_row(6, None, gmv=9.0)]
    m = routed_map(spark, rows, n_buckets=None)
    clean = sorted(i for i, v in m.items() if v in ("clean", "outlier"))
    assert clean == [3, 6]                 # NULL keys form one group too
    first = routed_map(spark, rows, keep="first", n_buckets=None)
    assert sorted(i for i, v in first.items() if v in ("clean", "outlier")) == [1, 5]


def test_row_conservation(spark):
    rows = [raw_row(i, f"k{i % 7}", gmv=float(i * 10 - 30), tickets=(i % 4)) for i in range(1, 60)]
    raw = spark.createDataFrame(rows, RAW_COLS)
    r = cl.route_rows(cl.prepare(raw, tz="UTC"))
    counts = {x["route"]: x["n_rows"] for x in r.counts().collect()}
    assert sum(counts.values()) == len(rows)


def test_top_share_tie_goes_to_smaller_value(spark):
    df = spark.createDataFrame([("c", "B"), ("c", "A"), ("c", "B"), ("c", "A"), ("c", None)], "fk_contact string, r string")
    row = ft.top_share(df, by="fk_contact", value="r", top="top").collect()[0]
    assert row["top"] == "A" and row["top_share"] == 0.5


def test_repeated_quantile_edges_fallback_labels(spark):
    df = spark.createDataFrame([(1.0,)] * 6 + [(1.4,), (2.0,)], "x double")
    # np.percentile edges: 1, 1, 1, 1, 1.24, 2 -> distinct 1, 1.24, 2 (pandas cut, include_lowest)
    got = {r["x"]: r["b"] for r in cl.quantile_bucket(df, col="x", n=5, out="b").collect()}
    assert got == {1.0: "(0.999, 1.24]", 1.4: "(1.24, 2.0]", 2.0: "(1.24, 2.0]"}
    uniq = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    got = {r["x"]: r["b"] for r in cl.quantile_bucket(uniq, col="x", n=5, out="b").collect()}
    assert got[1.0] == "Q1" and got[2.0] == "Q1" and got[3.0] == "Q2" and got[10.0] == "Q5"


def test_recency_minus_one_for_later_same_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2023, 12, 30, 23),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(ft.recency_days(F.col("t"), "2024-01-01")).collect()]
    assert got == [-1, 1]


def test_skew_needs_three_values_and_constant_is_dropped(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 100.0)], "a double, c double, s double")
    st = {r["feature"]: r["skew"] for r in zs.skew_stats(df, ["a", "c", "s"]).collect()}
    assert st["a"] is None
    df3 = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 1.0), (3.0, 5.0, 100.0), (4.0, 5.0, 2.0)],
                                "a double, c double, s double")
    sc = zs.fit_scaler(df3, cols=["a", "c", "s"])
    assert sc.removed_constant_cols == ["c"] and "s" in sc.log1p_cols


def test_sanitise_inf_nan_and_fill(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (None,), (2.0,)], "x double")
    got = [r[0] for r in df.select(zs.sanitize(F.col("x"), 7.0)).collect()]
    assert got == [0.0, 0.0, 0.0, 7.0, 2.0]


def test_population_std_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    sc = zs.fit_scaler(df, cols=["x"], log1p_auto=False)
    assert math.isclose(sc.scales["x"], math.sqrt(1.25))
    z = [r[0] for r in sc.transform(df).select("x_z").collect()]
    assert math.isclose(sum(z), 0.0, abs_tol=1e-12)


def test_null_contact_excluded_from_features(spark):
    df = spark.createDataFrame([("c1", "k1", dt.datetime(2024, 1, 1), 10.0, 1, 1.0, 0, "A__B", "X"),
                                (None, "k2", dt.datetime(2024, 1, 1), 10.0, 1, 1.0, 0, "A__B", "X")],
                               "fk_contact string, nk_ota_localizer_id string, purchase_datetime timestamp_ntz, "
                               "gmv_success double, total_tickets_quantity_success long, avg_price_per_ticket double, "
                               "has_return int, route_out string, fk_departure_ota_bus_company string")
    out = ft.customer_features(df, build_date="2024-01-02").collect()
    assert [r["fk_contact"] for r in out] == ["c1"]


def test_month_clamping_and_window_end_inclusive(spark):
    assert add_months(dt.date(2024, 2, 29), -12) == dt.date(2023, 2, 28)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59),), (dt.datetime(2024, 1, 2, 0, 0),),
                                (dt.datetime(2023, 1, 1, 0, 0),), (dt.datetime(2022, 12, 31, 23, 59),)],
                               "purchase_datetime timestamp_ntz")
    got = sorted(r[0] for r in observation_window(df, build_date="2024-01-01", months=12).collect())
    assert got == [dt.datetime(2023, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 23, 59, 59)]


def test_dst_gap_shift_and_overlap_null_under_two_session_zones(spark):
    df = spark.createDataFrame([(dt.datetime(1997, 10, 6, 0, 30),), (dt.datetime(1998, 2, 28, 23, 30),),
                                (dt.datetime(1998, 3, 1, 12, 0),)], "x timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(fx.localize_wall_clock(F.col("x"), "America/Sao_Paulo")).collect()]
            assert got == [dt.datetime(1997, 10, 6, 1, 0), None, dt.datetime(1998, 3, 1, 12, 0)]
        nul = [r[0] for r in df.select(fx.localize_wall_clock(F.col("x"), "America/Sao_Paulo", gap="null")).collect()]
        assert nul[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_season_daypart_holiday_edges(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 20, 5),), (dt.datetime(2024, 3, 15, 6),),
                                (dt.datetime(2024, 3, 16, 17),), (dt.datetime(2024, 6, 30, 18),)], "t timestamp_ntz")
    got = df.select(fx.season_south("t").alias("s"), fx.daypart(F.hour("t")).alias("d"),
                    fx.is_holiday_window("t").alias("h")).collect()
    assert [(r.s, r.d, r.h) for r in got] == [("verao", "madrugada", 1), ("outono", "manha", 1),
                                              ("outono", "tarde", 0), ("inverno", "noite", 1)]


def test_easter_and_carnival(spark):
    df = spark.createDataFrame([(2024,), (2000,), (1998,)], "y int")
    got = [r[0] for r in df.select(fx.easter_sunday(F.col("y"))).collect()]
    assert got == [dt.date(2024, 3, 31), dt.date(2000, 4, 23), dt.date(1998, 4, 12)]
    d = spark.createDataFrame([(dt.date(2024, 2, 13),), (dt.date(2024, 2, 16),)], "d date")   # Carnival Tue 2024-02-13
    assert [r[0] for r in d.select(fx.is_festive_period("d")).collect()] == [1, 0]
