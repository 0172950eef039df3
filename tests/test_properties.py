"""Property tests (hypothesis): conservation, shares, idempotence, inverse, label monotonicity."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.operators import cleaning as cl
from cohortlens.operators import features as ft
from cohortlens.operators import labels as lb
from cohortlens.operators import standardize as zs
from cohortlens.operators.quantiles import quantiles

from conftest import RAW_COLS, raw_row

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.floats(-50, 500, allow_nan=False)),
              st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 23), st.integers(0, 2)),
    min_size=1, max_size=40)


@SETTINGS
@given(rows_strategy)
def test_routing_conserves_rows_and_dedupe_is_idempotent(spark, rows):
    raw = spark.createDataFrame(
        [raw_row(i, f"k{k}", contact=f"c{c}", time=f"{h:02d}:00:00", gmv=g, tickets=t)
         for i, (k, g, t, h, c) in enumerate(rows)], RAW_COLS)
    prep = cl.prepare(raw, tz="UTC")
    r = cl.route_rows(prep)
    counts = {x["route"]: x["n_rows"] for x in r.counts().collect()}
    assert sum(counts.values()) == len(rows)
    kept = prep.where(cl.is_valid())
    once = cl.mark_duplicates(kept, keep="canonical").where("is_duplicated = 0").drop("is_duplicated")
    twice = cl.mark_duplicates(once, keep="canonical").where("is_duplicated = 0").drop("is_duplicated")
    assert sorted(x["_row_id"] for x in once.collect()) == sorted(x["_row_id"] for x in twice.collect())
    # canonical result does not depend on input order
    shuffled = kept.orderBy(F.rand(7))
    again = cl.mark_duplicates(shuffled, keep="canonical").where("is_duplicated = 0")
    assert sorted(x["_row_id"] for x in once.collect()) == sorted(x["_row_id"] for x in again.collect())


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 12), st.integers(0, 23)), min_size=1, max_size=30))
def test_share_families_sum_to_one(spark, rows):
    df = spark.createDataFrame([(f"c{c}", f"k{i}", dt.datetime(2023, m, 1, h), 10.0, 1, 10.0, 0, "A__B", "X")
                                for i, (c, m, h) in enumerate(rows)],
                               "fk_contact string, nk_ota_localizer_id string, purchase_datetime timestamp_ntz, "
                               "gmv_success double, total_tickets_quantity_success long, avg_price_per_ticket double, "
                               "has_return int, route_out string, fk_departure_ota_bus_company string")
    for r in ft.customer_features(df, build_date="2024-01-01").collect():
        for fam in (["pct_q1", "pct_q2", "pct_q3", "pct_q4"], ["pct_verao", "pct_outono", "pct_inverno", "pct_primavera"],
                    ["pct_madrugada", "pct_manha", "pct_tarde", "pct_noite"]):
            assert math.isclose(sum(r[c] for c in fam), 1.0, abs_tol=1e-9)
        for c in ("pct_weekend", "pct_holiday", "top_route_out_share", "top_company_out_share"):
            assert 0.0 <= r[c] <= 1.0


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=2, max_size=40),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_equal_numpy(spark, xs, qs):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    got = quantiles(df, "x", qs).collect()[0]
    for i, q in enumerate(qs):
        assert math.isclose(got[f"q{i}"], float(np.percentile(xs, q * 100)), rel_tol=1e-9, abs_tol=1e-6)
    assert got["n"] == len(xs)


def test_exact_quantiles_with_a_hot_value(spark):
    xs = [7.0] * 400 + [float(i % 97) - 20 for i in range(800)]
    df = spark.createDataFrame([(x, i % 3) for i, x in enumerate(xs)] + [(None, 0), (float("nan"), 1)], "x double, g int").repartition(6)
    got = quantiles(df, "x", [0, 0.01, 0.3, 0.5, 0.99, 1]).collect()[0]
    assert [got[f"q{i}"] for i in range(6)] == pytest.approx([float(np.percentile(xs, q)) for q in (0, 1, 30, 50, 99, 100)])
    assert got["n"] == 1200 and quantiles(df.limit(0), "x", [0.5]).collect()[0]["q0"] is None


@SETTINGS
@given(st.lists(st.tuples(st.floats(0, 1000, allow_nan=False), st.floats(-5, 5, allow_nan=False)),
                min_size=3, max_size=30))
def test_zscore_inverse_roundtrip(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double")
    sc = zs.fit_scaler(df, cols=["a", "b"], log1p_auto=False, drop_constant=False)
    back = sc.inverse(sc.transform(df), suffix_out="_back").collect()
    for r in back:
        assert math.isclose(r["a_back"], r["a"], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["b_back"], r["b"], rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=40))
def test_labels_monotone(spark, rows):
    df = spark.createDataFrame([(f"c{c}", dt.datetime(2024, 1, 1) + dt.timedelta(days=d)) for c, d in rows],
                               "fk_contact string, purchase_datetime timestamp_ntz")
    labels = lb.repurchase_labels(lb.purchase_days(df), min_history_days=3, horizons=(7, 30)).collect()
    by = {}
    for r in labels:
        assert r["y_buy_7d"] <= r["y_buy_30d"]
        assert r["censored"] == (1 if r["days_until_next"] is None else 0)
        by.setdefault(r["fk_contact"], []).append((r["ref_date"], r["n_purchases_life"]))
    for seq in by.values():
        lives = [n for _, n in sorted(seq)]
        assert lives == sorted(lives)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.floats(-100, 100, allow_nan=False)),
                min_size=1, max_size=60))
def test_grouped_quantiles_equal_numpy(spark, rows):
    from cohortlens.operators.quantiles import grouped_quantiles
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {r["g"]: r for r in grouped_quantiles(df, "g", "x", [0.5, 0.9]).collect()}
    for g in {g for g, _ in rows}:
        xs = [x for gg, x in rows if gg == g]
        assert math.isclose(got[g]["q0"], float(np.percentile(xs, 50)), rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[g]["q1"], float(np.percentile(xs, 90)), rel_tol=1e-9, abs_tol=1e-9)


def test_approx_options_and_extra_blocks(spark):
    df = spark.createDataFrame([(f"c{i % 3}", f"k{i}", dt.datetime(2023, 1 + i % 12, 1, i % 24), float(i + 1), 1,
                                 float(i + 1), 0, "A__B", "X") for i in range(60)],
                               "fk_contact string, nk_ota_localizer_id string, purchase_datetime timestamp_ntz, "
                               "gmv_success double, total_tickets_quantity_success long, avg_price_per_ticket double, "
                               "has_return int, route_out string, fk_departure_ota_bus_company string")
    exact = {r["fk_contact"]: r["frequency_12m"] for r in ft.customer_features(df, build_date="2024-01-01").collect()}
    approx = {r["fk_contact"]: r["frequency_12m"]
              for r in ft.customer_features(df, build_date="2024-01-01", approx_distinct=True).collect()}
    assert exact == approx == {"c0": 20, "c1": 20, "c2": 20}
    q = quantiles(df, "gmv_success", [0.5], accuracy=10000).collect()[0]["q0"]
    assert abs(q - 30.5) <= 1.0
    block = lambda d: d.groupBy("fk_contact").agg(F.max("gmv_success").alias("max_gmv"))
    out = ft.customer_features(df, build_date="2024-01-01", extra_blocks=[block])
    assert out.columns[-1] == "max_gmv" and out.where("max_gmv IS NULL").count() == 0
