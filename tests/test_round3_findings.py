"""One small test per finding of FINDINGS_r03.md; rows are built here."""

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

import __spark_entry__ as E
from cohortlens import config
from cohortlens.operators import cleaning
from cohortlens.plans import catalog_models


def test_names_join_returns_every_customer(spark, monkeypatch):
    seg = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "fk_contact string, cluster_id int")
    lab = spark.createDataFrame([(0, "frequency_12m", 1.0, "Alto"), (1, "frequency_12m", -1.0, "Baixo")],
                                "cluster_id int, feature string, z double, label string")
    monkeypatch.setattr(catalog_models, "_labels", lambda *a: (SimpleNamespace(used_cols=["frequency_12m"]), None, seg, lab))
    got = {r["fk_contact"]: (r["cluster_id"], r["cluster_name"].split()[0]) for r in E.queries()["j05_names_join"](spark, "unused").collect()}
    assert got == {"a": (0, "Alto"), "b": (0, "Alto"), "c": (1, "Baixo")}


def test_festive_flags_compute_the_day_and_easter_once(spark):
    first = dt.date(1999, 1, 1)
    days = [first + dt.timedelta(i) for i in range(366 * 3)] + [None]
    df = spark.createDataFrame([(i, str(d) if d else None) for i, d in enumerate(days)], "i int, text string")
    df = df.select("i", F.to_date("text").alias("date_purchase"))
    out = cleaning.with_festive_period(df)
    assert out.columns == ["i", "date_purchase", "is_national_holiday", "is_festive_period"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("make_date") == 1
    easter = {1999: dt.date(1999, 4, 4), 2000: dt.date(2000, 4, 23), 2001: dt.date(2001, 4, 15), 2002: dt.date(2002, 3, 31)}
    for r in out.collect():
        d = days[r["i"]]
        if d is None:
            assert r["is_national_holiday"] is None and r["is_festive_period"] is None
            continue
        national = f"{d:%m-%d}" in config.NATIONAL_HOLIDAYS or d == easter[d.year] - dt.timedelta(2)
        fest = national or f"{d:%m-%d}" >= "12-20" or f"{d:%m-%d}" <= "01-05" or d.month == 6 or abs((d - easter[d.year]).days + 47) <= 2
        assert (r["is_national_holiday"], r["is_festive_period"]) == (int(national), int(fest)), d
