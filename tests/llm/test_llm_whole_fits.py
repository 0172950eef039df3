"""Fits of op2 and op3 see every labelled row, not a sample."""

import numpy as np
from pyspark.sql import functions as F

from cohortlens.llm import pii, quality_gbt


def test_pii_trees_learn_from_every_labelled_candidate(spark, monkeypatch):
    texts = [f"bob.k{i}@mail{i}.example.com from 10.0.{i % 250}.7 and 1.2.{300 + i}.4" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, table = [], pii.training_table

    def spied(rows, n):
        out = table(rows, n)
        seen.append((rows.groupBy("label").count().count(), rows.select("c.k", "c.f", "label", "calibrate").distinct().count(), out.count(),
                     out.agg(F.sum("weight")).first()[0], rows.count()))
        return out
    monkeypatch.setattr(pii, "training_table", spied)
    pii.detect(docs, sample_rows=20).collect()
    pii.detect(docs).collect()
    (labels, forms, held, weight, n), (_, _, _, whole, _) = seen
    assert labels == 2 and held == forms > 20 and n > 600 and round(weight) == 20 and round(whole) == n


def test_rules_learn_from_every_labelled_row(spark, monkeypatch):
    n, names = 21_000, quality_gbt.FEATURES
    cols = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(997)) / 997).alias(c) for i, c in enumerate(names)]
    stats = spark.range(n).select(F.col("id").alias("doc_id"), *cols)
    good = (F.col(names[1]) + 0.3 * F.col(names[2]) - F.col("symbols_per_word") > 0.1).cast("int")
    asked, fit_table = [], quality_gbt.fit_table

    def spied(rows, **options):
        asked.append(rows)
        return fit_table(rows, n_trees=4, **options)
    monkeypatch.setattr(quality_gbt, "fit_table", spied)
    labels = stats.select("doc_id", good.alias("quality"))
    near = quality_gbt.train(stats, labels)
    monkeypatch.setattr(quality_gbt, "DRIVER_ROWS", 0)
    model = quality_gbt.train(stats, labels)                # the same from scans as from rows on the driver
    assert (near.split == model.split).all() and np.allclose(near.value, model.value, atol=1e-4) and abs(near.threshold - model.threshold) < 1e-4
    held = labels.join(stats, "doc_id").filter(F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).toPandas()
    assert asked[0].count() + len(held) == n
    rows = asked[0].toPandas()
    want = quality_gbt.fit(rows[names].to_numpy(float), rows["label"].to_numpy(float), n_trees=4)
    x, y = held[names].to_numpy(float), held["quality"].to_numpy()
    assert len(model.roots) == 4 and np.abs(model.probability(x) - want.probability(x)).mean() < 0.01
    kept = model.probability(x[y == 1]) >= model.threshold
    assert kept.mean() >= quality_gbt.KEEP and 0 < model.threshold <= 0.5
