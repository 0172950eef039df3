"""Registered queries: names, oracles and the pipeline, each stage also on awkward rows."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cohortlens.llm import queries
from tests_norm import norm

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert norm(E.queries()[name](spark, SF).toPandas()) == norm(con.execute(E.oracle_sql()[name]).fetchdf())


def test_pipeline_stages(spark):
    """Stage by stage on sf0.001: decisions agree with the operators', columns stay, every row is packed once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), check in zip(corpus_pipeline.STAGES, ["rules", "near", "leaks", "pii", None]):
        out = stage(spark, docs, SF)
        if check:
            assert out.columns == docs.columns
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        if check == "rules":
            kept = {r.doc_id for r in queries.op3_quality_rules(spark, SF).filter("kept").collect()}
            assert set(after) == kept and 0 < len(kept) < len(before)
        elif check == "near":
            sets = {i: {tuple(r.text.split()[k:k + 5]) for k in range(len(r.text.split()) - 4)} for i, r in before.items()}
            close = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
            for i in set(before) - set(after):
                assert any(close(sets[i], s) for j, s in sets.items() if j != i)
            ids = sorted(after)
            assert not any(close(sets[a], sets[b]) for n, a in enumerate(ids) for b in ids[n + 1:])
        elif check == "leaks":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(b in r.text for r in after.values() for b in items)
            assert all(any(b.lower() in r.text.lower() for b in items) for i, r in before.items() if i not in after)
        else:
            assert set(before) == set(after)
        docs = spark.createDataFrame(out.toPandas(), out.schema)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_awkward_rows(spark, k):
    rows = [(1, None), (2, ""), (3, "x " * 400), (3, "x " * 400), (None, "some text without an id " * 9), (4, "mail a@b.com now " * 30 + "z" * 50_000)]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, SF)
    assert out.count() <= len(rows) and (k == 4 or out.schema.names == docs.schema.names)
    if k in (2, 3, 4):
        assert out.count() == len(rows)
    assert stage(spark, docs.limit(0), SF).count() == 0
