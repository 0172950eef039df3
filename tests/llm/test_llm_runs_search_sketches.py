"""Operators 11 to 13 against brute force, with awkward rows, hot groups and executors that lack the package."""

import collections
import hashlib
import math
import os
import random
import re
import subprocess
import sys
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import bottom_k, jaccard_join, lexical_search, licenses, periodic_runs, queries, warc
from cohortlens.sources.testdata import table

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


# -- 11 ------------------------------------------------------------------------
def runs_by_hand(t, min_length=24, min_exponent=3):
    got = {}
    for q in range(1, len(t) // min_exponent + 1):
        i = 0
        while i + q < len(t):
            if t[i] != t[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(t) and t[i] == t[i + q]:
                i += 1
            if i - s + q >= max(min_length, min_exponent * q):
                got[s, i - s + q] = min(q, got.get((s, i - s + q), q))
    return sorted(((s, n, q) for (s, n), q in got.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("min_length, min_exponent", [(24, 3), (6, 2), (8, 3), (2, 2)])
def test_maximal_pairs_are_the_runs(min_length, min_exponent):
    rng = random.Random(min_length)
    found = 0
    for _ in range(250):
        batch = []
        for _ in range(rng.randint(1, 5)):
            t = []
            for _ in range(rng.randint(0, 4)):
                unit = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
                t += (unit * 9)[:rng.randint(0, 80)] + [rng.choice("abc") for _ in range(rng.randint(0, 3))]
            batch.append([x.encode() for x in t])
        want = [runs_by_hand(t, min_length, min_exponent) for t in batch]
        assert periodic_runs.runs_of(batch, min_length, min_exponent) == want
        found += sum(map(len, want))
    assert found > 100


def test_runs_of_long_and_even_texts():
    assert periodic_runs.runs_of([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]
    two = [b"a", b"b"] * 400 + [b"x"] + [b"b", b"a"] * 400
    assert periodic_runs.runs_of([two, two[:23], []]) == [[(0, 800, 2), (801, 800, 2)], [], []]


def test_planted_runs_query_by_hand(spark):
    out = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    planted = 0
    for d in table(spark, SF, "documents").collect():
        w = WORD.findall(d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = runs_by_hand(w)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        r = out[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (None if not runs else 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    assert planted > 5


def test_runs_of_awkward_rows(spark):
    again = " ".join(["é", "ü"] * 20)
    rows = docs(spark, [(1, again), (1, again), (None, again), (2, None), (3, ""), (4, " \t\n"), (5, "one")]).withColumns(
        {"id": F.lit(9), "runs": F.lit("x"), "collapsed": F.lit(1.0), "n_words": F.lit(None).cast("int")})
    out = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find_runs(rows).collect()), key=str)
    run = (40, [(0, 40, 2)], "é ü")
    assert out == sorted([(1, *run), (1, *run), (None, *run), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 1, [], "one")], key=str)
    empty = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.plant_runs(docs(spark, []))))
    assert empty.count() == 0 and "runs_sha256" in empty.columns


# -- 12 ------------------------------------------------------------------------
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_by_hand(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_hand(rows, items, top=10):
    bags = [collections.Counter(terms_by_hand(t)) for _, t in rows]
    n = [sum(b.values()) for b in bags]
    N, L = sum(x > 0 for x in n), sum(n)
    df = collections.Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), b, size in zip(rows, bags, n):
            s = sum(k * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * (25 + 75 * size * N // L)))
                    for t, k in collections.Counter(terms_by_hand(text)).items() if t in b)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def search_rows(seed=3):
    rng = random.Random(seed)
    voc = [f"T{i}" for i in range(60)] + ["Ünï", "日本", "x-1"]
    rows = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [(1000 - i, "t1 t2, T3! t3 other words here") for i in range(40)] + [(2000 + i, "t3 T3 t2 t1 not the same") for i in range(15)]      # one class, other words
    rows += [(None, "t1 t2 ünï"), (7, "t5 t6"), (7, "t5 t6"), (5000, None), (5001, ""), (5002, "?!")]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(1, 12)))) for i in range(12)] + [(50, "t1 t2 t3 t3"), (51, None), (52, "..."), (53, "unknown")]
    return rows, items


@pytest.mark.parametrize("block_bytes, cells", [(lexical_search.BLOCK_BYTES, lexical_search.CHUNK_CELLS), (120, 40)])
def test_search_matches_brute_force(spark, monkeypatch, block_bytes, cells):
    monkeypatch.setattr(lexical_search, "CHUNK_CELLS", cells)
    rows, items = search_rows()
    d = docs(spark, rows).withColumns({"id": F.lit(1), "n": F.lit(2), "h": F.lit("q"), "item": F.lit(None).cast("string")})
    b = spark.createDataFrame([*items, items[0]], "item_id long, text string").withColumn("query", F.lit(1))
    out = lexical_search.search(d, b, block_bytes=block_bytes)
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in out.collect()), key=str)
    assert got == ranked_by_hand(rows, items)


def test_search_scores_beyond_doubles_and_empty_tables(spark):
    p = lexical_search.Postings(["a a b", "b c"])
    import numpy as np
    gain = np.array([9, 8, 7, 6], np.int64)
    bags = [lexical_search.bag_of(lexical_search.terms("a b b c"), p.vocabulary), lexical_search.bag_of(lexical_search.terms("c"), p.vocabulary)]
    m = np.array([25, 100])
    assert (lexical_search.scores(p, gain, True, m, bags) == lexical_search.scores(p, gain, False, m, bags)).all()
    rows, items = search_rows()
    some = spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.search(docs(spark, []), some).count() == 0
    none = lexical_search.search(docs(spark, rows), some.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


# -- 13 ------------------------------------------------------------------------
def components_by_hand(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w)} if len(w) == 1 else set(zip(w, w[1:])))
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        low.setdefault(root(a), []).append(i)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    return sorted(((i, len(sets[a]), least[root(a)] if sets[a] else i) for a, (i, _) in enumerate(rows)), key=str)


def near_rows():
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(400)]
    base = [[rng.choice(voc) for _ in range(rng.randint(5, 260))] for _ in range(14)]
    passage = [rng.choice(voc) for _ in range(50)]
    rows = []
    for i in range(450):
        k = rng.random()
        if k < .5:                                   # near copies, half of them of one text
            b = list(base[0] if rng.random() < .5 else rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(b) // 12))):
                b[rng.randrange(len(b))] = rng.choice(voc)
        elif k < .8:                                 # a passage that many share
            b = passage + [rng.choice(voc) for _ in range(rng.randint(0, 60))]
        elif k < .9:
            b = [rng.choice(voc[:3]) for _ in range(rng.randint(0, 4))]
        else:
            b = [rng.choice(voc) for _ in range(rng.randint(1, 300))]
        rows.append((i, " ".join(b)))
    return rows + [(900, None), (901, " "), (None, rows[3][1].upper()), (None, "alone here"), (5, rows[5][1]), (902, rows[0][1])]


@pytest.mark.parametrize("block", [bottom_k.BLOCK, 16, 5])
def test_near_duplicates_match_brute_force(spark, block):
    """Small blocks: long lists, components of several blocks, and groups that meet across blocks."""
    rows = near_rows()
    d = docs(spark, rows).withColumns({c: F.lit(1) for c in ("id", "tid", "key", "n", "head", "full")})
    out = bottom_k.near_duplicates(d, block=block).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str) == components_by_hand(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_of_nothing_and_low_thresholds(spark):
    assert bottom_k.near_duplicates(docs(spark, [])).count() == 0
    out = bottom_k.near_duplicates(docs(spark, [(1, None), (2, ""), (3, "x")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True)]
    with pytest.raises(ValueError, match="similarity"):
        bottom_k.near_duplicates(docs(spark, []), threshold=bottom_k.THRESHOLD / 2)


def test_entries_are_lost_with_small_probability_only():
    """Chance that no two neighbours among the first values of a union are both shared at similarity 0.8."""
    none, last = 1.0, 0.0                             # last value: not shared, shared
    state = [1.0, 0.0]
    for _ in range(bottom_k.FIRST):
        state = [0.2 * sum(state), 0.8 * state[0]]
    assert sum(state) < 1e-9 and none > last
    assert 0.36 ** bottom_k.SAFE < 2e-9
    for k in (bottom_k.LIST_K, bottom_k.K):
        c = bottom_k.least_shared(k, 0.8)
        assert sum(math.comb(k, i) * .8**i * .2**(k - i) for i in range(c)) <= bottom_k.TOLERANCE


# -- shared parts ------------------------------------------------------------------
def test_one_of_each_keeps_columns_with_clashing_names(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other text of its own"), (3, "other text of its own"), (None, "x y z"), (4, None)]
    d = docs(spark, rows).withColumns({c: F.lit(c) for c in ("_tid", "_may_go", "_kept_id", "class_id", "n_links", "tid")})
    out = jaccard_join.one_of_each(d, jaccard_join.jaccard_join(d))
    assert out.columns == d.columns
    assert sorted(((r["doc_id"], r["_tid"], r["_may_go"], r["class_id"]) for r in out.collect()), key=str) == sorted(
        [(i, "_tid", "_may_go", "class_id") for i in (1, 3, None, 4)], key=str)


def test_short_pages_do_not_meet_in_one_partition(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("html")).repartition(8)
    long = spark.range(400, 420).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat(F.lit("z"), (F.col("id") % 2).cast("string")), 900).alias("html"))
    out = warc.resolve(pages.union(long))
    sizes = [r["n"] for r in out.filter("length(payload) < 1000").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 120 and sum(sizes) == 400
    assert {r["page_id"]: r["refers_to"] for r in out.filter("length(payload) >= 1000").collect()} == {i: None if i >= 418 else 418 + i % 2 for i in range(400, 420)}


def test_all_eight_prefixed_words_lose_their_gap(spark):
    lines = [f"these {a} {b} terms" for a in ("sub", "non", "Sub-", "NON") for b in ("licensed", "commercial", "infringing", "exclusive")]
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    joined = spark.createDataFrame([(i, t.replace("Sub- ", "sub").replace("sub ", "sub").replace("non ", "non").replace("NON ", "non")) for i, t in enumerate(lines)], "doc_id long, text string")
    known = licenses.known_licenses(spark)
    digest = lambda d: {r["doc_id"]: r["canonical_sha256"] for r in licenses.scan(d, known).collect()}
    assert digest(rows) == digest(joined)


def test_executors_need_no_installation(tmp_path):
    """Workers that cannot import the package run the operators: what they need travels with the plan."""
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent("""
        import sys
        sys.path.insert(0, sys.argv[1])
        from cohortlens.session import local_session
        from cohortlens.llm import bottom_k, decontam, lexical_search, periodic_runs
        spark = local_session(2, 2)
        def probe(batches):
            import importlib.util, pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_pydict({"there": [importlib.util.find_spec("cohortlens") is not None]})
        assert not spark.range(1).mapInArrow(probe, "there boolean").first()[0]
        words = [f"w{i % 37}x{i % 11}" for i in range(200)]
        d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-1])), (3, None)], "doc_id long, text string")
        b = spark.createDataFrame([(7, " ".join(words[20:60])), (8, "w1x1")], "item_id long, text string")
        assert {r.doc_id: r.contaminated for r in decontam.contamination(d, b).collect()} == {1: True, 2: True, 3: False}
        assert decontam.drop_contaminated(d, b).count() == 1
        assert lexical_search.search(d, b).count() == 4
        assert {r.doc_id: r.component_id for r in bottom_k.near_duplicates(d).collect()} == {1: 1, 2: 1, 3: 3}
        assert periodic_runs.find_runs(d).count() == 3
        print("fine")
    """))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, str(script), REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr[-2000:]
