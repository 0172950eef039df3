"""Every dealt operator against a brute-force version, and on awkward rows."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import (common, decontam, docstats, elias_fano, jaccard_join, licenses, ngram_trie, packing, pii, quality_fm, quality_gbt,
                            suffix_dedup, warc)

LONG = "word " * 3000 + "a" * 20_000 + " 1 2 3" * 500
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "tiny"), (5, LONG), (6, "same text here for all of us " * 20), (6, "same text here for all of us " * 20),
           (7, "same text here for all of us " * 20), (None, "no id on this row"), (None, "no id on this row"), (8, "ünï cödé ß İ ✓ " * 30)]
CLASH = ["score", "kept", "n_words", "id", "tid", "h", "g", "found", "spans", "bucket", "label", "units", "tag", "block"]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "en", "s", None, *[0] * len(CLASH)) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (5, 0), (6, 1), (7, 1), (8, 1), (None, 1), (4, None)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs away into the deep dark forest"), (2, None), (3, ""), (4, "short")],
                                 "item_id long, text string")


def docs(spark, texts, first=1):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.fixture(scope="module")
def per_row(spark, labels, bench):
    """Operators that return one row per input row."""
    return {
        "licenses": lambda d: licenses.scan(d, licenses.known_licenses(spark)), "pii": pii.detect,
        "rules": lambda d: quality_gbt.quality_rules(d, labels), "trie": ngram_trie.score_corpus,
        "machine": lambda d: quality_fm.classify(d, quality_fm.train(d, labels)), "packing": packing.pack,
        "suffix": suffix_dedup.remove_repeats, "decontam": lambda d: decontam.contamination(d, bench), "jaccard": jaccard_join.jaccard_join}


@pytest.mark.parametrize("name", ["licenses", "pii", "rules", "trie", "machine", "packing", "suffix", "decontam", "jaccard"])
def test_awkward_rows_and_empty_tables(spark, awkward, per_row, name):
    out = per_row[name](awkward).toPandas()
    assert sorted(out.doc_id.fillna(-1)) == sorted(-1 if i is None else i for i, _ in AWKWARD)
    same = out[out.doc_id == 6].drop(columns=[c for c in ("slot", "block", "batch") if c in out])
    assert len(same) == 2 and same.astype(str).nunique().max() == 1          # repeated rows: equal results
    assert per_row[name](awkward.limit(0)).count() == 0


def test_license_forms(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    other = re.sub("Copyright .*", "© 1999-2004 Somebody Else, All rights reserved.", mit).upper().replace(",", " ,").replace("SUBLICENSE", "sub-\nlicence")
    got = licenses.scan(docs(spark, [mit, other, mit + " more", "x\nLicenced under the Apache License - version 2.0\nx"]), licenses.known_licenses(spark))
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i].license_id for i in (1, 2, 3, 4)] == ["MIT", "MIT", None, None]
    assert rows[4].notices == "Apache-2.0" and rows[4].n_notice_lines == 1


PII_TEXTS = ["a_b@c.d_e@f.g x@y..z a@b.c..d@e.f", "1.2.3.4.5.6.7.8 1.2.3 300.1.1.1 000255.0.0.1 1.1.1.1000000000000", "+1 (988) 555-2485 and +123 +44 20 7946 0958.",
             "4041894974608795 4041 8949-7460 8795  4041894974608796 1 2 3 4 5 6 7 8 9 0 1 2 3 4", "ü@x.de ✓ me@x.de\n+49(0)30-1234567", "@" * 50 + "a.b@c",
             "1 " * 5000, "a." * 3000 + "@" + "b." * 3000 + "c", "9" * 20000, "+" * 1000 + "1" * 15, None]


def _base(text):
    def luhn(d):
        t = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            t += v - 9 if v > 9 else v
        return t % 10 == 0
    patterns = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for k, (kind, p) in enumerate(patterns):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")),
                    "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_pii_base_spans(spark):
    rows = {r.doc_id: r for r in pii.detect(docs(spark, PII_TEXTS)).collect()}
    for i, t in enumerate(PII_TEXTS):
        want = _base(t)
        r = rows[i + 1]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t and t[:60]
        assert set(want) <= set(r.spans.split(",")) or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]


def test_pii_trees_add_loose_forms_and_leave_clean_text(spark):
    texts = [f"call +1 ({200 + i}) 555-{1000 + i} or bob.k{i}@mail{i}.example.com from 10.0.{i}.7 version {i}.0 in 20{i % 30:02d}-01-0{i % 9 + 1}" for i in range(150)]
    loose = "write to ann.k (at) mail.example (dot) com from 10.0.[.]7"
    rows = {r.doc_id: r for r in pii.detect(docs(spark, texts + [loose, "chapter 3.2 of 2004, 17 pages at home. The end"])).collect()}
    assert "email:9:" in rows[151].spans and rows[152].spans == ""
    clean = pii.redact(docs(spark, texts[:40] + [None, ""])).orderBy("doc_id").collect()
    assert "[EMAIL]" in clean[3].text and "555" not in clean[3].text and "10.0" not in clean[3].text and "version 3.0" in clean[3].text
    assert clean[40].text is None and clean[41].text == ""


def test_pii_adds_spans_at_every_size_and_mix(spark):
    loose = "write to ann.k (at) mail.example (dot) com please"
    few = [f"contact bob.k{i}@mail{i}.example.com from 10.0.{i}.7 in 20{i % 30:02d}-01-0{i % 9 + 1}" for i in range(12)]
    dates = [" ".join(f"20{i % 30:02d}-01-{j + 10}" for j in range(20)) for i in range(60)]
    for texts, rows in ((few, pii.SAMPLE_ROWS), (few * 4 + dates, 200)):
        got = {r.doc_id: r for r in pii.detect(docs(spark, texts + [loose]), sample_rows=rows).collect()}
        assert "email:9:" in got[len(texts) + 1].spans
        assert all(got[i + 1].spans == "" for i, t in enumerate(texts) if t in dates)
    assert pii.shares({"a": 5, "b": 1000, "c": 90}, 200) == {"a": 5, "c": 90, "b": 105}
    assert pii.threshold([]) == pii.threshold([(0.9, 1.0, 1.0), (0.1, 0.0, 1.0)]) == pii.LEAST_SCORE
    assert pii.threshold([(0.9, 1.0, 1.0), (0.8, 0.0, 1.0)]) == 0.9 and pii.threshold([(0.9, 0.0, 1.0)]) == 2.0


def test_hash_sample_of_a_huge_table_is_not_empty(spark):
    rows = spark.range(20_000)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(rows), "count", lambda self: 3 * 10**10)              # as if there were so many
        held = common.hash_sample(rows, 20_000, F.col("id"), "id")
        condition = held._jdf.queryExecution().optimizedPlan().toString()
    share = int(re.search(r"xxhash64\(id#\d+L?, 42\) < (-?\d+)", condition).group(1)) + 2**63
    assert abs(share / 2**64 - 1.1 * 20_000 / (3 * 10**10)) < 1e-12
    assert abs(rows.filter(common.hash_below(F.col("id"), 0.25)).count() - 5000) < 300
    assert common.hash_sample(rows, 30_000, F.col("id"), "id").count() == 20_000 and common.hash_sample(rows, 50, F.col("id"), "id").count() <= 50


def test_rules_statistics_match_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["\n".join(" ".join(rng.choice(["a", "b#", "ç", "dd\x85e"], rng.integers(0, 9))) for _ in range(rng.integers(1, 20))) for _ in range(80)] + ["", "a b c a b c", "x\n x\nx\n\n\n"]
    for t in texts:
        got = dict(zip(docstats.COUNTS, docstats.document_stats(t.encode())))
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got == {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
                       "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}, t


def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(5)
    x = rng.random((3000, len(quality_gbt.FEATURES)))
    y = (x[:, 1] + 0.3 * rng.random(3000) - x[:, quality_gbt.FEATURES.index("symbols_per_word")] > 0.1).astype(float)
    m = quality_gbt.fit_with_threshold(x, y)
    assert ((m.probability(x) >= 0.5) == (y == 1)).mean() > 0.85
    for name in quality_gbt.MONOTONE:
        z = np.repeat(x[:50, None], 40, 1)
        z[:, :, quality_gbt.FEATURES.index(name)] = np.linspace(0, 1, 40)
        p = m.probability(z.reshape(-1, x.shape[1])).reshape(50, 40)
        assert (np.diff(p, axis=1) <= 1e-12).all()
    node = m.roots[0]                                     # node arrays agree with a walk down the first tree
    for _ in range(m.depth):
        node = m.left[node] if x[0, m.feature[node]] <= m.split[node] else m.right[node]
    assert m.left[node] == m.right[node] == node


def test_factorisation_machine_identity_and_heldout(spark):
    rng = np.random.default_rng(2)
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm.DIM), rng.normal(size=(quality_fm.DIM, 4)))
    i, v = rng.choice(quality_fm.DIM, 12, replace=False), rng.random(12)
    want = 0.3 + m.linear[i] @ v + sum(m.factors[a] @ m.factors[b] * x * y for (a, x), (b, y) in itertools.combinations(list(zip(i, v)), 2))
    assert m.margins(np.array([0, 12]), i, v)[0] == pytest.approx(want)
    table = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    d, lab = table("documents"), table("labels")
    out = quality_fm.classify(d, quality_fm.train(d, lab)).toPandas().merge(lab.toPandas(), on="doc_id")
    assert (out.held_out == out.doc_id.map(lambda x: zlib.crc32(str(x).encode()) % 5 == 0)).all()
    held = out[out.held_out]
    assert ((held.predicted == held.quality).mean()) > 0.9


def test_bounds_are_optimal_and_batches_keep_the_budget(spark):
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        top, c = np.sort(rng.choice(60, n, replace=False) + 1), rng.integers(1, 9, n)
        cost = lambda bounds: sum(k * (min(b for b in bounds if b >= t) - t) for t, k in zip(top, c))
        for k in (1, 2, 3, 8):
            best = min(cost((*cut, top[-1])) for r in range(min(k, n)) for cut in itertools.combinations(top[:-1], r))
            got = packing.optimal_bounds(c, c * top, top, k)
            assert cost(got) == best and len(got) <= k and got[-1] == top[-1]
    texts = ["w " * int(k) for k in rng.integers(0, 900, 500)]
    out = packing.pack(docs(spark, texts), n_buckets=4, token_budget=2000).toPandas()
    size = out.groupby(["bucket", "block", "batch"]).agg(n=("slot", "size"), slots=("slot", "nunique"), length=("bucket_len", "max"))
    assert len(out) == 500 and (size.n == size.slots).all() and ((size.n * size.length <= 2000) | (size.n == 1)).all()
    assert (out.pad_tokens >= 0).all() and (out.n_tokens == [len(texts[i - 1].split()) + 1 for i in out.doc_id]).all()


@pytest.mark.parametrize("n", [1, 2, 700, 40_000])
def test_elias_fano_round_trip(n):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, 2**50, n, dtype=np.uint64))
    ef = elias_fano.EliasFano.build(v)
    assert (ef.all() == v).all()
    ask = np.sort(np.concatenate([v[::3], rng.integers(0, 2**50, 50, dtype=np.uint64)]))
    at, equal = ef.successors(ask)
    assert (at == np.searchsorted(v, ask)).all() and (equal == np.isin(ask, v)).all()
    assert (elias_fano.EliasFano.build(np.repeat(v, 3)).all() == np.repeat(v, 3)).all()


@pytest.mark.parametrize("split", [ngram_trie.SPLIT, 3])
def test_trie_scores_match_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(ngram_trie, "SPLIT", split)              # 3: frequent contexts are spread over shards
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["The", "a", "ÉB", "cat", "x1", "dog", "z"], rng.integers(0, 30))) for _ in range(60)]
    out = ngram_trie.score_corpus(docs(spark, texts)).toPandas().set_index("doc_id")
    tok = {i + 1: [*re.sub("[A-Z]", lambda m: m[0].lower(), t).split(), "\n"] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tok}
    train = [x for i, x in tok.items() if not held[i]]
    c = collections.Counter(itertools.chain(*train))
    pair = collections.Counter(p for x in train for p in zip(["\t", *x], x))
    ctx, deg = collections.Counter(v for x in train for v in ["\t", *x[:-1]]), collections.Counter(v for v, _ in pair)
    N, V = sum(c.values()), len(c)
    uni = lambda w: (c[w] + 0.1) / (N + 0.1 * (V + 1))
    for i, x in tok.items():
        r = out.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(x), sum(c[w] > 0 for w in x), N)
        assert r.base_score == pytest.approx(sum(math.log10(uni(w)) for w in x))
        p = [(max(pair[v, w] - 0.75, 0) + 0.75 * deg[v] * uni(w)) / ctx[v] if ctx[v] else uni(w) for v, w in zip(["\t", *x], x)]
        assert r.score == pytest.approx(sum(map(math.log10, p)), abs=2e-4 * len(x))


def test_deep_shallow_sort_orders_and_classes():
    rng = np.random.default_rng(6)
    data = np.concatenate([rng.integers(0, 2, 3000, dtype=np.uint8), np.zeros(400, np.uint8), rng.integers(0, 2, 300, dtype=np.uint8)])
    data = np.concatenate([data, data[:1500], np.zeros(120, np.uint8)])
    starts = np.arange(len(data) - 110)
    order, kind = suffix_dedup.deep_shallow_sort(data, starts)
    strings = [data[s:s + 100].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert ((np.diff(kind) == 0) == np.array([a == b for a, b in zip(strings, strings[1:])])).all()


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK, 2])
def test_suffix_removal_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)             # 2: classes are merged across blocks
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    shared, line = word(260), word(130)
    texts = [word(150) + shared + word(90), shared, word(40) + shared[30:200] + word(60), "a" * 450, "xy" * 170, "", None, shared[:99], line * 3]
    texts += [word(int(rng.integers(0, 60))) + line + word(int(rng.integers(0, 60))) for _ in range(12)] + [texts[0]]
    out = suffix_dedup.remove_repeats(docs(spark, texts)).toPandas().set_index("doc_id")
    seen = set()
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(b[p:p + 100])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        r = out.loc[i + 1]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), i


def _semi_global(unit, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(unit, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_matches_edit_distance():
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abcdefgh  "), n))
    items = [(i, word(int(rng.integers(40, 96)))) for i in range(6)] + [(9, "too short"), (10, None)]
    index = decontam.build_index(items)
    assert (index.least >= 1).all()
    for trial in range(120):
        key, unit = items[trial % 6]
        chars = list(unit)
        for _ in range(int(rng.integers(0, 9))):
            p = int(rng.integers(0, len(chars)))
            op = rng.integers(0, 3)
            if op == 0:
                chars[p] = "z"
            elif op == 1:
                del chars[p]
            else:
                chars.insert(p, "q")
        text = word(50) + "".join(chars).upper() + word(50)
        found = decontam.scan_texts([text], index)[0]
        inside = _semi_global(unit, text.lower()) <= int(index.edits[[i for i, r in enumerate(index.item) if index.ids[r] == key][0]])
        assert bool([r for r in found if r[0] == key]) == inside
        assert all(0 <= r[1] < r[2] <= len(text) for r in found)
    assert decontam.scan_texts([word(500)] * 20 + [""], index) == [[]] * 21


def test_decontamination_in_blocks(spark, bench):
    base = bench.filter("item_id = 1").first().text
    texts = [f"x {base} y", base.upper().replace(" ", "\n"), "nothing here at all", None]
    assert len(decontam.benchmark_indexes(bench.union(bench), block_chars=1)) == 2
    rows = decontam.contamination(docs(spark, texts), bench).orderBy("doc_id").collect()
    assert [r.contaminated for r in rows] == [True, True, False, False] and rows[0].item_ids == [1] and rows[0].regions == f"1:2:{2 + len(base)}:0"
    assert [r.doc_id for r in decontam.drop_contaminated(docs(spark, texts), bench).orderBy("doc_id").collect()] == [3, 4]
    assert decontam.contamination(docs(spark, texts), bench.limit(0)).filter("contaminated").count() == 0


def test_decontamination_finds_parts_of_items(spark):
    """Every stretch of 48 characters within one edit in 16, wherever it begins; shorter items exactly and as whole words."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefgh  "), n))
    item = word(300)
    index = decontam.build_index([(1, item)], decontam.STRETCH)
    for trial in range(60):
        n = int(rng.integers(30, 110))
        at = int(rng.integers(0, 300 - n))
        chars = list(item[at:at + n])
        for _ in range(int(rng.integers(0, 7))):
            p = int(rng.integers(0, len(chars)))
            chars[p:p + int(rng.integers(0, 2))] = rng.choice(["z", "", "q"])
        text = word(40) + "".join(chars) + word(40)
        want = any(_semi_global(item[s:s + m], text) <= m // 16 for m in (48, 64, 80, 96) for s in range(max(0, at - 12), min(300 - m, at + n - m + 12) + 1))
        assert bool(decontam.scan_texts([text], index)[0]) == want, trial
    bench = spark.createDataFrame([(1, item), (2, "Forty two, of course"), (3, " \n"), (4, "8")], "item_id long, text string")
    texts = [word(30) + "#" + item[113:193] + "#" + word(30), word(30) + "#" + item[7:7 + 48] + "#", "so: forty two,\nof course!", "forty two, of courses", "18 80", "an 8."]
    rows = decontam.contamination(docs(spark, texts), bench).orderBy("doc_id").collect()
    assert [r.item_ids for r in rows] == [[1], [1], [2], [], [], [4]]
    s, e = map(int, rows[0].regions.split(":")[1:3])
    assert s <= 31 and e >= 111 and rows[2].regions == "2:4:24:0"
    assert [r.doc_id for r in decontam.drop_contaminated(docs(spark, texts), bench).orderBy("doc_id").collect()] == [4, 5]


def test_warc_round_trip_and_validation(spark):
    big = "<html>" + "é" * 800
    rows = [(1, "http://a b", big), (2, "u", big), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, None, None), (6, "u", ""), (2, "u", big), (None, "u", big), (7, "u", "y" * 100_000)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    out = {(r.page_id, r.record_type): r for r in warc.round_trip(pages).collect()}
    assert out[1, "revisit"].refers_to == 2 and (2, "revisit") not in out and out[None, "revisit"].refers_to == 2 and (3, "response") in out and (4, "response") in out
    assert out[2, "response"].payload.decode() == big and out[1, "revisit"].payload_bytes == len(big.encode()) and out[5, "response"].payload_bytes == 0
    assert out[1, "revisit"].payload_digest == hashlib.sha1(big.encode()).hexdigest() and out[1, "revisit"].url == "http://a%20b"
    assert warc.round_trip(pages).count() == len(rows) and warc.round_trip(pages.limit(0)).count() == 0
    records = [warc.build_record(i, "u", (b"payload %d " % i) * 300, None) for i in range(-3, 40)]
    archive = warc.write_archive(records, warc.train_dictionary([r for r in records] * 20))
    assert archive[:4] == b"\x5d\x2a\x4d\x18" and [r["page_id"] for r in warc.read_archive(archive)] == list(range(-3, 40))
    for bad in (archive[:-3], archive[4:], archive[:9]):
        with pytest.raises(Exception):
            list(warc.read_archive(bad))
    for a, b in ((b"WARC/1.1", b"WARC/3.1"), (b"payload 5", b"payload 6"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date", b"Date")):
        with pytest.raises(ValueError):
            warc.parse_record(records[8].replace(a, b, 1))


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_ROWS, 7])
def test_jaccard_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)         # 7: buckets and components are split into blocks
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [list(rng.choice(vocabulary, int(rng.integers(30, 90)))) for _ in range(12)]
    texts = []
    for k, b in enumerate(base):
        for _ in range(30 if k == 0 else 4):
            t = list(b)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(0, len(t)))] = str(rng.choice(vocabulary))
            texts.append(" ".join(t))
    texts += [texts[0], texts[0], "a b", "a b", "a  b", "", "", None]
    out = jaccard_join.jaccard_join(docs(spark, texts)).toPandas().set_index("doc_id")

    def grams(t):
        w = (t or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [grams(t) for t in texts]
    link = {i: [j for j, b in enumerate(sets) if j != i and a and b and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)}
    for i in link:
        todo, seen = [i], {i}
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (out.loc[i + 1].class_id, out.loc[i + 1].n_links) == (min(seen) + 1, len(link[i])), texts[i]
    assert jaccard_join.one_of_each(docs(spark, texts), jaccard_join.jaccard_join(docs(spark, texts))).count() == out.class_id.nunique()


def test_posterior_bound_keeps_pairs_at_the_threshold():
    least = jaccard_join.least_matches(0.8)
    for n, m in least.items():
        lost = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m))
        assert lost < 1e-6 and 0 < m < n
