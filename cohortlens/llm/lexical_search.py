"""Ranked lexical search of a stated set of items over all documents, with bag deduplication.

Only the terms of the items can score, so a document counts through the bag of those terms, its frequencies, and the length
value m. Documents with equal bags and equal m score alike for every item:

1. Items are taken in blocks of about ``BLOCK_BYTES`` of text (one block unless the items are many); a block's terms are
   its vocabulary, the only thing that is broadcast.
2. One pass restricts every whole document to the vocabulary and writes (id, length, hash of the bag, bag).
   Document frequencies and the corpus sums come from that table; partial counts meet, never documents.
3. Documents are grouped by hash, m and the whole bag (the hash finds a class, the bytes verify it), with map-side
   combination, so that a class of a third of all documents is one row per task. Each class is scored once.
4. A task keeps the best ``top`` classes of each item. A document among the best ``top`` of all lies in one of the
   best ``top`` classes, ordered by score and least id, because each better class has a better document.
5. The classes that won are expanded to their ``top`` least ids, and those are ranked.

Scores are 64-bit integers; sums in doubles are used only where a bound proves them exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import broadcast_value, received, slices

BLOCK_BYTES = 8 << 20
BATCH_BYTES = 2 << 20
CHUNK_CELLS = 1 << 20
#: Terms are made of digits, letters (A-Z lowered) and everything beyond ASCII; every other byte separates.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_NO_ID = 2**63 - 1


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def bag_of(tokens: list[bytes], vocabulary: dict[bytes, int]) -> bytes:
    """Numbers of the vocabulary terms in ascending order, then their frequencies, as 32-bit integers."""
    count = Counter(tokens)
    pairs = sorted((vocabulary[t], count[t]) for t in count.keys() & vocabulary.keys())
    return np.array(pairs, np.uint32).reshape(-1, 2).T.tobytes()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """Items by term: for term t the items ``item[start[t]:start[t + 1]]`` and how often each holds it."""

    def __init__(self, texts: list[str | None]):
        self.vocabulary: dict[bytes, int] = {}
        rows = []
        for i, text in enumerate(texts):
            rows += [(self.vocabulary.setdefault(t, len(self.vocabulary)), i, n) for t, n in Counter(terms(text)).items()]
        term, self.item, self.times = np.array(sorted(rows), np.int64).reshape(-1, 3).T
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.vocabulary)))]).astype(np.int64)
        self.n_items = len(texts)


def scores(postings: Postings, gain: np.ndarray, exact: bool, m: np.ndarray, bags: list[bytes]) -> np.ndarray:
    """(bags x items) integer scores; ``gain`` is weight times frequency in the item, along ``postings.item``."""
    flat = [np.frombuffer(b, np.uint32).reshape(2, -1) for b in bags]
    term, tf = np.concatenate(flat, 1).astype(np.int64)
    row = np.repeat(np.arange(len(bags)), [f.shape[1] for f in flat])
    part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
    n = postings.start[term + 1] - postings.start[term]
    at = np.repeat(postings.start[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
    cell, value = np.repeat(row, n) * postings.n_items + postings.item[at], np.repeat(part, n) * gain[at]
    if exact:                                                  # every sum stays below 2**53
        total = np.bincount(cell, weights=value, minlength=len(bags) * postings.n_items).astype(np.int64)
    else:
        total = np.zeros(len(bags) * postings.n_items, np.int64)
        np.add.at(total, cell, value)
    return total.reshape(len(bags), postings.n_items)


def best_of(item: np.ndarray, score: np.ndarray, least: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` best entries of each item: highest score first, then least id."""
    by = np.lexsort((least, -score, item))
    item = item[by]
    head = np.flatnonzero(np.diff(item, prepend=-1))
    return by[np.arange(len(by)) - np.repeat(head, np.diff(head, append=len(by))) < top]


def _bags(rows: DataFrame, vocabulary) -> DataFrame:
    """id, n (terms of the document), h (hash of the bag), bag."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for part in slices(batches, "text", BATCH_BYTES):
            n, bags = [], []
            for text in part.column("text").to_pylist():
                tokens = terms(text)
                n.append(len(tokens))
                bags.append(bag_of(tokens, known))
            h = np.array([xxhash.xxh3_64_intdigest(b) for b in bags], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), pa.array(h), pa.array(bags, pa.binary())], ["id", "n", "h", "bag"])
    return rows.mapInArrow(compute, "id long, n long, h long, bag binary")


def _frequencies(bags: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""
    def count(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for b in batch.column("bag").to_pylist():
                df[np.frombuffer(b, np.uint32, len(b) // 8)] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])
    out = np.zeros(n_terms, np.int64)
    for r in bags.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]                               # a row for each term of the block's vocabulary
    return out


def _best_classes(classes: DataFrame, shared, top: int) -> DataFrame:
    """query, score, h, m, least: the best ``top`` classes of each query in each task."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings, gain, exact = received(shared)
        held = [np.zeros(0, np.int64) for _ in range(5)]       # query, score, least, h, m
        rows = max(1, CHUNK_CELLS // max(1, postings.n_items))
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                m, h = (part.column(c).to_numpy() for c in ("m", "h"))
                least = part.column("least").fill_null(_NO_ID).to_numpy()
                s = scores(postings, gain, exact, m, part.column("bag").to_pylist())
                floor = np.partition(s, len(s) - top, axis=0)[len(s) - top] if len(s) > top else 0
                row, query = np.nonzero((s > 0) & (s >= floor))
                new = [query, s[row, query], least[row], h[row], m[row]]
                held = [np.concatenate(x) for x in zip(held, new)]
                stay = best_of(held[0], held[1], held[2], top)
                held = [x[stay] for x in held]
        query, score, least, h, m = held
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score), pa.array(h), pa.array(m), pa.array(least, mask=least == _NO_ID)],
                                         ["query", "score", "h", "m", "least"])
    return classes.select("h", "m", "bag", "least").mapInArrow(compute, "query long, score long, h long, m long, least long")


def _search_block(rows: DataFrame, ids: list, texts: list[str | None], top: int, item_type: str) -> DataFrame | None:
    spark = rows.sparkSession
    postings = Postings(texts)
    if not postings.vocabulary:
        return None
    vocabulary = spark.sparkContext.broadcast(postings.vocabulary)
    bags = cut_lineage(_bags(rows, vocabulary), "bags").filter("n > 0")
    n_docs, n_terms = bags.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bags = bags.filter(F.length("bag") > 0).withColumn("m", F.expr(f"100 - 75 + (75 * n * {n_docs}L) div {max(1, n_terms)}L"))
    df = _frequencies(bags, len(postings.vocabulary))
    w = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    gain = np.repeat(w, np.diff(postings.start)) * postings.times
    most = int(np.bincount(postings.item, weights=gain, minlength=postings.n_items).max()) * 1_000_000
    shared = broadcast_value(spark, (postings, gain, most < 2**53))
    classes = bags.groupBy("h", "m", "bag").agg(F.min("id").alias("least"))
    local = _best_classes(classes, shared, top)
    order = [F.col("score").desc(), F.col("least").asc_nulls_last()]
    won = local.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(*order, "h", "m"))).filter(F.col("r") <= top).drop("r")
    won = cut_lineage(won, "classes")
    # the members of the classes that won: a class is its hash, m and the bag of the document with its least id
    keys = won.select("h", "m", "least").distinct()
    of_class = (bags["h"] == keys["h"]) & (bags["m"] == keys["m"]) & bags["id"].eqNullSafe(keys["least"])
    first = bags.join(keys, of_class).select(keys["h"], keys["m"], keys["least"], bags["bag"]).distinct()
    # written, so that a class of very many documents can be split by the join and is cut to its best in every task after it
    members = cut_lineage(bags.join(cut_lineage(first, "won-bags"), ["h", "m", "bag"]).select("h", "m", "least", "id"), "members")
    members = members.withColumn("r", F.row_number().over(Window.partitionBy("h", "m", "least").orderBy(F.col("id").asc_nulls_last()))).filter(F.col("r") <= top)
    members = members.select("h", "m", "least", "id")
    of_member = (won["h"] == members["h"]) & (won["m"] == members["m"]) & won["least"].eqNullSafe(members["least"])
    ranked = won.join(members, of_member).select("query", "score", "id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())))
    names = spark.createDataFrame(list(enumerate(ids)), f"query long, item {item_type}")      # the ids of one block
    out = cut_lineage(ranked.filter(F.col("rank") <= top).join(names, "query").select("item", "rank", "id", "score"), "ranked")
    vocabulary.unpersist()
    shared.unpersist()
    return out


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of each item: item id, ``rank`` (from 1), id, ``score`` (above 0), best first, ties by ascending id.

    ``id_col`` holds integers. Null, empty and termless texts count nowhere and are never found; termless items find nothing. Rows that
    repeat an id are documents of their own; a null id comes last among equals. Items that repeat id and text are one item; different texts under one id are
    ranked each for itself. Other columns are ignored. No documents or no items: no rows. Whole texts count, and every document takes part.
    """
    kind, item_type = (t.schema[c].dataType.simpleString() for t, c in ((docs, id_col), (items, item_id)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    stated = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).filter(F.length("text") > 0).distinct()
    size = stated.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(size / block_bytes))
    stated = stated.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)))
    found = []
    for b in range(n_blocks):
        block = stated.filter(F.col("block") == b).collect()                                   # about block_bytes of text
        out = _search_block(rows, [r["item"] for r in block], [r["text"] for r in block], top, item_type) if block else None
        if out is not None:
            found.append(out)
    if not found:
        found = [rows.sparkSession.createDataFrame([], f"item {item_type}, rank int, id long, score long")]
    result = found[0] if len(found) == 1 else rows.sparkSession.read.parquet(*[f for t in found for f in t.inputFiles()])
    return result.select(F.col("item").alias(item_id), "rank", F.col("id").cast(kind).alias(id_col), "score")


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM documents),
f AS (SELECT k, doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT k, sum(tf)::BIGINT AS n FROM f GROUP BY k),
g AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM n),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, g WHERE t IN (SELECT t FROM q) GROUP BY t, nd),
s AS (SELECT item_id, k, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // l))))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN n USING (k), g GROUP BY item_id, k, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10"""
