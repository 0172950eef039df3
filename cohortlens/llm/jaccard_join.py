"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. Every whole text becomes a set of hashed five-word shingles and 128 MinHash values; equal texts collapse
   to one row with a count, so copies are never paired.
2. 32 bands of 4 values make buckets (a pair at similarity 0.8 shares none with probability 5e-8). Buckets
   with the same members count once. A bucket is split into blocks, and a task compares two blocks.
3. Inside a task, pairs are compared 16 MinHash values at a time; a pair is dropped as soon as the posterior
   probability (uniform prior) of reaching the threshold falls below ``TOLERANCE``. What survives is
   reduced to a spanning star at once, so no pair leaves a task.
4. The components of those stars are the only places where links can be. Their texts are brought together,
   again in blocks, pruned the same way, and the rest is verified exactly on the shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, small_batches
from .common import bitmap, in_bitmap, slices, words
from .components import components

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
HASHES, ROWS, STEP = 128, 4, 16
TOLERANCE = 1e-8
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20
BATCH_BYTES = 2 << 20
CHUNK_PAIRS = 1 << 18
_ODD = np.random.default_rng(20).integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ODD = np.random.default_rng(21).integers(0, 2**63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(tokens: list[bytes], cache: dict | None = None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word windows; a shorter text is one shingle, no words none."""
    cache = _WordHash() if cache is None else cache
    w = np.array(list(map(cache.__getitem__, tokens)), np.uint64)
    if len(w) == 0:
        return w
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = h * _MUL + w[i:len(w) - size + 1 + i]
    return np.unique(_mix(h))


def minhash(s: np.ndarray) -> np.ndarray:
    """``HASHES`` 32-bit MinHash values of a non-empty shingle set."""
    low = np.full(HASHES, 2**32 - 1, np.uint64)
    for i in range(0, len(s), 2048):
        low = np.minimum(low, ((s[i:i + 2048, None] * _ODD) >> np.uint64(32)).min(0))
    return low.astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of ``ROWS`` values, different for each band."""
    rows = sig.reshape(-1, ROWS).astype(np.uint64)
    return _mix((rows * _BAND_ODD).sum(1, dtype=np.uint64) + np.arange(len(rows), dtype=np.uint64) * _MUL).view(np.int64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of values compared, the least matches at which the pair stays.

    Posterior of the similarity after m matches of n under a uniform prior: Beta(m + 1, n - m + 1).
    """
    x = (np.arange(200_000) + 0.5) / 200_000
    lx, lr, above = np.log(x), np.log1p(-x), x >= threshold
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * lx + (n - m) * lr
            p = np.exp(log - log.max())
            if p[above].sum() >= tolerance * p.sum():
                out[n] = m
                break
    return out


def surviving(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Places of the pairs (a[i], b[i]) that no step of the incremental comparison drops."""
    at, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, m in least.items():
        part = slice(n - STEP, n)
        matches = matches + (sig[a[at], part] == sig[b[at], part]).sum(1)
        stay = matches >= m
        at, matches = at[stay], matches[stay]
    return at


def pairs_of(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs inside ``left`` (right is None) or between both, in chunks of bounded size."""
    step = max(1, CHUNK_PAIRS // max(1, len(left if right is None else right)))
    for i in range(0, len(left), step):
        rows = left[i:i + step]
        other = left[i:] if right is None else right
        a, b = np.repeat(rows, len(other)), np.tile(other, len(rows))
        if right is None:
            upper = np.repeat(np.arange(len(rows)), len(other)) < np.tile(np.arange(len(other)), len(rows))
            a, b = a[upper], b[upper]
        yield a, b


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component label (least member) of n nodes under the edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of equal keys; the input is sorted by them, and a group is two blocks at most."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1), len(k)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            now = tuple(k[start])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tid (128 bits of the text's SHA-256), n_shingles, sig and keys (null if the text has no word)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            cache, n, sigs, keys = _WordHash(), [], [], []
            for text in part.column("text").to_pylist():
                s = shingles(words(text), cache)
                sig = minhash(s) if len(s) else None
                n.append(len(s))
                sigs.append(sig.tobytes() if len(s) else None)
                keys.append(band_keys(sig).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("tid"), pa.array(n, pa.int64()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "tid", "n_shingles", "sig", "keys"])
    rows = docs.select(F.col(id_col).alias("id"), _tid(F.col(text_col)).alias("tid"), F.col(text_col).alias("text"))
    return rows.mapInArrow(compute, f"id {kind}, tid binary, n_shingles long, sig binary, keys array<long>")


def _tid(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def _into_blocks(rows: DataFrame, key: str, n_blocks: Column) -> DataFrame:
    """Each row once per pair of blocks (i <= j) that holds its own block; ``own`` is that block."""
    rows = rows.withColumn("nb", n_blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("tid"), F.col("nb")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("nb", "other")
    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def candidate_stars(texts: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """Edges (a, b) that span the surviving candidate pairs of all buckets."""
    least = least_matches(float(threshold))
    keyed = texts.filter("keys IS NOT NULL").select("tid", F.explode("keys").alias("key"))
    buckets = (keyed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("tid")).alias("x"),
                                        F.bit_xor(F.xxhash64("tid", F.lit(1))).alias("y"))
               .filter("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"))
    members = keyed.join(buckets, "key").join(texts.select("tid", "sig"), "tid")
    blocks = _into_blocks(members, "key", F.ceil(F.col("n") / BLOCK_ROWS))

    def stars(batches):
        for group in _groups(batches, ["key", "i", "j"]):
            tids, sig = group["tid"].to_pylist(), _matrix(group["sig"], np.uint32, HASHES)
            i, own = group["i"][0].as_py(), group["own"].to_numpy()
            split = group["i"][0] != group["j"][0]
            kept_a, kept_b = [], []
            for a, b in pairs_of(np.flatnonzero(own == i), np.flatnonzero(own != i) if split else None):
                at = surviving(sig, a, b, least)
                kept_a.append(a[at])
                kept_b.append(b[at])
            label = least_labels(len(tids), np.concatenate(kept_a or [own[:0]]), np.concatenate(kept_b or [own[:0]]))
            at = np.flatnonzero(label != np.arange(len(tids)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([tids[x] for x in at], pa.binary()), pa.array([tids[x] for x in label[at]], pa.binary())], ["a", "b"])
    return blocks.select("tid", "sig", "own", "key", "i", "j").mapInArrow(stars, "a binary, b binary")


def verified(group: pa.Table, least: dict[int, int], threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(links weighted by copies, label) of the rows of one pair of blocks, exact on the shingle sets."""
    sig, own, i = _matrix(group["sig"], np.uint32, HASHES), group["own"].to_numpy(), group["i"][0].as_py()
    copies, size = group["copies"].to_numpy(), group["n_shingles"].to_numpy()
    flat = np.frombuffer(b"".join(group["shingles"].to_pylist()), np.uint64)
    vocabulary, flat = np.unique(flat, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    links, kept_a, kept_b = np.zeros(len(own), np.int64), [], []
    there = np.zeros(len(vocabulary), bool)
    for a, b in pairs_of(np.flatnonzero(own == i), None if group["i"][0] == group["j"][0] else np.flatnonzero(own != i)):
        at = surviving(sig, a, b, least)
        a, b = a[at], b[at]
        cuts = np.flatnonzero(np.diff(a, prepend=-1, append=-1))      # pairs of one left row stand together
        for s, e in zip(cuts[:-1], cuts[1:]):
            row, others = a[s], b[s:e]
            mine = flat[start[row]:start[row + 1]]
            there[mine] = True
            n = size[others]
            inside = np.concatenate([[0], np.cumsum(n)])
            place = np.repeat(start[others] - inside[:-1], n) + np.arange(inside[-1])
            common = np.add.reduceat(there[flat[place]].astype(np.int64), inside[:-1])
            there[mine] = False
            hit = common * threshold.denominator >= (n + size[row] - common) * threshold.numerator
            others = others[hit]
            links[row] += copies[others].sum()
            links[others] += copies[row]
            kept_a.append(np.full(len(others), row))
            kept_b.append(others)
    return links, least_labels(len(own), np.concatenate(kept_a or [own[:0]]), np.concatenate(kept_b or [own[:0]]))


def jaccard_join(docs: DataFrame, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``class_id``, ``n_links``, ``n_shingles``.

    ``n_links``: other rows whose shingle set has Jaccard similarity ``threshold`` or more with this one (copies
    counted, though never paired); ``class_id``: least id of the rows connected by such links. Rows without words (null,
    empty, blank) link to nothing and are their own class; so are rows without links. Repeated rows are copies
    of each other; a null id counts as a row, and a class of null ids only has a null class id. Other columns are ignored.
    Empty input gives an empty result.
    """
    small_batches(docs.sparkSession)
    least = least_matches(float(threshold))
    rows = cut_lineage(signatures(docs, id_col, text_col), "signatures")
    texts = rows.groupBy("tid").agg(F.count("*").alias("copies"), F.min("id").alias("least_id"),
                                    F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
    texts = cut_lineage(texts, "texts")
    near = components(candidate_stars(texts, threshold))
    sizes = (near.join(texts.select("tid", "n_shingles"), F.col("node") == F.col("tid")).groupBy("root")
             .agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks")))
    members = (near.join(sizes, "root").withColumnRenamed("node", "tid").join(texts.drop("keys"), "tid")
               .withColumn("group", F.xxhash64("root")))
    # one row of each text, that with the least id; a bitmap of fixed size tells which rows may be such, so no other text moves
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(members.select(F.xxhash64("least_id", "tid"))))
    whole = docs.select(_tid(F.col(text_col)).alias("tid"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).select("tid", "text", F.xxhash64("id", "tid").alias("key"))

    def with_shingles(batches):
        for batch in batches:
            mine = batch.filter(pa.array(in_bitmap(bits.value, batch.column("key").to_numpy())))
            for part in slices([mine], "text", BATCH_BYTES):
                cache = _WordHash()
                sets = pa.array([shingles(words(t), cache).tobytes() for t in part.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("tid"), sets], ["tid", "shingles"])
    held = members.select("tid", "copies", "n_shingles", "sig", "blocks", "group")
    sets = held.join(whole.mapInArrow(with_shingles, "tid binary, shingles binary"), "tid").dropDuplicates(["tid"])
    blocks = _into_blocks(sets, "group", F.col("blocks"))

    def verify(batches):
        for group in _groups(batches, ["group", "i", "j"]):
            links, label = verified(group, least, threshold)
            at, tids = np.flatnonzero(links), group["tid"].to_pylist()
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([tids[x] for x in at], pa.binary()), pa.array([tids[x] for x in label[at]], pa.binary()),
                                                  pa.array(links[at], pa.int64())], ["tid", "to", "links"])
    found = cut_lineage(blocks.mapInArrow(verify, "tid binary, to binary, links long"), "links")
    links = found.groupBy("tid").agg(F.sum("links").alias("links"))
    classes = components(found, "tid", "to").withColumnRenamed("node", "tid")
    lows = classes.join(texts.select("tid", "least_id"), "tid").groupBy("root").agg(F.min("least_id").alias("low"))
    per_text = (texts.select("tid", "copies", "least_id", "n_shingles").join(links, "tid", "left").join(classes.join(lows, "root"), "tid", "left")
                .select("tid", F.coalesce("low", "least_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    per_text = cut_lineage(per_text, "per-text")       # a plain table, so that a text that very many rows share can be split
    out = rows.select("id", "tid", "n_shingles").join(per_text, "tid")
    empty = F.col("n_shingles") == 0
    return out.select(F.col("id").alias(id_col), F.when(empty, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"), "n_shingles")


def one_of_each(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of ``joined``: that whose id names the class (rows that repeat id and text stay once).

    Rows without an id cannot be told apart by it; they stay if their class has no id, else they go with their class.
    """
    small_batches(docs.sparkSession)
    again = joined.groupBy(id_col).agg(F.count("*").alias("n"), F.bool_or(~F.col("class_id").eqNullSafe(F.col(id_col))).alias("other")).filter("n > 1 OR other")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(again.select(F.xxhash64(id_col))))

    @F.pandas_udf("boolean")
    def may_go(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, h.to_numpy()))
    flag, tid = (_unused(docs, c) for c in ("_may_go", "_tid"))
    rows = docs.withColumn(flag, may_go(F.xxhash64(id_col)))          # rows without the flag are alone in class and id
    keep = joined.filter(F.col("class_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias(_unused(docs, "_kept_id"))).distinct()
    kept = rows.filter(flag).join(keep, docs[id_col].eqNullSafe(keep[keep.columns[0]]), "left_semi")
    kept = kept.withColumn(tid, _tid(F.col(text_col))).dropDuplicates([id_col, tid])
    return rows.filter(~F.col(flag)).select(*docs.columns).union(kept.select(*docs.columns))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 5 * c >= 4 * (a.n + b.n - c)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
k AS (SELECT x, least(x, min(y)) AS class_id FROM r GROUP BY x),
d AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n.n, 0) AS n_shingles
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN k ON k.x = w.doc_id LEFT JOIN d ON d.x = w.doc_id"""
