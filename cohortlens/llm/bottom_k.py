"""MinHash near-duplicates with bottom-k sketches of one hash function.

1. Every whole text becomes the set of its hashed word pairs. The ``K`` least hashes are its sketch: one hash function, and
   the sketches of two sets together hold the sketch of their union. Equal sets are one row from here on.
2. Inverted lists of retained values generate the overlaps. An entry is two values that stand next to each other in a sketch;
   of the first ``FIRST`` values of a union, at similarity 0.8, no neighbours are both shared with probability below
   1e-9, and two sets that are retained whole always share an entry. Lists with the same members count once.
3. In a list of up to ``BLOCK`` sets a task estimates the similarity from the union sketch and drops pairs that
   reach the threshold with probability below ``TOLERANCE``. Only spanning edges leave the task.
4. A longer list is not compared. Sets that stand in one get further entries from the rest of their sketches. A set with
   ``SAFE`` or more disjoint entries in short lists shares one of those with any similar set (else: probability below 2e-9).
   The others consist of such common values; the ones that share a long list become candidates of each other as a whole.
5. Candidate components are compared exactly, on full sets, in blocks. A set meets only sets that are not yet linked to it, so
   a block of near copies costs one comparison each. If a component has several blocks, one set of each group
   found in a block meets those of the other blocks, and what is still apart from the largest group then meets all others.
6. The groups that verified links connect are the result.

Full sets are computed again for candidates only; a bitmap of fixed size tells a task which rows may be some.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bitmap, in_bitmap, slices
from .components import components

SHINGLE = 2
THRESHOLD = Fraction(4, 5)
K, LIST_K = 128, 64                  # values of a sketch that are compared: with full sets, in a list
FIRST, LAST, SAFE = 32, 100, 20      # values that make entries, values that are kept, disjoint entries in short lists that suffice
TOLERANCE = 1e-9
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
BATCH_BYTES = 2 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)
_PAD = np.uint32(2**32 - 1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, cache: dict, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word windows (A-Z lowered); fewer words are one shingle, no words none."""
    w = np.array(list(map(cache.__getitem__, text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else [])), np.uint64)
    if len(w) == 0:
        return w
    size = min(n, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h = h * _MUL + w[i:len(w) - size + 1 + i]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(29)))


def sketch(s: np.ndarray, k: int = LAST) -> np.ndarray:
    """The upper halves of the ``k`` least values, in order (fewer, if the set has fewer)."""
    return (s[:k] >> np.uint64(32)).astype(np.uint32)


def identity(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def entries(values: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Entries start..stop-1: entry p holds the sketch's values p and p + 1. A set of one value has one entry, its value."""
    v = values.astype(np.uint64)
    pairs = (v[:-1] << np.uint64(32)) | v[1:] if len(v) > 1 else v << np.uint64(32)
    return pairs[start:stop].view(np.int64)


def least_shared(k: int, threshold: float, tolerance: float = TOLERANCE) -> int:
    """Least number c such that fewer than c of ``k`` union values are shared with probability below ``tolerance``."""
    total = 0.0
    for c in range(k + 1):
        total += math.comb(k, c) * threshold**c * (1 - threshold) ** (k - c)
        if total > tolerance:
            return c
    return k


class Sets:
    """The sets of one task's group: sketches of up to ``k`` values as ranks, and full sets if given."""

    def __init__(self, sketches: list[np.ndarray], n: np.ndarray, k: int, full: list[np.ndarray] | None = None, threshold: Fraction = THRESHOLD):
        self.n, self.k, self.threshold, self.least = n.astype(np.int64), k, threshold, least_shared(k, float(threshold))
        self.held = np.array([min(k, len(s)) for s in sketches])
        self.inside = np.arange(k) < self.held[:, None]
        values = np.full((len(sketches), k), _PAD, np.uint32)
        values[self.inside] = np.concatenate([s[:k] for s in sketches])
        vocabulary, rank = np.unique(values, return_inverse=True)
        self.rank, self.width = rank.reshape(values.shape), len(vocabulary)
        self.flat = None
        if full is not None:
            vocabulary, self.flat = np.unique(np.concatenate(full), return_inverse=True)
            self.there = np.zeros(len(vocabulary), bool)
            self.start = np.concatenate([[0], np.cumsum(self.n)])

    def similar(self, a: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that may reach the threshold with a by the union sketch, or do, if full sets are given."""
        num, den = self.threshold.numerator, self.threshold.denominator
        n, m = self.n[a], self.n[others]
        others = others[(np.minimum(n, m) * den >= np.maximum(n, m) * num)]
        if not len(others):
            return others
        mine = np.zeros(self.width, np.int64)
        np.add.at(mine, self.rank[a, :self.held[a]], 1)
        rank, inside = self.rank[others], self.inside[others]
        shared = (mine[rank] > 0) & inside
        place = np.cumsum(inside, 1) + np.cumsum(mine)[rank] - np.cumsum(shared, 1)    # in the union
        found = (shared & (place <= self.k)).sum(1)
        union = n + self.n[others] - shared.sum(1)
        whole = (n <= self.k) & (self.n[others] <= self.k)
        others = others[np.where(whole, shared.sum(1) * den >= union * num, found >= self.least)]
        if self.flat is None or not len(others):
            return others
        own = self.flat[self.start[a]:self.start[a + 1]]
        self.there[own] = True
        size = self.n[others]
        first = np.cumsum(size) - size
        at = np.repeat(self.start[others] - first, size) + np.arange(size.sum())
        common = np.add.reduceat(self.there[self.flat[at]].astype(np.int64), first)
        self.there[own] = False
        return others[common * den >= (size + n - common) * num]


def spanning(sets: Sets, label: np.ndarray, left: np.ndarray, right: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Edges that connect what is similar among ``left`` (or between left and right), and the labels they merge; equal labels are connected already."""
    label, out = label.copy(), []
    for i, a in enumerate(left.tolist()):
        others = left[i + 1:] if right is None else right
        others = others[label[others] != label[a]]
        if not len(others):
            continue
        hit = sets.similar(a, others)
        if len(hit):
            kinds, at = np.unique(label[hit], return_index=True)
            out += [(a, int(hit[x])) for x in at]
            label[np.isin(label, kinds)] = label[a]
    return out, label


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys; the input is sorted by them and a group is bounded."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys], 1)
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


def _edges(tids: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tids[x] for x, _ in pairs], pa.binary()), pa.array([tids[y] for _, y in pairs], pa.binary())], ["a", "b"])


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key (hash of id and text), tid (identity of the set), n, sketch (both null without words)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BATCH_BYTES):
            cache = _WordHash()
            sets = [shingles(t, cache) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array([identity(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["id", "key", "tid", "n", "sketch"])
    return _keyed(docs, id_col, text_col).mapInArrow(compute, f"id {kind}, key long, tid binary, n long, sketch binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))


def listed(texts: DataFrame, start: int, stop: int, wanted: DataFrame | None = None) -> DataFrame:
    """tid, entry, place: one row per entry of the inverted lists; with ``wanted`` (entries) those, and a few others by chance."""
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(wanted)) if wanted is not None else None

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [entries(np.frombuffer(s, np.uint32), start, stop) for s in batch.column("sketch").to_pylist()]
            size = np.array([len(f) for f in found], np.int64)
            entry, row = np.concatenate([np.zeros(0, np.int64), *found]), np.repeat(np.arange(len(found)), size)
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + start
            if bits is not None:
                mine = in_bitmap(bits.value, entry)
                entry, row, place = entry[mine], row[mine], place[mine]
            yield pa.RecordBatch.from_arrays([batch.column("tid").take(pa.array(row)), pa.array(entry), pa.array(place.astype(np.int32))], ["tid", "entry", "place"])
    return texts.select("tid", "sketch").mapInArrow(compute, "tid binary, entry long, place int")


def _lengths(lists: DataFrame) -> DataFrame:
    """entry, length and two sums that tell lists with other members apart, for lists of two or more."""
    return (lists.groupBy("entry").agg(F.count("*").alias("length"), F.bit_xor(F.xxhash64("tid")).alias("x"), F.bit_xor(F.xxhash64("tid", F.lit(1))).alias("y"))
            .filter("length > 1"))


def _compared(texts: DataFrame, lengths: DataFrame, start: int, stop: int, block: int, threshold: Fraction) -> DataFrame:
    """Edges (a, b) that span the candidates in the lists of up to ``block`` sets; b is the least set of those it connects."""
    short = lengths.filter(F.col("length") <= block).groupBy("length", "x", "y").agg(F.min("entry").alias("entry")).select("entry")
    short = cut_lineage(short, "short-lists")
    brief = texts.select("tid", "n", F.substring("sketch", 1, 4 * LIST_K).alias("sketch"))
    members = listed(texts, start, stop, short).join(short, "entry").select("entry", "tid").join(brief, "tid")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["entry"]):
            tids, every = group["tid"].to_pylist(), np.arange(group.num_rows)
            held = [np.frombuffer(s, np.uint32) for s in group["sketch"].to_pylist()]
            _, label = spanning(Sets(held, group["n"].to_numpy(), LIST_K, threshold=threshold), every, every)
            yield _to_heads(tids, label)
    return members.repartition("entry").sortWithinPartitions("entry").select("entry", "tid", "n", "sketch").mapInArrow(compute, "a binary, b binary")


def candidates(texts: DataFrame, threshold: Fraction = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Edges whose components hold every link (steps 2 to 4)."""
    lengths = cut_lineage(_lengths(listed(texts, 0, FIRST - 1)), "lengths")
    edges = _compared(texts, lengths, 0, FIRST - 1, block, threshold)
    long = lengths.filter(F.col("length") > block).select("entry")
    if long.limit(1).count() == 0:
        return edges
    common = cut_lineage(listed(texts, 0, FIRST - 1, long).join(long, "entry").select("tid", "entry"), "common")      # rows of the long lists
    some = cut_lineage(texts.join(common.select("tid").distinct(), "tid", "left_semi"), "common-texts")
    further = cut_lineage(_lengths(listed(some, FIRST - 1, LAST - 1)), "further")
    long = long.union(further.filter(F.col("length") > block).select("entry")).distinct()
    safe = listed(some, 0, LAST - 1).filter("place % 2 = 0").join(long, "entry", "left_anti").groupBy("tid").count().filter(F.col("count") >= SAFE)
    left = cut_lineage(common.join(safe, "tid", "left_anti"), "all-common")
    heads = cut_lineage(left.groupBy("entry").agg(F.min("tid").alias("b")), "heads")
    stars = left.join(heads, "entry").filter("tid <> b").select(F.col("tid").alias("a"), "b").distinct()
    return edges.union(_compared(some, further, FIRST - 1, LAST - 1, block, threshold)).union(stars)


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """tid, full of the rows whose key is among ``wanted`` (and of a few others, by chance)."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select("key")))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = in_bitmap(bits.value, batch.column("key").to_numpy())
            for part in slices([batch.filter(pa.array(mine))], "text", BATCH_BYTES):
                cache = _WordHash()
                sets = [s for s in (shingles(t, cache) for t in part.column("text").to_pylist()) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([identity(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["tid", "full"])
    return _keyed(docs, id_col, text_col).mapInArrow(compute, "tid binary, full binary")


def _exact(group: pa.Table, threshold: Fraction) -> Sets:
    full = [np.frombuffer(s, np.uint64) for s in group["full"].to_pylist()]
    return Sets([sketch(s, K) for s in full], group["n"].to_numpy(), K, full, threshold)


def _to_heads(tids: list[bytes], label: np.ndarray) -> pa.RecordBatch:
    """(a, b): each set that is not the least of its label, and that least set, its head."""
    head: dict[int, bytes] = {}
    for x, t in zip(label.tolist(), tids):
        head[x] = min(t, head.get(x, t))
    moved = [(t, head[x]) for x, t in zip(label.tolist(), tids) if t != head[x]]
    return pa.RecordBatch.from_arrays([pa.array([m[i] for m in moved], pa.binary()) for i in (0, 1)], ["a", "b"])


def _merged(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """(tid, head) of the sets of each (component, i) that exact links join to a set of lesser tid there, the head of its group."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["component", "i"]):
            if group.num_rows < 2:
                continue
            tids, every = group["tid"].to_pylist(), np.arange(group.num_rows)
            _, label = spanning(_exact(group, threshold), every, every)
            yield _to_heads(tids, label)
    rows = rows.select("component", "i", "tid", "n", "full").repartition("component", "i").sortWithinPartitions("component", "i")
    return rows.mapInArrow(compute, "a binary, b binary").select(F.col("a").alias("tid"), F.col("b").alias("head"))


def _crossed(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """Links (a, b) between groups (heads): the sets of side 0 of each (component, i, j) meet those of side 1 of other groups."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["component", "i", "j"]):
            heads, side = group["head"].to_pylist(), group["side"].to_numpy()
            kinds: dict[bytes, int] = {}
            label = np.array([kinds.setdefault(x, len(kinds)) for x in heads])
            if len(kinds) > 1:
                pairs, _ = spanning(_exact(group, threshold), label, np.flatnonzero(side == 0), np.flatnonzero(side == 1))
                if pairs:
                    yield _edges(heads, pairs)
    rows = rows.select("component", "i", "j", "side", "head", "tid", "n", "full")
    return rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(compute, "a binary, b binary")


def _n_blocks(block: int, shingles_: int = BLOCK_SHINGLES) -> Column:
    return F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / shingles_)).cast("int")


def _renamed(named: DataFrame, heads: DataFrame) -> DataFrame:
    """(tid, head) after the heads that ``heads`` (tid, head) names have moved under another one."""
    to = heads.select(F.col("tid").alias("head"), F.col("head").alias("to"))
    return named.join(to, "head", "left").select("tid", F.coalesce("to", "head").alias("head")).union(heads.select("tid", "head"))


def links(full: DataFrame, threshold: Fraction = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(tid, head) of every set with a link, but for the heads: the groups that exact links connect (step 5). ``full``: component, blocks, tid, n, full."""
    full = full.withColumn("own", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int"))
    first = cut_lineage(_merged(full.withColumn("i", F.col("own")), threshold), "groups")
    large = full.filter("blocks > 1").select("component", "blocks", "own", "tid", "n")
    if large.limit(1).count() == 0:
        return first
    # the heads of the groups of each block meet those of the other blocks
    keys = cut_lineage(large.join(first, "tid", "left").withColumn("head", F.coalesce("head", "tid")), "grouped")
    heads = keys.filter("tid = head").select("component", "tid", "n")
    counts = cut_lineage(heads.groupBy("component").agg(_n_blocks(block).alias("parts")), "parts")
    heads = heads.join(counts, "component").select("tid", F.pmod(F.xxhash64("tid", F.lit(1)), F.col("parts")).cast("int").alias("i"))
    second = cut_lineage(_merged(full.filter("blocks > 1").join(heads, "tid"), threshold), "heads")
    to = second.select(F.col("tid").alias("head"), F.col("head").alias("to"))
    keys = cut_lineage(keys.join(to, "head", "left").withColumn("head", F.coalesce("to", "head")).drop("to"), "grouped")
    named = _renamed(first, second)
    # what is apart from the largest group of its component meets all other groups
    sizes = keys.groupBy("component", "head").agg(F.count("*").alias("size"))
    most = sizes.groupBy("component").agg(F.max(F.struct("size", "head")).alias("m")).select("component", F.col("m.head").alias("largest"))
    apart = cut_lineage(keys.join(most, "component").filter("head <> largest"), "apart")
    if apart.limit(1).count() == 0:
        return named
    parts = cut_lineage(apart.groupBy("component").agg(_n_blocks(block).alias("parts")), "parts")
    one = (apart.join(parts, "component").withColumn("i", F.pmod(F.xxhash64("tid", F.lit(2)), F.col("parts")).cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("tid", "head", "i", "j", F.lit(0).alias("side")))
    other = (keys.join(parts, "component").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("tid", "head", "i", F.col("own").alias("j"), F.lit(1).alias("side")))
    third = cut_lineage(_crossed(full.filter("blocks > 1").join(one.union(other), "tid"), threshold).distinct(), "crossed")
    if third.limit(1).count() == 0:
        return named
    moved = components(third).filter("node <> root").select(F.col("node").alias("tid"), F.col("root").alias("head"))
    return _renamed(named, cut_lineage(moved, "moved"))


def near_duplicates(docs: DataFrame, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: id, ``n_shingles`` (size of its set of word pairs), ``component_id``, ``kept``.

    Rows are linked if the Jaccard similarity of their sets reaches ``threshold`` (0.8 and above; the tables of steps 2 and 4
    hold for that); ``component_id`` is the least id of the rows connected by links, ``kept`` whether it is the row's own.
    Rows without words (null, empty, blank) link to nothing. Repeated rows are copies of each other and share their id, so all of
    them are kept or none. A null id counts last: a component of null ids only has a null component id and its rows are kept. Other
    columns are ignored; empty input gives an empty result. Whole texts count.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"sketches are sized for a similarity of {THRESHOLD} or more")
    rows = cut_lineage(sketches(docs, id_col, text_col), "sketches")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    texts = rows.filter("n > 0").groupBy("tid").agg(least, F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    texts = cut_lineage(texts.select("tid", "n", "sketch", F.col("least.id").alias("id"), F.col("least.key").alias("key")), "sets")
    near = cut_lineage(components(cut_lineage(candidates(texts, threshold, block), "candidates")), "candidate-components")
    found = near.withColumnRenamed("node", "tid").join(texts.drop("sketch"), "tid")
    found = cut_lineage(found, "candidate-sets")
    sizes = cut_lineage(found.groupBy("root").agg(_n_blocks(block).alias("blocks")), "sizes")
    members = found.join(sizes, "root").select(F.xxhash64("root").alias("component"), "blocks", "tid", "n")
    full = members.join(full_sets(docs, found, id_col, text_col), "tid").dropDuplicates(["tid"])
    groups = cut_lineage(links(cut_lineage(full, "full"), threshold, block), "linked")
    classes = groups.union(groups.select("head", "head").distinct())
    lows = classes.join(texts.select("tid", "id"), "tid").groupBy("head").agg(F.min("id").alias("low"))
    named = classes.join(lows, "head").select("tid", "low")
    named = cut_lineage(texts.select("tid", "id").join(named, "tid", "left").select("tid", F.coalesce("low", "id").alias("component")), "components")
    out = rows.select("id", "tid", "n").join(named, "tid", "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"), own.eqNullSafe(F.col("id")).alias("kept"))


ORACLE = """
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
k AS (SELECT x, least(x, min(y)) AS component_id FROM r GROUP BY x)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, t.doc_id) AS component_id, coalesce(component_id, t.doc_id) = t.doc_id AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN k ON k.x = t.doc_id"""
