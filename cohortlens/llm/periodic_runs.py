"""Runs (stretches of words that repeat with a period) of every document, by maximal pairs.

A run of period q and length L is a pair of equal stretches of L - q words, q words apart, that can be extended
neither to the left nor to the right: a maximal pair. So runs are the maximal pairs whose distance fits their
length, and nothing has to be extended afterwards. For each slice of documents:

1. Only words that start ``DEPTH`` words which occur again within a third of their document can belong to
   such a pair (a hash picks them; what it picks too much drops out in 2). Documents without any are done.
2. The suffixes that are left are sorted by prefix doubling, documents kept apart, which also gives the length of
   the longest common prefix (LCP) of neighbours exactly.
3. The tree of LCP intervals is walked bottom-up. An interval keeps its suffixes in order of place, each in the
   class of the word to its left. When the lists of two children meet, the shorter is put into the longer:
   neighbours of different classes that lie near enough form a maximal pair; neighbours of one class do not
   (the pair would extend to the left). Looking at neighbours only is enough: another occurrence in between would be a
   shorter period. Of pairs that span the same stretch the least period stays.

A document is the unit of work: all but its words' numbers stays inside a task, which holds one slice of
about ``BATCH_BYTES`` or one longer document.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, slices, words

MIN_LENGTH, MIN_EXPONENT = 24, 3
BATCH_BYTES = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def least_depth(min_length: int, min_exponent: int) -> int:
    """Least common prefix of a pair: length - q with length >= max(min_length, min_exponent * q)."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the ``size`` numbers from each place on."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    h ^= h >> np.uint64(29)
    one, out = h, np.zeros(len(ids) - size + 1, np.uint64)
    done, width, power = 0, 1, 0xBF58476D1CE4E5B9
    while True:                                         # binary powers of the window
        if size & width:
            out = out * np.uint64(power) + one[done:done + len(out)]
            done += width
        if done == size:
            break
        one = one[:-width] * np.uint64(power) + one[width:]
        power, width = power * power % 2**64, 2 * width
    return (out ^ (out >> np.uint64(31))) * _ODD


def _survivors(ids: np.ndarray, doc: np.ndarray, size: np.ndarray, depth: int, min_exponent: int) -> np.ndarray:
    """Places whose ``depth`` words start again, near enough for a run, in the same document."""
    if len(ids) < depth:
        return np.zeros(0, np.int64)
    h = _windows(ids, depth)
    at = np.flatnonzero(doc[:len(h)] == doc[depth - 1:])
    h = h[at] + doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    by = np.argsort(h, kind="stable")
    h, at = h[by], at[by]
    near = (h[1:] == h[:-1]) & (np.diff(at) * min_exponent <= size[doc[at[1:]]])
    keep = np.zeros(len(at), bool)
    keep[1:] |= near
    keep[:-1] |= near
    return np.sort(at[keep])


def _sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``symbols`` and the rank of each place by its first 1, 2, 4 ... symbols."""
    order = np.argsort(symbols, kind="stable")
    head = np.flatnonzero(np.diff(symbols[order], prepend=-1) != 0)
    rank = np.empty(len(symbols), np.int64)
    rank[order] = np.repeat(head, np.diff(head, append=len(order)))
    ranks, step = [rank], 1
    while True:
        r = rank[order]
        shared = np.zeros(len(order), bool)
        shared[1:] = r[1:] == r[:-1]
        shared[:-1] |= shared[1:]
        open_at = np.flatnonzero(shared)
        if not len(open_at):
            return order, ranks
        place, group = order[open_at], r[open_at]
        after = place + step
        key = np.where(after < len(symbols), rank[np.minimum(after, len(symbols) - 1)] + 1, 0)
        by = np.lexsort((key, group))
        place, key, group = place[by], key[by], group[by]
        order[open_at] = place
        new = np.ones(len(place), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        head = np.flatnonzero(new)
        rank = rank.copy()
        rank[place] = np.repeat(open_at[head], np.diff(head, append=len(place)))
        ranks.append(rank)
        step *= 2


def _common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a[i] and b[i] (different places)."""
    a, b, n = a.copy(), b.copy(), len(ranks[0])
    length = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        rank = ranks[k]
        inside = (a < n) & (b < n)
        equal = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        step = equal.astype(np.int64) << k
        a, b, length = a + step, b + step, length + step
    return length


def _maximal_pairs(suffixes: list[int], lcp: list[int], left: dict[int, int], depth: int, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal pairs that fit; ``lcp[k]`` is that of suffixes k - 1 and k."""
    found: list[tuple[int, int, int]] = []

    def meet(a: list[int], b: list[int], common: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        reach = common // (min_exponent - 1)            # length >= min_exponent * q
        for x in b:
            k = bisect(a, x)
            for y in a[max(0, k - 1):k + 1]:
                q = abs(x - y)
                if q <= reach and common + q >= min_length and left[x] != left[y]:
                    found.append((min(x, y), common + q, q))
        if len(b) < 4:
            for x in b:
                insort(a, x)
            return a
        a += b
        a.sort()
        return a

    depths: list[int] = []
    lists: list[list[int]] = []
    now = [suffixes[0]]
    for k in range(1, len(suffixes) + 1):
        common = lcp[k] if k < len(suffixes) else 0
        while depths and depths[-1] > common:
            now = meet(lists.pop(), now, depths.pop())
        if common >= depth:
            if depths and depths[-1] == common:
                lists[-1] = meet(lists[-1], now, common)
            else:
                depths.append(common)
                lists.append(now)
        if k < len(suffixes):
            now = [suffixes[k]]
    return found


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period) of each list of words, by start, then period."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has at least two words and two periods")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    depth = least_depth(min_length, min_exponent)
    number = _Numbers()
    used = [i for i, t in enumerate(texts) if len(t) >= min_length]
    if not used:
        return out
    size = np.array([len(texts[i]) for i in used])
    ids = np.array([n for i in used for n in map(number.__getitem__, texts[i])], np.int64)
    doc = np.repeat(np.arange(len(used)), size)
    first = np.cumsum(size) - size
    alive = _survivors(ids, doc, size, depth, min_exponent)
    if not len(alive):
        return out
    # the words that the survivors cover, one zone after the other, each closed by a symbol of its own
    edge = np.bincount(alive, minlength=len(ids) + 1) - np.bincount(alive + depth, minlength=len(ids) + 1)[:len(ids) + 1]
    at = np.flatnonzero(np.cumsum(edge[:len(ids)]) > 0)
    zone = np.cumsum((np.diff(at, prepend=-2) > 1) | (np.diff(doc[at], prepend=-1) != 0)) - 1
    place = np.arange(len(at)) + zone
    symbols = np.full(len(at) + zone[-1] + 1, -1, np.int64)
    kinds, inner = np.unique(doc[at] * len(number) + ids[at], return_inverse=True)
    symbols[place] = inner
    ends = np.flatnonzero(symbols < 0)
    symbols[ends] = len(kinds) + np.arange(len(ends))
    order, ranks = _sorted_suffixes(symbols)
    here = np.zeros(len(symbols), bool)
    here[place[np.searchsorted(at, alive)]] = True
    order = order[here[order]]
    word = np.full(len(symbols), -1, np.int64)
    word[place] = at
    lcp = np.concatenate([[0], _common_prefixes(ranks, order[:-1], order[1:])])
    suffix = word[order]
    left = np.where(suffix == first[doc[suffix]], -1, ids[suffix - 1])
    # a suffix with no interval of the least depth on either side cannot pair
    inside = lcp >= depth
    inside[:-1] |= inside[1:]
    lcp, suffix, left = lcp[inside], suffix[inside], left[inside]
    if not len(suffix):
        return out
    pairs = _maximal_pairs(suffix.tolist(), lcp.tolist(), dict(zip(suffix.tolist(), left.tolist())), depth, min_length, min_exponent)
    least: dict[tuple[int, int], int] = {}
    for start, length, period in pairs:
        key = start, length
        least[key] = min(period, least.get(key, period))
    for (start, length), period in sorted(least.items(), key=lambda r: (r[0][0], r[1])):
        d = int(doc[start])
        out[used[d]].append((start - int(first[d]), length, period))
    return out


def collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what runs repeat after their first period."""
    if runs:
        edge = np.zeros(len(tokens) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(tokens)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per input row: id, ``n_words``, ``runs`` (array of start, length, period by start, then period), ``collapsed``.

    A run is a stretch of consecutive words with least period q and at least ``max(min_length, min_exponent * q)`` words
    that no neighbouring word extends. ``collapsed`` is the text without the words that a run contains after its first q words,
    joined by one space. Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated rows give
    repeated results, a null id stays null, other columns are ignored, and empty input gives an empty result. Texts are processed whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BATCH_BYTES):
            tokens = [words(t) for t in part.column("text").to_pylist()]
            found = runs_of(tokens, min_length, min_exponent)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(t) for t in tokens], pa.int64()),
                 pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found], pa.list_(RUN)),
                 pa.array([collapsed(t, r).decode("utf-8", "surrogatepass") for t, r in zip(tokens, found)], pa.string())],
                ["id", "n_words", "runs", "collapsed"])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(compute, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and text; every tenth document by crc32 of its id repeats a stretch of its own words (the contract's rule)."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")

        def body(v: Column) -> Column:
            a, p = v["a"], v["p"]
            tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + (i - a) % p).cast("int")))
            return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")
        a = g % n
        return F.when(n > 0, let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("long").alias("p")), body))
    planted = let(F.regexp_extract_all(text_col, F.lit(f"({WORD})"), F.lit(1)), repeated)
    return docs.select(F.col(id_col), F.when((h % 10 == 0) & F.col(text_col).isNotNull(), planted).otherwise(F.col(text_col)).alias(text_col))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns of ``find_runs``: number of runs, the run of greatest exponent, digests of runs and text."""
    def order(x: Column, y: Column) -> Column:
        more, less = x["length"] * y["period"], y["length"] * x["period"]       # exact comparison of length / period
        return (F.when(more > less, -1).when(more < less, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = F.get(F.array_sort("runs", order), 0)
    return found.select(
        id_col, "n_words", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


#: Equal 16-word windows q words apart, neighbouring ones put together, are the same maximal pairs; crc32 is computed bit by bit.
ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, coalesce(CAST(doc_id AS VARCHAR), '') AS t FROM documents),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[unicode(x), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[] FOR x IN string_split(t, '')])),
      lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END), 4294967295::BIGINT) AS h FROM d),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 AS r, h // 10 AS g FROM c),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT doc_id, n, CASE WHEN r = 0 AND n > 0 THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] ELSE w END AS w FROM p),
u AS (SELECT row_number() OVER () AS k, * FROM t),
s AS (SELECT k, n, i, array_to_string(w[i + 1:i + 16], ' ') AS s FROM (SELECT k, n, w, unnest(range(n - 15)) AS i FROM u WHERE n >= 24)),
e AS (SELECT x.k, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.k = y.k AND x.s = y.s AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
z AS (SELECT k, q, min(i) AS start, max(i) - min(i) + 16 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS z FROM e) GROUP BY k, q, z),
f AS (SELECT k, start, length, min(q) AS period FROM z WHERE length >= greatest(24, 3 * q) GROUP BY k, start, length),
b AS (SELECT k, start, length, period FROM f QUALIFY row_number() OVER (PARTITION BY k ORDER BY CAST(length AS HUGEINT) * 1000000000000 // period DESC, start, period) = 1),
m AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM f GROUP BY k),
x AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM f),
v AS (SELECT k, list(i) AS gone FROM x GROUP BY k)
SELECT doc_id, n AS n_words, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE [w[i + 1] FOR i IN range(n) IF NOT list_contains(gone, i)] END, ' ')) AS collapsed_sha256
FROM u LEFT JOIN m USING (k) LEFT JOIN b USING (k) LEFT JOIN v USING (k)"""
