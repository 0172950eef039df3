"""Many k-means fits at once: every scan of the vectors serves all (k, restart) pairs.

The vectors are a written table with one ``x array<double>`` column (and what goes along with it). A step sends the
centres of all pairs along (their number follows the parameters, never the data), each task adds up counts, sums and costs
per centre with matrix products over Arrow batches, Spark sums those partial rows, and one row per centre
comes back. So an iteration of 9 values of k with 10 restarts is one scan and one small aggregate instead of 90.

- ``moments``: per centre the rows nearest to it (count, sum of vectors, sum of squared norms, cost).
- ``starts``: k-means|| for all pairs in common scans (first rows by hash, two rounds of sampling by cost, weights), then
  weighted k-means++ over the few candidates on the driver.
- ``fit``: Lloyd's steps until no centre of a pair moves more than ``tol``; pairs that are done leave the scan.
- ``silhouettes``: the squared-euclidean silhouette of several centre sets in one scan.

Functions that run in tasks are closures over arrays, so executors need numpy and pyarrow only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_CELLS = 1 << 20
ROUNDS, OVERSAMPLING = 2, 2          # k-means||: rounds, and candidates per round as a multiple of k
TOL = 1e-4


@dataclass
class Moments:
    """Of the rows nearest to each centre of one set."""

    n: np.ndarray
    sums: np.ndarray
    sq: np.ndarray
    cost: float

    @property
    def means(self) -> np.ndarray:
        return self.sums / np.maximum(self.n, 1)[:, None]


def _parts(chunk: int):
    """Function that yields the vectors of Arrow batches as matrices of up to ``chunk`` rows."""
    def parts(batches, column=0):
        for batch in batches:
            held = batch.column(column)
            if not batch.num_rows:
                continue
            x = np.asarray(held.flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, -1)
            if not np.isfinite(x).all():
                raise ValueError("vectors must be finite; impute them first")
            for i in range(0, len(x), chunk):
                yield x[i:i + chunk], batch.slice(i, chunk)
    return parts


def _flat(sets) -> tuple[np.ndarray, list[int], list[int]]:
    width = [len(s) for s in sets]
    return np.concatenate([np.asarray(s, float) for s in sets]), width, [int(v) for v in np.cumsum([0, *width])[:-1]]


def moments(vectors: DataFrame, sets, x: str = "x") -> list[Moments]:
    """``Moments`` of each of ``sets`` (k x d centre matrices; ties go to the first centre) in one scan."""
    flat, width, start = _flat(sets)
    n_all, d = flat.shape
    parts = _parts(max(1, CHUNK_CELLS // 4 // n_all))

    def work(batches):
        half, twice = (flat * flat).sum(1)[:, None], -2 * flat
        total, cost = np.zeros((n_all, d + 2)), np.zeros(n_all)
        for part, _ in parts(batches):
            norm = (part * part).sum(1)
            score = twice @ part.T + half                                      # a row per centre: whole rows are compared
            near = np.empty_like(score)
            for s, w in zip(start, width):
                best = score[s:s + w].min(0)
                own = np.equal(score[s:s + w], best, out=near[s:s + w], casting="unsafe")
                if own.sum() != len(part):                                     # ties go to the first centre
                    label = score[s:s + w].argmin(0)
                    own[:] = 0
                    own[label, np.arange(len(part))] = 1
                cost[s:s + w] += own @ np.maximum(norm + best, 0)
            total += near @ np.concatenate([part, norm[:, None], np.ones((len(part), 1))], 1)
        sums, sq, n = total[:, :d], total[:, d], total[:, d + 1]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(sq[at]), pa.array(cost[at]), *(pa.array(sums[at, j]) for j in range(d))],
                                         ["c", "n", "sq", "cost", *(f"s{j}" for j in range(d))])
    names = ["n", "sq", "cost", *(f"s{j}" for j in range(d))]
    partial = vectors.select(x).mapInArrow(work, "c long, " + ", ".join(f"{c} double" for c in names))
    n, sums, sq, cost = np.zeros(n_all), np.zeros((n_all, d)), np.zeros(n_all), np.zeros(n_all)
    for r in partial.groupBy("c").agg(*[F.sum(c).alias(c) for c in names]).collect():          # a row per centre
        n[r["c"]], sq[r["c"]], cost[r["c"]], sums[r["c"]] = r["n"], r["sq"], r["cost"], r[4:]
    return [Moments(n[s:s + w], sums[s:s + w], sq[s:s + w], float(cost[s:s + w].sum())) for s, w in zip(start, width)]


def _mixer():
    """Function that mixes 64-bit hashes with a salt."""
    def mixed(h, salt):
        v = (h.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return v ^ (v >> np.uint64(29))
    return mixed


def _first_rows(hashed: DataFrame, seeds, most: int) -> dict[int, np.ndarray]:
    """For each seed the ``most`` distinct vectors of least hash."""
    parts, mixed = _parts(1 << 14), _mixer()

    def work(batches):
        held = {s: {} for s in seeds}
        for part, batch in parts(batches):
            h = batch.column(1).to_numpy()
            for s in seeds:
                u = (mixed(h, s) >> np.uint64(1)).view(np.int64)
                at = np.argsort(u, kind="stable")
                at = at[np.unique(u[at], return_index=True)[1][:most]]
                held[s].update(zip(u[at].tolist(), part[at].tolist()))
                held[s] = dict(sorted(held[s].items())[:most])
        rows = [(s, u, v) for s, m in held.items() for u, v in m.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.float64())))], ["seed", "u", "x"])
    found = hashed.mapInArrow(work, "seed long, u long, x array<double>").dropDuplicates(["seed", "u"])
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("seed").orderBy("u"))).filter(F.col("r") <= most)
    out: dict[int, list] = {s: [] for s in seeds}
    for r in found.orderBy("seed", "r").collect():                                             # seeds x most rows
        out[r["seed"]].append(r["x"])
    return {s: np.array(v, float) for s, v in out.items()}


def _sampled(hashed: DataFrame, keys, sets, rates, salt: int) -> list[np.ndarray]:
    """New candidates of each pair: a distinct vector comes with probability rate * (squared distance to the set)."""
    flat, width, start = _flat(sets)
    parts, mixed, salts = _parts(max(1, CHUNK_CELLS // len(flat))), _mixer(), [((salt + 1) * 1_000_003 + k) * 1_000_003 + s for k, s in keys]

    def work(batches):
        half = (flat * flat).sum(1)
        for part, batch in parts(batches):
            norm, h = (part * part).sum(1), batch.column(1).to_numpy()
            score = half - 2 * part @ flat.T
            for i, (s, w) in enumerate(zip(start, width)):
                d2 = np.maximum(norm + score[:, s:s + w].min(1), 0)
                at = np.flatnonzero((mixed(h, salts[i]) >> np.uint64(11)) * 2.0**-53 < rates[i] * d2)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(part[at].tolist(), pa.list_(pa.float64()))], ["i", "x"])
    out: list[list] = [[] for _ in keys]
    for r in hashed.mapInArrow(work, "i long, x array<double>").distinct().orderBy("i", "x").collect():   # about OVERSAMPLING * k rows a pair
        out[r["i"]].append(r["x"])
    return [np.array(v, float).reshape(len(v), flat.shape[1]) for v in out]


def _plus_plus(points: np.ndarray, weight: np.ndarray, k: int, rng) -> np.ndarray:
    """Weighted k-means++ and a few Lloyd steps over the candidates; fewer centres if there are fewer distinct points."""
    chosen = [points[rng.choice(len(points), p=weight / weight.sum())]]
    near = ((points - chosen[0]) ** 2).sum(1)
    while len(chosen) < k and (near * weight).sum() > 0:
        p = near * weight
        chosen.append(points[rng.choice(len(points), p=p / p.sum())])
        near = np.minimum(near, ((points - chosen[-1]) ** 2).sum(1))
    centres = np.array(chosen)
    for _ in range(30):
        label = ((points[:, None] - centres) ** 2).sum(2).argmin(1)
        total = np.bincount(label, weight, len(centres))
        sums = np.stack([np.bincount(label, weight * points[:, j], len(centres)) for j in range(points.shape[1])], 1)
        moved = np.where(total[:, None] > 0, sums / np.maximum(total, 1e-300)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def starts(vectors: DataFrame, keys, x: str = "x") -> dict[tuple[int, int], np.ndarray]:
    """k-means|| starting centres of every (k, seed) in ``keys``, in 2 + 2 * ``ROUNDS`` scans for all of them."""
    keys = list(keys)
    hashed = vectors.select(F.col(x).alias("x"), F.xxhash64(x).alias("h"))
    first = _first_rows(hashed, sorted({s for _, s in keys}), max(k for k, _ in keys))
    if not len(next(iter(first.values()))):
        raise ValueError("no vectors to fit")
    sets = [first[s][:1] for _, s in keys]
    for r in range(ROUNDS):
        costs = [m.cost for m in moments(vectors, sets, x)]
        rates = [OVERSAMPLING * k / c if c > 0 else 0.0 for (k, _), c in zip(keys, costs)]
        new = _sampled(hashed, keys, sets, rates, r)
        sets = [np.unique(np.concatenate([a, b]), axis=0) for a, b in zip(sets, new)]
    sets = [c if len(c) >= k else np.unique(np.concatenate([c, first[s][:k]]), axis=0) for (k, s), c in zip(keys, sets)]
    weights = [m.n for m in moments(vectors, sets, x)]
    return {key: _plus_plus(c[w > 0], w[w > 0], key[0], np.random.default_rng(key)) for key, c, w in zip(keys, sets, weights)}


def step(centres: np.ndarray, m: Moments) -> np.ndarray:
    """Means of the rows of each centre; a centre without rows stays."""
    return np.where(m.n[:, None] > 0, m.means, centres)


def fit(vectors: DataFrame, begin: dict, *, max_iter: int, tol: float = TOL, x: str = "x") -> dict:
    """(centres, cost over all rows) of each key of ``begin``: Lloyd's steps from its centres, one scan per step for all keys.

    A key is done when no centre of it moves more than ``tol``; the others go on, up to ``max_iter`` steps.
    """
    centres, active = {key: np.asarray(c, float) for key, c in begin.items()}, list(begin)
    for _ in range(max_iter):
        if not active:
            break
        found = moments(vectors, [centres[key] for key in active], x)
        still = []
        for key, m in zip(active, found):
            new = step(centres[key], m)
            if ((new - centres[key]) ** 2).sum(1).max() > tol * tol:
                still.append(key)
            centres[key] = new
        active = still
    keys = list(begin)
    return {key: (centres[key], m.cost) for key, m in zip(keys, moments(vectors, [centres[key] for key in keys], x))}


def silhouettes(vectors: DataFrame, sets, found: list[Moments], x: str = "x") -> list[float | None]:
    """Mean squared-euclidean silhouette of all rows under each of ``sets``; None where fewer than two centres have rows.

    The mean squared distance of a row to a cluster follows from the cluster's count, mean and mean squared norm.
    """
    flat, width, start = _flat(sets)
    n, sq = (np.concatenate([getattr(m, a) for m in found]) for a in ("n", "sq"))
    mean = np.concatenate([m.means for m in found])
    level = np.where(n > 0, sq / np.maximum(n, 1), np.inf)
    parts = _parts(max(1, CHUNK_CELLS // len(flat)))

    def work(batches):
        half = (flat * flat).sum(1)
        total, count = np.zeros(len(start)), 0
        for part, _ in parts(batches):
            norm, rows = (part * part).sum(1)[:, None], np.arange(len(part))
            score = half - 2 * part @ flat.T
            apart = np.maximum(norm - 2 * part @ mean.T + level, 0)            # mean squared distance to each cluster
            for i, (s, w) in enumerate(zip(start, width)):
                label, to = score[:, s:s + w].argmin(1), apart[:, s:s + w].copy()
                own = n[s + label]
                a = to[rows, label] * own / np.maximum(own - 1, 1)
                to[rows, label] = np.inf
                b = to.min(1)
                top = np.maximum(a, b)
                good = (own > 1) & (top > 0) & np.isfinite(b)
                total[i] += ((b[good] - a[good]) / top[good]).sum()
            count += len(part)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(start))), pa.array(total), pa.array(np.full(len(start), count))], ["i", "total", "count"])
    partial = vectors.select(x).mapInArrow(work, "i long, total double, count long")
    got = {r["i"]: r["t"] / r["c"] for r in partial.groupBy("i").agg(F.sum("total").alias("t"), F.sum("count").alias("c")).collect() if r["c"]}
    return [float(got[i]) if i in got and (m.n > 0).sum() > 1 else None for i, m in enumerate(found)]
