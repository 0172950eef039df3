"""Quality rules: gradient-boosted trees over document statistics, monotone in chosen features.

Statistics come from whole texts, one pass. The trees are fitted on all labelled rows: each level of a tree is a
scan of their binned statistics that adds up histograms in the tasks, and the driver picks the splits. They are flattened into
node arrays and score all documents with a few numpy steps per tree level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import quantile
from ..session import cut_lineage, small_batches
from .common import slices
from .docstats import COUNTS, RATIOS, batch_stats

N_BINS = 64
UNIT = 1 << 24
ROWS_A_TASK, DRIVER_ROWS = 25_000, 100_000
KEEP = 0.998                            # of the good rows held out
BATCH_BYTES = 4 << 20
#: More of these never raises the score.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1}
FEATURES = ["n_words", *RATIOS]
_COLUMNS = [(COUNTS + RATIOS).index(f) for f in FEATURES]


@dataclass
class Trees:
    """Flattened trees: node arrays (a leaf points to itself), one root per tree."""

    base: float = 0.0
    shrink: float = 0.1
    depth: int = 3
    threshold: float = 0.0                  # verdict: keep if probability >= threshold
    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    split: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def probability(self, x: np.ndarray) -> np.ndarray:
        """P(label 1) of each row of ``x`` (columns as ``FEATURES``)."""
        margin, row = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[row, self.feature[node]] <= self.split[node], self.left[node], self.right[node])
            margin += self.shrink * self.value[node]
        return 1.0 / (1.0 + np.exp(-margin))


def _best_split(g, h, lo, hi, sign, ridge, least):
    """Best cut of one node and feature from bin sums: (gain, bin, left value, right value) or None."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    wl, wr = (np.clip(-a / (b + ridge), lo, hi) for a, b in ((gl, hl), (gr, hr)))
    w = np.clip(-g.sum() / (h.sum() + ridge), lo, hi)
    loss = lambda a, b, v: a * v + 0.5 * (b + ridge) * v * v
    gain = loss(g.sum(), h.sum(), w) - loss(gl, hl, wl) - loss(gr, hr, wr)
    gain[(hl < least) | (hr < least) | (sign * (wr - wl) < 0)] = 0
    i = int(np.argmax(gain)) if len(gain) else 0
    return (gain[i], i, wl[i], wr[i]) if len(gain) and gain[i] > 1e-9 else None


@dataclass
class Nodes:
    """The trees of a fit so far (the last one may grow): as ``Trees``, with bin numbers as cuts."""

    base: float
    shrink: float
    depth: int
    roots: list[int]
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def sums(self, binned: np.ndarray, y: np.ndarray, open_nodes: list[int], n_bins: int) -> np.ndarray:
        """Sums of gradients and of curvatures by open node, feature and bin, over all rows of ``binned``."""
        margin, row = np.full(len(y), self.base), np.arange(len(y))
        for root in self.roots:
            node = np.full(len(y), root)
            for _ in range(self.depth):
                node = np.where(binned[row, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            if root != self.roots[-1]:
                margin += self.shrink * self.value[node]
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, np.maximum(prob * (1 - prob), 1e-9)
        out = np.zeros((len(open_nodes), binned.shape[1], n_bins, 2))
        for i, at in enumerate(open_nodes):
            rows = node == at
            for f in range(binned.shape[1]):
                b = binned[rows, f]
                out[i, f, :, 0], out[i, f, :, 1] = np.bincount(b, g[rows], n_bins), np.bincount(b, h[rows], n_bins)
        return out


def grow(edges: list[np.ndarray], n_good: float, n: int, sums, names=FEATURES, monotone=MONOTONE, n_trees: int = 60, depth: int = 3,
         shrink: float = 0.15, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Histogram gradient boosting with logistic loss on ``n`` rows, ``n_good`` of them with label 1.

    ``sums(nodes, open, bins)`` gives ``Nodes.sums`` over all rows; it is asked once per level of a tree. A split on a monotone feature
    is taken only if its leaf values are in order, and both subtrees are then kept on their side of the middle, so the sum of the trees
    is monotone in that feature. Fewer than two classes (or no rows): no trees, the score is the (smoothed) share of label 1.
    """
    p = (n_good + 0.5) / (n + 1.0)
    out = Trees(base=float(np.log(p / (1 - p))), shrink=shrink, depth=depth)
    if n == 0 or n_good in (0, n):
        return out
    feature, split, cut, left, right, value = [], [], [], [], [], []
    n_bins = max(len(e) for e in edges) + 1

    def new(v):
        for a, b in ((feature, 0), (split, 0.0), (cut, 0), (left, len(value)), (right, len(value)), (value, v)):
            a.append(b)
        return len(value) - 1
    for _ in range(n_trees):
        root = new(0.0)
        out.roots.append(root)
        open_nodes = [(root, -np.inf, np.inf)]
        for _ in range(depth):
            if not open_nodes:
                break
            so_far = Nodes(out.base, shrink, depth, out.roots, *(np.array(a) for a in (feature, cut, left, right, value)))
            below = []
            for (node, lo, hi), found_sums in zip(open_nodes, sums(so_far, [o[0] for o in open_nodes], n_bins)):
                best = None
                for f, e in enumerate(edges):
                    g, h = found_sums[f, :len(e) + 1].T
                    found = _best_split(g, h, lo, hi, monotone.get(names[f], 0), ridge, least)
                    if found and (best is None or found[0] > best[0][0]):
                        best = found, f
                if best is None:
                    continue
                (_, i, wl, wr), f = best
                feature[node], split[node], cut[node], left[node], right[node] = f, float(edges[f][i]), i, new(wl), new(wr)
                sign, mid = monotone.get(names[f], 0), (wl + wr) / 2
                below.append((left[node], mid if sign < 0 else lo, mid if sign > 0 else hi))
                below.append((right[node], mid if sign > 0 else lo, mid if sign < 0 else hi))
            open_nodes = below
        if left[root] == root:                  # no split is worth it, nor would be in the next tree
            break
    out.feature, out.split, out.left = np.array(feature), np.array(split), np.array(left)
    out.right, out.value = np.array(right), np.array(value)
    return out


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)


def fit(x: np.ndarray, y: np.ndarray, names=FEATURES, n_bins: int = N_BINS, **options) -> Trees:
    """``grow`` on rows in memory."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, n_bins + 1)[1:-1])) for c in x.T] if len(y) else []
    binned = _binned(x, edges) if len(y) else x
    return grow(edges, y.sum(), len(y), lambda nodes, at, bins: nodes.sums(binned, y, at, bins), names, **options)


def fit_with_threshold(x: np.ndarray, y: np.ndarray, keep: float = KEEP, **options) -> Trees:
    """Fit on four fifths; the verdict's threshold keeps the share ``keep`` of the good rows of the rest (0.5 at most)."""
    held = np.arange(len(y)) % 5 == 0
    model = fit(x[~held], y[~held], **options)
    good = model.probability(x[held & (y == 1)])
    model.threshold = float(min(0.5, np.quantile(good, 1 - keep, method="lower"))) if len(good) else 0.0
    return model


def _features(part: pa.RecordBatch) -> np.ndarray:
    return np.stack([part.column(n).to_numpy(zero_copy_only=False) for n in FEATURES], 1)


def fit_table(rows: DataFrame, n_bins: int = N_BINS, **options) -> Trees:
    """``grow`` on all rows (label and ``FEATURES``) of a table: a scan of their bins per level of a tree.

    Bins come from quantile sketches of all rows, sums per node, feature and bin come back from each scan (their number does not
    follow the rows).
    """
    ask = np.linspace(0, 1, n_bins + 1)[1:-1].tolist()
    counts = rows.agg(F.count("label").alias("n"), F.sum("label").alias("good"), *[F.percentile_approx(c, ask, 10_000).alias(c) for c in FEATURES]).first()
    n, good = counts["n"], counts["good"] or 0.0
    if n == 0 or good in (0, n):
        return grow([], good, n, None, **options)
    edges = [np.unique(counts[c]) for c in FEATURES]
    names = [f"b{i}" for i in range(len(FEATURES))]

    def to_bins(batches):
        for part in batches:
            b = _binned(_features(part), edges).astype(np.int16)
            yield pa.RecordBatch.from_arrays([part.column("label"), *(pa.array(c) for c in b.T)], ["label", *names])
    bins = rows.select("label", *FEATURES).mapInArrow(to_bins, "label double, " + ", ".join(f"{c} short" for c in names))
    bins = cut_lineage(bins.coalesce(-(-n // ROWS_A_TASK)), "rule_bins")          # scanned once per level: few tasks, growing with the rows
    if n <= DRIVER_ROWS:                        # all rows, 2 MB at most: cheaper than a job per level, the same sums
        held = np.array(bins.toPandas().to_numpy(float))
        b, y = held[:, 1:].astype(np.int16), held[:, 0]
        return grow(edges, good, n, lambda nodes, at, n_bins: np.rint(nodes.sums(b, y, at, n_bins) * UNIT) / UNIT, **options)

    def sums(nodes, at, n_bins):
        def work(batches):
            total = np.zeros((len(at), len(names), n_bins, 2))
            for part in batches:
                b = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in names], 1)
                total += nodes.sums(b, part.column("label").to_numpy(zero_copy_only=False), at, n_bins)
            flat = np.rint(total.reshape(-1, 2) * UNIT).astype(np.int64)             # whole numbers: the sum is the same in any order
            cell = np.flatnonzero(flat.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(flat[cell, 0]), pa.array(flat[cell, 1])], ["cell", "g", "h"])
        out = np.zeros((len(at) * len(names) * n_bins, 2))
        for r in bins.mapInArrow(work, "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            out[r["cell"]] = r["g"] / UNIT, r["h"] / UNIT
        return out.reshape(len(at), len(names), n_bins, 2)
    return grow(edges, good, n, sums, **options)


def least_kept(good: DataFrame, model: Trees, keep: float = KEEP) -> float:
    """The score that the share ``keep`` of the rows of ``good`` reach (0.5 at most; 0 without rows)."""
    def score(batches):
        for part in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.probability(_features(part)))], ["p"])
    scores = good.select(*FEATURES).mapInArrow(score, "p double")
    n = scores.count()
    if n == 0:
        return 0.0
    rank = int((1 - keep) * (n - 1))            # the quantile of a whole rank is a row's score, up to rounding
    return min(0.5, quantile(scores, "p", rank / max(1, n - 1)).first()["value"] * (1 - 1e-9))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and all statistics of every whole text, one row per input row."""
    small_batches(docs.sparkSession)
    names = COUNTS + RATIOS
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names)

    def compute(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            s = batch_stats(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(s[:, i]) for i in range(len(names)))], [id_col, *names])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(compute, schema)


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Trees:
    """Fit on all labelled rows but a fifth by hash of the id, whose good rows give the verdict's threshold (null labels are left out)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    joined = known.join(stats.withColumnRenamed(id_col, "id"), "id")
    rows = cut_lineage(joined.select("label", *FEATURES, (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("held")), "rule_rows")
    model = fit_table(rows.filter("NOT held"))
    model.threshold = least_kept(rows.filter("held AND label = 1"), model)
    return model


def base_failed(s: np.ndarray) -> np.ndarray:
    """The fixed rule on statistics rows: under 50 words, or over half of the words in repeated windows."""
    words, repeat = s[:, 0], s[:, COUNTS.index("n_repeat_words")]
    return (words < 50) | (100 * repeat > 50 * words)


def verdicts(stats: DataFrame, model: Trees, id_col: str = "doc_id") -> DataFrame:
    """id, the counts, ``base_failed``, ``kept`` and ``score`` of statistics rows."""
    schema = (f"`{id_col}` {stats.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in COUNTS)
              + ", base_failed boolean, kept boolean, score double")

    def judge(batches):
        for part in batches:
            s = np.stack([part.column(n).to_numpy(zero_copy_only=False) for n in COUNTS + RATIOS], 1)
            score, failed = model.probability(s[:, _COLUMNS]), base_failed(s)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(s[:, i].astype(np.int64)) for i in range(len(COUNTS))), pa.array(failed),
                 pa.array(~failed & (score >= model.threshold)), pa.array(score)],
                [id_col, *COUNTS, "base_failed", "kept", "score"])
    return stats.mapInArrow(judge, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, fit and verdict of all documents: one row per input row.

    Null and empty texts have zero counts and fail the base rule. Repeated rows and null ids are judged like
    any other row; other columns are ignored. No labelled rows: the model keeps what the base rule
    keeps. Empty input gives an empty result.
    """
    stats = cut_lineage(statistics(docs, id_col, text_col), "docstats")
    return verdicts(stats, train(stats, labels, id_col=id_col), id_col)


def keep_documents(docs: DataFrame, model: Trees, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that the base rule and the model keep."""
    small_batches(docs.sparkSession)

    def keep(batches):
        for part in slices(batches, text_col, BATCH_BYTES):
            s = batch_stats(part.column(text_col))
            yield part.filter(pa.array(~base_failed(s) & (model.probability(s[:, _COLUMNS]) >= model.threshold)))
    return docs.mapInArrow(keep, docs.schema)
