"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]), so the pairwise
interactions cost no more than the linear part. The model is fitted on the driver on a bounded sample of
labelled rows outside the held-out fold (``SAMPLE_ROWS`` in hash order of the id); every whole text is scored.
Labels, language, source and ids are no inputs; metadata is the recorded length ``n_chars``, if given.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, hash_sample, slices
from .docstats import COUNTS, RATIOS, batch_stats

SAMPLE_ROWS = 6_000
WORD_BUCKETS = 1 << 15
LEVELS = 32                                   # one-hot levels of each statistic
BATCH_BYTES = 2 << 20
N_STATS = len(COUNTS) + len(RATIOS) + 1       # the last is the metadata
DIM = WORD_BUCKETS + N_STATS * LEVELS


class _Buckets(dict):
    """Word to hash bucket, remembered for the words of one slice of documents."""

    def __missing__(self, word: bytes) -> int:
        b = self[word] = crc32(word) & (WORD_BUCKETS - 1)
        return b


def levels(stats: np.ndarray) -> np.ndarray:
    """Level of each statistic on a logarithmic scale from 2**-10 to 2**21, zero apart."""
    with np.errstate(divide="ignore"):
        return np.where(stats > 0, np.clip(np.floor(np.log2(np.where(stats > 0, stats, 1))) + 11, 1, LEVELS - 1), 0).astype(np.int64)


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (row starts, indices, values): words with unit norm, one level per statistic."""
    raws, cache = [t or b"" for t in texts.cast(pa.binary()).to_pylist()], _Buckets()
    n = len(raws)
    owners, buckets = [], []
    for i, raw in enumerate(raws):
        b = np.array(list(map(cache.__getitem__, raw.split())), np.int64)
        buckets.append(b + i * WORD_BUCKETS)
    keys, counts = np.unique(np.concatenate(buckets) if buckets else np.zeros(0, np.int64), return_counts=True)
    owners, index = keys // WORD_BUCKETS, keys % WORD_BUCKETS
    value = np.sqrt(counts.astype(np.float64))
    value /= np.sqrt(np.bincount(owners, value**2, n))[owners]
    lev = levels(np.column_stack([batch_stats(texts), n_chars])) + WORD_BUCKETS + np.arange(N_STATS) * LEVELS
    owners = np.concatenate([owners, np.repeat(np.arange(n), N_STATS)])
    index, value = np.concatenate([index, lev.ravel()]), np.concatenate([value, np.full(n * N_STATS, N_STATS ** -0.5)])
    order = np.argsort(owners, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))])
    return starts, index[order], value[order]


@dataclass
class Machine:
    bias: float
    linear: np.ndarray                        # DIM
    factors: np.ndarray                       # DIM x k

    def margins(self, starts, index, value) -> np.ndarray:
        """Scores before the sigmoid, linear in the number of entries (every row has some)."""
        if len(starts) < 2:
            return np.zeros(0)
        vx = self.factors[index] * value[:, None]
        s = np.add.reduceat(vx, starts[:-1])
        pairs = 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), starts[:-1]))
        return self.bias + np.add.reduceat(self.linear[index] * value, starts[:-1]) + pairs

    def probability(self, starts, index, value) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(starts, index, value), -35, 35)))


def fit(starts, index, value, y, k: int = 8, epochs: int = 12, rate: float = 0.1, ridge: float = 1e-4, batch: int = 32, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss in small batches; no rows or one class: a constant model."""
    rng = np.random.default_rng(seed)
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    m = Machine(float(np.log(p / (1 - p))), np.zeros(DIM), rng.normal(0, 0.05, (DIM, k)))
    if len(y) == 0 or y.min() == y.max():
        m.factors[:] = 0
        return m
    seen_b, seen_w, seen_v = 1e-6, np.full(DIM, 1e-6), np.full((DIM, k), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for rows in (order[i:i + batch] for i in range(0, len(y), batch)):
            size = starts[rows + 1] - starts[rows]
            cut = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(starts[rows] - cut[:-1], size) + np.arange(cut[-1])
            i, x, owner = index[at], value[at], np.repeat(np.arange(len(rows)), size)
            err = (m.probability(cut, i, x) - y[rows]) / len(rows)
            vx = m.factors[i] * x[:, None]
            s = np.add.reduceat(vx, cut[:-1])
            ex = err[owner] * x
            used, back = np.unique(i, return_inverse=True)
            gw = np.bincount(back, ex) + ridge * m.linear[used]
            part = ex[:, None] * (s[owner] - vx)
            gv = np.stack([np.bincount(back, part[:, f]) for f in range(k)], 1) + ridge * m.factors[used]
            seen_b += err.sum() ** 2
            seen_w[used] += gw**2
            seen_v[used] += gv**2
            m.bias -= rate * err.sum() / np.sqrt(seen_b)
            m.linear[used] -= rate * gw / np.sqrt(seen_w[used])
            m.factors[used] -= rate * gv / np.sqrt(seen_v[used])
    return m


def _inputs(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None):
    chars = F.col(chars_col).cast("double") if chars_col and chars_col in docs.columns else F.lit(0.0)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(chars, F.lit(0.0)).alias("chars"))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, sample_rows: int = SAMPLE_ROWS,
          id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> Machine:
    """Fit on at most ``sample_rows`` labelled rows whose crc32(id) mod ``folds`` is not 0.

    Only the texts of the sampled ids are gathered; the sample's ids (its bound) are the small side of the join.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("id").agg(F.min("label").alias("label"))
             .filter(crc32_mod("id", folds) != 0))
    sample = hash_sample(known, sample_rows, F.col("id"), "id")
    texts = _inputs(docs, id_col, text_col, chars_col).join(F.broadcast(sample), "id").dropDuplicates(["id"])  # sample_rows ids at most

    def sparse(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            starts, index, value = features(part.column("text"), part.column("chars").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").cast(pa.string()), part.column("label"), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(index, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(value, pa.float32()))], ["id", "label", "index", "value"])
    rows = texts.mapInArrow(sparse, "id string, label double, index array<int>, value array<float>").toArrow().combine_chunks().sort_by("id")
    if rows.num_rows == 0:
        return fit(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    sizes = np.array([len(v) for v in rows["index"]])
    flat = lambda c: np.concatenate([v.values.to_numpy(zero_copy_only=False) for v in rows[c]])
    return fit(np.concatenate([[0], np.cumsum(sizes)]), flat("index").astype(np.int64), flat("value").astype(float), rows["label"].to_numpy())


def classify(docs: DataFrame, model: Machine, folds: int = 5, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
             chars_col: str | None = "n_chars") -> DataFrame:
    """id, ``held_out``, ``score`` and ``predicted`` of every whole text, one row per input row.

    Null and empty texts are scored by their (zero) statistics. Repeated rows and null ids are rows like any other
    (a null id hashes as empty text); other columns are ignored. Empty input gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for part in slices(batches, "text", BATCH_BYTES):
            p = model.probability(*features(part.column("text"), part.column("chars").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p, pa.float64())], ["id", "score"])
    scored = _inputs(docs, id_col, text_col, chars_col).mapInArrow(score, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), (crc32_mod("id", folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
