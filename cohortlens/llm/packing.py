"""Optimal length buckets and token-budget batches.

1. A global histogram of token counts (one partial aggregate). Bins are exact up to ``FINE`` tokens and
   ``1/FINE`` of the length wide beyond, so their number grows with the logarithm of the longest text
   only; each bin keeps count, sum and largest length, so padding is computed exactly.
2. Dynamic programming over the bins chooses at most ``n_buckets`` upper bounds with the least padding.
3. Inside a bucket, rows are dealt by hash into blocks of about ``BLOCK_ROWS`` rows (a hot bucket thus
   spreads over many tasks); within a block, consecutive rows fill batches of at most ``token_budget``
   padded tokens. Only the last batch of a block can be part-full.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WORD

FINE = 256
BLOCK_ROWS = 50_000


def token_count(text: Column) -> Column:
    """Words plus one end token (a null text: 1)."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1).cast("long")


def length_bin(n: Column) -> Column:
    """Bin number: the length itself below ``FINE``, then ``FINE`` bins for each doubling."""
    power = F.floor(F.log2(n.cast("double"))) - int(math.log2(FINE))
    step = F.pow(F.lit(2.0), power)
    return F.when(n < FINE, n).otherwise((power + 1) * FINE + F.floor(n / step) - FINE).cast("long")


def optimal_bounds(counts, sums, longest, n_buckets: int) -> list[int]:
    """Upper bounds of the buckets with the least total padding, from bins in order of length.

    best[k][j]: least padding of the first j bins in k buckets; a bucket of bins i..j-1 pads each row to
    the longest row of bin j-1. Ties take the fewer buckets and the earlier cut. No bins: no bounds.
    """
    n = len(counts)
    if n == 0:
        return []
    c = np.concatenate([[0.0], np.cumsum(np.asarray(counts, float))])
    s = np.concatenate([[0.0], np.cumsum(np.asarray(sums, float))])
    top = np.asarray(longest, float)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts, totals = [], []
    for _ in range(min(n_buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, int)
        new[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + top[j - 1] * (c[j] - c[:j]) - (s[j] - s[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        cuts.append(cut)
        totals.append(new[n])
        best = new
    k, j, bounds = int(np.argmin(totals)), n, []
    while j > 0:
        bounds.append(int(top[j - 1]))
        j = int(cuts[k][j])
        k -= 1
    return bounds[::-1]


def pack(docs: DataFrame, n_buckets: int = 16, token_budget: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``bucket``, ``bucket_len``, ``block``, ``batch``, ``slot``, ``pad_tokens``.

    (``bucket``, ``block``, ``batch``) names a batch, ``slot`` the place in it; rows of a batch times
    ``bucket_len`` never exceed ``token_budget``, except that a text longer than the budget has a batch
    of its own. Null and empty texts have one token (the end). Repeated rows and null ids are rows like any other. Other
    columns are ignored. Empty input gives an empty result.
    """
    lens = cut_lineage(docs.select(F.col(id_col).alias("id"), token_count(F.col(text_col)).alias("n_tokens")), "lengths")
    hist = sorted(lens.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
                  .agg(F.count("*"), F.sum("n_tokens"), F.max("n_tokens")).collect())  # at most FINE bins per doubling
    bounds = optimal_bounds([h[1] for h in hist], [h[2] for h in hist], [h[3] for h in hist], n_buckets)
    blocks = max(1, math.ceil(sum(h[1] for h in hist) / BLOCK_ROWS))
    bucket, length = F.lit(len(bounds) - 1), F.lit(bounds[-1] if bounds else 0)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[i], i).otherwise(bucket)
        length = F.when(F.col("n_tokens") <= bounds[i], bounds[i]).otherwise(length)
    rows = lens.select("id", "n_tokens", bucket.cast("int").alias("bucket"), length.cast("long").alias("bucket_len"),
                       F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"))
    holds = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_len")))
    at = F.row_number().over(Window.partitionBy("bucket", "block").orderBy(F.col("id").asc_nulls_first())) - 1
    return rows.withColumn("at", at).select(
        F.col("id").alias(id_col), "n_tokens", "bucket", "bucket_len", "block",
        F.floor(F.col("at") / holds).cast("long").alias("batch"), (F.col("at") % holds).cast("long").alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("pad_tokens"))
