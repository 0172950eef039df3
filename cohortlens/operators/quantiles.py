"""Exact quantiles with linear interpolation (numpy's default) by bracketed selection: no sort, no copy of the values.

A whole column (``quantiles``):

1. A mergeable sketch (``percentile_approx``) brackets each wanted rank: its rank error is at most n / ``SKETCH``, so a few
   ten-thousandths of the rows lie in a bracket. Fewer rows than the sketch keeps: the bracket is everything.
2. While a bracket holds more than ``MOST`` rows, its rows are counted and sketched again (each round shrinks it by
   three orders of magnitude).
3. One scan counts what lies between the brackets and the distinct values inside them; that histogram (``MOST`` values
   a quantile at most, and a value that a third of the rows share is one of them) gives the exact ranks.

Per group (``grouped_quantiles``) the brackets are rows of a small table, one per group, column and quantile, that is joined to the
values; the last step ranks the distinct values of each bracket.

``accuracy=N`` switches to ``percentile_approx`` alone (one pass, bounded memory, rank error 1/N).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SKETCH = 10_000
MOST = 1 << 18
_MARGIN = 5 / SKETCH                 # sketch error on both sides, and the step from q * n to q * (n - 1)
_GRID = 200


def _lerp(lo: float, hi: float, t: float) -> float:
    """numpy's: a + (b - a) * t, or b - (b - a) * (1 - t) when t >= 0.5."""
    return hi - (hi - lo) * (1 - t) if t >= 0.5 else lo + (hi - lo) * t


def _inside(lo: float, hi: float) -> Column:
    x = F.col("_x")
    return (x >= F.lit(lo)) & (x <= F.lit(hi))


def _brackets(x: DataFrame, qs) -> tuple[int, list[tuple[float, float]]]:
    """(number of rows, an interval of values around the ranks of each quantile)."""
    ask = [min(1.0, max(0.0, q + side * _MARGIN)) for q in qs for side in (-1, 1)]
    n, found = x.agg(F.count("_x"), F.percentile_approx("_x", ask, SKETCH)).first()
    if n < SKETCH:
        return n, [(-math.inf, math.inf)] * len(qs)
    spans = [(-math.inf if a <= 0 else lo, math.inf if b >= 1 else hi) for (a, b), (lo, hi) in zip(zip(ask[::2], ask[1::2]), zip(found[::2], found[1::2]))]
    held = math.ceil(2 * (_MARGIN + 1 / SKETCH) * n)
    while held > MOST:               # count inside and below each bracket, then sketch inside it
        counts = x.agg(*[f for lo, hi in spans for f in (F.count_if(F.col("_x") < F.lit(lo)), F.count_if(_inside(lo, hi)))]).first()
        below, size = counts[::2], counts[1::2]
        if max(size) <= MOST:
            break
        rank = [((math.floor(q * (n - 1)) - b) / s, (math.ceil(q * (n - 1)) + 1 - b) / s) for q, b, s in zip(qs, below, size)]
        ask = [(max(0.0, a - _MARGIN), min(1.0, b + _MARGIN)) for a, b in rank]
        found = x.agg(*[F.percentile_approx(F.when(_inside(lo, hi), F.col("_x")), list(p), SKETCH) for (lo, hi), p in zip(spans, ask)]).first()
        narrow = [(lo if p[0] <= 0 else f[0], hi if p[1] >= 1 else f[1]) for (lo, hi), p, f in zip(spans, ask, found)]
        if narrow == spans:          # ties: few distinct values are left
            break
        spans = narrow
        held = math.ceil(2 * (_MARGIN + 1 / SKETCH) * max(size))
    return n, spans


def _select(x: DataFrame, qs) -> tuple[int, list[float | None]]:
    """(number of rows, exact quantiles) of ``_x`` (neither NULL nor NaN)."""
    n, spans = _brackets(x, qs)
    if n == 0:
        return 0, [None] * len(qs)
    joined: list[list[float]] = []
    for lo, hi in sorted(spans):
        if joined and lo <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    value, region = F.lit(None).cast("double"), F.lit(0)
    for lo, hi in joined:
        value = F.when(_inside(lo, hi), F.col("_x")).otherwise(value)
        region = region + F.when(F.col("_x") > F.lit(hi), 1).otherwise(0)
    rows = x.groupBy(region.alias("region"), value.alias("value")).agg(F.count(F.lit(1)).alias("c")).collect()
    rows.sort(key=lambda r: (r["region"], r["value"] is not None, r["value"] or 0.0))     # what lies before a bracket, then its values
    wanted = sorted({r for q in qs for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))})
    at, seen = {}, 0
    for row in rows:
        while wanted and wanted[0] < seen + row["c"]:
            at[wanted.pop(0)] = row["value"]
        seen += row["c"]
    out = []
    for q in qs:
        pos = q * (n - 1)
        lo, hi = at[math.floor(pos)], at[math.ceil(pos)]
        out.append(lo if lo == hi else _lerp(lo, hi, pos - math.floor(pos)))
    return n, out


def quantiles(df: DataFrame, col: str, qs, *, accuracy: int | None = None, prefix: str = "q", where=None) -> DataFrame:
    """One-row DataFrame with a DOUBLE column ``<prefix><i>`` per requested quantile and ``n``.

    NULL and NaN values are ignored; on empty input every quantile is NULL and n = 0.
    """
    qs = [float(q) for q in qs]
    x = (df if where is None else df.where(where)).select(F.col(col).cast("double").alias("_x"))
    x = x.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    names = [f"{prefix}{i}" for i in range(len(qs))]
    if accuracy is not None:
        arr = F.percentile_approx("_x", qs, accuracy)
        return x.agg(*[arr[i].alias(n) for i, n in enumerate(names)], F.count("_x").alias("n"))
    n, values = _select(x, qs)
    return df.sparkSession.createDataFrame([(*values, n)], ", ".join(f"`{c}` double" for c in names) + ", n long")


def _ranks(x: DataFrame, keys: list, qs) -> DataFrame:
    """keys, _q, _t, r0, r1 (ranks of the quantile), lo, hi, below, size: at first the bracket is everything."""
    ask = F.explode(F.array(*[F.struct(F.lit(i).alias("_q"), F.lit(q).alias("q")) for i, q in enumerate(qs)]))
    s = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).withColumn("a", ask)
    pos = F.col("a.q") * (F.col("size") - 1)
    return s.select(*keys, F.col("a._q").alias("_q"), (pos - F.floor(pos)).alias("_t"), F.floor(pos).alias("r0"), F.ceil(pos).alias("r1"),
                    F.lit(-math.inf).alias("lo"), F.lit(math.inf).alias("hi"), F.lit(0).cast("long").alias("below"), "size")


def _narrowed(x: DataFrame, s: DataFrame, keys: list) -> DataFrame:
    """The same table with brackets of about a hundredth of the rows, from a grid of sketched quantiles inside each."""
    inside = x.join(s, keys).where((F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi")))
    grid = inside.groupBy(*keys, "_q").agg(F.percentile_approx("_x", [i / _GRID for i in range(_GRID + 1)], SKETCH).alias("g"))
    a = F.floor((F.col("r0") - F.col("below")) / F.col("size") * _GRID).cast("int") - 1
    b = F.ceil((F.col("r1") + 1 - F.col("below")) / F.col("size") * _GRID).cast("int") + 1
    t = s.join(grid, [*keys, "_q"]).withColumns({"lo2": F.when(a < 1, F.col("lo")).otherwise(F.get("g", a)),
                                                 "hi2": F.when(b >= _GRID, F.col("hi")).otherwise(F.get("g", b))}).drop("g")
    t = cut_lineage(t, "brackets")
    now = x.join(t, keys).where((F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi"))).groupBy(*keys, "_q").agg(
        F.count_if(F.col("_x") < F.col("lo2")).alias("less"), F.count_if((F.col("_x") >= F.col("lo2")) & (F.col("_x") <= F.col("hi2"))).alias("held"))
    return t.join(now, [*keys, "_q"]).select(*keys, "_q", "_t", "r0", "r1", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"),
                                             (F.col("below") + F.col("less")).alias("below"), F.col("held").alias("size"))


def _grouped(x: DataFrame, keys: list, qs, names, most: int = MOST) -> DataFrame:
    """keys and one column per quantile: ``x`` has the keys (no NULLs) and the value ``_x`` (neither NULL nor NaN)."""
    s = cut_lineage(_ranks(x, keys, qs), "brackets")
    before = math.inf
    while (widest := s.agg(F.max("size")).first()[0] or 0) > most and widest < before:        # ties no longer shrink
        s, before = cut_lineage(_narrowed(x, s, keys), "brackets"), widest
    near = x.join(s, keys).where((F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi")))
    values = near.groupBy(*keys, "_q", "_x").agg(F.count(F.lit(1)).alias("_c"), F.first("below").alias("below"), F.first("r0").alias("r0"),
                                                 F.first("r1").alias("r1"), F.first("_t").alias("_t"))
    upto = Window.partitionBy(*keys, "_q").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("below") + F.coalesce(F.sum("_c").over(upto), F.lit(0))
    values = values.withColumn("_first", first)
    lo, hi = (F.max(F.when((F.col(r) >= F.col("_first")) & (F.col(r) < F.col("_first") + F.col("_c")), F.col("_x"))) for r in ("r0", "r1"))
    t = F.max("_t")
    exact = F.when(lo == hi, lo).when(t >= 0.5, hi - (hi - lo) * (1 - t)).otherwise(lo + (hi - lo) * t)
    each = values.groupBy(*keys, "_q").agg(exact.alias("_v"))
    return each.groupBy(*keys).agg(*[F.max(F.when(F.col("_q") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])


def grouped_quantiles(df: DataFrame, by: str, cols, qs, *, names=None) -> DataFrame:
    """Exact per-group quantiles of one or more columns, all columns in one pass.

    One row per group that has a value (NULL is a group like any other); for several columns the names are
    ``<column>`` with one quantile and ``<column>_<name>`` with more, for a single column ``names`` alone.
    """
    single = isinstance(cols, str)
    cols = [cols] if single else list(cols)
    qs = [float(q) for q in qs]
    names = names or [f"q{i}" for i in range(len(qs))]
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(cols)]))
    x = df.select(F.col(by).alias("_g"), rows.alias("_r")).select(F.struct("_g").alias("_g"), "_r._f", "_r._x")
    x = x.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    out = _grouped(x, ["_g", "_f"], qs, names)
    if single:
        return out.select(F.col("_g._g").alias(by), *names)
    labels = [c if len(names) == 1 else f"{c}_{n}" for c in cols for n in names]
    values = [F.max(F.when(F.col("_f") == i, F.col(n))) for i in range(len(cols)) for n in names]
    wide = [v.alias(label) for v, label in zip(values, labels)]
    return out.groupBy("_g").agg(*wide).select(F.col("_g._g").alias(by), *labels)


def quantile(df: DataFrame, col: str, q: float, *, accuracy: int | None = None, name: str = "value", where=None) -> DataFrame:
    """One-row DataFrame with the single quantile as ``name``."""
    return quantiles(df, col, [q], accuracy=accuracy, where=where).select(F.col("q0").alias(name))
