"""Skew-aware log1p + z-score standardisation (z01-z08, s12, f09).

Fitting runs exactly two aggregate jobs over the whole table (one for skew, one for
variance/mean/std) — each a single-row, map-side combined aggregate over all columns at
once — and collects one number per feature and statistic. Scoring is a lazy projection.

Decisions (see survey S12/S13): skew is the bias-corrected G1 (pandas), the scale is the
population std (sklearn's StandardScaler; 1 when the std is 0), the constant filter uses the
sample variance <= 1e-12, and columns fitted with log1p are log1p'ed again when scoring.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_feature_columns(df: DataFrame, *, id_col: str = "fk_contact") -> list:
    """f09: numeric columns except the id and names ending in _dt / _date."""
    out = []
    for f in df.schema.fields:
        if f.name == id_col or f.name.endswith("_dt") or f.name.endswith("_date"):
            continue
        if isinstance(f.dataType, NUMERIC):
            out.append(f.name)
    return out


def g1_skew(c: str) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``); NULL when fewer than 3 values."""
    n = F.count(c)
    g1 = F.skewness(c)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def skew_stats(df: DataFrame, cols) -> DataFrame:
    """z01 statistics, long form: (feature, n_positive, skew). One aggregate for all columns."""
    xs = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])   # one projection
    aggs = []
    for i, _ in enumerate(cols):
        x = F.col(f"x{i}")
        aggs += [F.sum(F.when(x > 0, 1).otherwise(0)).alias(f"p{i}"), g1_skew(x).alias(f"s{i}")]
    wide = xs.agg(*aggs)
    rows = ", ".join(f"'{c}', p{i}, s{i}" for i, c in enumerate(cols))
    return wide.select(F.expr(f"stack({len(cols)}, {rows}) AS (feature, n_positive, skew)"))


def log1p_clip(c) -> Column:
    """z02: log1p(max(x, 0)), NULL stays NULL."""
    x = F.col(c).cast("double") if isinstance(c, str) else c
    return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0))))


def sanitize(x: Column, fill: float = config.DEFAULT_FILL) -> Column:
    """z03: NULL -> fill; NaN and +/-inf -> 0."""
    v = F.coalesce(x, F.lit(float(fill)))
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v)


@dataclass
class Scaler:
    """Fitted standardisation parameters (one row per used feature)."""

    used_cols: list
    means: dict
    scales: dict
    log1p_cols: list = field(default_factory=list)
    removed_constant_cols: list = field(default_factory=list)
    missing_in_input: list = field(default_factory=list)
    fill: float = config.DEFAULT_FILL
    suffix: str = config.Z_SUFFIX
    skew_threshold: float = config.DEFAULT_SKEW_THRESHOLD

    def prepared(self, c: str) -> Column:
        x = log1p_clip(c) if c in self.log1p_cols else F.col(c).cast("double")
        return sanitize(x, self.fill)

    def transform(self, df: DataFrame, *, keep: bool = True) -> DataFrame:
        """z06: add ``<feature><suffix>`` columns; column set and order come from the fit."""
        missing = [c for c in self.used_cols if c not in df.columns]
        if missing:
            raise ValueError(f"columns expected by the scaler are missing: {missing}")
        zs = {f"{c}{self.suffix}": ((self.prepared(c) - F.lit(self.means[c])) / F.lit(self.scales[c])).cast("double")
              for c in self.used_cols}
        return df.withColumns(zs) if keep else df.select(*[v.alias(k) for k, v in zs.items()])

    def inverse(self, df: DataFrame, *, expm1: bool = False, suffix_out: str = "") -> DataFrame:
        """z07: x = z * scale + mean (optionally expm1 for log1p features)."""
        cols = {}
        for c in self.used_cols:
            x = F.col(f"{c}{self.suffix}") * F.lit(self.scales[c]) + F.lit(self.means[c])
            if expm1 and c in self.log1p_cols:
                x = F.expm1(x)
            cols[f"{c}{suffix_out}"] = x
        return df.withColumns(cols)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """s12: the parameters as a table (feature, position, mean, scale, log1p, fill, suffix)."""
        rows = [(c, i, float(self.means[c]), float(self.scales[c]), c in self.log1p_cols, float(self.fill), self.suffix)
                for i, c in enumerate(self.used_cols)]
        return spark.createDataFrame(rows, "feature string, position int, mean double, scale double, log1p boolean, "
                                           "fill double, suffix string")

    @classmethod
    def from_df(cls, params: DataFrame, **kw) -> "Scaler":
        rows = sorted(params.collect(), key=lambda r: r["position"])   # one row per feature
        kw = {n: rows[0][n] for n in ("fill", "suffix") if rows and n in params.columns} | kw
        return cls(used_cols=[r["feature"] for r in rows], means={r["feature"]: r["mean"] for r in rows},
                   scales={r["feature"]: r["scale"] for r in rows},
                   log1p_cols=[r["feature"] for r in rows if r["log1p"]], **kw)

    def report(self) -> "FitReport":
        return FitReport(tuple(self.used_cols), tuple(self.log1p_cols), tuple(self.removed_constant_cols),
                         tuple(self.missing_in_input), self.skew_threshold)


class FitReport(NamedTuple):
    """What the fit decided about the columns it was given."""

    used: tuple
    logged: tuple
    constant: tuple
    absent: tuple
    skew_limit: float


def select_log1p(stats_rows, threshold: float) -> list:
    return [r["feature"] for r in stats_rows
            if r["n_positive"] and r["n_positive"] > 0 and r["skew"] is not None and r["skew"] == r["skew"]
            and r["skew"] >= threshold]


def fit_scaler(df: DataFrame, *, cols, log1p_auto: bool = True, log1p_cols=None, skew_threshold: float = config.DEFAULT_SKEW_THRESHOLD,
               fill: float = config.DEFAULT_FILL, drop_constant: bool = True, eps: float = config.CONSTANT_EPS,
               suffix: str = config.Z_SUFFIX) -> Scaler:
    """z08: select -> log1p (of ``log1p_cols``, or of the skewed columns) -> fill/sanitise -> drop constant ->
    mean / population std."""
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    if not present:
        raise ValueError(f"none of the columns is present: {cols}")
    if log1p_cols is not None:
        log1p_cols = [c for c in present if c in set(log1p_cols)]
    elif not log1p_auto:
        log1p_cols = []
    else:
        log1p_cols = select_log1p(skew_stats(df, present).collect(), skew_threshold)
    prep = {c: (sanitize(log1p_clip(c), fill) if c in log1p_cols else sanitize(F.col(c).cast("double"), fill))
            for c in present}
    prepared = df.select(*[prep[c].alias(f"x{i}") for i, c in enumerate(present)])   # one projection
    aggs = []
    for i, _ in enumerate(present):
        aggs += [F.var_samp(f"x{i}").alias(f"v{i}"), F.avg(f"x{i}").alias(f"m{i}"),
                 F.stddev_pop(f"x{i}").alias(f"s{i}")]
    row = prepared.agg(*aggs).collect()[0]
    removed = []
    used = []
    for i, c in enumerate(present):
        var = row[f"v{i}"]
        if drop_constant and (var is None or var != var or var <= eps):
            removed.append(c)
        else:
            used.append(c)
    if not used:
        raise ValueError("every column was removed as constant")
    means = {c: float(row[f"m{present.index(c)}"]) for c in used}
    scales = {}
    for c in used:
        s = row[f"s{present.index(c)}"]
        scales[c] = 1.0 if s is None or s == 0 or s != s else float(s)
    return Scaler(used_cols=used, means=means, scales=scales, log1p_cols=[c for c in log1p_cols if c in used],
                  removed_constant_cols=removed, missing_in_input=missing, fill=fill, suffix=suffix,
                  skew_threshold=skew_threshold)


def z_long(df: DataFrame, scaler: Scaler, *, id_col: str = "fk_contact") -> DataFrame:
    """Long form (id, feature, z) of the scored table."""
    z = scaler.transform(df.select(id_col, *scaler.used_cols), keep=True)
    rows = ", ".join(f"'{c}', `{c}{scaler.suffix}`" for c in scaler.used_cols)
    return z.select(id_col, F.expr(f"stack({len(scaler.used_cols)}, {rows}) AS (feature, z)"))


def read_standardized(spark: SparkSession, path: str, *, id_col: str = "fk_contact", suffix: str = config.Z_SUFFIX) -> tuple[DataFrame, list]:
    """s03: a stored standardised table, as long rows (id, feature, z) of its ``<feature><suffix>`` columns, and those features' names.

    Only the id and the z columns are read. A table without z columns is an error; without ``id_col`` the rows have no id.
    """
    stored = spark.read.parquet(path)
    features = z_columns_from_schema(stored, suffix=suffix)
    if not features:
        raise ValueError(f"no column ends in {suffix}: {path}")
    rows = ", ".join(f"'{c}', CAST(`{c}{suffix}` AS DOUBLE)" for c in features)
    ids = [id_col] if id_col in stored.columns else []
    return stored.select(*ids, F.expr(f"stack({len(features)}, {rows}) AS (feature, z)")), features


def z_columns_from_schema(df: DataFrame, *, suffix: str = config.Z_SUFFIX) -> list:
    """Feature names recovered from ``<feature><suffix>`` columns."""
    return [c[: -len(suffix)] for c in df.columns if c.endswith(suffix)]
