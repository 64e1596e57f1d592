"""Outlier bounds: fit once (one job for all columns), apply as literals.

Methods
-------
``iqr``      O1: q1, median, q3; values strictly outside
             [q1 - 1.5 IQR, q3 + 1.5 IQR] -> floor(median); adds a fill flag.
``sigma``    O2: mean and sample stddev; strictly outside mean +- 3 sd -> floor(mean).
``clamp95``  O3: v > q95 -> floor(q95); v = -1 -> median; else v.
``clamp5``   O4: v > q95 -> floor(median); v = -1 -> median; else v.

Fitted bounds are a small table (one row per column).  They are persisted
with the model (fit on training rows, applied at prediction without reading
the prediction batch) and applied as literals inside a single projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.functions.expressions import SENTINEL, fill_flag
from ratecraft.operators.quantiles import quantiles

# ---- fixed values ----------------------------------------------------------
IQR_FENCE = 1.5
SIGMA_FENCE = 3.0
CLAMP_UPPER_P = 0.95
DEFAULT_REL_ERROR = 0.1      # relative error of the approximate quantiles
# ----------------------------------------------------------------------------

METHODS = ("iqr", "sigma", "clamp95", "clamp5")

BOUNDS_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("method", T.StringType(), False),
    T.StructField("center", T.DoubleType(), True),     # median (iqr, clamp) or mean (sigma)
    T.StructField("lower", T.DoubleType(), True),
    T.StructField("upper", T.DoubleType(), True),
])


@dataclass(frozen=True)
class Bounds:
    method: str
    center: dict = field(default_factory=dict)
    lower: dict = field(default_factory=dict)
    upper: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(self.center)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.method, self.center[c], self.lower.get(c), self.upper.get(c))
                for c in self.columns]
        return spark.createDataFrame(rows, BOUNDS_SCHEMA)

    @staticmethod
    def from_df(df: DataFrame) -> "Bounds":
        rows = df.collect()  # one row per column
        if not rows:
            raise ValueError("empty bounds table")
        method = rows[0]["method"]
        return Bounds(method, {r["column"]: r["center"] for r in rows},
                      {r["column"]: r["lower"] for r in rows},
                      {r["column"]: r["upper"] for r in rows})


def fit_bounds(df: DataFrame, cols: Sequence[str], method: str = "iqr",
               rel_error: float = DEFAULT_REL_ERROR) -> Bounds:
    """One job for all ``cols`` (quantile sketch or mean/stddev aggregate)."""
    cols = list(cols)
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; expected one of {METHODS}")
    if method == "sigma":
        value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols}     # NaN does not count
        row = df.agg(*[F.avg(value[c]).alias(f"m_{c}") for c in cols],
                     *[F.stddev_samp(value[c]).alias(f"s_{c}") for c in cols]).first()
        center, lower, upper = {}, {}, {}
        for c in cols:
            m, s = row[f"m_{c}"], row[f"s_{c}"]
            center[c] = m
            lower[c] = None if m is None or s is None else m - SIGMA_FENCE * s
            upper[c] = None if m is None or s is None else m + SIGMA_FENCE * s
        return Bounds(method, center, lower, upper)
    return bounds_from_quantiles(quantiles(df, cols, quantile_probs(method), rel_error), method)


def quantile_probs(method: str) -> list[float]:
    """The quantiles that a method's bounds are made of."""
    if method not in METHODS or method == "sigma":
        raise ValueError(f"{method!r} has no quantiles; expected one of {[m for m in METHODS if m != 'sigma']}")
    return [0.25, 0.5, 0.75] if method == "iqr" else [0.5, CLAMP_UPPER_P]


def bounds_from_quantiles(q: dict[str, list[float | None]], method: str) -> Bounds:
    """Bounds from column -> the quantiles of :func:`quantile_probs`."""
    if method != "iqr":
        return Bounds(method, {c: v[0] for c, v in q.items()}, {c: None for c in q}, {c: v[1] for c, v in q.items()})
    center, lower, upper = {}, {}, {}
    for c, (q1, med, q3) in q.items():
        center[c] = med
        if q1 is None or q3 is None:
            lower[c] = upper[c] = None
        else:
            iqr = q3 - q1
            lower[c], upper[c] = q1 - IQR_FENCE * iqr, q3 + IQR_FENCE * iqr
    return Bounds(method, center, lower, upper)


def _lit(x) -> Column:
    return F.lit(None).cast("double") if x is None else F.lit(float(x))


def _floor(x):
    return None if x is None else float(math.floor(x))


def bounded_column(c: str, b: Bounds) -> Column:
    """The replacement expression ``<c>_new`` for one column (double)."""
    v = F.col(c)
    vd = v.cast("double")
    lo, hi, mid = b.lower.get(c), b.upper.get(c), b.center.get(c)
    if b.method in ("iqr", "sigma"):
        if lo is None or hi is None:
            return vd
        return F.when((v > _lit(hi)) | (v < _lit(lo)), _lit(_floor(mid))).otherwise(vd)
    top = _floor(hi) if b.method == "clamp95" else _floor(mid)
    if hi is None:
        return F.when(v == SENTINEL, _lit(mid)).otherwise(vd)
    return (F.when(v > _lit(hi), _lit(top))
            .when(v == SENTINEL, _lit(mid))
            .otherwise(vd))


def apply_bounds(df: DataFrame, b: Bounds, keep_source: bool = False,
                 suffix: str = "_new") -> DataFrame:
    """Add ``<c>_new`` for every bounded column (and ``<c>TF`` for ``iqr``),
    dropping the source column unless ``keep_source``.  One projection."""
    out = []
    for name in df.columns:
        if name in b.center:
            if keep_source:
                out.append(F.col(name))
            out.append(bounded_column(name, b).alias(f"{name}{suffix}"))
            if b.method == "iqr":
                out.append(fill_flag(name).alias(f"{name}TF"))
        else:
            out.append(F.col(name))
    return df.select(*out)


def outlier_rows(df: DataFrame, b: Bounds, id_cols: Sequence[str] = ("uid_uid",)) -> DataFrame:
    """Every (id, column, value) strictly outside its fences.

    Unpivot to long form and compare against the bounds, inlined as a
    per-column CASE (one row per column; no join)."""
    cols = [c for c in b.columns if b.lower.get(c) is not None and b.upper.get(c) is not None]
    long = df.select(*id_cols, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in cols])))
    col = F.col("column")
    lo_expr, hi_expr = None, None
    for c in cols:
        lo_expr = (F.when(col == c, _lit(b.lower[c])) if lo_expr is None
                   else lo_expr.when(col == c, _lit(b.lower[c])))
        hi_expr = (F.when(col == c, _lit(b.upper[c])) if hi_expr is None
                   else hi_expr.when(col == c, _lit(b.upper[c])))
    v = F.col("value")
    return long.where((v < lo_expr) | (v > hi_expr))
