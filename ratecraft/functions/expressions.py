"""Scalar expressions of the scoring application.

All are native Catalyst expressions, so they stay inside whole-stage codegen
and do not block predicate pushdown.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the scoring rules being reproduced) ----------
# Age rule: ages outside [12, 65] are replaced by 34; 0 and -1 mean "not filled".
AGE_MIN = 12
AGE_MAX = 65
AGE_REPLACEMENT = 34
AGE_UNFILLED = (0, -1)
# Sentinel for "not filled in" in the other raw columns.
SENTINEL = -1
# Score scale: probability p in [0, 1] maps to p * 500 + 350, i.e. [350, 850].
SCORE_SCALE = 500.0
SCORE_OFFSET = 350.0
# Hash split: the first 8 hex digits of md5(key) as a number, modulo 10, below 7 -> train.
SPLIT_BUCKETS = 10
SPLIT_TRAIN_BUCKETS = 7
# ----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_guard(x, expr: Column) -> Column:
    """``expr`` where ``x`` is not null, else NULL (a UDF on a null input gives
    null; a bare ``when/otherwise`` would give the otherwise branch)."""
    return F.when(_c(x).isNotNull(), expr)


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when either side is NULL or den == 0.

    ``try_divide`` keeps ANSI mode on for everything else."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def age_rule(age="uid_age") -> Column:
    """outside [AGE_MIN, AGE_MAX] (strict) -> AGE_REPLACEMENT, else age; double."""
    a = _c(age)
    return null_guard(a, F.when((a > AGE_MAX) | (a < AGE_MIN), F.lit(float(AGE_REPLACEMENT)))
                      .otherwise(a.cast("double")))


def age_fill_flag(age="uid_age") -> Column:
    """F16: 0 when age is an unfilled sentinel (0 or -1), else 1; NULL stays NULL."""
    a = _c(age)
    return null_guard(a, F.when(a.isin(*AGE_UNFILLED), F.lit(0)).otherwise(F.lit(1)))


def fill_flag(x) -> Column:
    """0 when the value is the sentinel -1, else 1; NULL stays NULL."""
    v = _c(x)
    return null_guard(v, F.when(v == SENTINEL, F.lit(0)).otherwise(F.lit(1)))


def vector_element(vec, i: int) -> Column:
    """Element ``i`` of an ML vector column, as double."""
    return vector_to_array(_c(vec))[i]


def score_from_probability(p) -> Column:
    """P * 500 + 350."""
    return _c(p).cast("double") * F.lit(SCORE_SCALE) + F.lit(SCORE_OFFSET)


def label_to_double(x) -> Column:
    """Numeric label or label text as double (explicit cast: the
    implicit string * number form casts to bigint under ANSI and throws)."""
    return _c(x).cast("double")


def hash_split_bucket(key="uid_uid") -> Column:
    """Stable bucket 0..9 from md5 of the key; independent of partitioning."""
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % F.lit(SPLIT_BUCKETS)


def is_train_row(key="uid_uid") -> Column:
    return hash_split_bucket(key) < F.lit(SPLIT_TRAIN_BUCKETS)
