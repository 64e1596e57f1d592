"""Evaluation operators (E1-E11) over a (score, label) frame.

Curves are built from one row per distinct score (a map-side combined
group-by), written once: totals, slice bounds and running counts are all read
from that table, so the input is evaluated a single time.  Running counts come
from :func:`cumulative_sums` (no single-task window), and the areas are sums of
per-threshold trapezoids whose left edge is recovered from the row's own
counts -- so no ``lag`` over a global order.

One rule for missing values: a row counts where both of what is compared are
there (prediction and label, or score and label); others are left out and
reported as ``n_excluded``.  Nothing is rounded.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.cumulative import cumulative_sums
from ratecraft.sources.writers import stage


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """sqrt(mean((prediction - label)^2)), one row."""
    d = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy and test error (1 - accuracy) over the rows that have both, one row."""
    hit = F.avg((F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double"))
    return df.agg(hit.alias("accuracy"), (1 - hit).alias("test_error"))


def _positive(label: str) -> Column:
    return F.col(label).cast("double") == 1.0


def score_counts(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, tp, fp) per distinct score: positives / negatives at that score."""
    pos = _positive(label)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(score).cast("double").alias("threshold"))
            .agg(F.count(F.when(pos, 1)).alias("tp"), F.count(F.when(~pos, 1)).alias("fp")))


class Counts(NamedTuple):
    """The written per-score counts and their totals."""

    table: DataFrame
    positives: int
    negatives: int


def written_counts(df: DataFrame, score: str = "score", label: str = "label") -> Counts:
    table = stage(score_counts(df, score, label), "score-counts")
    tot = table.agg(F.sum("tp").alias("p"), F.sum("fp").alias("n")).first()
    return Counts(table, int(tot["p"] or 0), int(tot["n"] or 0))


def _cumulative(counts: Counts) -> DataFrame:
    return cumulative_sums(counts.table, [], "threshold", ["tp", "fp"], descending=True)


def _f_beta(prec: Column, rec: Column, beta: float) -> Column:
    b2 = beta * beta
    den = F.lit(b2) * prec + rec
    return F.when(den == 0, F.lit(0.0)).otherwise(F.lit(1 + b2) * prec * rec / den)


def threshold_curve(df: DataFrame, score: str = "score", label: str = "label",
                    beta: float = 0.5, counts: Counts | None = None) -> DataFrame:
    """Per distinct threshold t (predict positive when score >= t):
    cumulative tp/fp, precision, recall, F1 and F-beta."""
    counts = counts or written_counts(df, score, label)
    tp, fp = F.col("cum_tp"), F.col("cum_fp")
    prec = tp / (tp + fp)
    rec = tp / F.lit(counts.positives) if counts.positives else F.lit(0.0)
    return _cumulative(counts).select(
        "threshold", tp.alias("tp"), fp.alias("fp"), prec.alias("precision"), rec.alias("recall"),
        _f_beta(prec, rec, 1.0).alias("f1"), _f_beta(prec, rec, beta).alias("f_beta"))


def curve_points(df: DataFrame, score: str = "score", label: str = "label",
                 counts: Counts | None = None) -> DataFrame:
    """ROC (fpr, tpr) and PR (recall, precision) point per threshold,
    plus each point's trapezoid under both curves."""
    counts = counts or written_counts(df, score, label)
    tp, fp, ctp, cfp = F.col("tp"), F.col("fp"), F.col("cum_tp"), F.col("cum_fp")
    Pl, Nl = F.lit(float(max(counts.positives, 1))), F.lit(float(max(counts.negatives, 1)))
    prec = ctp / (ctp + cfp)
    prev_tp, prev_all = ctp - tp, ctp + cfp - tp - fp
    prev_prec = F.when(prev_all == 0, prec).otherwise(prev_tp / prev_all)
    return _cumulative(counts).select(
        "threshold",
        (cfp / Nl).alias("fpr"), (ctp / Pl).alias("tpr"),
        (ctp / Pl).alias("recall"), prec.alias("precision"),
        ((fp / Nl) * (ctp + prev_tp) / (2 * Pl)).alias("roc_area"),
        ((tp / Pl) * (prec + prev_prec) / 2).alias("pr_area"))


def pr_roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return curve_points(df, score, label).select("threshold", "fpr", "tpr", "recall", "precision")


def auc(df: DataFrame, score: str = "score", label: str = "label", counts: Counts | None = None) -> DataFrame:
    """One row (auc_roc, auc_pr); trapezoids from (0,0) for ROC and
    from (0, precision at the top threshold) for PR."""
    return curve_points(df, score, label, counts).agg(F.sum("roc_area").alias("auc_roc"), F.sum("pr_area").alias("auc_pr"))


METRICS = ("accuracy", "test_error", "auc_roc", "auc_pr", "n", "n_excluded")


def classification_report(df: DataFrame, prediction: str = "prediction", score: str = "score",
                          label: str = "label", beta: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(metrics in long format (metric, value); the threshold curve).

    ``n`` counts the rows that have prediction and label, ``n_excluded`` the
    others.  The areas and the curve share one table of counts per score."""
    counts = written_counts(df, score, label)
    both = F.col(prediction).isNotNull() & F.col(label).isNotNull()
    sizes = df.agg(F.count(F.when(both, 1)).cast("double").alias("n"), F.count(F.when(~both, 1)).cast("double").alias("n_excluded"))
    # three one-row frames, stacked
    rows = accuracy(df, prediction, label).unionByName(auc(df, score, label, counts), True).unionByName(sizes, True)
    metrics = rows.select(F.inline(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]))).where(F.col("value").isNotNull())
    return metrics, threshold_curve(df, score, label, beta, counts)


def report_metrics(metrics: DataFrame) -> dict[str, float | None]:
    """The metrics of a report as a dict (a handful of rows)."""
    found = {r["metric"]: r["value"] for r in metrics.collect()}
    return {m: found.get(m) for m in METRICS}
