"""Model-free, deterministic scores derived from the feature table.

They stand in for model output where an operator's *relational* behaviour is
under test (combining, describing, evaluating, score mapping), so the result
can be compared value-for-value with SQL.  Each is a share in [0, 1] taken
from one view's own columns, rounded to 4 places; NULL where the share is
undefined (0/0).  The interaction table only covers customers with events,
so the combination also exercises missing keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.functions.expressions import age_rule, safe_ratio, score_from_probability


def share(num: str, *den_terms: str) -> Column:
    den = F.col(den_terms[0])
    for t in den_terms[1:]:
        den = den + F.col(t)
    return F.round(safe_ratio(num, den), 4)


def eval_frame(features: DataFrame) -> DataFrame:
    """(uid_uid, label, score, prediction) of every customer: label = uid_flag as
    double, score = success share among successful and returned lines, prediction
    = score >= 0.5; NULL where they are not defined."""
    s = F.round(safe_ratio("ord_success_order_count",
                           F.col("ord_success_order_count") + F.col("voi_complrefund_count")), 3)
    return (features.select("uid_uid", F.col("uid_flag").cast("double").alias("label"), s.alias("score"))
            .select("*", (F.col("score") >= 0.5).cast("double").alias("prediction")))


def rule_probabilities(features: DataFrame) -> dict[str, DataFrame]:
    """Score column -> (uid_uid, p)."""
    f = features
    return {
        "ScoreConsume": f.select("uid_uid", share("ord_success_order_count", "ord_success_order_count",
                                                  "voi_complrefund_count").alias("p")),
        "ScoreFinance": f.select("uid_uid", share("ord_success_order_count", "ord_success_order_count",
                                                  "ord_cancel_order_count").alias("p")),
        "ScoreInteraction": f.where(F.col("pro_base_active") > 0).select(
            "uid_uid", share("voi_comment_count", "pro_base_active").alias("p")),
        "ScorePeople": f.select("uid_uid", F.round(age_rule("uid_age") / 100.0, 4).alias("p")),
        "ScoreRelation": f.select("uid_uid", share("ord_success_order_cmobile_count",
                                                   "com_mobile_count").alias("p")),
    }


def rule_scores(features: DataFrame) -> dict[str, DataFrame]:
    """Score column -> (uid_uid, score) with score = p * 500 + 350."""
    return {c: df.select("uid_uid", score_from_probability("p").alias(c))
            for c, df in rule_probabilities(features).items()}
