"""Explicit schemas (no inference: inference costs a pass over the file and
turns string keys such as ``001`` into numbers)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# ---- fixed values: type of each feature column (key, label, 79 features) ----
#  Integer-valued
# columns that are counts are bigint, codes are int, amounts are double.
_INT_COLS = {
    "uid_flag", "uid_grade", "uid_age", "uid_mobilevalid", "uid_addressvalid",
    "uid_isindentify", "uid_signmonths", "pro_phone_type", "pro_htl_star_prefer",
    "ord_success_flt_last_order_days", "ord_success_htl_last_order_days",
    "ord_success_trn_last_order_days",
}
_DOUBLE_COLS = {
    "pro_validpoints", "pro_advanced_date", "pro_platform_profits",
    "ord_success_max_order_amount", "ord_success_avg_leadtime",
    "ord_success_flt_max_order_amount", "ord_success_flt_avg_order_pricerate",
    "ord_success_htl_max_order_amount", "ord_success_htl_order_refund_ratio",
    "ord_success_order_amount", "ord_success_first_class_order_amount",
    "ord_success_aboard_order_amount", "ord_success_flt_first_class_order_amount",
    "ord_success_flt_aboard_order_amount", "ord_success_flt_order_amount",
    "ord_success_htl_first_class_order_amount", "ord_success_htl_aboard_order_amount",
    "ord_success_htl_order_amount", "ord_success_trn_order_amount",
    "ord_success_trn_max_order_amount", "ord_total_order_amount", "cap_tmoney_balance",
    "cap_wallet_balance",
}
# ------------------------------------------------------------------------------


def feature_schema() -> T.StructType:
    from ratecraft.plans.features import FEATURE_COLUMNS

    def typ(c):
        if c == "uid_uid":
            return _S
        if c in _INT_COLS:
            return _I
        if c in _DOUBLE_COLS:
            return _D
        return _L

    return T.StructType([T.StructField(c, typ(c), c != "uid_uid") for c in FEATURE_COLUMNS])


def score_schema(score_col: str) -> T.StructType:
    return T.StructType([T.StructField("uid_uid", _S, True), T.StructField(score_col, _D, True)])
