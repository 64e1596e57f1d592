"""The five scoring views (P1-P9, F1-F19) as declarative specs + one builder.

A view is one projection over the feature table: derived ratios and sums,
the age rule, fitted clamps (people), null fill, then the column list.
Catalyst collapses it into a single Project inside the scan's codegen stage.

Phases: ``train`` keeps ``uid_uid`` + label ``uid_flag`` + features and drops
rows whose label is NULL (instead of filling the label); ``predict`` keeps
``uid_uid`` + features.  (The key is kept in the train view too: the split and
the reproducible training layout are keyed on it; it is not a feature.)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.functions.expressions import age_fill_flag, age_rule, is_train_row, safe_ratio
from ratecraft.operators.outliers import Bounds, bounded_column, fit_bounds
from ratecraft.operators.sketches import bounds_from_sketches, read_parts, write_part

KEY = "uid_uid"
LABEL = "uid_flag"

# ---- fixed values: the column lists of the five views ----------------------
CONSUME_FEATURES = (
    "pro_advanced_date", "pro_htl_star_prefer", "pro_platform_profits",
    "ord_success_max_order_amount", "ord_success_avg_leadtime", "ord_cancel_order_count",
    "ord_success_order_type_count", "ord_success_order_acity_count",
    "ord_success_flt_last_order_days", "ord_success_flt_max_order_amount",
    "ord_success_flt_avg_order_pricerate", "ord_success_flt_order_acity_count",
    "ord_success_htl_last_order_days", "ord_success_htl_max_order_amount",
    "ord_success_htl_order_refund_ratio", "ord_success_htl_guarantee_order_count",
    "ord_success_htl_noshow_order_count", "ord_cancel_htl_order_count",
    "ord_success_trn_last_order_days", "ord_success_order_price",
    "ord_success_first_class_order_price", "ord_success_aboard_order_price",
    "ord_success_flt_first_class_order_price", "ord_success_flt_aboard_order_price",
    "ord_success_flt_order_price", "ord_success_htl_first_class_order_price",
    "ord_success_htl_aboard_order_price", "ord_success_htl_order_price",
    "ord_success_trn_order_price",
)
CONSUME_PRICE_PREFIXES = (
    "ord_success_order", "ord_success_first_class_order", "ord_success_aboard_order",
    "ord_success_flt_first_class_order", "ord_success_flt_aboard_order", "ord_success_flt_order",
    "ord_success_htl_first_class_order", "ord_success_htl_aboard_order", "ord_success_htl_order",
    "ord_success_trn_order",
)
FINANCE_FEATURES = (
    "voi_complrefund_count", "fai_lackbalance", "bil_refundord_count", "bil_ordertype_count",
    "bil_platform_count", "pro_htl_star_prefer", "pro_htl_consuming_capacity", "pro_phone_type",
    "ord_success_max_order_amount", "ord_total_order_amount",
    "ord_success_flt_first_class_order_count", "ord_success_trn_max_order_amount",
    "ord_success_htl_first_class_order_count", "ord_success_htl_max_order_amount",
    "ord_success_aboard_order_count", "cap_balance", "ord_success_htl_aboard_order_price",
    "ord_success_first_class_order_price", "bil_pays_debit_ratio", "bil_pays_credit_ratio",
    "bil_pays_ratio",
)
FINANCE_RATIOS = (
    ("bil_pays_ratio", "bil_paysord_count", "bil_payord_count"),
    ("bil_pays_credit_ratio", "bil_paysord_credit_count", "bil_payord_credit_count"),
    ("bil_pays_debit_ratio", "bil_paysord_debit_count", "bil_payord_debit_count"),
    ("ord_success_first_class_order_price", "ord_success_first_class_order_amount",
     "ord_success_first_class_order_count"),
    ("ord_success_htl_aboard_order_price", "ord_success_htl_aboard_order_amount",
     "ord_success_htl_aboard_order_count"),
)
# cap_balance = tmoney + wallet + wallet (the wallet term appears twice, as specified)
FINANCE_SUMS = (("cap_balance", ("cap_tmoney_balance", "cap_wallet_balance", "cap_wallet_balance")),)
INTERACTION_FEATURES = (
    "voi_complaint_count", "voi_complrefund_count", "voi_comment_count", "acc_loginday_count",
    "pro_validpoints", "pro_base_active", "pro_platform_profits", "pro_customervalue",
)
RELATION_FEATURES = (
    "com_passenger_count", "com_idno_count", "com_mobile_count", "ord_success_order_cmobile_count",
)
PEOPLE_FEATURES = (
    "uid_grade", "uid_dealorders_new", "uid_emailvalid", "uid_age_new", "is_age_fill",
    "uid_mobilevalid", "uid_addressvalid", "uid_isindentify", "uid_authenticated_days_new",
    "uid_signupdays_new", "uid_signmonths_new", "uid_lastlogindays_new", "uid_samemobile",
    "ord_success_order_cmobile_count_new", "com_mobile_count_new", "pro_generous_stingy_tag",
    "pro_base_active", "pro_customervalue", "pro_phone_type", "pro_validpoints",
    "pro_htl_consuming_capacity",
)
PEOPLE_CLAMP = (
    "uid_dealorders", "uid_authenticated_days", "uid_signupdays", "uid_signmonths",
    "uid_lastlogindays", "ord_success_order_cmobile_count", "com_mobile_count",
)
# The eighteen raw people columns the original outlier step was given.
OUTLIER_COLUMNS = (
    "uid_dealorders", "uid_emailvalid", "uid_mobilevalid", "uid_addressvalid", "uid_isindentify",
    "uid_authenticated_days", "uid_signupdays", "uid_signmonths", "uid_lastlogindays",
    "uid_samemobile", "ord_success_order_cmobile_count", "com_mobile_count",
    "pro_generous_stingy_tag", "pro_base_active", "pro_customervalue", "pro_phone_type",
    "pro_validpoints", "pro_htl_consuming_capacity",
)
CONSUME_TRAIN_FILL = -1.0
FINANCE_FILL = 0
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class ViewSpec:
    module: str
    features: tuple[str, ...]
    ratios: tuple[tuple[str, str, str], ...] = ()
    sums: tuple[tuple[str, tuple[str, ...]], ...] = ()
    fill: float | int | None = None
    age_rule: bool = False
    predict_label: bool = False    # the prediction view keeps the label, where the input has one
    clamp: tuple[str, ...] = ()
    clamp_method: str = "clamp95"

    def derived(self) -> dict[str, Column]:
        d: dict[str, Column] = {}
        for out, num, den in self.ratios:
            d[out] = safe_ratio(num, den)
        for out, terms in self.sums:
            expr = F.col(terms[0]).cast("double")
            for t in terms[1:]:
                expr = expr + F.col(t)
            d[out] = expr
        if self.age_rule:
            d["uid_age_new"] = age_rule("uid_age")
            d["is_age_fill"] = age_fill_flag("uid_age")
        return d


VIEWS: dict[str, ViewSpec] = {
    "consume": ViewSpec(
        "consume", CONSUME_FEATURES,
        ratios=tuple((f"{p}_price", f"{p}_amount", f"{p}_count") for p in CONSUME_PRICE_PREFIXES),
        fill=CONSUME_TRAIN_FILL),
    "finance": ViewSpec("finance", FINANCE_FEATURES, ratios=FINANCE_RATIOS, sums=FINANCE_SUMS,
                        fill=FINANCE_FILL),
    "interaction": ViewSpec("interaction", INTERACTION_FEATURES),
    "relation": ViewSpec("relation", RELATION_FEATURES),
    "people": ViewSpec("people", PEOPLE_FEATURES, age_rule=True, clamp=PEOPLE_CLAMP, predict_label=True),
}


def fit_view_bounds(features: DataFrame, spec: ViewSpec, rel_error: float = 0.0,
                    train_only: bool = True) -> Bounds | None:
    """Bounds of the clamped columns, fitted on the hash-train rows."""
    if not spec.clamp:
        return None
    rows = features.where(is_train_row(KEY)) if train_only else features
    return fit_bounds(rows, spec.clamp, spec.clamp_method, rel_error)


def add_view_part(features: DataFrame, spec: ViewSpec, path: str, part: str) -> None:
    """The sketches of the clamped columns over the hash-train rows of one part of the
    data (a day's customers), kept at ``path`` with those of the other parts."""
    write_part(features.where(is_train_row(KEY)), spec.clamp, path, part)


def view_bounds_of_parts(spark: SparkSession, spec: ViewSpec, path: str) -> Bounds:
    """Bounds of the clamped columns over all parts at ``path``: merged, not refitted."""
    return bounds_from_sketches(read_parts(spark, path), spec.clamp, spec.clamp_method)


_FRACTIONAL = (T.FloatType, T.DoubleType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _fill(expr: Column, dtype: T.DataType, value) -> Column:
    """``na.fill`` for one numeric column: NULL (and NaN for floating types)
    -> ``value`` cast to the column's type; other types untouched."""
    if isinstance(dtype, _FRACTIONAL):
        return F.when(expr.isNull() | F.isnan(expr), F.lit(float(value)).cast(dtype)).otherwise(expr)
    if isinstance(dtype, _INTEGRAL) or isinstance(dtype, T.DecimalType):
        return F.coalesce(expr, F.lit(value).cast(dtype))
    return expr


def view_columns(features: DataFrame, spec: ViewSpec, bounds: Bounds | None = None,
                 fill_override: float | int | None = None) -> list[Column]:
    """The feature expressions of one view (derived -> clamped -> filled), in order."""
    exprs = dict(spec.derived())
    for c in spec.clamp:
        exprs[f"{c}_new"] = bounded_column(c, bounds)
    types = {f.name: f.dataType for f in features.schema.fields}
    fill = spec.fill if fill_override is None else fill_override
    cols = []
    for c in spec.features:
        if c in exprs:
            e = exprs[c]
            dtype = T.IntegerType() if c == "is_age_fill" else T.DoubleType()
        else:
            e, dtype = F.col(c), types[c]
        cols.append((_fill(e, dtype, fill) if fill is not None else e).alias(c))
    return cols


def build_view(features: DataFrame, spec: ViewSpec | str, phase: str = "train",
               bounds: Bounds | None = None, fill_override: float | int | None = None,
               rel_error: float = 0.0) -> DataFrame:
    """One projection: derived columns -> clamps -> fill -> column list.

    A view with clamped columns needs the bounds fitted at training time when it
    predicts; fitting them on the batch would make a customer's features depend
    on who else is scored."""
    if isinstance(spec, str):
        spec = VIEWS[spec]
    if phase not in ("train", "predict"):
        raise ValueError("phase must be 'train' or 'predict'")
    if spec.clamp and bounds is None:
        if phase == "predict":
            raise ValueError(f"{spec.module}: pass the bounds fitted at training time")
        bounds = fit_view_bounds(features, spec, rel_error)
    df = features
    if phase == "train":
        df = df.where(F.col(LABEL).isNotNull())
    labelled = phase == "train" or (spec.predict_label and LABEL in features.columns)
    head = [KEY, LABEL] if labelled else [KEY]
    return df.select(*[F.col(c) for c in head], *view_columns(features, spec, bounds, fill_override))


def build_all_views(features: DataFrame, phase: str = "predict", bounds: Bounds | None = None,
                    fill_overrides: dict | None = None, rel_error: float = 0.0,
                    modules: Sequence[str] | None = None) -> DataFrame:
    """All five views (or those of ``modules``) from ONE scan and ONE projection: ``uid_uid`` (+ label
    in the train phase) and one struct column per module holding that view's
    features -- ``df.select(KEY, "consume.*")`` is the consume view."""
    fill_overrides = fill_overrides or {}
    if bounds is None:
        if phase == "predict":
            raise ValueError("people: pass the bounds fitted at training time")
        bounds = fit_view_bounds(features, VIEWS["people"], rel_error)
    df = features.where(F.col(LABEL).isNotNull()) if phase == "train" else features
    head = [KEY, LABEL] if phase == "train" else [KEY]
    structs = [F.struct(*view_columns(features, spec, bounds if spec.clamp else None,
                                      fill_overrides.get(m))).alias(m)
               for m, spec in VIEWS.items() if modules is None or m in modules]
    return df.select(*[F.col(c) for c in head], *structs)


def split_view(view: DataFrame, method: str = "hash", seed: int = 42,
               weights: tuple[float, float] = (0.7, 0.3)) -> tuple[DataFrame, DataFrame]:
    """M1: (train, test).

    ``hash`` (default, D7): 70/30 by the md5 of the key -- the same customer
    always lands on the same side, whatever the partitioning.  ``random``:
    Spark's seeded ``randomSplit`` (the original behaviour, reproducible only
    for an unchanged input layout)."""
    if method == "random":
        tr, te = view.randomSplit(list(weights), seed)
        return tr, te
    if method != "hash":
        raise ValueError("method must be 'hash' or 'random'")
    t = is_train_row(KEY)
    return view.where(t), view.where(~t)


__all__ = ["ViewSpec", "VIEWS", "build_view", "build_all_views", "view_columns", "fit_view_bounds", "add_view_part", "view_bounds_of_parts",
           "split_view", "KEY", "LABEL"]
