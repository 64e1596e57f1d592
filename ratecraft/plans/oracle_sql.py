"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark code, from the derivation rules in
events`` are registered by the checker.  Doubles are rounded where two engines
could differ in the last bit (sums); single IEEE operations are left as is.
"""

from __future__ import annotations

FEATURES_SQL = r"""
ln AS (
  SELECT o.o_custkey AS k, o.o_orderkey AS ok, o.o_orderstatus AS st,
         l.l_suppkey AS sk, l.l_partkey AS pk, s.s_nationkey AS city,
         l.l_extendedprice AS price, l.l_discount AS disc, l.l_returnflag AS rf,
         l.l_extendedprice * (1 - l.l_discount) AS amt, p.p_size AS psize,
         CASE WHEN p.p_type IN ('PROMO','LARGE') THEN 'flt'
              WHEN p.p_type IN ('ECONOMY','STANDARD') THEN 'htl' ELSE 'trn' END AS lob,
         CASE WHEN p.p_size >= 40 THEN 1 ELSE 0 END AS fc,
         CASE WHEN sn.n_regionkey <> cn.n_regionkey THEN 1 ELSE 0 END AS ab,
         datediff('day', CAST(o.o_orderdate AS DATE), DATE '2001-08-01') AS age,
         datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS lead
  FROM orders o
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  JOIN nation sn ON sn.n_nationkey = s.s_nationkey
),
la AS (
  SELECT k,
    CAST(CASE WHEN count(CASE WHEN rf='R' THEN 1 END) < 0.35*count(*) THEN 1 ELSE 0 END AS INTEGER) AS uid_flag,
    CASE WHEN k % 17 = 0 THEN -1 ELSE count(DISTINCT ok) END AS uid_dealorders,
    CAST(CASE WHEN k % 19 = 0 THEN -1 ELSE max(age) END AS BIGINT) AS uid_authenticated_days,
    CAST(CASE WHEN k % 23 = 0 THEN -1 ELSE max(age) END AS BIGINT) AS uid_signupdays,
    CAST(floor(max(age)/30) AS INTEGER) AS uid_signmonths,
    CAST(CASE WHEN k % 29 = 0 THEN -1 ELSE min(age) END AS BIGINT) AS uid_lastlogindays,
    count(DISTINCT CASE WHEN st='F' THEN sk END) AS ord_success_order_cmobile_count,
    count(DISTINCT sk) AS com_mobile_count,
    count(DISTINCT pk) AS com_passenger_count,
    count(DISTINCT city) AS com_idno_count,
    count(CASE WHEN lob='htl' THEN 1 END) AS pro_htl_consuming_capacity,
    max(CASE WHEN lob='htl' THEN psize END) AS pro_htl_star_prefer,
    round(avg(lead),4) AS pro_advanced_date,
    round(sum(price*disc),4) AS pro_platform_profits,
    max(CASE WHEN st='F' THEN round(amt,4) END) AS ord_success_max_order_amount,
    round(avg(CASE WHEN st='F' THEN lead END),4) AS ord_success_avg_leadtime,
    count(CASE WHEN st='P' THEN 1 END) AS ord_cancel_order_count,
    count(DISTINCT CASE WHEN st='F' THEN lob END) AS ord_success_order_type_count,
    count(DISTINCT CASE WHEN st='F' THEN city END) AS ord_success_order_acity_count,
    CAST(min(CASE WHEN st='F' AND lob='flt' THEN age END) AS INTEGER) AS ord_success_flt_last_order_days,
    max(CASE WHEN st='F' AND lob='flt' THEN round(amt,4) END) AS ord_success_flt_max_order_amount,
    round(avg(CASE WHEN st='F' AND lob='flt' THEN 1-disc END),6) AS ord_success_flt_avg_order_pricerate,
    count(DISTINCT CASE WHEN st='F' AND lob='flt' THEN city END) AS ord_success_flt_order_acity_count,
    CAST(min(CASE WHEN st='F' AND lob='htl' THEN age END) AS INTEGER) AS ord_success_htl_last_order_days,
    max(CASE WHEN st='F' AND lob='htl' THEN round(amt,4) END) AS ord_success_htl_max_order_amount,
    round(avg(CASE WHEN st='F' AND lob='htl' THEN CAST(CASE WHEN rf='R' THEN 1 ELSE 0 END AS DOUBLE) END),6) AS ord_success_htl_order_refund_ratio,
    count(CASE WHEN st='F' AND lob='htl' AND rf='A' THEN 1 END) AS ord_success_htl_guarantee_order_count,
    count(CASE WHEN st='F' AND lob='htl' AND rf='N' THEN 1 END) AS ord_success_htl_noshow_order_count,
    count(CASE WHEN st='P' AND lob='htl' THEN 1 END) AS ord_cancel_htl_order_count,
    CAST(min(CASE WHEN st='F' AND lob='trn' THEN age END) AS INTEGER) AS ord_success_trn_last_order_days,
    round(sum(CASE WHEN st='F' THEN amt END),4) AS ord_success_order_amount,
    count(CASE WHEN st='F' THEN 1 END) AS ord_success_order_count,
    round(sum(CASE WHEN st='F' AND fc=1 THEN amt END),4) AS ord_success_first_class_order_amount,
    count(CASE WHEN st='F' AND fc=1 THEN 1 END) AS ord_success_first_class_order_count,
    round(sum(CASE WHEN st='F' AND ab=1 THEN amt END),4) AS ord_success_aboard_order_amount,
    count(CASE WHEN st='F' AND ab=1 THEN 1 END) AS ord_success_aboard_order_count,
    round(sum(CASE WHEN st='F' AND lob='flt' AND fc=1 THEN amt END),4) AS ord_success_flt_first_class_order_amount,
    count(CASE WHEN st='F' AND lob='flt' AND fc=1 THEN 1 END) AS ord_success_flt_first_class_order_count,
    round(sum(CASE WHEN st='F' AND lob='flt' AND ab=1 THEN amt END),4) AS ord_success_flt_aboard_order_amount,
    count(CASE WHEN st='F' AND lob='flt' AND ab=1 THEN 1 END) AS ord_success_flt_aboard_order_count,
    round(sum(CASE WHEN st='F' AND lob='flt' THEN amt END),4) AS ord_success_flt_order_amount,
    count(CASE WHEN st='F' AND lob='flt' THEN 1 END) AS ord_success_flt_order_count,
    round(sum(CASE WHEN st='F' AND lob='htl' AND fc=1 THEN amt END),4) AS ord_success_htl_first_class_order_amount,
    count(CASE WHEN st='F' AND lob='htl' AND fc=1 THEN 1 END) AS ord_success_htl_first_class_order_count,
    round(sum(CASE WHEN st='F' AND lob='htl' AND ab=1 THEN amt END),4) AS ord_success_htl_aboard_order_amount,
    count(CASE WHEN st='F' AND lob='htl' AND ab=1 THEN 1 END) AS ord_success_htl_aboard_order_count,
    round(sum(CASE WHEN st='F' AND lob='htl' THEN amt END),4) AS ord_success_htl_order_amount,
    count(CASE WHEN st='F' AND lob='htl' THEN 1 END) AS ord_success_htl_order_count,
    round(sum(CASE WHEN st='F' AND lob='trn' THEN amt END),4) AS ord_success_trn_order_amount,
    count(CASE WHEN st='F' AND lob='trn' THEN 1 END) AS ord_success_trn_order_count,
    max(CASE WHEN st='F' AND lob='trn' THEN round(amt,4) END) AS ord_success_trn_max_order_amount,
    round(sum(amt),4) AS ord_total_order_amount,
    count(CASE WHEN rf='R' THEN 1 END) AS voi_complrefund_count,
    count(CASE WHEN rf='R' AND st='O' THEN 1 END) AS bil_refundord_count
  FROM ln GROUP BY k
),
ev AS (
  SELECT user_id AS k,
    count(*) AS pro_base_active,
    count(CASE WHEN event_type='error' THEN 1 END) AS voi_complaint_count,
    count(CASE WHEN event_type='view' THEN 1 END) AS voi_comment_count,
    count(DISTINCT CAST(ts AS DATE)) AS acc_loginday_count,
    count(CASE WHEN event_type='error' AND value>100 THEN 1 END) AS fai_lackbalance,
    count(DISTINCT event_type) AS bil_ordertype_count,
    count(CASE WHEN event_type='signup' THEN 1 END) AS bil_platform_count,
    count(CASE WHEN event_type IN ('purchase','click') THEN 1 END) AS bil_payord_count,
    count(CASE WHEN event_type='purchase' THEN 1 END) AS bil_paysord_count,
    count(CASE WHEN event_type IN ('purchase','click') AND value>=50 THEN 1 END) AS bil_payord_credit_count,
    count(CASE WHEN event_type='purchase' AND value>=50 THEN 1 END) AS bil_paysord_credit_count,
    count(CASE WHEN event_type IN ('purchase','click') AND value>=200 THEN 1 END) AS bil_payord_debit_count,
    count(CASE WHEN event_type='purchase' AND value>=200 THEN 1 END) AS bil_paysord_debit_count,
    round(sum(value),2) AS cap_tmoney_balance
  FROM events GROUP BY user_id
),
features AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS uid_uid,
    la.uid_flag,
    c.c_nationkey % 5 AS uid_grade,
    la.uid_dealorders,
    c.c_custkey % 2 AS uid_emailvalid,
    CAST(CASE WHEN c.c_custkey % 11 = 0 THEN -1 WHEN c.c_custkey % 13 = 0 THEN 0
              ELSE 5 + c.c_custkey % 70 END AS INTEGER) AS uid_age,
    CASE WHEN c.c_custkey % 3 > 0 THEN 1 ELSE 0 END AS uid_mobilevalid,
    CASE WHEN c.c_custkey % 5 > 1 THEN 1 ELSE 0 END AS uid_addressvalid,
    CASE WHEN c.c_custkey % 7 > 2 THEN 1 ELSE 0 END AS uid_isindentify,
    la.uid_authenticated_days, la.uid_signupdays, la.uid_signmonths, la.uid_lastlogindays,
    c.c_custkey % 4 AS uid_samemobile,
    la.ord_success_order_cmobile_count, la.com_mobile_count, la.com_passenger_count, la.com_idno_count,
    c.c_custkey % 3 AS pro_generous_stingy_tag,
    coalesce(ev.pro_base_active, 0) AS pro_base_active,
    CAST(floor(c.c_acctbal/100) AS BIGINT) AS pro_customervalue,
    c.c_nationkey % 3 AS pro_phone_type,
    c.c_acctbal AS pro_validpoints,
    la.pro_htl_consuming_capacity, la.pro_htl_star_prefer, la.pro_advanced_date,
    la.pro_platform_profits, la.ord_success_max_order_amount, la.ord_success_avg_leadtime,
    la.ord_cancel_order_count, la.ord_success_order_type_count, la.ord_success_order_acity_count,
    la.ord_success_flt_last_order_days, la.ord_success_flt_max_order_amount,
    la.ord_success_flt_avg_order_pricerate, la.ord_success_flt_order_acity_count,
    la.ord_success_htl_last_order_days, la.ord_success_htl_max_order_amount,
    la.ord_success_htl_order_refund_ratio, la.ord_success_htl_guarantee_order_count,
    la.ord_success_htl_noshow_order_count, la.ord_cancel_htl_order_count,
    la.ord_success_trn_last_order_days,
    la.ord_success_order_amount, la.ord_success_order_count,
    la.ord_success_first_class_order_amount, la.ord_success_first_class_order_count,
    la.ord_success_aboard_order_amount, la.ord_success_aboard_order_count,
    la.ord_success_flt_first_class_order_amount, la.ord_success_flt_first_class_order_count,
    la.ord_success_flt_aboard_order_amount, la.ord_success_flt_aboard_order_count,
    la.ord_success_flt_order_amount, la.ord_success_flt_order_count,
    la.ord_success_htl_first_class_order_amount, la.ord_success_htl_first_class_order_count,
    la.ord_success_htl_aboard_order_amount, la.ord_success_htl_aboard_order_count,
    la.ord_success_htl_order_amount, la.ord_success_htl_order_count,
    la.ord_success_trn_order_amount, la.ord_success_trn_order_count,
    la.ord_success_trn_max_order_amount, la.ord_total_order_amount,
    coalesce(ev.voi_complaint_count, 0) AS voi_complaint_count,
    la.voi_complrefund_count,
    coalesce(ev.voi_comment_count, 0) AS voi_comment_count,
    coalesce(ev.acc_loginday_count, 0) AS acc_loginday_count,
    ev.fai_lackbalance, la.bil_refundord_count, ev.bil_ordertype_count, ev.bil_platform_count,
    ev.bil_payord_count, ev.bil_paysord_count, ev.bil_payord_credit_count,
    ev.bil_paysord_credit_count, ev.bil_payord_debit_count, ev.bil_paysord_debit_count,
    ev.cap_tmoney_balance,
    CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS cap_wallet_balance
  FROM customer c
  LEFT JOIN la ON la.k = c.c_custkey
  LEFT JOIN ev ON ev.k = c.c_custkey
)"""


def with_features(select_sql: str, extra_ctes: str = "") -> str:
    """``WITH <feature CTEs>[, extra] <select>``."""
    ctes = FEATURES_SQL.strip()
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{select_sql}"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


register("feature_table", with_features("SELECT * FROM features"))


# ---- views ------------------------------------------------------------------
# Column lists are fixed values shared with the Spark views; every expression
# below is written again in SQL.
from ratecraft.plans import views as _v  # noqa: E402
from ratecraft.sources.schemas import feature_schema as _feature_schema  # noqa: E402

_SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
_RAW_TYPES = {f.name: f.dataType.simpleString() for f in _feature_schema().fields}
TRAIN_FILTER = "('0x' || substr(md5(uid_uid), 1, 8))::BIGINT % 10 < 7"


def _clamp_sql(c: str, method: str = "clamp95") -> str:
    top = f"floor(h_{c})" if method == "clamp95" else f"floor(m_{c})"
    return (f"CAST(CASE WHEN {c} IS NULL THEN NULL WHEN {c} > h_{c} THEN {top} "
            f"WHEN {c} = -1 THEN m_{c} ELSE {c} END AS DOUBLE)")


def _ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif({den}, 0))"


# Derived columns of the views, from SURVEY F1-F16, not from the Spark specs.
_PRICES = {
    "ord_success_order_price": ("ord_success_order_amount", "ord_success_order_count"),
    "ord_success_first_class_order_price": ("ord_success_first_class_order_amount", "ord_success_first_class_order_count"),
    "ord_success_aboard_order_price": ("ord_success_aboard_order_amount", "ord_success_aboard_order_count"),
    "ord_success_flt_first_class_order_price": ("ord_success_flt_first_class_order_amount", "ord_success_flt_first_class_order_count"),
    "ord_success_flt_aboard_order_price": ("ord_success_flt_aboard_order_amount", "ord_success_flt_aboard_order_count"),
    "ord_success_flt_order_price": ("ord_success_flt_order_amount", "ord_success_flt_order_count"),
    "ord_success_htl_first_class_order_price": ("ord_success_htl_first_class_order_amount", "ord_success_htl_first_class_order_count"),
    "ord_success_htl_aboard_order_price": ("ord_success_htl_aboard_order_amount", "ord_success_htl_aboard_order_count"),
    "ord_success_htl_order_price": ("ord_success_htl_order_amount", "ord_success_htl_order_count"),
    "ord_success_trn_order_price": ("ord_success_trn_order_amount", "ord_success_trn_order_count"),
}
_PAYS = {
    "bil_pays_ratio": ("bil_paysord_count", "bil_payord_count"),
    "bil_pays_credit_ratio": ("bil_paysord_credit_count", "bil_payord_credit_count"),
    "bil_pays_debit_ratio": ("bil_paysord_debit_count", "bil_payord_debit_count"),
}
_AGE_NEW = ("CAST(CASE WHEN uid_age IS NULL THEN NULL WHEN uid_age > 65 OR uid_age < 12 "
            "THEN 34 ELSE uid_age END AS DOUBLE)")
_AGE_FILL = "CASE WHEN uid_age IS NULL THEN NULL WHEN uid_age IN (0, -1) THEN 0 ELSE 1 END"
_CLAMPED = ("uid_dealorders", "uid_authenticated_days", "uid_signupdays", "uid_signmonths",
            "uid_lastlogindays", "ord_success_order_cmobile_count", "com_mobile_count")
DERIVED_SQL: dict[str, tuple[str, str]] = {
    **{c: (_ratio(*pair), "double") for c, pair in {**_PRICES, **_PAYS}.items()},
    "cap_balance": ("(CAST(cap_tmoney_balance AS DOUBLE) + CAST(cap_wallet_balance AS DOUBLE) "
                    "+ CAST(cap_wallet_balance AS DOUBLE))", "double"),
    "uid_age_new": (_AGE_NEW, "double"),
    "is_age_fill": (_AGE_FILL, "int"),
    **{f"{c}_new": (_clamp_sql(c), "double") for c in _CLAMPED},
}
FILLS = {"consume": "-1.0", "finance": "0", "interaction": None, "people": None, "relation": None}


def view_sql(module: str, phase: str, fill=None) -> str:
    fill = FILLS[module] if fill is None else fill
    cols = ["uid_uid"] + (["uid_flag"] if phase == "train" or module == "people" else [])
    for c in _v.VIEWS[module].features:
        e, t = DERIVED_SQL.get(c) or (c, _RAW_TYPES[c])
        if fill is not None:
            e = f"coalesce({e}, CAST({fill} AS {_SQL_TYPE[t]}))"
        cols.append(f"{e} AS {c}")
    where = " WHERE uid_flag IS NOT NULL" if phase == "train" else ""
    ctes = ""
    src = "features"
    if module == "people":
        aggs = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}, quantile_disc({c}, 0.95) AS h_{c}"
                         for c in _CLAMPED)
        ctes = f"qb AS (SELECT {aggs} FROM features WHERE {TRAIN_FILTER})"
        src = "features, qb"
    return with_features(f"SELECT {', '.join(cols)} FROM {src}{where}", ctes)


register("consume_view_train", view_sql("consume", "train"))
register("consume_view_predict", view_sql("consume", "predict", fill=0))
register("finance_view_train", view_sql("finance", "train"))
register("finance_view_predict", view_sql("finance", "predict"))
register("interaction_view", view_sql("interaction", "predict"))
register("relation_view", view_sql("relation", "predict"))
register("people_view_train", view_sql("people", "train"))
register("people_view_predict", view_sql("people", "predict"))


# ---- outliers, quantiles, split, scalar rules ---------------------------------
OUTLIER_COLUMNS = _v.OUTLIER_COLUMNS
_PROBS = (0.25, 0.5, 0.75, 0.95)


def _iqr_sql(cols) -> str:
    stats = ", ".join(
        f"quantile_disc({c}, 0.25) AS q1_{c}, quantile_disc({c}, 0.5) AS m_{c}, "
        f"quantile_disc({c}, 0.75) AS q3_{c}" for c in cols)
    fences = ", ".join(
        f"q1_{c} - 1.5 * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + 1.5 * (q3_{c} - q1_{c}) AS hi_{c}, m_{c}"
        for c in cols)
    return (f"qs AS (SELECT {stats} FROM features), "
            f"fb AS (SELECT {fences} FROM qs)")


def _iqr_select(cols) -> str:
    out = []
    for c in cols:
        out.append(f"CAST(CASE WHEN {c} > hi_{c} OR {c} < lo_{c} THEN floor(m_{c}) ELSE {c} END AS DOUBLE) "
                   f"AS {c}_new")
        out.append(f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} = -1 THEN 0 ELSE 1 END AS {c}TF")
    return ", ".join(out)


register("outlier_iqr", with_features(
    f"SELECT uid_uid, {_iqr_select(OUTLIER_COLUMNS)} FROM features, fb", _iqr_sql(OUTLIER_COLUMNS)))

register("outlier_iqr_rows", with_features(
    "SELECT uid_uid, \"column\", \"value\" FROM ("
    + " UNION ALL ".join(
        f"SELECT uid_uid, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS \"value\" FROM features, fb "
        f"WHERE {c} < lo_{c} OR {c} > hi_{c}" for c in OUTLIER_COLUMNS) + ")",
    _iqr_sql(OUTLIER_COLUMNS)))

_sig_stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}" for c in OUTLIER_COLUMNS)
_sig_sel = ", ".join(
    f"CAST(CASE WHEN {c} > mu_{c} + 3 * sd_{c} OR {c} < mu_{c} - 3 * sd_{c} THEN floor(mu_{c}) "
    f"ELSE {c} END AS DOUBLE) AS {c}_new" for c in OUTLIER_COLUMNS)
register("outlier_sigma", with_features(
    f"SELECT uid_uid, {_sig_sel} FROM features, ss", f"ss AS (SELECT {_sig_stats} FROM features)"))


def _clamp_all_sql(method: str) -> str:
    cols = _v.PEOPLE_CLAMP
    stats = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}, quantile_disc({c}, 0.95) AS h_{c}"
                      for c in cols)
    sel = ", ".join(f"{_clamp_sql(c, method)} AS {c}_new" for c in cols)
    return with_features(f"SELECT uid_uid, {sel} FROM features, qb",
                         f"qb AS (SELECT {stats} FROM features)")


register("clamp_q95", _clamp_all_sql("clamp95"))
register("clamp_median", _clamp_all_sql("clamp5"))

register("quantiles_exact", with_features(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS \"value\" "
    f"FROM features" for c in OUTLIER_COLUMNS for p in _PROBS)))

for _name in ("quantiles_approx", "quantiles_sketch"):
    register(_name, with_features(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, count({c}) AS n, true AS within_error FROM features"
        for c in OUTLIER_COLUMNS for p in _PROBS)))

register("hash_split_rows", with_features(
    f"SELECT uid_uid, {TRAIN_FILTER} AS is_train FROM features"))
register("hash_split_counts", with_features(
    f"SELECT CASE WHEN {TRAIN_FILTER} THEN 'train' ELSE 'test' END AS split, count(*) AS n "
    f"FROM features GROUP BY 1"))
register("age_rule", with_features(
    "SELECT uid_uid, uid_age, CAST(CASE WHEN uid_age IS NULL THEN NULL WHEN uid_age > 65 OR uid_age < 12 "
    "THEN 34 ELSE uid_age END AS DOUBLE) AS uid_age_new, "
    "CASE WHEN uid_age IS NULL THEN NULL WHEN uid_age IN (0, -1) THEN 0 ELSE 1 END AS is_age_fill "
    "FROM features"))
register("label_double", with_features("SELECT uid_uid, CAST(uid_flag AS DOUBLE) AS label FROM features"))


# ---- evaluation, indexing, scaling, scores, joins -----------------------------
EVAL_CTE = """
ev_in AS (
  SELECT uid_uid, CAST(uid_flag AS DOUBLE) AS label,
         round(CAST(ord_success_order_count AS DOUBLE)
               / nullif(ord_success_order_count + voi_complrefund_count, 0), 3) AS score
  FROM features),
evf AS (SELECT *, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction
        FROM ev_in WHERE score IS NOT NULL AND label IS NOT NULL),
cnt AS (SELECT score AS threshold, count(CASE WHEN label = 1 THEN 1 END) AS tp0,
               count(CASE WHEN label <> 1 THEN 1 END) AS fp0 FROM evf GROUP BY score),
tot AS (SELECT CAST(sum(tp0) AS DOUBLE) AS P, CAST(sum(fp0) AS DOUBLE) AS N FROM cnt),
cc AS (SELECT threshold, tp0, fp0,
              CAST(sum(tp0) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
              CAST(sum(fp0) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp FROM cnt),
pts AS (SELECT threshold, tp / N AS dummy, fp / N AS fpr, tp / P AS tpr, tp / (tp + fp) AS prec
        FROM cc, tot),
lagged AS (SELECT threshold, fpr, tpr, prec,
                  coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0) AS pfpr,
                  coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0) AS ptpr,
                  coalesce(lag(prec) OVER (ORDER BY threshold DESC), prec) AS pprec FROM pts)"""


def with_eval(select_sql: str) -> str:
    return with_features(select_sql, EVAL_CTE)


register("rmse", with_eval("SELECT round(sqrt(avg((score - label) * (score - label))), 6) AS rmse FROM evf"))
register("accuracy", with_eval(
    "SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, "
    "round(1 - avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS test_error FROM evf"))


def _fb(b2: float) -> str:
    p, r = "(CAST(tp AS DOUBLE) / (tp + fp))", "(tp / P)"
    return (f"round(CASE WHEN {b2!r} * {p} + {r} = 0 THEN 0.0 "
            f"ELSE {1 + b2!r} * {p} * {r} / ({b2!r} * {p} + {r}) END, 6)")


_CURVE = (
    "SELECT threshold, tp, fp, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, "
    f"round(tp / P, 6) AS recall, {_fb(1.0)} AS f1, {_fb(0.25)} AS f_beta FROM cc, tot")
register("threshold_curve", with_eval(_CURVE))
register("classification_report_curve", with_eval(_CURVE))
register("pr_roc_curve", with_eval(
    "SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, round(tpr, 6) AS recall, "
    "round(prec, 6) AS precision FROM pts"))
_AUC_ROC = "round(sum((fpr - pfpr) * (tpr + ptpr) / 2), 6)"
_AUC_PR = "round(sum((tpr - ptpr) * (prec + pprec) / 2), 6)"
register("auc_roc", with_eval(f"SELECT {_AUC_ROC} AS auc_roc FROM lagged"))
register("auc_pr", with_eval(f"SELECT {_AUC_PR} AS auc_pr FROM lagged"))
register("classification_report", with_eval(
    "SELECT 'accuracy' AS metric, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS value FROM evf "
    "UNION ALL SELECT 'test_error', round(1 - avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) FROM evf "
    f"UNION ALL SELECT 'auc_roc', {_AUC_ROC} FROM lagged "
    f"UNION ALL SELECT 'auc_pr', {_AUC_PR} FROM lagged "
    "UNION ALL SELECT 'n', CAST(count(*) AS DOUBLE) FROM evf "
    "UNION ALL SELECT 'n_excluded', CAST(count(*) AS DOUBLE) FROM ev_in WHERE score IS NULL OR label IS NULL"))

LABEL_RANK_CTE = """
lab AS (SELECT CAST(CAST(uid_flag AS DOUBLE) AS VARCHAR) AS label, count(*) AS n
        FROM features WHERE uid_flag IS NOT NULL GROUP BY 1),
rk AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS index_label, n
       FROM lab)"""
register("label_index", with_features("SELECT label, index_label, n FROM rk", LABEL_RANK_CTE))
register("index_to_label", with_features(
    "SELECT f.uid_uid, rk.index_label, rk.label AS predictedLabel FROM features f "
    "JOIN rk ON rk.label = CAST(CAST(f.uid_flag AS DOUBLE) AS VARCHAR)", LABEL_RANK_CTE))

_mm_ok = " AND ".join(f"{c} IS NOT NULL" for c in _v.RELATION_FEATURES)
_mm_stats = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _v.RELATION_FEATURES)
_mm_sel = ", ".join(
    f"CASE WHEN {_mm_ok} THEN round(CASE WHEN mx_{c} = mn_{c} THEN 0.5 "
    f"ELSE CAST({c} - mn_{c} AS DOUBLE) / (mx_{c} - mn_{c}) END, 6) END AS {c}_scaled"
    for c in _v.RELATION_FEATURES)
register("minmax_scaled", with_features(
    f"SELECT uid_uid, {_mm_sel} FROM features, mm",
    f"mm AS (SELECT {_mm_stats} FROM features WHERE {TRAIN_FILTER} AND {_mm_ok})"))

register("score_map", with_eval(
    "SELECT uid_uid, round(1 - score, 6) AS Proba_1, round(score, 6) AS Proba_2, "
    "round(score * 500.0 + 350.0, 6) AS Score FROM ev_in"))
register("score_map_label", with_eval(
    "SELECT uid_uid, CASE WHEN score >= 0.5 THEN '1.0' WHEN score < 0.5 THEN '0.0' END AS predictedLabel, "
    "CASE WHEN score >= 0.5 THEN 850.0::DOUBLE WHEN score < 0.5 THEN 350.0::DOUBLE END AS ScoreInteraction FROM ev_in"))


def _share(num: str, *den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) / nullif({' + '.join(den)}, 0), 4)"


RULE_CTE = f"""
s_consume AS (SELECT uid_uid, {_share('ord_success_order_count', 'ord_success_order_count', 'voi_complrefund_count')} * 500.0 + 350.0 AS ScoreConsume FROM features),
s_finance AS (SELECT uid_uid, {_share('ord_success_order_count', 'ord_success_order_count', 'ord_cancel_order_count')} * 500.0 + 350.0 AS ScoreFinance FROM features),
s_interaction AS (SELECT uid_uid, {_share('voi_comment_count', 'pro_base_active')} * 500.0 + 350.0 AS ScoreInteraction FROM features WHERE pro_base_active > 0),
s_people AS (SELECT uid_uid, round(CAST(CASE WHEN uid_age IS NULL THEN NULL WHEN uid_age > 65 OR uid_age < 12 THEN 34 ELSE uid_age END AS DOUBLE) / 100.0, 4) * 500.0 + 350.0 AS ScorePeople FROM features),
s_relation AS (SELECT uid_uid, {_share('ord_success_order_cmobile_count', 'com_mobile_count')} * 500.0 + 350.0 AS ScoreRelation FROM features)"""

_COMBINE = (
    "SELECT a.uid_uid, a.ScoreConsume, b.ScoreFinance, c.ScoreInteraction, d.ScorePeople, e.ScoreRelation, "
    "round(a.ScoreConsume * 0.25 + b.ScoreFinance * 0.2 + c.ScoreInteraction * 0.15 + d.ScorePeople * 0.3 "
    "+ e.ScoreRelation * 0.1, 6) AS ScoreAll "
    "FROM s_consume a JOIN s_finance b ON a.uid_uid = b.uid_uid "
    "JOIN s_interaction c ON a.uid_uid = c.uid_uid JOIN s_people d ON a.uid_uid = d.uid_uid "
    "JOIN s_relation e ON a.uid_uid = e.uid_uid")
register("combine_scores", with_features(_COMBINE, RULE_CTE))
register("combine_scores_sql", with_features(_COMBINE, RULE_CTE))

_DESC = ("SELECT count(*) AS n_rows, count(ScoreConsume) AS \"count\", round(avg(ScoreConsume), 6) AS mean, "
         "round(stddev_samp(ScoreConsume), 6) AS stddev, CAST(min(ScoreConsume) AS DOUBLE) AS \"min\", "
         "CAST(max(ScoreConsume) AS DOUBLE) AS \"max\" FROM s_consume")
register("describe_scores", with_features(_DESC, RULE_CTE))
register("describe_scores_notnull", with_features(_DESC + " WHERE ScoreConsume IS NOT NULL", RULE_CTE))

_rel = ", ".join(f"l.{c}" for c in _v.RELATION_FEATURES)
_int = ", ".join(f"r.{c}" for c in _v.INTERACTION_FEATURES)
register("concat_positional", with_features(
    f"SELECT l.uid_uid, {_rel}, r.uid_uid AS uid_uid_2, {_int} FROM "
    "(SELECT *, row_number() OVER (ORDER BY uid_uid) AS pos FROM features) l JOIN "
    "(SELECT *, row_number() OVER (ORDER BY uid_uid) AS pos FROM features) r ON l.pos = r.pos"))


# ---- models ---------------------------------------------------------------------
# What SQL can compute is compared by value: split side, label, the label's index
# by its count among the training rows, who is scored.  The other columns are
# checks that the Spark query makes on the model's numbers.
TRAIN_RANK_CTE = f"""
lab AS (SELECT CAST(uid_flag AS DOUBLE) AS label, count(*) AS n FROM features
        WHERE uid_flag IS NOT NULL AND {TRAIN_FILTER} GROUP BY 1),
rk AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS label_index FROM lab)"""


def scored_sql(module: str) -> str:
    """Every feature of the prediction view is there."""
    if FILLS[module] is not None:
        return "true"
    # a clamped column is missing where its source is
    return " AND ".join(f"({c.removesuffix('_new') if c.removesuffix('_new') in _CLAMPED else DERIVED_SQL.get(c, (c,))[0]}) IS NOT NULL"
                        for c in _v.VIEWS[module].features)


_HELD_OUT = f"(SELECT count(*) FROM features WHERE uid_flag IS NOT NULL AND NOT ({TRAIN_FILTER}))"
for _m in ("consume", "finance", "interaction", "people", "relation"):
    register(f"{_m}_train_predict", with_features(
        f"SELECT uid_uid, {TRAIN_FILTER} AS is_train, CAST(uid_flag AS DOUBLE) AS label, rk.label_index, "
        f"{scored_sql(_m)} AS scored, true AS score_follows_label_index, true AS reload_equal, "
        f"true AS train_area_above_half, {_HELD_OUT} AS n_evaluated, CAST(0 AS BIGINT) AS n_excluded, true AS report_agrees "
        "FROM features LEFT JOIN rk ON rk.label = CAST(uid_flag AS DOUBLE)", TRAIN_RANK_CTE))
register("rf_regression", with_features(
    f"SELECT uid_uid, {TRAIN_FILTER} AS is_train, CAST(uid_flag AS DOUBLE) AS label, true AS within_label_range "
    "FROM features WHERE uid_flag IS NOT NULL"))
_SIDES = with_features(
    f"SELECT {TRAIN_FILTER} AS is_train, count(*) AS n, round(avg(CAST(uid_flag AS DOUBLE)), 6) AS mean_label, "
    "count(*) AS n_predicted, true AS train_beats_mean FROM features WHERE uid_flag IS NOT NULL GROUP BY 1")
register("rf_regression_sides", _SIDES)
register("gbt_regression", _SIDES)
register("combined_model_scores", with_features(
    "SELECT uid_uid, " + " AND ".join(f"({scored_sql(m)})" for m in FILLS) + " AS scored, true AS is_weighted_sum, "
    "true AS one_pass_equal, " + ", ".join(f"{_HELD_OUT} AS n_evaluated_{m}" for m in ("consume", "finance", "interaction", "people", "relation"))
    + " FROM features"))
register("combine_job", with_features(_COMBINE, RULE_CTE))
register("combine_job_description", with_features(
    "SELECT count(*) AS n_rows, count(ScoreAll) AS \"count\", round(avg(ScoreAll), 6) AS mean, "
    "round(stddev_samp(ScoreAll), 6) AS stddev, round(min(ScoreAll), 6) AS \"min\", round(max(ScoreAll), 6) AS \"max\" "
    "FROM combined", RULE_CTE + ",\ncombined AS (" + _COMBINE.replace("round(a.", "(a.").replace(", 6) AS ScoreAll", ") AS ScoreAll") + ")"))
register("train_predict_paths", with_features(
    f"SELECT uid_uid, {scored_sql('relation')} AS scored, "
    f"{_HELD_OUT} AS n_evaluated FROM features"))


# ---- sources and sinks --------------------------------------------------------
register("csv_roundtrip", with_features("SELECT * FROM features"))
_N = "CAST(uid_uid AS BIGINT) % 50"
register("csv_quarantine", with_features(
    f"SELECT uid_uid, CASE WHEN {_N} <> 7 THEN uid_age END AS uid_age, CASE WHEN {_N} <> 13 THEN uid_signmonths END AS uid_signmonths, "
    f"CASE WHEN {_N} IN (7, 13) THEN concat(CAST(uid_age AS VARCHAR), CASE WHEN {_N} = 7 THEN 'x' ELSE '' END, ',', uid_uid, ',', "
    f"CASE WHEN {_N} = 13 THEN 'abc' ELSE CAST(uid_signmonths AS VARCHAR) END) END AS record FROM features"))
register("json_roundtrip", with_features("SELECT * FROM features"))
register("catalog_table", with_features("SELECT * FROM features"))
register("score_parquet_roundtrip", with_features("SELECT uid_uid, ScoreConsume FROM s_consume", RULE_CTE))
register("score_table_replaced", with_features(
    "SELECT uid_uid, ScorePeople AS ScoreConsume, CAST(2 AS BIGINT) AS versions FROM s_people", RULE_CTE))
register("profile", with_features(f"SELECT count(*) AS n_rows, {len(_RAW_TYPES)} AS n_columns FROM features"))
register("preview", with_features("SELECT * FROM features ORDER BY uid_uid LIMIT 5"))
