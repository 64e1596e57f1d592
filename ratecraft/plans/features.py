"""Customer feature table: one row per customer, 81 columns.

Derived from the star schema (customer, orders, lineitem, part, supplier,
nation, events) as described in FIXTURES.md.  This is the wide input table the
five scoring views read.

Plan shape (what survives at scale):
* orders are joined to their customer's region first (order level, smaller
  than lines), so the line relation never has to be shuffled by customer key
  for a join -- only once, by the final aggregation, after map-side partial
  aggregation.  A customer holding a third of all lines therefore costs one
  partially-aggregated row per map task, not a third of the data in one task.
* nation, part, supplier and orders join as the planner decides (AQE broadcasts them when small at run time,
  shuffle joins otherwise).  Lines meet the small dimensions (part, supplier)
  first, so without statistics the planner never picks the line side to
  broadcast; at scale the three line shuffles (pk, sk, ok) are the same in
  any order.
* plain aggregates and distinct counts are two separate aggregations joined
  on the customer key.  In one aggregation Spark's distinct rewrite makes the
  first level group by (customer, distinct value, group id) and gives every
  such group the full buffer of all ~55 plain aggregates -- millions of wide
  buffers (19 s vs 6 s at sf0.1, and it grows with lines x buffer width).
  Split, the plain branch is one partially aggregated shuffle of narrow
  partials, and the distinct branch reads only (k, ok, sk, pk, city, lob, st):
  its counts share one column of values, so a group is (customer, which
  column, value) with one number, and not a row of all counted columns.  The
  cost is a second, column-pruned evaluation of the line joins; jobs that reuse
  the table write it once (``materialize_feature_table``).
* each branch is left-joined to the customers by itself, so a query that reads
  the columns of one evaluates the lines for that one alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.sources.tables import load_tables

# ---- fixed values of the fixture derivation (FIXTURES.md) ------------------
REFERENCE_DATE = "2001-08-01"
LOB_FLIGHT_TYPES = ("PROMO", "LARGE")
LOB_HOTEL_TYPES = ("ECONOMY", "STANDARD")
FIRST_CLASS_MIN_SIZE = 40
RETURN_SHARE_GOOD = 0.35
LINES_PER_TASK = 250_000     # of the distinct counts
SLICES = 8                   # tasks, at most, that one customer's values are dealt over

FEATURE_COLUMNS = (
    "uid_uid", "uid_flag", "uid_grade", "uid_dealorders", "uid_emailvalid", "uid_age",
    "uid_mobilevalid", "uid_addressvalid", "uid_isindentify", "uid_authenticated_days",
    "uid_signupdays", "uid_signmonths", "uid_lastlogindays", "uid_samemobile",
    "ord_success_order_cmobile_count", "com_mobile_count", "com_passenger_count",
    "com_idno_count", "pro_generous_stingy_tag", "pro_base_active", "pro_customervalue",
    "pro_phone_type", "pro_validpoints", "pro_htl_consuming_capacity", "pro_htl_star_prefer",
    "pro_advanced_date", "pro_platform_profits", "ord_success_max_order_amount",
    "ord_success_avg_leadtime", "ord_cancel_order_count", "ord_success_order_type_count",
    "ord_success_order_acity_count", "ord_success_flt_last_order_days",
    "ord_success_flt_max_order_amount", "ord_success_flt_avg_order_pricerate",
    "ord_success_flt_order_acity_count", "ord_success_htl_last_order_days",
    "ord_success_htl_max_order_amount", "ord_success_htl_order_refund_ratio",
    "ord_success_htl_guarantee_order_count", "ord_success_htl_noshow_order_count",
    "ord_cancel_htl_order_count", "ord_success_trn_last_order_days",
    "ord_success_order_amount", "ord_success_order_count",
    "ord_success_first_class_order_amount", "ord_success_first_class_order_count",
    "ord_success_aboard_order_amount", "ord_success_aboard_order_count",
    "ord_success_flt_first_class_order_amount", "ord_success_flt_first_class_order_count",
    "ord_success_flt_aboard_order_amount", "ord_success_flt_aboard_order_count",
    "ord_success_flt_order_amount", "ord_success_flt_order_count",
    "ord_success_htl_first_class_order_amount", "ord_success_htl_first_class_order_count",
    "ord_success_htl_aboard_order_amount", "ord_success_htl_aboard_order_count",
    "ord_success_htl_order_amount", "ord_success_htl_order_count",
    "ord_success_trn_order_amount", "ord_success_trn_order_count",
    "ord_success_trn_max_order_amount", "ord_total_order_amount", "voi_complaint_count",
    "voi_complrefund_count", "voi_comment_count", "acc_loginday_count", "fai_lackbalance",
    "bil_refundord_count", "bil_ordertype_count", "bil_platform_count", "bil_payord_count",
    "bil_paysord_count", "bil_payord_credit_count", "bil_paysord_credit_count",
    "bil_payord_debit_count", "bil_paysord_debit_count", "cap_tmoney_balance",
    "cap_wallet_balance",
)
# ----------------------------------------------------------------------------


def line_relation(t: dict[str, DataFrame]) -> DataFrame:
    """One row per order line with the customer key and the line attributes."""
    nation = t["nation"].select(F.col("n_nationkey"), F.col("n_regionkey"))
    cust = (t["customer"].select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("k"), F.col("n_regionkey").alias("c_region")))
    orders = (t["orders"]
              .select(F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("k"),
                      F.col("o_orderstatus").alias("st"), F.col("o_orderdate").cast("date").alias("odate"))
              .join(cust, "k"))
    p_type = F.col("p_type")
    part = t["part"].select(
        F.col("p_partkey").alias("pk"),
        F.when(p_type.isin(*LOB_FLIGHT_TYPES), "flt")
         .when(p_type.isin(*LOB_HOTEL_TYPES), "htl").otherwise("trn").alias("lob"),
        F.col("p_size").alias("psize"))
    supp = (t["supplier"].select("s_suppkey", "s_nationkey")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("sk"), F.col("s_nationkey").alias("city"),
                    F.col("n_regionkey").alias("s_region")))
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_returnflag").alias("rf"),
        F.col("l_shipdate").cast("date").alias("shipdate"))
    ln = lines.join(part, "pk").join(supp, "sk").join(orders, "ok")
    return ln.select(
        "k", "ok", "st", "sk", "pk", "city", "price", "disc", "rf", "psize", "lob",
        F.when(F.col("s_region") != F.col("c_region"), 1).otherwise(0).alias("ab"),
        F.datediff(F.lit(REFERENCE_DATE).cast("date"), F.col("odate")).alias("age"),
        F.datediff(F.col("shipdate"), F.col("odate")).alias("lead"),
    )


def _cnt(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _sum4(cond: Column, x: Column) -> Column:
    return F.round(F.sum(F.when(cond, x)), 4)


def _segments():
    """(name prefix, condition) of the amount/count pairs."""
    st, lob, ab = F.col("st"), F.col("lob"), F.col("ab")
    ok, fc = st == "F", F.col("psize") >= FIRST_CLASS_MIN_SIZE
    return [
        ("ord_success_order", ok),
        ("ord_success_first_class_order", ok & fc),
        ("ord_success_aboard_order", ok & (ab == 1)),
        ("ord_success_flt_first_class_order", ok & (lob == "flt") & fc),
        ("ord_success_flt_aboard_order", ok & (lob == "flt") & (ab == 1)),
        ("ord_success_flt_order", ok & (lob == "flt")),
        ("ord_success_htl_first_class_order", ok & (lob == "htl") & fc),
        ("ord_success_htl_aboard_order", ok & (lob == "htl") & (ab == 1)),
        ("ord_success_htl_order", ok & (lob == "htl")),
        ("ord_success_trn_order", ok & (lob == "trn")),
    ]


def line_aggregates(ln: DataFrame) -> DataFrame:
    """Plain per-customer aggregates of the line relation (one partially
    aggregated shuffle on the customer key)."""
    st, lob, rf = F.col("st"), F.col("lob"), F.col("rf")
    amt, age, lead = F.col("price") * (1 - F.col("disc")), F.col("age"), F.col("lead")
    ok = st == "F"
    r4 = lambda c: F.round(c, 4)
    aggs = [
        _cnt(rf == "R").alias("_n_returned"),
        F.count(F.lit(1)).alias("_n_lines"),
        F.max(age).alias("_max_age"),
        F.min(age).alias("_min_age"),
        _cnt(lob == "htl").alias("pro_htl_consuming_capacity"),
        F.max(F.when(lob == "htl", F.col("psize"))).alias("pro_htl_star_prefer"),
        F.round(F.avg(lead), 4).alias("pro_advanced_date"),
        F.round(F.sum(F.col("price") * F.col("disc")), 4).alias("pro_platform_profits"),
        F.max(F.when(ok, r4(amt))).alias("ord_success_max_order_amount"),
        F.round(F.avg(F.when(ok, lead)), 4).alias("ord_success_avg_leadtime"),
        _cnt(st == "P").alias("ord_cancel_order_count"),
        F.min(F.when(ok & (lob == "flt"), age)).cast("int").alias("ord_success_flt_last_order_days"),
        F.max(F.when(ok & (lob == "flt"), r4(amt))).alias("ord_success_flt_max_order_amount"),
        F.round(F.avg(F.when(ok & (lob == "flt"), 1 - F.col("disc"))), 6)
         .alias("ord_success_flt_avg_order_pricerate"),
        F.min(F.when(ok & (lob == "htl"), age)).cast("int").alias("ord_success_htl_last_order_days"),
        F.max(F.when(ok & (lob == "htl"), r4(amt))).alias("ord_success_htl_max_order_amount"),
        F.round(F.avg(F.when(ok & (lob == "htl"),
                             F.when(rf == "R", 1).otherwise(0).cast("double"))), 6)
         .alias("ord_success_htl_order_refund_ratio"),
        _cnt(ok & (lob == "htl") & (rf == "A")).alias("ord_success_htl_guarantee_order_count"),
        _cnt(ok & (lob == "htl") & (rf == "N")).alias("ord_success_htl_noshow_order_count"),
        _cnt((st == "P") & (lob == "htl")).alias("ord_cancel_htl_order_count"),
        F.min(F.when(ok & (lob == "trn"), age)).cast("int").alias("ord_success_trn_last_order_days"),
    ]
    for prefix, cond in _segments():
        aggs.append(_sum4(cond, amt).alias(f"{prefix}_amount"))
        aggs.append(_cnt(cond).alias(f"{prefix}_count"))
    # the lines of business are the three of line_relation
    kinds = [F.when(_cnt(ok & (lob == x)) > 0, 1).otherwise(0) for x in ("flt", "htl", "trn")]
    aggs += [
        (kinds[0] + kinds[1] + kinds[2]).cast("bigint").alias("ord_success_order_type_count"),
        F.max(F.when(ok & (lob == "trn"), r4(amt))).alias("ord_success_trn_max_order_amount"),
        F.round(F.sum(amt), 4).alias("ord_total_order_amount"),
        _cnt(rf == "R").alias("voi_complrefund_count"),
        _cnt((rf == "R") & (st == "O")).alias("bil_refundord_count"),
    ]
    return ln.groupBy("k").agg(*aggs)


def line_distinct_counts(ln: DataFrame, partitions: int | None = None) -> DataFrame:
    """The distinct counts per customer (see module notes): first each value of each
    column once, with the most that a line says of it, then the counts.

    The values of a customer lie in at most SLICES of the ``partitions`` (the session's
    shuffle partitions when not given): so few rows a customer are left to add up, and
    a customer that holds a third of all lines is still no single task's."""
    columns = ("ok", "sk", "pk", "city")
    done = F.col("st") == "F"
    level = F.when(done & (F.col("lob") == "flt"), 2).when(done, 1).otherwise(0)
    cells = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("bigint").alias("value")) for i, c in enumerate(columns)])
    rows = (ln.select("k", level.alias("level"), F.inline(cells))
            .withColumn("slice", F.pmod(F.hash("value"), F.lit(SLICES))))
    by = ("k", "slice")
    rows = rows.repartition(partitions, *by) if partitions else rows.repartition(*by)
    seen = rows.groupBy(*by, "which", "value").agg(F.max("level").alias("level"))

    def distinct(column: str, least: int = 0) -> Column:
        return F.count(F.when((F.col("which") == columns.index(column)) & (F.col("level") >= least), F.col("value")))

    return seen.groupBy("k").agg(
        distinct("ok").alias("_n_orders"),
        distinct("sk", 1).alias("ord_success_order_cmobile_count"),
        distinct("sk").alias("com_mobile_count"),
        distinct("pk").alias("com_passenger_count"),
        distinct("city").alias("com_idno_count"),
        distinct("city", 1).alias("ord_success_order_acity_count"),
        distinct("city", 2).alias("ord_success_flt_order_acity_count"))


def event_aggregates(events: DataFrame) -> DataFrame:
    et, v = F.col("event_type"), F.col("value")
    pay = et.isin("purchase", "click")
    buy = et == "purchase"
    ev = events.select(F.col("user_id").alias("k"), "ts", "event_type", "value")
    return ev.groupBy("k").agg(
        F.count(F.lit(1)).alias("pro_base_active"),
        _cnt(et == "error").alias("voi_complaint_count"),
        _cnt(et == "view").alias("voi_comment_count"),
        _cnt((et == "error") & (v > 100)).alias("fai_lackbalance"),
        _cnt(et == "signup").alias("bil_platform_count"),
        _cnt(pay).alias("bil_payord_count"),
        _cnt(buy).alias("bil_paysord_count"),
        _cnt(pay & (v >= 50)).alias("bil_payord_credit_count"),
        _cnt(buy & (v >= 50)).alias("bil_paysord_credit_count"),
        _cnt(pay & (v >= 200)).alias("bil_payord_debit_count"),
        _cnt(buy & (v >= 200)).alias("bil_paysord_debit_count"),
        F.round(F.sum(v), 2).alias("cap_tmoney_balance"),
    ).join(ev.groupBy("k").agg(
        F.expr("count(DISTINCT cast(ts AS date))").alias("acc_loginday_count"),
        F.expr("count(DISTINCT event_type)").alias("bil_ordertype_count"),
    ), "k", "left")   # both have the same keys; a left join goes where its columns are not read


def customer_columns(customer: DataFrame) -> DataFrame:
    ck, nk, bal = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    return customer.select(
        ck.alias("k"),
        ck.cast("string").alias("uid_uid"),
        (nk % 5).alias("uid_grade"),
        (ck % 2).alias("uid_emailvalid"),
        F.when(ck % 11 == 0, -1).when(ck % 13 == 0, 0).otherwise(5 + ck % 70).cast("int").alias("uid_age"),
        F.when(ck % 3 > 0, 1).otherwise(0).alias("uid_mobilevalid"),
        F.when(ck % 5 > 1, 1).otherwise(0).alias("uid_addressvalid"),
        F.when(ck % 7 > 2, 1).otherwise(0).alias("uid_isindentify"),
        (ck % 4).alias("uid_samemobile"),
        (ck % 3).alias("pro_generous_stingy_tag"),
        F.floor(bal / 100).cast("bigint").alias("pro_customervalue"),
        (nk % 3).alias("pro_phone_type"),
        bal.alias("pro_validpoints"),
        F.when(bal >= 0, bal).alias("cap_wallet_balance"),
    )


def build_feature_table(tables: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    """``lines``: an already materialized line relation (see
    ``materialize_feature_table``); computed from ``tables`` when omitted."""
    ln = lines if lines is not None else line_relation(tables)
    ev = event_aggregates(tables["events"])
    k = F.col("k")
    plain = line_aggregates(ln).select(
        "*",
        F.when(F.col("_n_returned") < RETURN_SHARE_GOOD * F.col("_n_lines"), 1).otherwise(0)
         .cast("int").alias("uid_flag"),
        F.when(k % 19 == 0, -1).otherwise(F.col("_max_age")).cast("bigint").alias("uid_authenticated_days"),
        F.when(k % 23 == 0, -1).otherwise(F.col("_max_age")).cast("bigint").alias("uid_signupdays"),
        F.floor(F.col("_max_age") / 30).cast("int").alias("uid_signmonths"),
        F.when(k % 29 == 0, -1).otherwise(F.col("_min_age")).cast("bigint").alias("uid_lastlogindays"),
    )
    # as many tasks as the lines ask for, so a task's groups do not grow with the table
    tasks = max(1, -(-tables["lineitem"].count() // LINES_PER_TASK))
    distinct = line_distinct_counts(ln, tasks).withColumn(
        "uid_dealorders", F.when(k % 17 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("_n_orders")))
    # a left join goes where none of its columns is read
    out = (customer_columns(tables["customer"]).join(plain, "k", "left").join(distinct, "k", "left")
           .join(ev, "k", "left"))
    zero_filled = {"pro_base_active", "voi_complaint_count", "voi_comment_count", "acc_loginday_count"}
    cols = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) if c in zero_filled else F.col(c)
            for c in FEATURE_COLUMNS]
    return out.select(*cols)


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_feature_table(load_tables(spark, sf_dir))


def materialize_feature_table(spark: SparkSession, sf_dir: str, path: str,
                              mode: str = "errorifexists", stage_lines: bool = True) -> DataFrame:
    """Write the feature table once (Parquet, in a shared folder) and return a
    scan of it: downstream views, fits and predictions then read pruned
    columns instead of re-running the star-schema joins, and the lineage is
    cut (a lost executor costs a re-read, not a re-join).

    ``stage_lines``: the line relation is written first (``<path>_lines``), so
    its three join shuffles run once and the plain and distinct aggregations
    each read only their columns from it -- instead of each branch re-running
    the joins.  The price is one write of the line relation; without it
    (``stage_lines=False``) the joins run twice."""
    from ratecraft.sources.schemas import feature_schema
    tables = load_tables(spark, sf_dir)
    lines = None
    if stage_lines:
        lines_path = f"{path.rstrip('/')}_lines"
        line_relation(tables).write.mode(mode).parquet(lines_path)
        lines = spark.read.parquet(lines_path)
    build_feature_table(tables, lines).write.mode(mode).parquet(path)
    return spark.read.schema(feature_schema()).parquet(path)
