"""Benchmark of the headline jobs.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each timed step is fully executed (written to the ``noop`` sink or a scratch
Parquet folder) -- nothing is collected to the driver.  One warm-up, then the
median of ``$BENCH_REPS`` runs; fits of all five modules, with the original
parameters, run once, at once, after a warm-up fit.  ``registered_*`` steps are the
registered queries as they are, from the driver's tables.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ratecraft.operators import evaluate as ev  # noqa: E402
from ratecraft.operators.outliers import fit_bounds  # noqa: E402
from ratecraft.plans import jobs  # noqa: E402
from ratecraft.plans.features import feature_table, materialize_feature_table  # noqa: E402
from ratecraft.plans.models import MODULE_MODELS, small_spec  # noqa: E402
from ratecraft.plans.queries import QUERIES  # noqa: E402
from ratecraft.plans.rule_scores import eval_frame  # noqa: E402
from ratecraft.plans.views import OUTLIER_COLUMNS, VIEWS, build_all_views, fit_view_bounds  # noqa: E402
from ratecraft.session import local_session, scratch_path, shared_dir  # noqa: E402
from ratecraft.sources.writers import ModelStore  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps=REPS, warmup=True):
    if warmup:
        fn()
    times = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main():
    spark = local_session(CPUS, "ratecraft-bench",
                          extra={"spark.sql.shuffle.partitions": str(int(CPUS) * 2)})
    shared_dir(spark)   # the session's spark.checkpoint.dir; a private folder only if unset
    q = {}
    cmp = {}   # alternative forms, reported but not part of the total

    # 1. feature table from the star schema (7 tables, joins + 60 aggregates)
    q["feature_table"] = timed(lambda: run(feature_table(spark, SF_DIR)))
    # the job form: written once to the shared folder, then read column-pruned
    t0 = time.perf_counter()
    ft = materialize_feature_table(spark, SF_DIR, scratch_path(spark, "features"))
    cmp["materialize_feature_table"] = round(time.perf_counter() - t0, 3)

    # 2. all five views from one scan and one projection (people: train bounds)
    pb = fit_view_bounds(ft, VIEWS["people"], rel_error=0.0)
    q["five_views_one_pass"] = timed(lambda: run(build_all_views(ft, "predict", bounds=pb)))

    # 3. bounds fitting: exact distributed quantiles vs GK sketch, 18 columns
    cols = list(OUTLIER_COLUMNS)
    q["fit_bounds_exact"] = timed(lambda: fit_bounds(ft, cols, "iqr", rel_error=0.0))
    q["fit_bounds_approx"] = timed(lambda: fit_bounds(ft, cols, "iqr", rel_error=0.1))
    # the original pattern for comparison: one quantile job per column
    cmp["fit_bounds_approx_per_column"] = timed(
        lambda: [fit_bounds(ft, [c], "iqr", rel_error=0.1) for c in cols], reps=1)

    # 4. evaluation curve + areas on a deterministic score
    q["threshold_curve_auc"] = timed(lambda: (run(ev.threshold_curve(eval_frame(ft))),
                                              ev.auc(eval_frame(ft)).collect()))

    # 5. the registered queries of the curve, the areas and the combination
    for name in ("threshold_curve", "classification_report", "combine_scores", "concat_positional"):
        q[f"registered_{name}"] = timed(lambda n=name: run(QUERIES[n](spark, SF_DIR)))

    # the same work in every round, whatever this repository does: the machine's speed
    cmp["calibration"] = timed(lambda: run(spark.range(200_000_000).selectExpr("sum(hash(id)) AS s")))

    # 6. training with the original parameters, saved; predicting (load model + bounds, score, write)
    store = ModelStore(scratch_path(spark, "models"))
    jobs.train(ft, "relation", small_spec("relation"))     # warm-up
    q["train_relation_full_params"] = timed(lambda: jobs.train(ft, "relation", MODULE_MODELS["relation"]), reps=2, warmup=False)
    t0 = time.perf_counter()
    jobs.train_all(ft, store=store)                        # five modules at once
    q["train_five_full_params"] = round(time.perf_counter() - t0, 3)
    # five concurrent jobs; one pass over the features with one table, and one job after another, for comparison
    q["predict_five"] = timed(lambda: jobs.predict_each_and_save(ft, store, mode="overwrite"), reps=2)
    cmp["predict_five_one_pass"] = timed(lambda: jobs.predict_all_and_save(ft, store, mode="overwrite"), reps=2)
    cmp["predict_five_separately"] = timed(lambda: [jobs.predict_and_save(ft, m, store, mode="overwrite") for m in jobs.MODULES], reps=1)

    # 7. combine the five persisted sub-score tables
    q["combine"] = timed(lambda: run(jobs.combine(spark, store)))

    total = round(sum(q.values()), 3)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": q,
                      "comparisons": cmp,
                      "sf": float(sf.group(1)) if sf else SF_DIR, "cpus": int(CPUS),
                      "shuffle_partitions": int(CPUS) * 2, "reps": REPS}))
    spark.stop()


if __name__ == "__main__":
    main()
