"""Benchmark the headline queries.

Runs one untimed warm-up round over all queries, then each query ``BENCH_REPEATS``
(default 3) times, and reports the median wall time. Results are fully materialised through Spark's ``noop`` sink,
so nothing is collected to the driver. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEATS (default 3), BENCH_QUERIES (comma list, optional)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickroll.plans import catalog  # noqa: E402
from clickroll.session import build_session  # noqa: E402

HEADLINE = ["session_features_v1", "session_features_v2", "session_features_v2_orders",
            "labels_first_per_session", "fold_encodings", "baseline_cv", "blend_two",
            "gbt_fulltrain", "gbt_group_cv"]


def accuracy(spark, sf_dir: str) -> dict:
    """Model check (untimed): 5-fold group CV MSE of the boosted trees vs the global-mean
    predictor on the same folds, both on the log1p target."""
    from clickroll.operators import ensemble, folds
    from clickroll.plans import modeling
    src = catalog._src(spark, sf_dir)
    params = catalog._gbt_params()
    sc = modeling.cv_scores(src, k=5, seeds=(42,), params=params, fold_method="group", fold_seed=42)
    gbt = ensemble.fold_scores(sc).agg({"mse": "avg"}).first()[0]
    fr, _ = modeling.model_frames(src)
    base = folds.baseline_cv(folds.group_folds(fr, "user_id", 5, 42), "y").first()["cv_mean_mse"]
    return {"gbt_cv_mse_log": round(gbt, 6), "mean_baseline_cv_mse_log": round(base, 6)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(f"local[{cpus}]", app_name="clickroll-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    def run(name):
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:          # one warm-up round over all queries (JIT, caches), untimed
        run(name)
    timings = {name: round(statistics.median(run(name) for _ in range(repeats)), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    acc = accuracy(spark, sf_dir) if os.environ.get("BENCH_ACCURACY", "1") == "1" else {}
    print(json.dumps({"metric": "headline_total_median_wall", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": m.group(1) if m else sf_dir,
                      "cpus": cpus, "repeats": repeats, "accuracy": acc}))
    spark.stop()


if __name__ == "__main__":
    main()
