"""Bench: wall time of headline queries, one JSON line on stdout.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every
query is written to the noop sink, so all of its columns and rows are computed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helioframe.catalog import queries  # noqa: E402
from helioframe.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_constant_predictor",
    "t7_time_features",
    "t8_differences",
    "w1_forward_fill",
    "w2_backward_fill",
    "w3_fill_missing",
    "w3_fill_missing_split",
    "x1_group_split",
    "x2_row_split",
    "x3_subsample",
    "x4_vocabulary",
    "a2_scaler_fit",
    "a9_describe",
    "a14_model_report",
    "a15_two_head_loss",
    "a18_histogram",
    "a19_corr_matrix",
    "j1_fill_template",
    "j5_ensemble_aligned",
    "w4_early_stop",
    "w5_best_checkpoints",
    "w6_leaderboard",
    "s4_delivery_file",
    "m13_prepared_features",
    "m3_hurdle_job",
    "m7_robust_linear",
    "m8_two_head_linear",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    known = queries()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.count()
    # One untimed pass over a small query starts the workers and the code cache.
    known["t7_time_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.time()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "rows_per_sec": {n: round(rows / t) for n, t in times.items() if t > 0},
                "rows": rows,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
