"""Time the headline queries and print one JSON line.

Each query is planned and run completely (into a sink that discards rows), twice; the
faster run counts. `jobs` has the Spark jobs of one run, those of planning included.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from checks import registry  # noqa: E402
from checks.compare import session  # noqa: E402

HEADLINE = (
    "flagship_user_churn", "R5_totals", "W6_rolling_all", "W8_slopes", "W15_deciles", "T4_churn_targets",
    "C5_low_cardinality_sorted", "U2_append_month_by_period", "K7_exact_undersample", "E1_best_gain",
    "E4_threshold_sweep", "E5_top_n_sweep", "E7_select_top", "E12_ensemble_report", "E15_distribution",
    "J4_align_studies", "D1_null_shares", "D6_psi_ranking", "S7_parquet_sink", "M1_fit_and_score", "M3_study_scores",
    "recipe_late_features",
)


def run(spark, name: str, sf_dir: str) -> float:
    spark.sparkContext.setJobGroup(name, name)
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = session(cpus, cpus)
    run(spark, "W18_row_index", sf_dir)
    times, jobs = {}, {}
    for name in HEADLINE:
        first = run(spark, name, sf_dir)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        times[name] = round(min(first, run(spark, name, sf_dir)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "jobs": jobs, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
