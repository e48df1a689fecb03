"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every query
runs once to warm code generation and once for the clock; all rows are computed (noop sink).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from accountwise.plans.registry import registered  # noqa: E402
from accountwise.session import local_session  # noqa: E402

HEADLINE = (
    "m8_fact_ml_churn", "m9_fact_ml_cross_sell", "m10_mart_clv_analytics", "f1_rfm", "f2_trajectory", "f3_service",
    "f4_support", "f5_policy", "f6_assemble_features", "l1_clv_labels", "c4_regression_metrics",
    "c7_clv_percentile", "vs2_kaplan_meier", "vs6_concordance", "g6_cluster_profiles", "x3_ranking_metrics",
    "x5_recommendations", "v4_account_profile", "v5_segment_overview", "v8_clv_by_tier",
    "b4_churn_arr_decomposition", "b5_arr_and_pipeline_by_month", "b14_out_of_policy_ribbon", "t1_windowed_activity",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "accountwise-bench")
    runs = registered()
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
