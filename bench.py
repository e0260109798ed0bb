"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local threads), BENCH_REPEATS.
Every query runs once cold, with remembered measurements and hot-key checks emptied; the reported
time is the median of the repeats after that, each with its full result consumed by a no-op sink.
The cold times are printed beside them (the JVM itself is warm from the queries before).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loanloom.operators import ordered, ranking  # noqa: E402
from loanloom.plans import registry  # noqa: E402
from loanloom.session import local_session  # noqa: E402

HEADLINE = [
    "agg1_portfolio_kpis", "agg3_segment_stats", "agg4_channel_stats", "agg6_product_stats",
    "agg11_monthly_kpis", "agg12_loan_rollup", "agg16_product_tier_pivot", "jn2_master",
    "jn3_attach_signals", "jn6_match_rate", "fe6_rolling_max", "fe12_min_cash_flow", "pan1_panel",
    "st1_roll_rates", "st2_information_value", "st3_cramers_v", "st4_spearman", "st5_kruskal",
    "st10_predefault_windows", "snk1_write_table", "ml1_training_checks", "ev1_roc_points", "ev2_auc", "ev4_ks", "ev7_confusion",
    "ev9_average_precision", "sc3_scorecard_summary", "pol4_escalations", "pol5_approval_stance",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    registry.load_all()
    spark = local_session(cpus, "loanloom-bench")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in HEADLINE:
        ranking._measured.clear()
        ordered._known_hot.clear()
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        cold[name] = round(runs[0], 3)
        times[name] = round(statistics.median(runs[1:]), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "cold_total": round(sum(cold.values()), 3), "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
