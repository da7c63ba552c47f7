"""Benchmark the headline queries.

Runs the queries of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``; each query is executed in
full through the ``noop`` sink (no driver collect), warm, median of
``$BENCH_REPEAT`` runs (default 3). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


# Headline queries: one or more per SURVEY section (source, EDA, evaluation,
# decisions, what-if, serving joins, streaming, text).
HEADLINE = [
    "s4_member_snapshot",
    "slice_archetype_tier_mix",
    "a3_describe",
    "a14_correlation_matrix",
    "w1_kaplan_meier",
    "m15_compute_metrics",
    "m17_cost_threshold",
    "d5_recommend",
    "q4_q5_cheapest_lever_uplift",
    "q6_uplift_panel",
    "j1_j2_u3_customers_with_latest_score",
    "w8_top3_reference_drivers",
    "t3_weekly_engagement",
    "f19_normalize_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from churnwise.session import get_spark
    from churnwise.plans.registry import load_all

    spark = get_spark(f"local[{cpus}]", "churnwise-bench", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    names = only or [n for n in HEADLINE if n in reg]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(names[0])  # warm the JVM, the parquet footers and the code cache
    timings = {}
    for n in names:
        timings[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
