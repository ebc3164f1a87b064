"""Benchmark: the six analysis steps end to end on the driver tables, the
steps one by one, and headline queries cold and warm.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans import workspace  # noqa: E402
from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.plans.steps import run_pipeline  # noqa: E402
from tillroll.session import drop_scratch, get_spark, scratch_path  # noqa: E402
from tillroll.sources.tables import retail_dirty  # noqa: E402

HEADLINE = ["rfm_log", "eda_kpis", "eda_weekday_hour", "segment_metrics", "classify_metrics", "score_rfm_fixed"]


def run_queries(spark, sf_dir: str) -> dict[str, float]:
    """Each headline query cold (nothing shared yet in the session) and again warm."""
    out = {}
    for name in HEADLINE:
        workspace.clear()
        for kind in ("cold", "warm"):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name if kind == "cold" else f"{name}_warm"] = round(time.time() - t, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    timings = {}
    # the end-to-end run, elbow sweep and every output included; steps overlap
    t0 = time.time()
    run_pipeline(spark, retail_dirty(spark, sf_dir), out_dir=scratch_path(spark, "bench-out"),
                 runs_path=scratch_path(spark, "bench-runs"), sweep=True)
    total = time.time() - t0
    # once more with each step built and written before the next: wall time by step
    serial = run_pipeline(spark, retail_dirty(spark, sf_dir), out_dir=scratch_path(spark, "bench-serial"),
                          runs_path=scratch_path(spark, "bench-runs"), sweep=True, serial=True)
    for k, v in serial["timings"].items():
        timings[f"serial_step_{k}"] = round(v, 3)
    timings["serial_total"] = round(sum(serial["timings"].values()), 3)
    timings.update(run_queries(spark, sf_dir))
    drop_scratch(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "end_to_end_seconds", "value": round(total, 3), "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
